"""Literal examples and seeded differential tests of the column functions."""

import datetime
import hashlib
import random
import re
import unicodedata
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cleanroom.functions import coerce, masking, text


def apply(spark, values, expression):
    """Evaluate ``expression(F.col('v'))`` over ``values``, in order."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, v string")
    return [r.out for r in df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


def random_texts(alphabet, n=3000, longest=12, seed=5):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, longest))) for _ in range(n)]


def differ(spark, values, expression, model):
    got = apply(spark, values, expression)
    return [(v, g, model(v)) for v, g in zip(values, got) if g != model(v)]


def test_split_category(spark):
    values = ["Tecnología|Libros de programación", "Ciencia", None, "", "Novela|Drama|Clásico"]
    names = apply(spark, values, lambda c: text.split_category(c)[0])
    notes = apply(spark, values, lambda c: text.split_category(c)[1])
    assert names == ["Tecnología", "Ciencia", "Sin categoría", "Sin categoría", "Novela"]
    assert notes == ["Libros de programación", *["Sin descripción"] * 3, "Drama|Clásico"]


def test_loan_status(spark):
    values = ["Devuelto", "  devuelto ", "Pendiente", "PENDIENTE", "Atrasado", "   atrasado  \t", None, "Estado raro"]
    assert apply(spark, values, coerce.loan_status) == [
        "DEVUELTO", "DEVUELTO", "ACTIVO", "ACTIVO", "VENCIDO", "VENCIDO", "ACTIVO", "ACTIVO",
    ]


def test_clean_text(spark):
    values = ["   GABRIEL GARCÍA MÁRQUEZ  \t ", "n/a", " NaN", "null ", "None", "", None, "nulls"]
    assert apply(spark, values, lambda c: text.clean_text(c, "x", title=True)) == [
        "Gabriel García Márquez", "x", "x", "x", "x", "x", "x", "Nulls",
    ]
    spaces = ["a\xa0\xa0b", "a  \t b", "\x1ca\x1f"]
    assert apply(spark, spaces, text.clean_text) == ["a b", "a b", "a"]


def test_title_case_matches_python(spark):
    fixed = ["saint-exupéry", "o'neil", "1ª edición", "ÑANDÚ", "a1b2"]
    assert apply(spark, fixed, text.title_case) == [v.title() for v in fixed]
    assert not differ(spark, random_texts("abXYéÉñß中λдª-'0 _"), text.title_case, str.title)


def python_fold(value):
    folded = unicodedata.normalize("NFD", value or "").encode("ascii", "ignore").decode()
    return re.sub(r"\s+", " ", folded.lower()).strip()


def test_fold_and_block_key(spark):
    values = ["HOLA", "Canción", "El   libro", None, ""]
    assert apply(spark, values, text.fold) == ["hola", "cancion", "el libro", "", ""]
    titles = ["Cien años de soledad", "Ángeles caídos", "", "Hamlet", None]
    assert apply(spark, titles, text.block_key) == ["cien", "angeles", "__empty__", "hamlet", "__empty__"]
    assert not differ(spark, random_texts("aÉñøßK \t\xa0ǎ́"), text.fold, python_fold)


def test_emails(spark):
    rows = [
        (0, "ana.mar_libros_at_email.com", "Ana Martínez"),
        (1, None, "María García"),
        (2, "correo_malformado", "Juan"),
        (3, " A.B at C.co ", "x"),
        (4, None, "***"),
    ]
    df = spark.createDataFrame(rows, "i int, mail string, name string")
    out = df.select("i", text.normalize_email(F.col("mail"), F.col("name")).alias("m")).orderBy("i").collect()
    assert [r.m for r in out] == [
        "ana.mar_libros@email.com", "maria.garcia@sin-correo.local", "juan@sin-correo.local",
        "a.b@c.co", "usuario.desconocido@sin-correo.local",
    ]
    assert apply(spark, ["a@b.c1", "a@b.co", "A%@B.CO"], text.storable_email) == [False, True, True]


def python_date(value):
    value = re.sub(r"\s+", " ", value).strip()
    for pattern in ("%Y-%m-%d", "%d/%m/%Y", "%m/%d/%Y", "%d/%m/%y"):
        try:
            return datetime.datetime.strptime(value, pattern).date()
        except ValueError:
            pass
    return None


def dates(n=3000, seed=9):
    rnd = random.Random(seed)
    shapes = [
        "{y:04}-{m:02}-{d:02}", "{y:04}-{m}-{d}", "{d}/{m}/{y:04}", "{m}/{d}/{y:04}",
        "{d:02}/{m:02}/{s:02}", "{y:04}{m:02}{d:02}", "{y:04}-W{w:02}-{k}", "{y:04}W{w:02}{k}", "{y:04}-W{w:02}",
    ]
    tails = ["", "", "T12", " 12:30", "T12:30:15.5", "é12", " 24:00", "T12:30Z", "T12:30+05:30", "T12:30 +05", "T12:3"]
    return [
        rnd.choice(shapes).format(
            y=rnd.choice([0, 1, 1900, 2000, 2020, 2024, 2026]), m=rnd.randint(0, 13), d=rnd.randint(0, 32),
            s=rnd.randint(0, 99), w=rnd.choice([0, 1, 52, 53, 54]), k=rnd.randint(0, 8),
        ) + rnd.choice(tails)
        for _ in range(n)
    ]


def test_parse_date(spark):
    values = ["1/2/2024", "12/31/2024", "1/2/69", "1/2/68", "2024-1-5", "31/02/2024", "N/A", "2024-01-05 00:00:00"]
    day = datetime.date
    assert apply(spark, values, coerce.parse_date) == [
        day(2024, 2, 1), day(2024, 12, 31), day(1969, 2, 1), day(2068, 2, 1), day(2024, 1, 5), None, None, None,
    ]
    assert not differ(spark, dates(), coerce.parse_date, python_date)


def python_iso(value):
    try:
        datetime.datetime.fromisoformat(value)
        return True
    except ValueError:
        return False


def test_is_iso_date(spark):
    values = ["2024-01-01", "20240101", "2024-W01-1", "2020-W53-1", "2024-W53-1", "2024-1-5", "2024", "01/02/2024", ""]
    assert apply(spark, values, coerce.is_iso_date) == [True, True, True, True, False, False, False, False, False]
    assert not differ(spark, dates(seed=10), coerce.is_iso_date, python_iso)


def python_int(value):
    try:
        number = int(value)
    except ValueError:
        return None
    return Decimal(max(min(number, 10**38 - 1), 1 - 10**38))


def test_parse_int(spark):
    values = ["1_000", " 12 ", "+5", "12.7", "Diez", "", "9" * 50, "-" + "9" * 39, "0" * 60 + "5", "9" * 4301, "٣"]
    assert not differ(spark, values, coerce.parse_int, python_int)
    assert not differ(spark, random_texts("0129_+- a", longest=6), coerce.parse_int, python_int)


def test_rating_quantity_position(spark):
    stars = ["5/5", "Cinco", "2-5", "10/5", "3", "0", "", None]
    assert apply(spark, stars, coerce.rating) == [5, 3, 3, 5, 3, 1, 3, 3]
    stock = ["Diez", "-5", "7", None, "12.7", "1_000"]
    assert apply(spark, stock, lambda c: coerce.quantity(c).cast("int")) == [0, 0, 7, 0, 0, 1000]
    users = ["Usuario_Desconocido", None, "0", "-3", " 4 ", "9" * 30]
    assert apply(spark, users, coerce.user_position) == [1, 1, 1, 1, 4, 2**62]


@pytest.mark.parametrize(
    ("checkout", "returned", "fine"),
    [
        ("2024-01-01", "2024-01-16", 0), ("2024-01-01", "2024-01-11", 0), ("2024-01-01", "2024-01-17", 1500),
        ("2024-01-01", "2024-01-26", 15000), ("2024-03-01", "2024-04-15", 45000), (None, None, 0),
        ("2024-05-12", None, 7500),
    ],
)
def test_loan_fine(spark, checkout, returned, fine):
    date = lambda v: F.lit(v).cast("date")
    got = spark.range(1).select(coerce.loan_fine(date(checkout), date(returned), date("2024-06-01"))).first()[0]
    assert got == fine


def python_mask(value):
    if not value or "@" not in value or value.startswith("@"):
        return hashlib.sha256((value or "").encode()).hexdigest()
    local, domain = value.split("@", 1)
    stars = "*" * max(len(local) - 1, 3) if len(local) <= 2 else "*" * (len(local) - 2) + local[-1]
    return f"{local[0]}{stars}@{domain}"


def test_mask_email(spark):
    fixed = ["maria.lopez@correo.com", "ab@x.com", "a@correo.com", "zorro@example.com", "", "sinArroba", None, "@x"]
    assert not differ(spark, fixed, masking.mask_email, python_mask)
    assert not differ(spark, random_texts("ab@.é", longest=7), masking.mask_email, python_mask)
    hashed = apply(spark, ["a@b.co"], lambda c: masking.mask_email(c, mode="hash"))
    assert hashed == [hashlib.sha256(b"a@b.co").hexdigest()]


def test_export_values(spark):
    df = spark.sql(
        "SELECT timestamp'2024-01-02 08:30:45' AS fecha_salida, timestamp'2024-01-02 08:30:45' AS fecha_resena, "
        "date'2024-01-02' AS fecha_publicacion, '  USER@EMAIL.COM ' AS correo, cast(null as date) AS fecha_x, 1 AS n"
    )
    assert tuple(masking.export_frame(df).first()) == (
        "02/01/2024", "02/01/2024 08:30:45", "02/01/2024",
        hashlib.sha256(b"user@email.com").hexdigest(), None, 1,
    )


def test_masking_reads_a_run_once_and_keeps_what_follows_an_address(spark):
    from time import monotonic

    texts = ["ana@b.com_c@d.org", "x@y.io ana.b@c.com", "@b.com a@b", "", None, "x." * 50_000 + " luis@b.com"]
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, s string")
    start = monotonic()
    masked = [r.m for r in rows.select("n", masking.mask_emails_in(F.col("s")).alias("m")).orderBy("n").collect()]
    assert monotonic() - start < 30
    assert masked == ["a*a@b.com_***@d.org", "x***@y.io a***b@c.com", "@b.com a@b", "", None, "x." * 50_000 + " l**s@b.com"]
