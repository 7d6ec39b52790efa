"""Lenient text -> typed value coercions that never fail on bad input."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from cleanroom.functions.text import clean_text, first_match, strip

# Fixed values -------------------------------------------------------------
LOAN_STATUS = {
    "DEVUELTO": "DEVUELTO",
    "PENDIENTE": "ACTIVO",
    "ACTIVO": "ACTIVO",
    "ATRASADO": "VENCIDO",
    "VENCIDO": "VENCIDO",
}
DEFAULT_STATUS = "ACTIVO"
DEFAULT_RATING = 3
RATING_RANGE = (1, 5)
FINE_GRACE_DAYS = 15
FINE_PER_DAY = 1500
INT4_MAX = 2147483647
# Longest digit string that Python turns into an integer.
MAX_INT_DIGITS = 4300
# --------------------------------------------------------------------------

_DAY = r"(?:3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])"
_MONTH = r"(?:1[0-2]|0[1-9]|[1-9])"
_YEAR = r"(?!0000)[0-9]{4}"

_WHOLE_CLOCK = (
    r"(?:[01][0-9]|2[0-3])(?:(?::[0-5][0-9]){1,2}|(?:[0-5][0-9]){1,2})?"
)
_CLOCK = rf"{_WHOLE_CLOCK}(?:[.,][0-9]+)?"
# Python lets one stray character stand between a clock and its zone.
_STRAY = rf"(?:{_WHOLE_CLOCK}|{_WHOLE_CLOCK}[.,][0-9]{{6,}})[\x00-\x7f&&[^+Z-]]"
_ZONE = rf"(?:Z|[+-]{_CLOCK})"
_TIME = rf"(?s:.(?:{_CLOCK}{_ZONE}?|{_STRAY}{_ZONE}))?"


@lru_cache(maxsize=1)
def _digit_table() -> tuple[str, str]:
    """Decimal digits of all scripts beside their ASCII forms."""
    pairs = [
        (chr(code), str(unicodedata.decimal(chr(code))))
        for code in range(0x80, 0x110000)
        if unicodedata.decimal(chr(code), None) is not None
    ]
    return "".join(p[0] for p in pairs), "".join(p[1] for p in pairs)


def parse_int(c: Column) -> Column:
    """Whole number as Python's ``int()`` reads text, as ``decimal(38,0)``.

    Surrounding white space, a sign and single ``_`` between digits are fine;
    anything else is null.  Values beyond 38 digits saturate.
    """
    number = first_match(
        F.translate(strip(c), *_digit_table()), r"^[+-]?[0-9]+(?:_[0-9]+)*\z"
    )
    plain = F.regexp_replace(number, "[+_]+", "")
    readable = first_match(plain, rf"^-?[0-9]{{1,{MAX_INT_DIGITS}}}\z")
    short = F.regexp_replace(readable, r"^(-?)0+(?=[0-9])", "$1")
    capped = F.regexp_replace(short, r"^(?<sign>-?)[0-9]{39,}\z", "${sign}" + "9" * 38)
    return capped.try_cast("decimal(38,0)")


def parse_date(c: Column) -> Column:
    """First of Y-m-d, d/m/Y, m/d/Y, d/m/y that gives a real calendar day.

    The slashed forms are rewritten in that order; a text that one of them took
    no longer has slashes.  d/m/Y on an impossible day never fits m/d/Y, since
    only days above 28 are impossible.
    """
    text = clean_text(c)
    for pattern, iso in (
        (rf"^({_DAY})/({_MONTH})/({_YEAR})\z", "$3-$2-$1"),
        (rf"^({_MONTH})/({_DAY})/({_YEAR})\z", "$3-$1-$2"),
        (rf"^({_DAY})/({_MONTH})/([0-5][0-9]|6[0-8])\z", "20$3-$2-$1"),
        (rf"^({_DAY})/({_MONTH})/([0-9]{{2}})\z", "19$3-$2-$1"),
    ):
        text = F.regexp_replace(text, pattern, iso)
    dashed = first_match(text, rf"^{_YEAR}-{_MONTH}-{_DAY}\z")
    return F.regexp_replace(dashed, "- ?([1-9])(?![0-9])", "-0$1").try_cast("date")


def is_iso_date(c: Column) -> Column:
    """Whether text is an ISO 8601 date or date-time as Python reads it."""
    calendar = F.regexp_replace(
        c, rf"^({_YEAR})(?:-([0-9]{{2}})-([0-9]{{2}})|([0-9]{{2}})([0-9]{{2}})){_TIME}\z", "$1-$2$4-$3$5"
    )
    day = first_match(calendar, r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}\z").try_cast("date")
    week = r"W(?:0[1-9]|[1-4][0-9]|5[0-2])"
    by_week = c.rlike(rf"^{_YEAR}(?:-{week}(?:-[1-7])?|{week}[1-7]?){_TIME}\z")
    # 28 December lies in the last week of its year.
    long_year = first_match(c, rf"^({_YEAR})(?:-W53(?:-[1-7])?|W53[1-7]?){_TIME}\z", 1)
    last_week = F.weekofyear(F.concat(long_year, F.lit("-12-28")).try_cast("date"))
    return F.coalesce(day.isNotNull() | by_week | F.coalesce(last_week == 53, F.lit(False)), F.lit(False))


def loan_status(c: Column) -> Column:
    """Map a free-text status to the three stored ones."""
    key = F.upper(strip(c))
    out = F.lit(DEFAULT_STATUS)
    for raw, stored in LOAN_STATUS.items():
        out = F.when(key == raw, F.lit(stored)).otherwise(out)
    return out


def quantity(c: Column) -> Column:
    """Stock level: whole number, at least 0; unreadable text counts as 0."""
    zero = F.lit(0).cast("decimal(38,0)")
    return F.greatest(F.coalesce(parse_int(c), zero), zero)


def rating(c: Column) -> Column:
    """Stars from 1 to 5; text before the first slash counts."""
    low, high = RATING_RANGE
    stars = F.coalesce(
        parse_int(F.split_part(c, F.lit("/"), F.lit(1))),
        F.lit(DEFAULT_RATING).cast("decimal(38,0)"),
    )
    return F.least(F.greatest(stars, F.lit(low)), F.lit(high)).cast("int")


def user_position(c: Column) -> Column:
    """1-based position of the reviewer; unreadable references mean the first."""
    # ``least`` and ``greatest`` skip nulls, so the default comes first.
    n = F.coalesce(parse_int(c), F.lit(1).cast("decimal(38,0)"))
    bounded = F.least(F.greatest(n, F.lit(1)), F.lit(2**62).cast("decimal(38,0)"))
    return bounded.cast("bigint")


def loan_fine(checkout: Column, returned: Column, as_of: Column) -> Column:
    """Late fee: per day beyond the grace period; 0 for an unknown loan."""
    late = F.datediff(F.coalesce(returned, as_of), checkout) - FINE_GRACE_DAYS
    return F.coalesce(F.greatest(late, F.lit(0)), F.lit(0)).cast("bigint") * FINE_PER_DAY
