"""Quality rules by distribution divergence.

Two histograms of a text, one over character classes and one over the common words of
its language, are compared with language references by the Jensen-Shannon distance.
The references come from the whole corpus: a word is common if it makes up at least
``common_share`` of its language's words, so a language has at most 1 / common_share of
them, whatever the corpus holds.  They are found exactly in two passes.  A word of that
share reaches half of it in blocks that hold half of its language's words or more, so
words below half the share of a block need not leave the block, and few candidates are
left to be counted in full.  Candidates and references are tables with a row of bounded
size per language, joined to the texts by language: Spark broadcasts them while they are
small and splits a hot language otherwise, and a task holds those of few languages at a
time, however many values the column has.

Defined cases: a null or empty text has no words and fails the base rules; a text with a
null language has no reference, so the base rules alone judge it; a text shorter
than ``min_chars`` characters or ``min_words`` words is not judged by a histogram;
repeated rows are judged alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cleanroom.llm.common import folded, settle, text_chunks
from cleanroom.llm.kernels import SPACE, mixed, per_row, rows_of, word_codes, words

SYMBOLS = b"#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "space", "newline", "stop", "pause", "symbol", "other_ascii", "beyond_ascii")
BASE_SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " base_failed boolean, kept boolean, class_distance double, word_distance double"
)


@dataclass(frozen=True)
class Rules:
    """Thresholds; the distances are square roots of base-2 divergences (0 to 1).

    Clean labelled texts of 50 words or more stay below 0.30 and 0.40.
    """

    common_share: float = 0.002
    max_class_distance: float = 0.32
    max_word_distance: float = 0.45
    min_chars: int = 200
    min_words: int = 50


def class_table() -> np.ndarray:
    """The character class of each byte; bytes that continue a character have none (-1)."""
    out = np.full(256, CLASSES.index("other_ascii"), np.int64)
    out[128:192] = -1
    out[192:] = CLASSES.index("beyond_ascii")
    for name, members in (
        ("lower", range(97, 123)), ("upper", range(65, 91)), ("digit", range(48, 58)), ("space", b" \t\v\f\r"),
        ("newline", b"\n"), ("stop", b".?!"), ("pause", b",;:-'\"()"), ("symbol", SYMBOLS),
    ):
        out[list(members)] = CLASSES.index(name)
    return out


def class_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows by character classes."""
    kind = class_table()[data]
    cell = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets)) * len(CLASSES) + kind
    counts = np.bincount(cell[kind >= 0], minlength=(len(offsets) - 1) * len(CLASSES))
    return counts.reshape(-1, len(CLASSES))


def base_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of the base rules, per row."""
    starts, ends, bounds = words(data, offsets)
    in_word = ~SPACE[data] & ((data & 0xC0) != 0x80)
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    codes, row = word_codes(data, starts, ends), rows_of(bounds)
    repeats = np.zeros(len(starts) + 2, bool)
    if len(starts) > 2:
        window = mixed(mixed(mixed(codes[:-2]) + codes[1:-1]) + codes[2:])
        key = mixed(window + row[:-2].astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
        whole = np.flatnonzero(row[:-2] == row[2:])
        order = whole[np.argsort(key[whole])]
        same = key[order[1:]] == key[order[:-1]]
        found = np.concatenate([order[1:][same], order[:-1][same]])
        for i in range(3):
            repeats[found + i] = True
    lines = np.zeros(len(offsets) - 1, np.int64)
    raw = data.tobytes()
    for i in range(len(lines)):
        seen = set()
        for line in raw[offsets[i] : offsets[i + 1]].split(b"\n"):
            if line in seen:
                lines[i] += 1
            elif line.strip():
                seen.add(line)
    return {
        "n_words": np.diff(bounds),
        "word_chars": per_row(in_word, offsets),
        "n_symbols": per_row(symbol[data], offsets),
        "n_dup_lines": lines,
        "n_repeat_words": per_row(repeats[: len(starts)], bounds),
    }


def _inputs(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
        *[F.col(c).alias(f"_{c}") for c in more],
    )


def _word_counts(docs: DataFrame, share: float, most: int = 200_000) -> DataFrame:
    """Per language and block of words: words of at least ``share`` of the block, and the block's size.

    A row without a word holds the size.
    """

    def count(batches):
        held: dict[str | None, Counter] = {}

        def flush():
            rows = []
            for lang, counts in held.items():
                total = sum(counts.values())
                rows.append((lang, None, total))
                rows += [(lang, w, n) for w, n in counts.items() if n >= share * total]
            held.clear()
            columns = list(zip(*rows)) or [(), (), ()]
            kinds = (pa.string(), pa.binary(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["lang", "word", "n"])

        for batch in batches:
            langs = batch.column(1).to_pylist()
            for first, _, data, offsets in text_chunks(batch.column(0)):
                raw = data.tobytes()
                for i in range(len(offsets) - 1):
                    held.setdefault(langs[first + i], Counter()).update(raw[offsets[i] : offsets[i + 1]].split())
            if sum(map(len, held.values())) > most:
                yield flush()
        yield flush()

    return docs.select("text", "lang").mapInArrow(count, "lang string, word binary, n long")


class Held:
    """What a task keeps per language, made from the first row of it; begun anew when full."""

    def __init__(self, make, most: int = 64):
        self.make, self.most, self.kept = make, most, {}

    def get(self, lang: str, *row):
        if lang not in self.kept:
            if len(self.kept) >= self.most:
                self.kept.clear()
            self.kept[lang] = self.make(*(x.as_py() for x in row))
        return self.kept[lang]


def reference_table(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """A row per language with words: ``classes``, the share of each character class, and
    ``words`` with their ``shares``, the common words in the order of their bytes; over all documents.
    """
    docs = _inputs(docs)
    blocks = _word_counts(docs, rules.common_share / 2).groupBy("lang", "word").agg(F.sum("n").alias("n"))
    blocks = settle(blocks.where("lang is not null"), "blocks")
    sizes = blocks.where("word is null and n > 0").select("lang", F.col("n").alias("total"))
    likely = blocks.where("word is not null").join(sizes, "lang").where(F.col("n") >= F.col("total") * (rules.common_share / 2))
    # A language whose words are all rare has a row without candidates.
    wanted = sizes.join(likely.groupBy("lang").agg(F.collect_list("word").alias("wanted")), "lang", "left")
    wanted = settle(wanted.select("lang", "total", F.coalesce("wanted", F.array().cast("array<binary>")).alias("wanted")), "candidates")

    def count(batches, most: int = 200_000):
        held = Held(frozenset)
        classes: dict[str, np.ndarray] = {}
        found: dict[str, Counter] = {}

        def flush():
            rows = [(k, CLASSES[i].encode(), True, int(n)) for k, c in classes.items() for i, n in enumerate(c) if n]
            rows += [(k, w, False, n) for k, c in found.items() for w, n in c.items()]
            classes.clear()
            found.clear()
            kinds = {"lang": pa.string(), "key": pa.binary(), "is_class": pa.bool_(), "n": pa.int64()}
            columns = zip(list(zip(*rows)) or [()] * 4, kinds.items())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in columns], list(kinds))

        for batch in batches:
            langs = batch.column(1).to_pylist()
            for first, _, data, offsets in text_chunks(batch.column(0)):
                raw, counts = data.tobytes(), class_counts(data, offsets)
                for i in range(len(offsets) - 1):
                    lang = langs[first + i]
                    words_of = held.get(lang, batch.column(2)[first + i])
                    classes[lang] = classes.get(lang, 0) + counts[i]
                    found.setdefault(lang, Counter()).update(filter(words_of.__contains__, raw[offsets[i] : offsets[i + 1]].split()))
            if sum(map(len, found.values())) + len(CLASSES) * len(classes) > most:
                yield flush()
        yield flush()

    texts = docs.join(wanted, "lang").select("text", "lang", "wanted")
    counted = texts.mapInArrow(count, "lang string, key binary, is_class boolean, n long")
    counted = counted.groupBy("lang", "key", "is_class").agg(F.sum("n").alias("n")).join(wanted.drop("wanted"), "lang")
    common = ~F.col("is_class") & (F.col("n") >= F.lit(rules.common_share) * F.col("total"))
    word = F.struct(F.col("key").alias("word"), (F.col("n") / F.col("total")).alias("share"))
    of_class = [F.sum(F.when(F.col("is_class") & (F.col("key") == F.lit(c.encode())), F.col("n")).otherwise(0)) for c in CLASSES]
    rows = counted.groupBy("lang").agg(
        F.array(*of_class).alias("counts"), F.sum(F.when(F.col("is_class"), F.col("n"))).alias("chars"),
        F.array_sort(F.collect_list(F.when(common, word))).alias("common"),
    )
    share = F.transform("counts", lambda n: F.coalesce(n / F.col("chars"), F.lit(0.0)))
    return rows.select("lang", share.alias("classes"), F.col("common.word").alias("words"), F.col("common.share").alias("shares"))


def references(docs: DataFrame, rules: Rules = Rules()) -> dict[str, tuple[list[float], dict[bytes, float]]]:
    """The reference table as a mapping on the driver, to look at; ``judge`` does not use it."""
    rows = reference_table(docs, rules).collect()
    return {r.lang: (list(r.classes), {bytes(w): s for w, s in zip(r.words, r.shares)}) for r in rows}


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two distributions: the root of the base-2 divergence."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        terms = np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)
    return float(np.sqrt(max(terms.sum() / 2, 0)))


def judge(docs: DataFrame, rules: Rules = Rules(), *more: str) -> DataFrame:
    """Base counts, distances and verdict of every document; columns named in ``more`` come along as ``_name``."""
    rows = _inputs(docs, *more)
    names = [x.split()[0] for x in BASE_SCHEMA.split(", ")] + [f"_{c}" for c in more]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    refs = settle(reference_table(docs, rules), "references")
    rows = rows.join(refs, "lang", "left").select("doc_id", "text", "lang", "classes", "words", "shares", *names[len(names) - len(more) :])

    def prepared(classes, common, shares):
        return np.array(classes), {w: i for i, w in enumerate(common)}, np.append(shares, max(0.0, 1 - np.sum(shares)))

    def score(batches):
        held = Held(prepared)
        for batch in batches:
            ids, langs, known = batch.column(0), batch.column(2).to_pylist(), batch.column(3).is_valid().to_pylist()
            for first, last, data, offsets in text_chunks(batch.column(1)):
                base, counts, raw = base_counts(data, offsets), class_counts(data, offsets), data.tobytes()
                n = base["n_words"]
                failed = (n < 50) | (100 * base["n_repeat_words"] > 50 * n)
                far = np.full((2, last - first), np.nan)
                for i in range(last - first):
                    if not known[first + i]:
                        continue
                    classes, place, shares = held.get(langs[first + i], *(batch.column(k)[first + i] for k in (3, 4, 5)))
                    chars = counts[i].sum()
                    if chars >= rules.min_chars:
                        far[0, i] = distance(counts[i] / chars, classes)
                    if n[i] >= rules.min_words:
                        own = raw[offsets[i] : offsets[i + 1]].split()
                        hist = np.zeros(len(shares))
                        for w, c in Counter(filter(place.__contains__, own)).items():
                            hist[place[w]] = c
                        hist[-1] = len(own) - hist.sum()
                        far[1, i] = distance(hist / len(own), shares)
                with np.errstate(invalid="ignore"):
                    odd = (far[0] > rules.max_class_distance) | (far[1] > rules.max_word_distance)
                columns = [ids.slice(first, last - first), *(pa.array(v.astype(np.int64)) for v in base.values())]
                columns += [pa.array(failed), pa.array(~failed & ~odd)]
                columns += [pa.array(x, pa.float64(), mask=np.isnan(x)) for x in far]
                columns += [batch.column(6 + k).slice(first, last - first) for k in range(len(more))]
                yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(score, BASE_SCHEMA + "".join(f", `_{c}` {kinds[f'_{c}']}" for c in more))


def keep_good(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that pass, with all their columns."""
    others, back = folded(docs)
    judged = judge(docs.select("doc_id", "text", "lang", others), rules, "others").where("kept")
    return judged.select(F.col("_others").alias("others")).select(*back)
