"""Quality classifier: a factorisation machine.

Inputs of a text are hashed words (weighted by their share of the text), statistics of
its structure, and metadata derived from it.  Every input has a weight and a low-rank
vector; the products of the vectors are the weights of all pairs, summed in linear time:
half of (the square of the sum less the sum of the squares), per dimension.

The model is fitted on labelled rows whose id's CRC-32 is not held out, of which at most
``sample`` are taken, in the order of a hash of the id, with one text each.  That bound makes
what comes to the driver, and the model, a fixed size; every text is scored by the executors.

Defined cases: a null text is an empty one and gets a score as well; a null id is never
held out and never learned from; labels that contradict each other are left out; without
two classes among the labels every score is the share of label 1 (a half if there is no
label); repeated rows get the same score, and of several texts under one id that with the
least hash is learned from; an empty table gives no rows; other columns
are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cleanroom.llm.common import text_chunks, typed
from cleanroom.llm.kernels import SPACE, mixed, per_row, rows_of, word_codes, words

STATISTICS = (
    "log_words", "log_chars", "log_lines", "word_length", "upper", "digit", "symbol", "stop", "pause", "exclamation",
    "beyond_ascii", "space", "distinct_words", "repeated_neighbours", "shouted_words", "symbol_words", "bar_words", "empty",
)


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 14
    rank: int = 8
    sample: int = 8000
    epochs: int = 12
    batch: int = 256
    rate: float = 0.02
    decay: float = 1e-4
    seed: int = 7
    held_out_of: int = 4
    held_out: int = 2


def held_out(doc_id: Column, settings: Settings = Settings()) -> Column:
    """Whether the CRC-32 of the id as text has the held-out remainder."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % settings.held_out_of == settings.held_out, F.lit(False))


def features(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sparse words as (bounds per row, bucket, value), and the statistics (rows by names)."""
    starts, ends, bounds = words(data, offsets)
    codes, row = word_codes(data, starts, ends), rows_of(bounds)
    n, size = np.diff(bounds), np.diff(offsets)
    # Distinct buckets of each text with their counts.
    bucket = (codes >> np.uint64(40)).astype(np.int64) % buckets
    cell, count = np.unique(row * buckets + bucket, return_counts=True)
    of = cell // buckets
    value = np.sqrt(count / np.maximum(n[of], 1))
    sparse_bounds = np.searchsorted(of, np.arange(len(n) + 1))
    # Statistics.
    share = lambda mask: per_row(mask, offsets) / np.maximum(size, 1)
    among = lambda members: np.isin(data, list(members))
    by_word = lambda mask: per_row(mask, bounds) / np.maximum(n, 1)
    symbol = among(b"#*$%&|<>")
    total = np.concatenate([[0], np.cumsum(symbol)])
    has_symbol = total[ends] > total[starts]
    upper = (data >= 65) & (data <= 90)
    raised = np.concatenate([[0], np.cumsum(upper)])
    key = np.sort(mixed(codes) // np.uint64(1 << 20) + (row.astype(np.uint64) << np.uint64(44)))
    fresh = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
    distinct = np.bincount((key[fresh] >> np.uint64(44)).astype(np.int64), minlength=len(n)) if len(key) else np.zeros(len(n))
    again = np.zeros(len(codes), bool)
    again[1:] = (codes[1:] == codes[:-1]) & (row[1:] == row[:-1])
    one_bar = (ends - starts == 1) & (data[starts] == 0x7C) if len(starts) else np.zeros(0, bool)
    statistics = [
        np.log1p(n), np.log1p(size), np.log1p(per_row(data == 10, offsets)), per_row(~SPACE[data], offsets) / np.maximum(n, 1) / 10,
        share(upper), share((data >= 48) & (data <= 57)), share(symbol), share(among(b".?")), share(among(b",;:")), share(data == 33),
        share(data >= 0xC0), share(SPACE[data]), distinct / np.maximum(n, 1), by_word(again),
        by_word((raised[ends] - raised[starts]) * 2 > ends - starts), by_word(has_symbol), by_word(one_bar), (n == 0).astype(float),
    ]
    return sparse_bounds, cell % buckets, value, np.stack(statistics, axis=1)


class Machine:
    """Weights ``w`` and vectors ``v`` of hashed words, then of standardized statistics."""

    def __init__(self, settings: Settings, mean: np.ndarray, scale: np.ndarray):
        rng = np.random.default_rng(settings.seed)
        size = settings.buckets + len(mean)
        self.buckets, self.mean, self.scale, self.bias = settings.buckets, mean, scale, 0.0
        self.w = np.zeros(size)
        self.v = rng.normal(0, 0.05, (size, settings.rank))

    def inputs(self, bounds, bucket, value, statistics):
        """All inputs of each row: row, index, value."""
        dense = np.clip((statistics - self.mean) / self.scale, -5, 5)
        rows, width = dense.shape
        row = np.concatenate([rows_of(bounds), np.repeat(np.arange(rows), width)])
        index = np.concatenate([bucket, np.tile(self.buckets + np.arange(width), rows)])
        return row, index, np.concatenate([value, dense.ravel()])

    def margin(self, row, index, value, rows):
        """Scores before the logistic function, and the sums per dimension."""
        linear = np.bincount(row, self.w[index] * value, minlength=rows)
        part = self.v[index] * value[:, None]
        sums = np.stack([np.bincount(row, part[:, k], minlength=rows) for k in range(part.shape[1])], axis=1)
        squares = np.bincount(row, (part * part).sum(1), minlength=rows)
        return self.bias + linear + ((sums * sums).sum(1) - squares) / 2, sums

    def score(self, bounds, bucket, value, statistics):
        margin, _ = self.margin(*self.inputs(bounds, bucket, value, statistics), len(statistics))
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def fit(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]], settings: Settings = Settings()) -> Machine:
    """A machine from (buckets, values, statistics, label) rows, by Adam on the logistic loss."""
    statistics = np.array([r[2] for r in rows]).reshape(len(rows), len(STATISTICS))
    labels = np.array([r[3] for r in rows], float)
    mean = statistics.mean(0) if len(rows) else np.zeros(len(STATISTICS))
    scale = np.maximum(statistics.std(0), 1e-3) if len(rows) else np.ones(len(STATISTICS))
    machine = Machine(settings, mean, scale)
    positive = labels.mean() if len(rows) else 0.5
    if positive in (0.0, 1.0) or not len(rows):
        machine.bias = float(np.log(np.clip(positive, 1e-6, 1 - 1e-6) / (1 - np.clip(positive, 1e-6, 1 - 1e-6))))
        machine.v[:] = 0
        return machine
    # Both classes weigh the same.
    weight = np.where(labels == 1, 0.5 / positive, 0.5 / (1 - positive))
    rng = np.random.default_rng(settings.seed)
    moments = [np.zeros_like(machine.w), np.zeros_like(machine.w), np.zeros_like(machine.v), np.zeros_like(machine.v)]
    first = second = 0.0
    step = 0
    for epoch in range(settings.epochs):
        rate = settings.rate * (1 - epoch / settings.epochs)
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), settings.batch):
            some = order[at : at + settings.batch]
            bounds = np.concatenate([[0], np.cumsum([len(rows[i][0]) for i in some])])
            bucket, value = (np.concatenate([rows[i][k] for i in some]) for k in (0, 1))
            row, index, x = machine.inputs(bounds, bucket, value, statistics[some])
            margin, sums = machine.margin(row, index, x, len(some))
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[some]) * weight[some] / len(some)
            used, place = np.unique(index, return_inverse=True)
            gw = np.bincount(place, error[row] * x) + settings.decay * machine.w[used]
            part = error[row][:, None] * x[:, None] * (sums[row] - machine.v[index] * x[:, None])
            gv = np.stack([np.bincount(place, part[:, k]) for k in range(part.shape[1])], 1) + settings.decay * machine.v[used]
            step += 1
            for target, grad, m, s in ((machine.w, gw, moments[0], moments[1]), (machine.v, gv, moments[2], moments[3])):
                m[used] = 0.9 * m[used] + 0.1 * grad
                s[used] = 0.999 * s[used] + 0.001 * grad * grad
                target[used] -= rate * (m[used] / (1 - 0.9**step)) / (np.sqrt(s[used] / (1 - 0.999**step)) + 1e-8)
            gb = error.sum()
            first, second = 0.9 * first + 0.1 * gb, 0.999 * second + 0.001 * gb * gb
            machine.bias -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return machine


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Machine:
    """Fit on at most ``settings.sample`` labelled documents that are not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"), settings))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
    known = known.where("quality = other").select("doc_id", "quality")
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.sample)
    chosen = {r.doc_id: r.quality for r in sample.collect()}  # at most settings.sample pairs
    buckets = settings.buckets

    def extract(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, last, data, offsets in text_chunks(batch.column(1)):
                bounds, bucket, value, statistics = features(data, offsets, buckets)
                cut = lambda x, i: x[bounds[i] : bounds[i + 1]].tolist()
                rows = range(last - first)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[first:last], pa.int64()),
                        pa.array([cut(bucket, i) for i in rows], pa.list_(pa.int32())),
                        pa.array([cut(value, i) for i in rows], pa.list_(pa.float32())),
                        pa.array([statistics[i].tolist() for i in rows], pa.list_(pa.float64())),
                    ],
                    ["doc_id", "bucket", "value", "statistics"],
                )

    if not chosen:
        return fit([], settings)
    # Only chosen ids leave the scan, and a repeated one is reduced before it is shuffled.
    ids = docs.sparkSession.createDataFrame([(i,) for i in chosen], "doc_id long")
    some = typed(docs).join(F.broadcast(ids), "doc_id", "left_semi")
    some = some.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first"))
    found = some.select("doc_id", F.col("first.text").alias("text")).mapInArrow(extract, "doc_id long, bucket array<int>, value array<float>, statistics array<double>")
    rows = {}
    for part in found.toArrow().to_batches(max_chunksize=500):
        for i, b, v, s in zip(*(part.column(k) for k in range(4))):
            rows[i.as_py()] = (np.asarray(b.values, np.int64), np.asarray(v.values, np.float64), np.asarray(s.values, np.float64))
    return fit([(*rows[i], chosen[i]) for i in sorted(rows)], settings)


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``doc_id, score`` for every document."""
    state = {k: v for k, v in vars(machine).items()}

    def run(batches):
        model = Machine.__new__(Machine)
        vars(model).update(state)
        for batch in batches:
            for first, last, data, offsets in text_chunks(batch.column(1), 1 << 18):
                scores = model.score(*features(data, offsets, model.buckets))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(scores)], ["doc_id", "score"])

    return typed(docs).mapInArrow(run, "doc_id long, score double")
