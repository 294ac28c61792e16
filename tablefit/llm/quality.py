"""Document quality by random Fourier features and ridge regression (operator 9).

1. ``statistics``: about twenty numbers of the whole text (character classes,
   word lengths, repetition of words and lines).
2. ``fit``: standardised statistics pass through ``FEATURES`` random cosines,
   which approximate a Gaussian kernel. Every partition sums its share of the
   normal equations, Spark adds these sums, and the driver solves one system
   of ``FEATURES + 1`` unknowns. All labelled rows outside the held-out fold
   take part; a third of them (remainder ``CALIBRATION``) is kept from the
   ridge and serves the isotonic calibration, over scores counted in bins of
   ``1 / BINS``, so the driver sees at most ``4 * BINS + 1`` bins.
3. ``scores`` / ``accept``: the calibrated score of each row.

Null texts count as empty and get a score like any other. Labels are
averaged per doc_id, null ones ignored; a row without a doc_id has no label.
Without a single usable label every score is 0.5. Repeated rows get equal
scores. Other columns of the input are ignored (``accept`` passes them on).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefit.llm.common import materialize, table

FOLDS, HELD_OUT, CALIBRATION = 4, 2, 3
THRESHOLD = 0.7
FEATURES = 256
RIDGE = 1e-3
BINS = 1000
#: Standardised statistics beyond this many deviations are cut to it.
REACH = 6.0

_CLASSES = np.zeros((256, 9))
for _i, _members in enumerate(
    [range(65, 91), range(97, 123), range(48, 58), (32, 9, 11, 12, 13), (10,), b"!?", b"#$%&*+/<=>@\\^_`{|}~", b".,;:'\"()-[]", range(128, 256)]
):
    _CLASSES[list(_members), _i] = 1.0
_SIZE = 21


def statistics_of(text: str | None) -> np.ndarray:
    out = np.zeros(_SIZE)
    raw = text.encode("utf-8", "surrogatepass") if text else b""
    words = raw.split()
    if not words:
        out[:2] = np.log1p(len(raw)), 1.0
        return out
    n = len(words)
    out[0] = np.log1p(len(raw))
    out[2:11] = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _CLASSES / len(raw)
    lengths = np.fromiter(map(len, words), np.float64, n)
    out[11], out[12] = lengths.mean(), lengths.std()
    counts = Counter(words)
    out[13] = len(counts) / n
    out[14] = max(counts.values()) / n
    out[15] = sum(map(bytes.isalpha, words)) / n
    out[16] = sum(map(bytes.isupper, words)) / n
    out[17] = (lengths <= 2).mean()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    out[18] = np.log1p(n / len(lines))
    out[19] = 1 - len(set(lines)) / len(lines)
    out[20] = raw.count(b".") / n
    return out


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [statistics_of(t) for t in batch.column(1).to_pylist()]
        flat = pa.array(np.concatenate(rows) if rows else np.empty(0))
        offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * _SIZE)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, flat)], ["doc_id", "stats"])


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, stats array<double>`` of each row of ``docs(doc_id, text)``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_statistics, "doc_id long, stats array<double>")


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null ids count as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    deviation: np.ndarray
    weights: np.ndarray
    steps_x: np.ndarray
    steps_y: np.ndarray

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return cosines(stats, self.mean, self.deviation) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.steps_x, self.steps_y)


def cosines(stats: np.ndarray, mean: np.ndarray, deviation: np.ndarray) -> np.ndarray:
    """The random features of a Gaussian kernel, and a last column of ones."""
    rng = np.random.default_rng(9)
    directions = rng.normal(0, 1 / np.sqrt(_SIZE), (_SIZE, FEATURES))
    phases = rng.uniform(0, 2 * np.pi, FEATURES)
    x = np.clip((stats - mean) / deviation, -REACH, REACH)
    return np.hstack([np.sqrt(2 / FEATURES) * np.cos(x @ directions + phases), np.ones((len(x), 1))])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, _SIZE)


def _normal_equations(mean: np.ndarray, deviation: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                z = cosines(_matrix(part.column(0)), mean, deviation)
                total[:, :-1] += z.T @ z
                total[:, -1] += z.T @ part.column(1).to_numpy(zero_copy_only=False)
        if total[-1, -2]:
            offsets = np.arange(FEATURES + 2, dtype=np.int32) * (FEATURES + 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(FEATURES + 1, dtype=np.int32)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(total.ravel()))],
                ["i", "row"],
            )

    return run


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over sorted ``x``: the steps' places and heights."""
    blocks: list[list[float]] = []  # height, weight, first x, last x
    for a, b, w in zip(x, y, weight):
        blocks.append([b, w, a, a])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            top, under = blocks.pop(), blocks[-1]
            under[0] = (under[0] * under[1] + top[0] * top[1]) / (under[1] + top[1])
            under[1] += top[1]
            under[3] = top[3]
    xs = [v for b in blocks for v in (b[2], b[3])]
    return np.array(xs), np.array([b[0] for b in blocks for _ in range(2)])


def _raw_scores(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = np.rint(np.clip(model.raw(_matrix(batch.column(0))), -2, 2) * BINS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column(1)], ["bin", "y"])

    return run


def constant(value: float = 0.5) -> Model:
    return Model(np.zeros(_SIZE), np.ones(_SIZE), np.zeros(FEATURES + 1), np.zeros(1), np.full(1, value))


def fit(stats: DataFrame, labels: DataFrame, target: str = "quality", folds: int = FOLDS, held_out: int = HELD_OUT,
        calibration: int = CALIBRATION) -> Model:
    """Learn from ``stats(doc_id, stats)`` and ``labels(doc_id, <target>)``."""
    marks = (
        labels.where(F.col(target).isNotNull() & F.col("doc_id").isNotNull() & (fold_of(F.col("doc_id"), folds) != held_out))
        .groupBy(F.col("doc_id").cast("long").alias("label_id"))
        .agg((F.avg(target) >= 0.5).cast("double").alias("y"))
    )
    rows = materialize(
        stats.join(marks, stats["doc_id"] == marks["label_id"]).select(
            "stats", "y", (fold_of(F.col("doc_id"), folds) == calibration).alias("late")
        )
    )
    if rows.isEmpty():
        return constant()
    early, late = ((rows if part.isEmpty() else part) for part in (rows.where("NOT late"), rows.where("late")))
    summary = early.select(Summarizer.metrics("mean", "std").summary(array_to_vector("stats")).alias("s")).first().s
    mean = summary["mean"].toArray()
    deviation = np.where(summary["std"].toArray() > 1e-9, summary["std"].toArray(), 1.0)
    sums = (
        early.select("stats", "y")
        .mapInArrow(_normal_equations(mean, deviation), "i int, row array<double>")
        .groupBy("i")
        .agg(vector_to_array(Summarizer.sum(array_to_vector("row"))).alias("row"))
        .collect()  # FEATURES + 1 rows
    )
    system = np.array([r.row for r in sorted(sums, key=lambda r: r.i)])
    n = system[-1, -2]
    ridge = np.diag(np.append(np.full(FEATURES, RIDGE * n / FEATURES), 0.0))
    model = Model(mean, deviation, np.linalg.solve(system[:, :-1] + ridge, system[:, -1]), np.zeros(1), np.zeros(1))
    bins = (
        late.select("stats", "y")
        .mapInArrow(_raw_scores(model), "bin int, y double")
        .groupBy("bin")
        .agg(F.count("*").alias("n"), F.avg("y").alias("y"))
        .orderBy("bin")
        .collect()  # at most 4 * BINS + 1 rows
    )
    x, y = isotonic(np.array([r.bin / BINS for r in bins]), np.array([r.y for r in bins]), np.array([float(r.n) for r in bins]))
    return Model(model.mean, model.deviation, model.weights, x, np.clip(y, 0.0, 1.0))


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(_matrix(batch.column(1))))], ["doc_id", "score"])

    return run


def scores(stats: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of each row of ``stats(doc_id, stats)``."""
    return stats.select("doc_id", "stats").mapInArrow(_score(model), "doc_id long, score double")


def accept(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores ``threshold`` or more, unchanged."""
    column = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = [statistics_of(t) for t in batch.column(column).to_pylist()]
            if stats:
                yield batch.filter(pa.array(model.score(np.array(stats)) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = materialize(statistics(table(spark, sf_dir, "documents")))
    model = fit(stats, table(spark, sf_dir, "labels"))
    return scores(stats, model).select(
        "doc_id",
        (fold_of(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
