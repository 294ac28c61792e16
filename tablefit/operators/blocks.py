"""Rows as matrix blocks, for fits and scores that pass over the data.

A block holds the features of some thousand rows as one binary matrix, the
labels of all label expressions as another, and the hold-out flags. Blocks
are made once, in the tasks that read the rows, and persisted on the executors'
disks as plain bytes; every pass then moves whole matrices to numpy instead of
rows. A task holds one block at a time, on both sides of the way to Python:
cached tables and Arrow batches take up many such rows at once, and more of
them the larger the task's input. What a pass returns is a
vector for each key (a model, a label): each task sums its blocks, and one
small aggregate sums the tasks, so the driver sees a vector per key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

#: features, labels (NaN where null) and hold-out flags of some rows
Block = tuple[np.ndarray, np.ndarray, np.ndarray]

_SCHEMA = "n long, x binary, y binary, t binary"
#: Feature values of a block at most (a row stays whole).
BLOCK_VALUES = 1_000_000


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            size = max(1, BLOCK_VALUES // max(1, len(batch.column(0)[0])))
            for start in range(0, batch.num_rows, size):
                yield batch.slice(start, size)


def _pack(n_labels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            y = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            t = batch.column(2).to_numpy(zero_copy_only=False).astype(np.uint8)
            if len(y) != batch.num_rows * n_labels:
                raise ValueError("each row needs all labels")
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.num_rows], pa.int64()), pa.array([x.tobytes()], pa.binary()),
                 pa.array([y.tobytes()], pa.binary()), pa.array([t.tobytes()], pa.binary())],
                ["n", "x", "y", "t"])
    return run


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield _block(batch.column(0)[i].as_py(), *(batch.column(c)[i].as_buffer() for c in (1, 2, 3)))


def _block(n: int, x: bytes, y: bytes, t: bytes) -> Block:
    return (np.frombuffer(x, np.float64).reshape(n, -1), np.frombuffer(y, np.float64).reshape(n, -1),
            np.frombuffer(t, np.uint8).astype(bool))


def _plain(rows: Iterator[Row]) -> Iterator[tuple]:
    return ((r["n"], bytes(r["x"]), bytes(r["y"]), bytes(r["t"])) for r in rows)


@dataclass
class Blocks:
    frame: DataFrame             # a row a block
    labels: list[str]
    held: RDD                    # the same as plain bytes, which passes read

    def unpersist(self) -> None:
        self.held.unpersist()

    def passed(self, per_task: Callable[[Iterator[Block]], Iterable[tuple]], schema: str) -> DataFrame:
        """One pass: the rows that ``per_task`` gives for the blocks of each task."""
        def run(rows: Iterator[tuple]) -> Iterable[tuple]:
            return per_task(_block(*r) for r in rows)
        return self.frame.sparkSession.createDataFrame(self.held.mapPartitions(run), schema, verifySchema=False)

    def summed(self, per_task: Callable[[Iterable[Block]], dict[int, np.ndarray]]) -> dict[int, np.ndarray]:
        """One pass: the vectors that ``per_task`` gives for its blocks,
        summed by key over all tasks."""
        def run(blocks: Iterator[Block]) -> Iterator[tuple]:
            for key, v in per_task(blocks).items():
                yield int(key), np.ravel(v).astype(np.float64).tolist()
        parts = self.passed(run, "key int, v array<double>")
        rows = parts.groupBy("key").agg(Summarizer.sum(array_to_vector("v")).alias("v")).collect()
        return {r["key"]: r["v"].toArray() for r in rows}


def to_blocks(df: DataFrame, features_col: str, labels: dict[str, Column],
              test: Column | None = None, persist: bool = True) -> Blocks:
    """``features_col`` (a vector column) and the label columns of ``df`` as blocks."""
    y = F.array(*[c.cast("double") for c in labels.values()]) if labels else F.array().cast("array<double>")
    rows = df.select(vector_to_array(F.col(features_col), "float64").alias("x"), y.alias("y"),
                     (test if test is not None else F.lit(False)).alias("t"))
    frame = rows.mapInArrow(_pack(len(labels)), _SCHEMA)
    held = frame.rdd.mapPartitions(_plain, True)
    return Blocks(frame, list(labels), held.persist(StorageLevel.DISK_ONLY) if persist else held)


def training_rows(block: Block, label: int, positive: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the rows that train ``label``: not held out, and
    labelled. ``positive`` turns the label into 1 where it exceeds 0, else 0."""
    x, y, t = block
    target = y[:, label]
    keep = ~t & ~np.isnan(target)
    if not keep.all():
        x, target = x[keep], target[keep]
    return x, (target > 0).astype(np.float64) if positive else target


def counts(blocks: Blocks) -> tuple[int, int]:
    """Rows, and held-out rows."""
    def per_task(parts: Iterable[Block]) -> dict[int, np.ndarray]:
        total = np.zeros(2)
        for _, _, t in parts:
            total += (len(t), t.sum())
        return {0: total}
    n, held_out = blocks.summed(per_task).get(0, np.zeros(2))
    return round(n), round(held_out)  # sums of doubles


def label_sets(labels: Sequence[str]) -> dict[str, int]:
    return {name: i for i, name in enumerate(labels)}
