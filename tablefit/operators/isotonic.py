"""Isotonic regression by pool-adjacent-violators over range partitions.

1. Rows become one point a feature value (sum of labels, weight), range-
   partitioned by that value.
2. Each partition pools its own violators into blocks of rising means.
3. The driver looks at the first and the last block of each partition, one row
   a partition. Where a last block's mean exceeds the next partition's first,
   the two merge (with whole partitions between them that are one block). The
   merged block goes to the left partition in one round, to the right one in
   the next, and that partition pools again, so a round takes up all blocks of
   a side that the merged block swallows. Rounds go on until no boundary is
   violated; then no adjacent blocks violate the order anywhere, which is the
   condition of the solution.

Blocks stay distributed, and so do predictions: rows and knots are range-
partitioned together, ties split by a row number, and each partition
interpolates with the knots around its ends. As in Spark's own model, a value
inside a block gets its mean, one between blocks the line between their ends,
one outside the nearest mean.

Rows without a feature value or label take no part in the fit; rows without a
feature value get no prediction.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablefit.session import scratch_dir

_BLOCK = "part int, lo double, hi double, s double, w double"
_EDIT = "part int, drop_first boolean, drop_last boolean, at_head boolean, lo double, hi double, s double, w double"
_FIELDS = ["lo", "hi", "s", "w"]


def pooled(blocks: np.ndarray) -> np.ndarray:
    """Rows ``lo, hi, s, w`` in order, violators pooled until the means rise."""
    out: list[list[float]] = []
    for lo, hi, s, w in blocks.tolist():
        out.append([lo, hi, s, w])
        while len(out) > 1 and out[-2][2] * out[-1][3] > out[-1][2] * out[-2][3]:
            _, hi, s, w = out.pop()
            out[-1][1] = hi
            out[-1][2] += s
            out[-1][3] += w
    return np.array(out, dtype=float).reshape(-1, 4)


def _rows(table: pa.Table) -> np.ndarray:
    rows = np.stack([table.column(c).to_numpy() for c in _FIELDS], axis=1) if table.num_rows else np.empty((0, 4))
    return rows[np.argsort(rows[:, 0], kind="stable")]


def _as_table(part: int, rows: np.ndarray) -> pa.Table:
    return pa.table({"part": pa.array([part] * len(rows), pa.int32()), **{c: rows[:, i] for i, c in enumerate(_FIELDS)}})


def _pool_part(table: pa.Table) -> pa.Table:
    return _as_table(table.column("part")[0].as_py(), pooled(_rows(table)))


def _edit_part(table: pa.Table, edits: pa.Table) -> pa.Table:
    part = (table if table.num_rows else edits).column("part")[0].as_py()
    rows, head, tail = _rows(table), [], []
    for e in edits.to_pylist():
        if e["drop_first"]:
            rows = rows[1:]
        if e["drop_last"]:
            rows = rows[:-1]
        if e["lo"] is not None:
            (head if e["at_head"] else tail).append([e[c] for c in _FIELDS])
    return _as_table(part, pooled(np.vstack([np.reshape(x, (-1, 4)) for x in (head, rows, tail)])))


def boundary_edits(edges: list, to_left: bool) -> list[tuple]:
    """What the violated boundaries change: a row per edited partition and
    change. ``edges``: part, first, last (``lo, hi, s, w``) and blocks of each
    partition that has any, in order."""
    mean = lambda b: b["s"] / b["w"]
    edits, i = [], 0
    while i < len(edges):
        j = i
        while j + 1 < len(edges) and mean(edges[j]["last"]) > mean(edges[j + 1]["first"]) and (j == i or edges[j]["n"] == 1):
            j += 1
        if j > i:
            taken = [edges[i]["last"], *[e["first"] for e in edges[i + 1:j + 1]]]
            merged = (taken[0]["lo"], taken[-1]["hi"], float(sum(b["s"] for b in taken)), float(sum(b["w"] for b in taken)))
            none = (None,) * 4
            edits.append((edges[i]["part"], False, True, False, *(merged if to_left else none)))
            for e in edges[i + 1:j]:
                edits.append((e["part"], True, False, False, *none))
            edits.append((edges[j]["part"], True, False, True, *(none if to_left else merged)))
            # a partition of one block has given it away: it can't merge again this round
            i = j + 1 if edges[j]["n"] == 1 else j
        else:
            i += 1
    return edits


@dataclass
class IsotonicBlocks:
    """``frame``: part, lo, hi, s, w; the fitted value of a block is s / w (negated, if falling)."""
    frame: DataFrame
    increasing: bool
    rounds: int

    def fitted(self) -> DataFrame:
        """``lo, hi, value, weight``, a row per block; neighbours of equal value may be apart."""
        return self.frame.select("lo", "hi", ((F.col("s") / F.col("w")) * (1.0 if self.increasing else -1.0)).alias("value"),
                                 F.col("w").alias("weight"))

    def predict(self, df: DataFrame, value: Column, out: str = "prediction") -> DataFrame:
        """``df`` with the fitted value at ``value`` as column ``out``."""
        spark = df.sparkSession
        ends = F.explode(F.array_distinct(F.array("lo", "hi")))
        row_type = df.schema.simpleString()
        knots = self.fitted().select(ends.alias("x"), F.col("value").alias("y")).select(
            "x", F.lit(-1).cast("long").alias("tie"), "y", F.lit(None).cast(row_type).alias("row"))
        rows = df.select(value.cast("double").alias("x"), F.monotonically_increasing_id().alias("tie"),
                         F.lit(None).cast("double").alias("y"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        placed = _stored(knots.unionByName(rows).repartitionByRange(parts, "x", "tie").withColumn("part", F.spark_partition_id()))
        at = F.struct("x", "y")
        edges = placed.where("row IS NULL").groupBy("part").agg(F.min(at).alias("a"), F.max(at).alias("b")).orderBy("part").collect()
        firsts, lasts = [(r["part"], tuple(r["a"])) for r in edges], [(r["part"], tuple(r["b"])) for r in edges]

        def run(table: pa.Table) -> pa.Table:
            part = table.column("part")[0].as_py()
            is_row = table.column("row").combine_chunks().is_valid()
            own = table.filter(pa.compute.invert(is_row))
            mine = sorted(zip(own.column("x").to_pylist(), own.column("y").to_pylist()))
            near = [k for p, k in lasts if p < part][-1:] + mine + [k for p, k in firsts if p > part][:1]
            table = table.filter(is_row)
            x = table.column("x").to_numpy()
            kx, ky = np.array(near, dtype=float).reshape(-1, 2).T
            y = np.interp(x, kx, ky) if len(kx) else np.full(len(x), np.nan)
            y = pa.array(y, mask=np.isnan(x) | np.isnan(y))
            rows = table.column("row").combine_chunks()
            rows = rows.chunk(0) if isinstance(rows, pa.ChunkedArray) and rows.num_chunks else rows
            fields = rows.flatten() if table.num_rows else [pa.array([], f.type) for f in rows.type]
            return pa.Table.from_arrays([*fields, y], [*[f.name for f in rows.type], out])

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + f", `{out}` double"
        return placed.groupBy("part").applyInArrow(run, schema)


def _stored(df: DataFrame) -> DataFrame:
    path = scratch_dir(df.sparkSession, "isotonic")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fit_isotonic(df: DataFrame, value: Column, label: Column, increasing: bool = True,
                 weight: Column | None = None, partitions: int | None = None) -> IsotonicBlocks:
    """The least squares fit of ``label`` that never falls (or rises) with ``value``."""
    spark = df.sparkSession
    sign = 1.0 if increasing else -1.0
    w = F.lit(1.0) if weight is None else weight.cast("double")
    rows = df.select(value.cast("double").alias("x"), (label.cast("double") * sign).alias("y"), w.alias("w"))
    points = (rows.where("x IS NOT NULL AND NOT isnan(x) AND y IS NOT NULL AND w > 0")
              .groupBy("x").agg(F.sum(F.col("y") * F.col("w")).alias("s"), F.sum("w").alias("w")))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = _stored(points.repartitionByRange(n, "x").select(
        F.spark_partition_id().alias("part"), F.col("x").alias("lo"), F.col("x").alias("hi"), "s", "w"))
    blocks = _stored(placed.groupBy("part").applyInArrow(_pool_part, _BLOCK))
    block, rounds = F.struct(*_FIELDS), 0
    while True:
        edges = (blocks.groupBy("part").agg(F.min(block).alias("first"), F.max(block).alias("last"), F.count(F.lit(1)).alias("n"))
                 .orderBy("part").collect())  # a row per partition
        edits = boundary_edits(edges, to_left=rounds % 2 == 0)
        if not edits:
            return IsotonicBlocks(blocks, increasing, rounds)
        rounds += 1
        touched = sorted({e[0] for e in edits})
        changed = (blocks.where(F.col("part").isin(touched)).groupBy("part")
                   .cogroup(spark.createDataFrame(edits, _EDIT).groupBy("part")).applyInArrow(_edit_part, _BLOCK))
        blocks = _stored(blocks.where(~F.col("part").isin(touched)).unionByName(changed))
