"""Approximate nearest neighbours by a permutation index (operator 3).

1. The square root of their number of distinct vectors, but ``LEAST_PIVOTS``
   to ``MAX_PIVOTS``, are drawn by hashed id as pivots (the only sample).
2. Every vector is written as the ordered list of its ``LENGTH`` nearest
   pivots (largest inner product), and posted in the inverted files of its
   first ``POST`` pivots.
3. A query looks into the files of its first pivots: ``PROBE`` of them up to
   ``FEW_PIVOTS`` pivots, and beyond that a number that grows with the root of
   the number of pivots (``probes``), as a file then holds a smaller share of
   the vectors and a neighbour's first pivots lie further down the query's
   list. More than ``MAX_PIVOTS`` aren't drawn; then the files grow. Each file is cut into parts of about ``PART`` postings and as many queries; a part ranks
   its postings by the footrule distance of the pivot lists (a pivot missing
   from a list counts as at place ``LENGTH``), keeps the first ``SHARE`` of
   them, and reranks these by the inner product of the vectors themselves.
4. The best of all parts are merged for each query. A query that found fewer
   than it could is searched again in all files.

Vectors that are null, zero, or hold null or non-finite components take no
part, nor do rows without an id; nor vectors of another length than the most
common one (the smaller on a tie). Equal rows count once. If an id has several
vectors, it is searched by each and found by its best. Ties go to the smaller
id. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablefit.llm.common import materialize, table

NEAREST = 20
EVERY = 20
LEAST_PIVOTS, MAX_PIVOTS = 128, 4096
LENGTH = 64
POST = 12
PROBE, FEW_PIVOTS = 16, 256
PART = 4096
#: A part reranks this share of its postings, and CANDIDATES at least.
SHARE, CANDIDATES = 0.25, 100

_POSTED = "vec_id long, vec binary, near array<int>, perm binary"
_FOUND = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, vec`` (an array of floats or doubles) of the vectors that take part, equal rows once."""
    element = vectors.schema["embedding"].dataType.elementType.typeName()
    kind = "array<float>" if element == "float" else "array<double>"
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("vec"))
    v = v.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull())
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    v = v.where(finite & F.exists("vec", lambda x: x != 0))
    sizes = v.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return v.where(F.size("vec") == (sizes["size"] if sizes else 0)).distinct()


def pivots_of(vectors: DataFrame, n: int) -> np.ndarray:
    wanted = min(MAX_PIVOTS, max(LEAST_PIVOTS, math.isqrt(n)))
    distinct = vectors.groupBy("vec").agg(F.min("vec_id").alias("vec_id"))
    rows = distinct.orderBy(F.xxhash64("vec_id"), "vec_id").limit(wanted).collect()  # at most MAX_PIVOTS vectors
    return np.array([r.vec for r in rows], np.float64)


def probes(pivots: int) -> int:
    """How many of ``pivots`` files a query looks into."""
    return min(pivots, math.ceil(PROBE * math.sqrt(max(1.0, pivots / FEW_PIVOTS))))


def permutations(vectors: DataFrame, pivots: np.ndarray, probe: int) -> DataFrame:
    """``vec_id``, ``vec`` (the components' bytes), ``perm`` (16-bit numbers of the
    nearest pivots in order) and ``near``, as many of them as are posted or probed, as an array."""
    first = min(len(pivots), max(POST, probe))
    length = min(max(LENGTH, first), len(pivots))
    sent = vectors.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                perm = np.argsort(-(v @ sent.value.T.astype(v.dtype)), axis=1, kind="stable")[:, :length].astype(np.int16)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([x.tobytes() for x in v], pa.binary()),
                     pa.array(list(perm[:, :first].astype(np.int32)), pa.list_(pa.int32())), pa.array([x.tobytes() for x in perm], pa.binary())],
                    ["vec_id", "vec", "near", "perm"],
                )

    return vectors.mapInArrow(run, _POSTED)


def _rerank(pivots: int, nearest: int, kind: type):
    def run(posted: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(posted) and len(asked):
            posted = posted.sort_values("vec_id", kind="stable")
            ids, qids = posted["vec_id"].to_numpy(np.int64), asked["vec_id"].to_numpy(np.int64)
            vectors = np.frombuffer(b"".join(posted["vec"]), kind).reshape(len(ids), -1).astype(np.float64)
            queries = np.frombuffer(b"".join(asked["vec"]), kind).reshape(len(qids), -1).astype(np.float64)
            perm, qperm = (np.frombuffer(b"".join(x["perm"]), np.int16).reshape(len(x), -1) for x in (posted, asked))
            length = perm.shape[1]
            places = np.ascontiguousarray(perm.T).astype(np.int64)
            keep = min(len(ids), max(CANDIDATES, math.ceil(SHARE * len(ids))))
            for start in range(0, len(qids), 32):
                q = slice(start, start + 32)
                rows = len(qids[q])
                place = np.full((rows, pivots), length, np.int16)
                place[np.arange(rows)[:, None], qperm[q]] = np.arange(length)
                # Over the query's pivots: those that the posting lacks count from their place to the end,
                # which is all of them less those that it has.
                footrule = np.full((rows, len(ids)), length * (length + 1) // 2, np.int16)
                for i in range(length):
                    at = place.take(places[i], axis=1)
                    footrule += at + np.abs(at - i) - length
                order = footrule.astype(np.int64) * len(ids) + np.arange(len(ids))  # ties to the smaller id
                best = np.argpartition(order, keep - 1, axis=1)[:, :keep]
                for j in range(rows):
                    found = best[j][ids[best[j]] != qids[start + j]]
                    score = (vectors[found] * queries[start + j]).sum(axis=1)
                    top = np.lexsort((ids[found], -score))[:nearest]
                    out.append((np.full(len(top), qids[start + j]), ids[found][top], score[top]))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns)))

    return run


def _look(index: DataFrame, queries: DataFrame, pivots: int, probe: int, nearest: int, kind: type) -> DataFrame:
    """``query_id, vec_id, score`` of the best that the first ``probe`` files hold."""
    posted = index.select(F.explode(F.slice("near", 1, POST)).alias("pivot"), "vec_id", "vec", "perm")
    asked = queries.select(F.explode(F.slice("near", 1, probe)).alias("pivot"), "vec_id", "vec", "perm")
    sizes = (
        posted.groupBy("pivot").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
        .join(asked.groupBy("pivot").agg(F.ceil(F.count("*") / PART).cast("int").alias("qparts")), "pivot")
    )
    sizes = F.broadcast(materialize(sizes))  # at most MAX_PIVOTS rows

    def dealt(rows: DataFrame, own: str, other: str, salt: int, own_parts: str, other_parts: str) -> DataFrame:
        mine: Column = F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.col(own_parts)).cast("int")
        return rows.join(sizes, "pivot").select(
            mine.alias(own), F.explode(F.sequence(F.lit(0), F.col(other_parts) - 1)).alias(other),
            *[F.col(c).alias(c) for c in ("pivot", "vec_id", "vec", "perm")],  # new columns: both sides come from one table
        )

    keys = ["pivot", "part", "qpart"]
    left = dealt(posted, "part", "qpart", 0, "parts", "qparts").groupBy(*keys)
    right = dealt(asked, "qpart", "part", 1, "qparts", "parts").groupBy(*keys)
    return left.cogroup(right).applyInPandas(_rerank(pivots, nearest, kind), _FOUND)


def _best(found: DataFrame, nearest: int) -> DataFrame:
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return once.withColumn("rank", rank.cast("int")).where(F.col("rank") <= nearest)


def search(vectors: DataFrame, every: int = EVERY, nearest: int = NEAREST, probe: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``nearest`` found for each vector
    of ``vectors(vec_id, embedding)`` whose id is divisible by ``every``;
    ``probe`` files are looked into, by default ``probes`` of them."""
    clean = materialize(usable(vectors))
    counted = clean.agg(F.count_distinct("vec_id").alias("ids"), F.count("*").alias("n")).first()
    if counted.ids < 2:
        return clean.select(
            F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score")
        ).limit(0)
    pivots = pivots_of(clean, counted.n)
    probe = probes(len(pivots)) if probe is None else probe
    index = materialize(permutations(clean, pivots, probe))
    queries = index.where(F.pmod("vec_id", F.lit(every)) == 0)
    kind = np.float32 if clean.schema["vec"].dataType.elementType.typeName() == "float" else np.float64
    found = materialize(_best(_look(index, queries, len(pivots), probe, nearest, kind), nearest))
    wanted = min(nearest, counted.ids - 1)
    full = found.groupBy("query_id").count().where(F.col("count") >= wanted).select(F.col("query_id").alias("vec_id"))
    short = materialize(queries.join(full, "vec_id", "left_anti"))
    if short.isEmpty():
        return found.select("query_id", "rank", "vec_id", "score")
    everywhere = short.withColumn("near", F.sequence(F.lit(0), F.lit(len(pivots) - 1)))
    again = _best(_look(index, everywhere, len(pivots), len(pivots), nearest, kind), nearest)
    rest = found.join(short.select(F.col("vec_id").alias("query_id")).distinct(), "query_id", "left_anti")
    return rest.select("query_id", "rank", "vec_id", "score").union(again.select("query_id", "rank", "vec_id", "score"))


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))
