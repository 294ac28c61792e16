"""Helpers shared by the operators: table reads, lineage cuts, words and shingles.

Words are what lies between the bytes ``\\x20`` and ``\\x09-\\x0D``; only
A-Z are lower-cased. Python's ``bytes.lower`` and ``bytes.split`` do exactly
that on UTF-8 text.
"""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession

#: Words whose hashes a Python worker keeps; beyond it the table starts anew.
WORD_CACHE = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_root(spark: SparkSession) -> str:
    """The session's checkpoint folder. The cluster names it in
    ``spark.checkpoint.dir``; only a plain local session without that setting
    gets a temporary one."""
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        configured = sc.getConf().get("spark.checkpoint.dir")
        if configured is None:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
            configured = tempfile.mkdtemp(prefix="tablefit-checkpoint-")
        sc.setCheckpointDir(configured)
    return sc._jsc.sc().getCheckpointDir().get()


def materialize(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage with a reliable checkpoint."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table below the checkpoint folder: computed once, with
    its lineage cut and its real size known to the planner. (The size that a
    checkpoint keeps is the estimate of its plan; over many rounds of joins these
    estimates multiply without bound.)"""
    path = f"{checkpoint_root(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table_ = df.sparkSession.read.schema(df.schema).parquet(path)
    table_.stored_at = path
    return table_


def release(*frames: DataFrame | None) -> None:
    """Delete what ``stored`` or ``materialize`` wrote for these frames, once nothing reads them any more."""
    for df in frames:
        if df is None:
            continue
        files = [df.stored_at] if "stored_at" in vars(df) else []
        plan = df._jdf.queryExecution().analyzed()
        if not files and plan.getClass().getSimpleName() == "LogicalRDD":
            file = plan.rdd().getCheckpointFile()
            files = [file.get()] if file.isDefined() else []
        for file in files:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(file)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


class WordHashes(dict):
    """64-bit hashes of words, kept while they fit ``WORD_CACHE`` entries."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = WordHashes()


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def shingles_of(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles; a shorter
    text is one shingle, an empty one none."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    h = word_hashes(words)
    n = max(len(words) - width + 1, 1)
    s = h[:n] ^ np.uint64(0x9E3779B97F4A7C15)
    for j in range(1, min(width, len(words))):
        s *= np.uint64(0xFF51AFD7ED558CCD)
        s ^= s >> np.uint64(32)
        s += h[j : j + n]
    s ^= s >> np.uint64(33)
    s *= np.uint64(0xC4CEB9FE1A85EC53)
    s ^= s >> np.uint64(29)
    return np.unique(s)
