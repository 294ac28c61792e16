"""From raw documents to token ids, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns the rows it keeps, in
the columns of ``docs``; the last one returns token ids and their digests.
``run`` writes every stage's rows as Parquet below the checkpoint folder and
gives the table read back to the next one.

Nulls: a null text is empty; a row without a doc_id is judged by its text and
never merged with another. Equal texts under one doc_id count as one document;
different texts under one doc_id are documents of their own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefit.llm import byte_bpe, decontaminate, near_dedup, pii, quality
from tablefit.llm.common import checkpoint_root, stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from ``labels``, accepts."""
    model = quality.fit(quality.statistics(docs), table(spark, sf_dir, "labels"))
    return quality.accept(docs, model)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, and one row of it: the
    smallest. A doc_id with several texts gets a number of its own for each of
    them, beyond 2**62, so that every text is judged alone and plain ids come first."""
    text = F.coalesce("text", F.lit(""))
    digest = F.xxhash64(text)
    several = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(digest).alias("lo"), F.max(digest).alias("hi"))
    several = stored(several.where("lo <> hi").select(F.col("doc_id").alias("several")))
    own = F.xxhash64("doc_id", text).bitwiseAND(F.lit(2**62 - 1)).bitwiseOR(F.lit(2**62))
    named = docs.join(several, F.col("doc_id") == F.col("several"), "left").select(
        F.struct(*docs.columns).alias("row"), F.when(F.col("several").isNotNull(), own).otherwise(F.col("doc_id")).alias("id")
    )
    judged = stored(near_dedup.near_duplicates(named.select(F.col("id").alias("doc_id"), F.col("row.text").alias("text"))))
    dropped = stored(judged.where("NOT kept").select(F.col("doc_id").alias("id")).distinct())
    repeated = stored(judged.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id")).count().where("count > 1").select("id"))
    kept = named.join(dropped, "id", "left_anti")
    one = kept.join(repeated, "id", "left_semi").groupBy("id").agg(F.min("row").alias("row"))
    return kept.join(repeated, "id", "left_anti").select("row.*").union(one.select("row.*"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; ``n_chars`` follows the text."""
    masked = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return masked
    n_chars = F.coalesce(F.length("text"), "n_chars").cast(docs.schema["n_chars"].dataType)
    return masked.withColumn("n_chars", n_chars)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids`` and the digests of ids and decoded bytes."""
    import public_tokenizers

    tokens = byte_bpe.tokenize(docs, public_tokenizers.path(byte_bpe.VOCABULARY), public_tokenizers.PATTERN)
    return byte_bpe.digests(tokens, "ids")


STAGES = [
    ("quality classifier", quality_stage),
    ("MinHash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("PII", pii_stage),
    ("byte-level BPE", tokens_stage),
]

# Learnt weights, regular expressions with checksums and byte pair merges
# have no SQL form; tests/llm/test_pipeline.py holds every stage against a
# plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. The written tables go when the driver's JVM ends."""
    root = f"{checkpoint_root(spark)}/corpus-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{i}")
        docs = spark.read.parquet(f"{root}/{i}")
    return docs
