"""Benchmark decontamination by size-partitioned MinHash containment (operator 1).

Finds short items inside long documents: a pair counts when the document
holds at least ``PERCENT`` of the item's distinct word shingles.

1. Items are partitioned by size: partition p holds the items of 2**p to
   2**(p+1) - 1 distinct shingles. An item's signature is a bottom-k MinHash:
   its ``k`` smallest shingles by (number of items that hold the shingle,
   hash), with k set by the partition's largest size u:
   k = floor(u * (1 - PERCENT / 100)) + 1. A document that holds the
   demanded share of the item lacks fewer than k of its shingles, so it holds
   at least one of any k of them: no pair is missed, however long the document.
   What many items share, such as a common question form, thus proposes an
   item only where the item has too few shingles of its own.
2. The hashes of all shingles of a document look up the signatures. A hit
   proposes the pair.
3. Proposed pairs are tested on the shingles themselves, built again as text
   from the whole document.

DataFrame functions only. The signatures are broadcast while they have at
most ``BROADCAST_ROWS`` rows (three longs each) and joined by a shuffle beyond.

Words are what lies between white space (\\x20, \\x09-\\x0D), lower-cased. A
text of fewer than ``WIDTH`` words is one shingle; an empty or null one has
none and is in no pair, be it item or document. Repeated rows give one pair;
texts that share a doc_id (or item_id) give the pair with the largest share.
Null ids are kept as null. Rows are told apart by two 64-bit hashes of id and
text. Other columns are ignored, and passed on by ``clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefit.llm.common import materialize, table

WIDTH = 5
PERCENT = 75
BROADCAST_ROWS = 1_000_000

_SPACE = " \t\n\x0b\x0c\r"


def _words(rows: DataFrame) -> DataFrame:
    """``rows(key, text)`` with at least one word, as ``key, words``."""
    trimmed = rows.select("key", F.btrim(F.lower("text"), F.lit(_SPACE)).alias("text")).where("text <> ''")
    return trimmed.select("key", F.split("text", "[ \\x09-\\x0D]+").alias("words"))


def _starts(words: str) -> Column:
    return F.sequence(F.lit(0), F.greatest(F.size(words) - WIDTH, F.lit(0)))


def _hashes(words: DataFrame) -> DataFrame:
    """``key, hash``, a row for every shingle."""
    at = words.select("key", "words", F.explode(_starts("words")).alias("i"))
    return at.select("key", F.xxhash64(*[F.get("words", F.col("i") + j) for j in range(WIDTH)]).alias("hash"))


def _shingles(words: str) -> Column:
    return F.array_distinct(
        F.transform(_starts(words), lambda i: F.array_join(F.slice(words, i + 1, WIDTH), " "))
    )


def _demanded(size: Column, percent: int) -> Column:
    """Minima to keep for an item of ``size`` shingles: those of its partition's largest size."""
    largest = F.pow(F.lit(2.0), F.length(F.bin(size))) - 1
    return F.floor(largest * (100 - percent) / 100).cast("int") + 1


def _key(*columns: str) -> Column:
    """128 bits that stand for the row."""
    return F.struct(F.xxhash64(*columns).alias("k1"), F.xxhash64(F.lit(1), *columns).alias("k2"))


def keyed(docs: DataFrame) -> DataFrame:
    """``key, doc_id, text`` of each row of ``docs``, with a key made of the other two."""
    return docs.select(_key("doc_id", "text").alias("key"), "doc_id", "text")


def contained(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs ``key, doc_id, item_id, item_shingles, shared`` between
    ``docs(key, doc_id, text)`` and ``items(item_id, text)``."""
    docs = docs.select("key", "doc_id", F.col("text").cast("string").alias("text"))
    items = items.select("item_id", F.col("text").cast("string").alias("text")).distinct()
    items = materialize(items.withColumn("key", _key("item_id", "text")))
    item_words = _words(items)
    hashes = materialize(_hashes(item_words).distinct())
    held = hashes.join(hashes.groupBy("hash").agg(F.count("*").alias("items")), "hash")
    sized = held.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("items", "hash"))).alias("hashes"))  # one item's shingles
    signatures = materialize(
        sized.select(
            F.col("key").alias("item"),
            F.explode(F.slice("hashes.hash", F.lit(1), _demanded(F.size("hashes"), percent))).alias("hash"),
        )
    )
    proposed = _hashes(_words(docs))
    if signatures.count() <= BROADCAST_ROWS:
        signatures = F.broadcast(signatures)
    proposed = materialize(proposed.join(signatures, "hash").select("key", "item").distinct())

    texts = docs.join(proposed.select("key").distinct(), "key", "left_semi")
    texts = materialize(texts.distinct())
    found = _words(texts).select("key", _shingles("words").alias("shingles"))
    wanted = item_words.select(F.col("key").alias("item"), _shingles("words").alias("wanted"))
    tested = (
        proposed.join(wanted, "item")
        .join(found, "key")
        .select("key", "item", F.size("wanted").alias("item_shingles"), F.size(F.array_intersect("wanted", "shingles")).alias("shared"))
        .where(F.col("shared") * 100 >= F.col("item_shingles") * percent)
    )
    return (
        tested.join(items.select(F.col("key").alias("item"), "item_id"), "item")
        .join(texts.select("key", "doc_id"), "key")
        .select("key", "doc_id", "item_id", "item_shingles", "shared")
    )


def clean(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that hold no item, unchanged."""
    leaks = materialize(contained(keyed(docs), items, percent).select("key").distinct())
    own = docs.select(F.struct("*").alias("row"), _key("doc_id", "text").alias("key"))
    return own.join(leaks, "key", "left_anti").select("row.*")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, item_id, item_shingles, shared, containment`` of all pairs."""
    pairs = contained(keyed(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))
    best = pairs.groupBy("doc_id", "item_id").agg(
        F.max(F.struct(F.col("shared") / F.col("item_shingles"), "shared", "item_shingles")).alias("m")
    )
    return best.select(
        "doc_id",
        "item_id",
        F.col("m.item_shingles").cast("long").alias("item_shingles"),
        F.col("m.shared").cast("long").alias("shared"),
        (F.col("m.shared") / F.col("m.item_shingles")).alias("containment"),
    )


# Plain counting of distinct shingles held in common, without signatures.
OP1_SQL = r"""
WITH w AS (
  SELECT 'd' AS side, doc_id AS id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \t\n\x0b\x0c\r]+'), lambda x: x <> '') AS ws FROM documents
  UNION ALL
  SELECT 'i', item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \t\n\x0b\x0c\r]+'), lambda x: x <> '') FROM benchmark
), s AS (
  SELECT DISTINCT side, id, array_to_string(ws[p:p + 4], ' ') AS shingle
  FROM (SELECT side, id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS p FROM w WHERE len(ws) > 0)
), n AS (SELECT id, count(*) AS item_shingles FROM s WHERE side = 'i' GROUP BY id),
h AS (
  SELECT d.id AS doc_id, i.id AS item_id, count(*) AS shared
  FROM s d JOIN s i ON d.shingle = i.shingle AND d.side = 'd' AND i.side = 'i' GROUP BY ALL
)
SELECT doc_id, item_id, item_shingles, shared, shared / item_shingles AS containment
FROM h JOIN n ON n.id = h.item_id WHERE shared * 100 >= item_shingles * 75
"""
