"""Trie of conversation prefixes over padded turn-id matrices (operator 13).

Two conversations share a node of depth d if their first d turns have the same
roles and texts. For every node the operator gives its members, children,
leaves, the bytes saved by keeping each shared turn once, and a digest of the
conversations that end there.

1. Each turn becomes the first 128 bits of a SHA-256 of role and text, so no
   text is shuffled; each conversation becomes one row, a list of these.
2. Conversations are range-partitioned by (list, id) into shards of about
   ``TURNS_PER_SHARD`` turns. The id breaks ties, so one list, however common,
   and one first turn fall into as many shards as their rows need. Each shard
   also gets the first list of the next one.
3. A shard numbers its turns densely and fills a matrix, a row per
   conversation, padded with -1. ``numpy.lexsort`` puts rows with a common
   prefix together; the masks of columns that differ from the row above,
   OR-accumulated from the left, mark where the nodes of every depth start, and
   ``reduceat`` aggregates them. ``BLOCK`` columns are taken at a time, of the
   rows that reach them, so a long conversation pads no other.
4. Nodes that lie on the path of the shard's first list or of the next
   shard's first list may have members elsewhere. Their sums are partial: the
   last shard that holds a node counts it as a child and as a leaf, so that all
   sums add up, and a grouping by the digest of the prefix recombines them.
   All other nodes are final in their shard.

The ends of a node are hashed where they are; those of a shared node come as
blocks of ``IDS_PER_BLOCK`` ids, which one task hashes in order as they stream
by (SHA-256 of one long string can't be split).

Nulls: a null role or text is empty; rows without a conv_id belong to no
conversation and take no part. Turns are ordered by ``turn``, null first; turns
of one number by the digest of role and text, repeated rows counting each. An
empty table has no node. Extra columns are not read. A conversation is one
row, as a text is: its turns' digests meet in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablefit.llm.common import materialize, release, table

#: Turns that a shard holds on average (one more of at most the longest conversation).
TURNS_PER_SHARD = 200_000
#: Columns of a padded matrix.
BLOCK = 32
IDS_PER_BLOCK = 1024

_EMPTY_SHA = hashlib.sha256(b"").hexdigest()
_FINAL, _PART, _ENDS = 0, 1, 2
_OUT = [
    ("kind", pa.int32()), ("shard", pa.int32()), ("node", pa.binary()), ("parent", pa.binary()), ("conv_id", pa.int64()),
    ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
    ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends", pa.string()), ("block", pa.int64()),
]
_OUT_DDL = (
    "kind int, shard int, node binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends string, block long"
)


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns array<struct<key binary, bytes long>>``, a row per conversation, turns in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").alias("turn"),
            F.substring(F.unhex(F.sha2(whole, 256)), 1, 16).alias("key"),
            F.octet_length(text).cast("long").alias("bytes"),
        ).alias("t"),
    )
    ordered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return ordered.select("conv_id", F.transform("turns", lambda t: F.struct(t["key"].alias("key"), t["bytes"].alias("bytes"))).alias("turns"))


class Matrix:
    """The sorted prefixes of a shard's conversations, depth by depth."""

    def __init__(self, keys: np.ndarray, lengths: np.ndarray, conv: np.ndarray) -> None:
        """``keys``: 16 bytes a turn, row after row. Rows sort by turns, then ``conv``, then place."""
        self.lengths, self.conv = lengths, conv
        self.offsets = np.concatenate(([0], np.cumsum(lengths)))[:-1]
        halves = np.frombuffer(keys, ">u8").astype(np.uint64).reshape(-1, 2)
        self.ids = np.empty(len(halves), np.int64)
        if len(halves):
            order = np.lexsort((halves[:, 1], halves[:, 0]))
            new = (halves[order[1:]] != halves[order[:-1]]).any(axis=1)
            self.ids[order] = np.concatenate(([0], np.cumsum(new)))

    def depths(self, block: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For d = 1, 2, ...: d, the rows of at least d turns in order, and the
        places among them where the nodes of depth d start."""
        longest = int(self.lengths.max(initial=0))
        group = np.zeros(len(self.lengths), np.int64)  # of the rows' node at the end of the last block
        for base in range(0, longest, block):
            rows = np.flatnonzero(self.lengths > base)
            width = min(block, longest - base)
            matrix = np.full((len(rows), width), -1, np.int64)
            here = np.minimum(self.lengths[rows] - base, width)
            live = np.arange(width) < here[:, None]
            first = self.offsets[rows] + base
            matrix[live] = self.ids[(first[:, None] + np.arange(width))[live]]
            order = np.lexsort((self.conv[rows], *matrix.T[::-1], group[rows]))
            rows, matrix, here = rows[order], matrix[order], here[order]
            change = np.ones((len(rows), width + 1), bool)
            change[1:, 0] = np.diff(group[rows]) != 0
            change[1:, 1:] = matrix[1:] != matrix[:-1]
            np.logical_or.accumulate(change, axis=1, out=change)
            for j in range(width):
                reach = np.flatnonzero(here > j)
                yield base + j + 1, rows[reach], np.flatnonzero(change[reach, j + 1])
            group[rows] = np.cumsum(change[:, width])


def _lists(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Lengths and values of a list column without nulls inside its used part."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.diff(column.offsets.to_numpy()).astype(np.int64), column.flatten()


def shard_nodes(table_: pa.Table, block: int = BLOCK, ids_per_block: int = IDS_PER_BLOCK) -> pa.Table:
    """The nodes of one shard: final ones, parts of shared ones, and the ends of these."""
    is_next = table_.column("is_next").to_numpy().astype(bool)
    order = np.argsort(is_next, kind="stable")  # the next shard's first list stands last
    table_ = table_.take(pa.array(order)).combine_chunks()
    shard, n = int(table_.column("shard")[0].as_py()), table_.num_rows
    has_next = bool(is_next.any())
    real = n - has_next
    conv = np.full(n, np.iinfo(np.int64).max)
    conv[:real] = table_.column("conv_id").slice(0, real).to_numpy()
    lengths, values = _lists(table_.column("keys"))
    keys = np.frombuffer(b"".join(values.to_pylist()), np.uint8).reshape(-1, 16)
    sizes = _lists(table_.column("sizes"))[1].to_numpy(zero_copy_only=False).astype(np.int64)
    matrix = Matrix(keys.tobytes(), lengths, conv)
    weight = np.ones(n, np.int64)
    weight[real:] = 0
    out: list[dict[str, object]] = []
    blocks: list[tuple[bytes, int, str]] = []

    # From the root down: nodes, members and what they share with other shards.
    levels = []
    conv_above, key_above = np.zeros(n, np.int64), np.zeros(n, np.int64)  # of each row's node one level up; key: 0 none, 1, 2
    chain = [b"", b""]  # digests of the paths of the first list and of the next shard's first list

    def level(depth: int, rows: np.ndarray, starts: np.ndarray, paths: tuple[int, int]) -> dict:
        first_row, next_row = paths
        part = np.maximum.reduceat((rows == first_row).astype(np.int64), starts) + 2 * np.maximum.reduceat((rows == next_row).astype(np.int64), starts)
        members = np.add.reduceat(weight[rows], starts)
        node_conv = np.minimum.reduceat(conv[rows], starts)
        top = rows[starts]
        count = np.diff(np.append(starts, len(rows)))
        info = {
            "depth": depth, "rows": rows, "starts": starts, "path": part, "members": members, "conv": node_conv,
            "above_conv": conv_above[top], "above_key": key_above[top], "keys_above": tuple(chain),
            "longest": np.maximum.reduceat(np.where(weight[rows] > 0, lengths[rows], -1), starts),
        }
        if depth:
            for which, row in enumerate(paths):
                if row >= 0 and lengths[row] >= depth:
                    at = int(matrix.offsets[row]) + depth - 1
                    chain[which] = hashlib.blake2b(chain[which] + keys[at].tobytes(), digest_size=16).digest()
        info["keys"] = tuple(chain)
        conv_above[rows] = np.repeat(node_conv, count)
        key_above[rows] = np.repeat(part, count)
        return info

    depths = matrix.depths(block)
    first = next(depths, None)
    # the shard's first list: the empty one of the smallest id, or else the first of the sorted rows
    empty = np.flatnonzero((lengths == 0) & (weight > 0))
    if len(empty):
        first_row = int(empty[np.argmin(conv[empty])])
    else:
        first_row = _first(matrix, n)
    paths = (first_row, n - 1 if has_next else -1)
    levels.append(level(0, np.arange(n), np.zeros(1, np.int64), paths))
    while first is not None:
        levels.append(level(*first, paths))
        first = next(depths, None)

    # From the leaves up: what the rows carry is summed over each node's rows.
    saved, leaf, child = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for info in reversed(levels):
        rows, starts, depth = info["rows"], info["starts"], info["depth"]
        owned = info["path"] < 2  # the next shard has no member
        top = rows[starts]
        if depth:
            at = matrix.offsets[rows] + depth - 1
            saved[rows] += sizes[at] * weight[rows]
            saved[top] -= np.where(owned, sizes[at[starts]], 0)
        childless = owned & (info["longest"] == depth)
        leaf[top[childless]] = 1
        info["n_children"] = np.add.reduceat(child[rows], starts)
        info["n_leaves"] = np.add.reduceat(leaf[rows], starts)
        info["saved"] = np.add.reduceat(saved[rows], starts)
        child[rows] = 0
        child[top[owned]] = 1

    for info in levels:
        rows, starts, depth = info["rows"], info["starts"], info["depth"]
        keep = info["members"] > 0
        at_end = np.flatnonzero((lengths[rows] == depth) & (weight[rows] > 0))
        which = np.searchsorted(starts, at_end, side="right") - 1
        if depth == 0:
            inside = np.argsort(conv[rows[at_end]], kind="stable")
            at_end, which = at_end[inside], which[inside]
        ends = np.full(len(starts), _EMPTY_SHA, object)
        edges = np.flatnonzero(np.diff(which, prepend=-1, append=-2)) if len(which) else []
        for a, b in zip(edges[:-1], edges[1:]):
            node, ids = int(which[a]), conv[rows[at_end[a:b]]]
            if info["path"][node]:
                key = info["keys"][0] if info["path"][node] & 1 else info["keys"][1]
                for k in range(0, len(ids), ids_per_block):
                    blocks.append((key, k // ids_per_block, ",".join(map(str, ids[k : k + ids_per_block].tolist()))))
            else:
                ends[node] = hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()
        path, above = info["path"][keep], info["above_key"][keep]
        key_of = lambda marks, two: [None if m == 0 else two[0] if m & 1 else two[1] for m in marks.tolist()]
        shared = path > 0
        has_final_parent = (above == 0) & (depth > 0)
        m = int(keep.sum())
        out.append({
            "kind": np.where(shared, _PART, _FINAL).astype(np.int32), "shard": np.full(m, shard, np.int32),
            "node": key_of(path, info["keys"]), "parent": key_of(above, info["keys_above"]) if depth else [None] * m,
            "conv_id": info["conv"][keep], "depth": np.full(m, depth, np.int64),
            "parent_conv_id": pa.array(info["above_conv"][keep], pa.int64(), mask=~has_final_parent),
            "n_convs": info["members"][keep], "n_children": info["n_children"][keep], "n_leaves": info["n_leaves"][keep],
            "saved_tokens": info["saved"][keep], "ends": pa.array(np.where(shared, None, ends[keep]).tolist(), pa.string()),
            "block": pa.nulls(m, pa.int64()),
        })
    if blocks:
        m = len(blocks)
        none = pa.nulls(m, pa.int64())
        out.append({
            "kind": np.full(m, _ENDS, np.int32), "shard": np.full(m, shard, np.int32), "node": [b[0] for b in blocks],
            "parent": [None] * m, "conv_id": none, "depth": none, "parent_conv_id": none, "n_convs": none, "n_children": none,
            "n_leaves": none, "saved_tokens": none, "ends": [b[2] for b in blocks], "block": [b[1] for b in blocks],
        })
    schema = pa.schema(_OUT)
    tables = [
        pa.Table.from_arrays([x[name] if isinstance(x[name], pa.Array) else pa.array(x[name], kind) for name, kind in _OUT], schema=schema)
        for x in out
    ]
    return pa.concat_tables(tables)


def _first(matrix: Matrix, n: int) -> int:
    """The row that sorts first: at each depth the rows of the smallest turn, of those that end there the smallest id."""
    rows, depth = np.arange(n), 0
    while len(rows) > 1:
        done = rows[matrix.lengths[rows] == depth]
        if len(done):
            return int(done[np.argmin(matrix.conv[done])])
        ids = matrix.ids[matrix.offsets[rows] + depth]
        rows, depth = rows[ids == ids.min()], depth + 1
    return int(rows[0])


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest a node, of blocks that come in order."""
    node, sha = None, None

    def row(key: bytes, digest: str) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest])], ["node", "ends_sha256"])

    for batch in batches:
        for i in range(batch.num_rows):
            key, text = batch.column(0)[i].as_py(), batch.column(1)[i].as_py().encode()
            if key != node:
                if node is not None:
                    yield row(node, sha.hexdigest())
                node, sha = key, hashlib.sha256(text)
            else:
                sha.update(b"," + text)
    if node is not None:
        yield row(node, sha.hexdigest())


def prefix_trie(seqs: DataFrame) -> DataFrame:
    """The nodes of the trie of ``seqs(conv_id, turns)``, a row per conversation:
    ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``."""
    spark = seqs.sparkSession
    rows = seqs.select("conv_id", F.col("turns.key").alias("keys"), F.col("turns.bytes").alias("sizes"))
    turns = rows.agg(F.sum(F.size("keys") + 1)).first()[0] or 0
    n_shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // TURNS_PER_SHARD))
    placed = rows.repartitionByRange(n_shards, "keys", "conv_id")
    shards = materialize(placed.select(F.spark_partition_id().alias("shard"), "*"))
    # One row a shard: its first list goes to the shard before it.
    firsts = shards.groupBy("shard").agg(F.min("keys").alias("keys"))
    before = firsts.select(F.lag("shard").over(Window.orderBy("shard")).alias("shard"), "keys").where("shard IS NOT NULL")
    empty = F.transform("keys", lambda _: F.lit(0).cast("long"))
    given = shards.withColumn("is_next", F.lit(False)).unionByName(
        before.select("shard", F.lit(None).cast("long").alias("conv_id"), "keys", empty.alias("sizes"), F.lit(True).alias("is_next"))
    )
    block, ids_per_block = BLOCK, IDS_PER_BLOCK
    nodes = materialize(given.groupBy("shard").applyInArrow(lambda t: shard_nodes(t, block, ids_per_block), _OUT_DDL))
    release(shards)

    parts = nodes.where(F.col("kind") == _PART)
    summed = parts.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("shard").alias("last"), F.any_value("parent").alias("parent"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
    )
    blocks = nodes.where(F.col("kind") == _ENDS).select("node", "shard", "block", "ends")
    streamed = blocks.repartition("node").sortWithinPartitions("node", "shard", "block").select("node", "ends")
    hashed = streamed.mapInArrow(_hash_ends, "node binary, ends_sha256 string")
    whole = materialize(summed.join(hashed, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY_SHA))))
    # Parents that other shards have members of, as each shard has to know them.
    known = parts.select("shard", "node").join(whole.select("node", F.col("conv_id").alias("above")), "node").select(
        "shard", F.col("node").alias("parent"), "above"
    )
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    final = nodes.where(F.col("kind") == _FINAL).withColumnRenamed("ends", "ends_sha256")
    inner = final.where("parent IS NULL").select(columns)
    outer = final.where("parent IS NOT NULL").join(known, ["shard", "parent"]).withColumn("parent_conv_id", F.col("above")).select(columns)
    shared = (
        whole.withColumnRenamed("last", "shard").join(known, ["shard", "parent"], "left").withColumn("parent_conv_id", F.col("above")).select(columns)
    )
    return inner.unionByName(outer).unionByName(shared)


def rebuilt(seqs: DataFrame) -> DataFrame:
    """Every conversation c as the query's contract wants it: the first h turns
    of conversation c - c % 5, then c's own turns after its first h, h being
    the CRC-32 of c modulo 9."""
    heads = seqs.select(F.col("conv_id").alias("head_id"), F.slice("turns", 1, 8).alias("head"))
    own = seqs.withColumn("h", F.expr("cast(crc32(cast(cast(conv_id AS string) AS binary)) % 9 AS int)"))
    joined = own.join(heads, F.expr("conv_id - conv_id % 5 = head_id"), "left")
    return joined.selectExpr(
        "conv_id",
        "concat(CASE WHEN head IS NULL THEN slice(turns, 1, 0) ELSE slice(head, 1, h) END, slice(turns, h + 1, greatest(size(turns) - h, 0))) AS turns",
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    seqs = materialize(sequences(table(spark, sf_dir, "conversations")))
    built = materialize(rebuilt(seqs))
    nodes = prefix_trie(built)
    release(seqs, built)
    return nodes


# The nodes by their whole prefixes, and DuckDB's CRC-32 from its table (see
# the query of periodic runs).
OP13_SQL = """
WITH crc AS (
  SELECT list(list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY n) AS t
  FROM range(256) AS r(n)),
seq AS (
  SELECT conv_id, list(coalesce(role, '') || chr(31) || coalesce(text, '') ORDER BY turn NULLS FIRST, role, text) AS own,
         list(strlen(coalesce(text, '')) ORDER BY turn NULLS FIRST, role, text) AS own_size
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
hashed AS (
  SELECT seq.*, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(cast(conv_id AS varchar), ''), lambda x: cast(ord(x) AS bigint))),
                                lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) % 9 AS h
  FROM seq, crc),
built AS (
  SELECT a.conv_id, list_concat(coalesce(b.own, [])[:a.h], a.own[a.h + 1:]) AS turns,
         list_concat(coalesce(b.own_size, [])[:a.h], a.own_size[a.h + 1:]) AS sizes
  FROM hashed a LEFT JOIN seq b ON b.conv_id = a.conv_id - a.conv_id % 5),
member AS (
  SELECT conv_id, d, list_reduce(list_prepend('', turns[:d]), lambda p, x: sha256(p || x)) AS node,
         CASE WHEN d > 0 THEN list_reduce(list_prepend('', turns[:d - 1]), lambda p, x: sha256(p || x)) END AS parent,
         CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size, len(turns) AS n
  FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM built)),
node AS (
  SELECT d, node, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved,
         max(n) = d AS leaf, coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (WHERE n = d), '') AS ends
  FROM member GROUP BY d, node),
below AS (
  SELECT a.d, a.node, sum(x.saved) AS saved_tokens, sum(CASE WHEN x.leaf THEN 1 ELSE 0 END) AS n_leaves
  FROM (SELECT DISTINCT u.d, u.node, v.d AS xd, v.node AS xnode FROM member u JOIN member v ON u.conv_id = v.conv_id AND v.d >= u.d) a
  JOIN node x ON x.d = a.xd AND x.node = a.xnode GROUP BY a.d, a.node),
child AS (SELECT parent, d - 1 AS d, count(*) AS n_children FROM node WHERE d > 0 GROUP BY ALL)
SELECT node.conv_id, node.d AS depth, up.conv_id AS parent_conv_id, node.n_convs, coalesce(child.n_children, 0) AS n_children,
       cast(below.n_leaves AS bigint) AS n_leaves, cast(below.saved_tokens AS bigint) AS saved_tokens, sha256(node.ends) AS ends_sha256
FROM node JOIN below ON below.d = node.d AND below.node = node.node
LEFT JOIN child ON child.d = node.d AND child.parent = node.node
LEFT JOIN node up ON up.d = node.d - 1 AND up.node = node.parent
"""
