"""Byte-level BPE encoding and decoding (operator 4).

A text is cut by a pattern into pieces; each piece is encoded alone. A piece
that is itself in the vocabulary is that token. Otherwise its bytes are the
first tokens, and a segment tree over the byte positions holds at each leaf
the rank of the pair that starts there (of the token at that position and
its live right neighbour) and at each inner node the smallest pair below it,
the leftmost one on a tie. A merge takes the root, joins the pair, closes the
right token's leaf and renews the leaves of the merged token and of its left
neighbour: three point updates of logarithmic cost.

Pieces up to ``SHORT`` bytes run in lock step, one row of a numpy matrix
each; longer ones run alone, so a piece of a million bytes needs a million
logarithmic steps. A worker remembers the pieces that it has encoded, up to
``PIECE_CACHE`` of them.

Null texts count as empty: no ids, empty bytes. Every row is answered on its
own, so repeated rows, ties and null ids need no care.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefit.llm.common import table

VOCABULARY = "byte_bpe_50k.tiktoken"
PIECE_CACHE = 150_000
SHORT = 64
#: Bytes of a vocabulary file that the driver sends to the workers at most.
MAX_VOCABULARY_BYTES = 64 << 20
#: Characters that a worker cuts into pieces at a time (a longer text stays whole).
_PORTION = 1_000_000


class ByteBPE:
    def __init__(self, vocabulary: bytes, pattern: str) -> None:
        self.token_of: list[bytes] = []
        ranks: dict[bytes, int] = {}
        for line in vocabulary.splitlines():
            if line:
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        size = max(ranks.values()) + 1
        self.token_of = [b""] * size
        for token, rank in ranks.items():
            self.token_of[rank] = token
        self.ranks = ranks
        self.size = size
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * size + right] = rank
        self.pairs = pairs
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)
        self.ints = list(range(size))
        self.tokens = pa.array(self.token_of, pa.large_binary())
        self.find = regex.compile(pattern).findall
        self.known: dict[str, tuple[int, ...]] = {}

    def _rank(self, left: np.ndarray, right: np.ndarray, none: int) -> np.ndarray:
        key = left * self.size + right
        at = np.searchsorted(self.pair_keys, key)
        at[at == len(self.pair_keys)] = 0
        return np.where((right >= 0) & (left >= 0) & (self.pair_keys[at] == key), self.pair_ranks[at], none)

    def _merge_short(self, pieces: list[bytes]) -> list[list[int]]:
        """Pieces of one size class, a row each."""
        n, longest = len(pieces), max(map(len, pieces))
        leaves = 1 << max(1, (longest - 1).bit_length())
        lengths = np.fromiter(map(len, pieces), np.int64, n)
        flat = np.frombuffer(b"".join(pieces), np.uint8)
        live = np.arange(leaves) < lengths[:, None]
        token = np.full((n, leaves + 1), -1, np.int64)  # the last column stands for "no neighbour"
        token[:, :leaves][live] = self.byte_ids[flat]
        right = np.minimum(np.arange(1, leaves + 2), lengths[:, None])
        right[right == lengths[:, None]] = leaves
        left = np.tile(np.arange(-1, leaves), (n, 1))  # -1, the last column, likewise
        left[:, 0] = leaves
        none = self.size * leaves
        tree = np.full((n, 2 * leaves), none, np.int64)
        rank = self._rank(token[:, : leaves - 1], token[:, 1:leaves], -1)
        tree[:, leaves : 2 * leaves - 1] = np.where(rank >= 0, rank * leaves + np.arange(leaves - 1), none)
        width = leaves
        while width > 1:
            level = tree[:, width : 2 * width]
            tree[:, width // 2 : width] = np.minimum(level[:, ::2], level[:, 1::2])
            width //= 2
        rows = np.flatnonzero(tree[:, 1] < none)
        while len(rows):
            best = tree[rows, 1]
            at = best % leaves
            gone = right[rows, at]
            token[rows, at] = best // leaves
            token[rows, gone] = -1
            after = right[rows, gone]
            right[rows, at] = after
            left[rows, after] = at
            before = left[rows, at]
            fresh = self._rank(token[rows, at], np.where(after < leaves, token[rows, after], -1), -1)
            tree[rows, leaves + at] = np.where(fresh >= 0, fresh * leaves + at, none)
            tree[rows, leaves + gone] = none
            has = before < leaves
            front = np.where(has, before, at)
            fresh = self._rank(np.where(has, token[rows, front], -1), token[rows, at], -1)
            tree[rows, leaves + front] = np.where(has, np.where(fresh >= 0, fresh * leaves + front, none), tree[rows, leaves + front])
            nodes = [leaves + at, leaves + gone, leaves + front]
            while nodes[0][0] > 1:
                nodes = [x >> 1 for x in nodes]
                for x in nodes:
                    tree[rows, x] = np.minimum(tree[rows, 2 * x], tree[rows, 2 * x + 1])
            rows = rows[tree[rows, 1] < none]
        body = token[:, :leaves]
        kept = body >= 0
        counts = kept.sum(axis=1)
        ends = np.cumsum(counts).tolist()
        ids = list(map(self.ints.__getitem__, body[kept].tolist()))
        return [ids[e - c : e] for e, c in zip(ends, counts.tolist())]

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same on plain lists, for one piece."""
        n = len(piece)
        leaves = 1 << (n - 1).bit_length()
        none = self.size * leaves
        pairs, size = self.pairs, self.size
        token = [int(self.byte_ids[b]) for b in piece]
        right, left = list(range(1, n + 1)), list(range(-1, n))
        tree = [none] * (2 * leaves)
        for i in range(n - 1):
            rank = pairs.get(token[i] * size + token[i + 1])
            if rank is not None:
                tree[leaves + i] = rank * leaves + i
        for i in range(leaves - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])

        def put(i: int, value: int) -> None:
            i += leaves
            tree[i] = value
            while i > 1:
                i >>= 1
                a, b = tree[2 * i], tree[2 * i + 1]
                value = a if a < b else b
                if tree[i] == value:
                    break
                tree[i] = value

        while tree[1] < none:
            at = tree[1] % leaves
            token[at] = tree[1] // leaves
            gone = right[at]
            after = right[at] = right[gone]
            token[gone] = -1
            if after < n:
                left[after] = at
                rank = pairs.get(token[at] * size + token[after])
                put(at, none if rank is None else rank * leaves + at)
            else:
                put(at, none)
            put(gone, none)
            before = left[at]
            if before >= 0:
                rank = pairs.get(token[before] * size + token[at])
                put(before, none if rank is None else rank * leaves + before)
        return [self.ints[t] for t in token if t >= 0]

    def _learn(self, missing: Iterable[str]) -> None:
        classes: dict[int, list[tuple[str, bytes]]] = {}
        for piece in missing:
            raw = piece.encode("utf-8", "surrogatepass")
            whole = self.ranks.get(raw)
            if whole is not None:
                self.known[piece] = (self.ints[whole],)
            elif len(raw) > SHORT:
                self.known[piece] = tuple(self._merge_long(raw))
            else:
                classes.setdefault((len(raw) - 1).bit_length(), []).append((piece, raw))
        for group in classes.values():
            for start in range(0, len(group), 20_000):
                part = group[start : start + 20_000]
                for (piece, _), ids in zip(part, self._merge_short([raw for _, raw in part])):
                    self.known[piece] = tuple(ids)

    def encode(self, texts: list[str]) -> list[list[int]]:
        cut = [self.find(t) for t in texts]
        distinct = set().union(*cut) if cut else set()
        if len(self.known) > PIECE_CACHE:
            self.known.clear()
        self._learn(distinct - self.known.keys())
        get = self.known.__getitem__
        return [list(chain.from_iterable(map(get, pieces))) for pieces in cut]

    def decode_all(self, flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The bytes of each of the rows of ids that ``offsets`` cut ``flat`` into:
        the ids' tokens are taken one after the other, so a row is one stretch
        of their bytes."""
        taken = self.tokens.take(pa.array(flat))
        ends = np.frombuffer(taken.buffers()[1], np.int64, len(flat) + 1, taken.offset * 8) if len(flat) else np.zeros(1, np.int64)
        bytes_at = (ends[offsets] - ends[0]).astype(np.int32)
        data = taken.buffers()[2].slice(int(ends[0])) if len(flat) else pa.py_buffer(b"")
        return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(bytes_at.tobytes()), data])

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.token_of.__getitem__, ids))


_LOADED: dict[tuple[int, str], ByteBPE] = {}


def _codec(vocabulary: bytes, pattern: str) -> ByteBPE:
    key = (hash(vocabulary), pattern)
    if key not in _LOADED:
        _LOADED[key] = ByteBPE(vocabulary, pattern)
    return _LOADED[key]


def portions(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``_PORTION`` characters."""
    start = chars = 0
    for i, text in enumerate(texts):
        if chars and chars + len(text) > _PORTION:
            yield start, i
            start, chars = i, 0
        chars += len(text)
    if start < len(texts):
        yield start, len(texts)


def _tokens(vocabulary, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary.value, pattern)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for start, end in portions(texts):
                encoded = codec.encode(texts[start:end])
                offsets = np.zeros(end - start + 1, np.int32)
                np.cumsum([len(x) for x in encoded], out=offsets[1:])
                flat = np.fromiter(chain.from_iterable(encoded), np.int32, int(offsets[-1]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, end - start), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                     codec.decode_all(flat, offsets)],
                    ["doc_id", "ids", "decoded"],
                )

    return run


def tokenize(docs: DataFrame, vocabulary_path: str, pattern: str) -> DataFrame:
    """``doc_id, ids array<int>, decoded binary`` of each row of ``docs(doc_id,
    text)``; ``decoded`` comes from the ids. The vocabulary file is read on
    the driver and sent to the workers."""
    with open(vocabulary_path, "rb") as f:
        vocabulary = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(vocabulary) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{vocabulary_path} has more than {MAX_VOCABULARY_BYTES} bytes")
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_tokens(sent, pattern), "doc_id long, ids array<int>, decoded binary")


def digests(tokens: DataFrame, *more: str) -> DataFrame:
    """``doc_id``, the columns ``more`` of ``tokens``, and the digests of ids and bytes."""
    return tokens.select(
        "doc_id",
        *more,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(tokenize(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN))
