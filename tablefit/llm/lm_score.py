"""Language-model scores of documents (operator 2).

The model is a bigram model over lower-cased words with a last token ``end``
per document. Unigrams: p(w) = (1 - u) * c(w) / N for words seen in training
and u for all others together (one type, as the base score has it), where
u = (singletons + 1) / (N + 2). Bigrams: p(w | v) = (c(vw) + K * p(w)) /
(c(v) + K) with K = ``CONCENTRATION``, which sums to one over w.

As a weighted backoff automaton: a state for every context word, one for the
start of a text and the root. A state has an arc for each bigram of positive
count, with the logarithm of its smoothed probability; all other words take
the failure arc to the root, of weight log K / (c(v) + K), and the root's arc
there. One traversal from left to right carries the state and adds up the
weights. An unknown word leads to the root.

The counts are those of all training documents, however many. They do not fit
one machine, so every block of about ``BLOCK_DOCS`` documents sees only the
part of the automaton that its own texts can reach:

1. a block lists its distinct n-grams as hashes with its training counts, cut
   into buckets by hash;
2. a bucket sums the counts over all blocks and answers each block in the
   block's order;
3. the block builds its part of the automaton and scores its texts.

Buckets grow in number with the blocks, so their size stays; hashes spread
n-grams evenly, however frequent they are, as a block names each one once.
Keys hold ``KEY_BYTES`` bytes besides the bucket's number, so two n-grams of
one bucket fall together with a chance of about 1e-12 a pair.

Null texts count as empty: one token, ``end``. A null doc_id has the crc32 of
the empty text, so its rows train. Repeated rows train and are scored each by
itself. Without training rows N is 0 and all scores are 0.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefit.llm.common import table, words_of
from tablefit.llm.quality import fold_of

FOLDS, HELD_OUT = 7, 2
BLOCK_DOCS = 2048
BUCKETS_PER_BLOCK = 2
KEY_BYTES = 5
CONCENTRATION = 20.0

END = b" "  # no word holds a space
_KEY = np.uint64((1 << 8 * KEY_BYTES) - 1)
_SCHEMA = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Block:
    """The n-grams of a block of texts. Word 0 is ``end``; as a context it is the start of a text."""

    def __init__(self, texts: list[str | None], train: np.ndarray) -> None:
        number: defaultdict[bytes, int] = defaultdict()
        number.default_factory = number.__len__
        number[END]
        docs = [words_of(t) for t in texts]
        self.sizes = np.array([len(d) + 1 for d in docs], np.int64)
        ends = np.cumsum(self.sizes) - 1
        self.seq = np.zeros(int(self.sizes.sum()), np.int64)
        inner = np.ones(len(self.seq), bool)
        inner[ends] = False
        n = int(inner.sum())
        self.seq[inner] = np.fromiter(map(number.__getitem__, chain.from_iterable(docs)), np.int64, n)
        self.words = len(number)
        context = np.zeros_like(self.seq)
        context[1:] = self.seq[:-1]
        weight = np.repeat(train, self.sizes).astype(np.int64)
        self.word_counts = np.bincount(self.seq, weights=weight, minlength=self.words).astype(np.uint32)
        self.pairs, place = np.unique(context * self.words + self.seq, return_inverse=True)
        self.pair_counts = np.bincount(place, weights=weight, minlength=len(self.pairs)).astype(np.uint32)
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, number), np.uint64, self.words)
        self.word_hashes = _mix(h)
        self.pair_hashes = _mix(_mix(h[self.pairs // self.words] + np.uint64(0x9E3779B97F4A7C15)) + h[self.pairs % self.words])

    def order(self, hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Order of the hashes by bucket and key, the keys in it, and where each bucket starts."""
        bucket = (hashes >> np.uint64(8 * KEY_BYTES)) % np.uint64(buckets)
        key = hashes & _KEY
        order = np.lexsort((key, bucket))
        return order, key[order], np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))


def _packed(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys.view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]).tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // KEY_BYTES, 8), np.uint8)
    out[:, :KEY_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, KEY_BYTES)
    return out.view(np.uint64).ravel()


def _asks(buckets: int):
    def run(docs: pd.DataFrame) -> pd.DataFrame:
        block = Block(docs["text"].tolist(), ~docs["held_out"].to_numpy(bool))
        w_order, w_keys, w_at = block.order(block.word_hashes, buckets)
        p_order, p_keys, p_at = block.order(block.pair_hashes, buckets)
        w_counts, p_counts = block.word_counts[w_order], block.pair_counts[p_order]
        rows = []
        for b in np.flatnonzero((np.diff(w_at) > 0) | (np.diff(p_at) > 0)).tolist():
            w, p = slice(w_at[b], w_at[b + 1]), slice(p_at[b], p_at[b + 1])
            rows.append((b, _packed(w_keys[w]), w_counts[w].tobytes(), _packed(p_keys[p]), p_counts[p].tobytes()))
        out = pd.DataFrame(rows, columns=["bucket", "words", "word_counts", "pairs", "pair_counts"])
        out.insert(1, "block", docs["block"].iloc[0])
        return out

    return run


def _sums(keys: pd.Series, counts: pd.Series) -> tuple[np.ndarray, list[bytes]]:
    """The summed count of each distinct key, and those of each row's keys."""
    lists = [_unpacked(k) for k in keys]
    distinct, place = np.unique(np.concatenate(lists), return_inverse=True)
    total = np.bincount(place, weights=np.frombuffer(b"".join(counts), np.uint32), minlength=len(distinct))
    # Counts go back as 64-bit numbers that compress well.
    answers = np.split(total[place].astype(np.int64), np.cumsum([len(x) for x in lists])[:-1])
    return total, [a.tobytes() for a in answers]


def _answers(rows: pd.DataFrame) -> pd.DataFrame:
    """For each block its summed counts; a row of block -1 has the bucket's tokens, types and singletons."""
    words, word_answers = _sums(rows["words"], rows["word_counts"])
    _, pair_answers = _sums(rows["pairs"], rows["pair_counts"])
    out = pd.DataFrame({"block": rows["block"], "bucket": rows["bucket"], "words": word_answers, "pairs": pair_answers})
    out["tokens"] = out["types"] = out["singles"] = 0
    totals = (-1, rows["bucket"].iloc[0], b"", b"", int(words.sum()), int((words > 0).sum()), int((words == 1).sum()))
    out.loc[len(out)] = totals
    return out


def traverse(seq: list[int], arcs: dict[int, float], root: list[float], fail: list[float], known: list[bool], words: int) -> float:
    """The log10 probability of one text (its word numbers, ``end`` last)."""
    total, state = 0.0, 0  # the start of a text
    for word in seq:
        arc = arcs.get(state * words + word) if state >= 0 else None
        if arc is None:  # down the failure arc, if not there already, and on from the root
            if state >= 0:
                total += fail[state]
            arc = root[word]
        total += arc
        state = word if known[word] else -1
    return total


def _scores(buckets: int, concentration: float):
    def run(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        block = Block(docs["text"].tolist(), ~docs["held_out"].to_numpy(bool))
        answers = answers.sort_values("bucket")
        n, v, singles = (int(answers[c].iloc[0]) for c in ("all_tokens", "all_types", "all_singles"))
        word_counts = np.empty(block.words, np.int64)
        word_counts[block.order(block.word_hashes, buckets)[0]] = np.frombuffer(b"".join(answers["words"]), np.int64)
        pair_counts = np.empty(len(block.pairs), np.int64)
        pair_counts[block.order(block.pair_hashes, buckets)[0]] = np.frombuffer(b"".join(answers["pairs"]), np.int64)

        unknown = (singles + 1) / (n + 2) if n else 1.0
        p = np.where(word_counts > 0, (1 - unknown) * word_counts / max(n, 1), unknown)
        # The start of a text is a context as often as ``end`` is a token.
        seen = np.flatnonzero(pair_counts)
        left, right = block.pairs[seen] // block.words, block.pairs[seen] % block.words
        weights = np.log10((pair_counts[seen] + concentration * p[right]) / (word_counts[left] + concentration))
        arcs = dict(zip(block.pairs[seen].tolist(), weights.tolist()))
        root, known = np.log10(p).tolist(), (word_counts > 0).tolist()
        fail = np.log10(concentration / (word_counts + concentration)).tolist()
        base = np.log10((word_counts + 1) / (n + v + 1))[block.seq]
        starts = np.cumsum(block.sizes) - block.sizes
        seq = block.seq.tolist()
        score = [
            traverse(seq[s : s + size], arcs, root, fail, known, block.words) if n else 0.0
            for s, size in zip(starts.tolist(), block.sizes.tolist())
        ]
        return pd.DataFrame(
            {
                "doc_id": docs["doc_id"].astype("Int64"), "held_out": docs["held_out"], "n_tokens": block.sizes,
                "n_known": np.add.reduceat((word_counts > 0)[block.seq].astype(np.int64), starts), "train_tokens": n,
                "base_score": np.add.reduceat(base, starts), "score": score,
            }
        )

    return run


def score(docs: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT, concentration: float = CONCENTRATION) -> DataFrame:
    """Scores of all rows of ``docs(doc_id, text)``, learnt from those outside the held-out fold."""
    blocks = max(1, -(-docs.count() // BLOCK_DOCS))
    buckets = BUCKETS_PER_BLOCK * blocks
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # One plan from here on: the texts are shuffled by block once and read by both steps that need them.
    dealt = rows.select(
        "doc_id", "text", (fold_of(F.col("doc_id"), folds) == held_out).alias("held_out"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).alias("block"),
    ).repartition("block")
    asks = dealt.groupBy("block").applyInPandas(
        _asks(buckets), "bucket long, block long, words binary, word_counts binary, pairs binary, pair_counts binary"
    )
    answers = asks.groupBy("bucket").applyInPandas(
        _answers, "block long, bucket long, words binary, pairs binary, tokens long, types long, singles long"
    )
    totals = answers.where("block = -1").agg(
        F.lit(0).alias("one"), F.sum("tokens").alias("all_tokens"), F.sum("types").alias("all_types"), F.sum("singles").alias("all_singles")
    )
    told = answers.where("block >= 0").withColumn("one", F.lit(0)).join(F.broadcast(totals), "one")  # totals is one row
    told = told.select("block", "bucket", "words", "pairs", "all_tokens", "all_types", "all_singles")
    return dealt.groupBy("block").cogroup(told.groupBy("block")).applyInPandas(_scores(buckets, concentration), _SCHEMA)


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
