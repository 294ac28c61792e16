"""Token counts by the whole-token shortcut (operator 12).

A text is cut at the strings of added tokens (one token each) and then by the
pattern into pre-tokens; each of them is merged alone. Most pre-tokens of real
text are strings of the vocabulary, but that alone does not make them one
token: the merges, taken by rank, may stop before. So the driver proves once,
before any text is read, which strings of the vocabulary merge to one token
when they stand alone. A pre-token among the proven ones counts 1 without a
merge; only the rest is merged (pieces beyond ``_SHORT`` bytes by a heap of
rank and place). A worker remembers the counts of up to ``REST_CACHE`` merged
ones.

Character classes depend on the Unicode version. The driver compares how the
pattern and the tokenizer library cut around every character of the basic
plane; texts with a character that they treat differently, or that lies
beyond that plane, are cut by the library's own splitter. Long texts are cut
in front of a blank after an ASCII letter or digit, where no pre-token can
reach across, so that memory doesn't grow with their pre-tokens.

Null texts count as empty: 0 bytes, 0 tokens. Every row is answered on its
own, so repeated rows, ties and null ids need no care; other columns are not
read. An empty table gives an empty one. Tokenizer files with a normalizer, a
pre-tokenizer other than the byte-level one, dropout or word affixes are
refused with a ``ValueError``.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefit.llm.byte_bpe import portions
from tablefit.llm.common import table

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
#: Merged pre-tokens whose counts a worker keeps; beyond it the table starts anew.
REST_CACHE = 250_000
#: Bytes of a tokenizer file that the driver reads and sends to the workers at most.
MAX_VOCABULARY_BYTES = 64 << 20
#: Characters from which a text is cut before the pattern runs over it.
_LONG = 200_000
#: Bytes up to which a pre-token is merged by scanning its pairs.
_SHORT = 100
_CUT = regex.compile(r"(?<=[A-Za-z0-9]) ")


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    visible Latin-1 characters for themselves, the other bytes in order from U+0100 on."""
    visible = {b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b}
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def merged(piece: bytes, ranks: dict[tuple[bytes, bytes], int]) -> list[bytes]:
    """The tokens of one pre-token: the pair of the smallest rank joins first, the leftmost one on a tie."""
    if len(piece) > _SHORT:
        return _merged_by_heap(piece, ranks)
    get, none = ranks.get, len(ranks)
    tokens = [piece[i : i + 1] for i in range(len(piece))]
    pairs = [get(p, none) for p in zip(tokens, tokens[1:])]
    while pairs:
        best = min(pairs)
        if best == none:
            break
        i = pairs.index(best)
        tokens[i] += tokens.pop(i + 1)
        del pairs[i]
        if i < len(pairs):
            pairs[i] = get((tokens[i], tokens[i + 1]), none)
        if i:
            pairs[i - 1] = get((tokens[i - 1], tokens[i]), none)
    return tokens


def _merged_by_heap(piece: bytes, ranks: dict[tuple[bytes, bytes], int]) -> list[bytes]:
    n = len(piece)
    token: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
    right, left = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []

    def offer(i: int) -> None:
        if i >= 0 and right[i] < n:
            rank = ranks.get((token[i], token[right[i]]))
            if rank is not None:
                heapq.heappush(heap, (rank, i, token[i], token[right[i]]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        if token[i] != a or right[i] >= n or token[right[i]] != b:
            continue  # one of the two has gone into another merge
        gone = right[i]
        token[i], token[gone] = a + b, None
        right[i] = right[gone]
        if right[i] < n:
            left[right[i]] = i
        offer(left[i])
        offer(i)
    return [t for t in token if t is not None]


class Vocabulary:
    """What counting needs of a tokenizer file: merges, added strings and the proven whole tokens."""

    def __init__(self, raw: bytes) -> None:
        spec = json.loads(raw)
        model, cut = spec["model"], spec.get("pre_tokenizer") or {}
        affixes = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        if model.get("type") != "BPE" or any(model.get(k) for k in affixes) or spec.get("normalizer"):
            raise ValueError("only plain BPE without a normalizer")
        if cut.get("type") != "ByteLevel" or not cut.get("use_regex", True) or cut.get("add_prefix_space"):
            raise ValueError("only the byte-level pre-tokenizer with its pattern and no blank put in front")
        added = spec.get("added_tokens") or []
        if any(t.get("single_word") or t.get("lstrip") or t.get("rstrip") for t in added):
            raise ValueError("added tokens must match exactly their own string")
        self.added = sorted((t["content"] for t in added), key=len, reverse=True)
        byte = byte_of_char()
        if not byte.keys() <= model["vocab"].keys():
            raise ValueError("the vocabulary lacks single bytes")
        as_bytes = lambda s: bytes(map(byte.__getitem__, s))
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.ranks = {(as_bytes(a), as_bytes(b)): rank for rank, (a, b) in enumerate(pairs)}
        added_ids = {t["id"] for t in added}
        strings = [as_bytes(s) for s, i in model["vocab"].items() if i not in added_ids]
        self.proven = [s for s in strings if len(merged(s, self.ranks)) == 1]


@lru_cache(maxsize=4)
def unlike(pattern: str) -> str:
    """A character class of what the pattern and the library cut differently, or may."""
    from tokenizers import pre_tokenizers

    library = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    find = regex.compile(pattern).finditer
    ranges: list[list[int]] = []
    for code in range(0x10000):
        c = chr(code)
        probe = f"a{c}1{c}!{c} {c}{c}b"
        if 0xD800 <= code < 0xE000 or [m.span() for m in find(probe)] != [span for _, span in library.pre_tokenize_str(probe)]:
            if ranges and ranges[-1][1] == code - 1:
                ranges[-1][1] = code
            else:
                ranges.append([code, code])
    return "[" + "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in ranges) + "\\U00010000-\\U0010ffff]"


class Counts(dict):
    """Tokens of a pre-token: of the proven ones from the start, of up to ``REST_CACHE`` others once merged."""

    def __init__(self, proven: list[bytes], ranks: dict[tuple[bytes, bytes], int]) -> None:
        self.whole = {}
        for token in proven:
            try:
                self.whole[token.decode()] = 1
            except UnicodeDecodeError:
                pass  # part of a character: never a pre-token
        super().__init__(self.whole)
        self.ranks, self.merges = ranks, 0

    def __missing__(self, piece: str) -> int:
        if len(self) >= len(self.whole) + REST_CACHE:
            self.clear()
            self.update(self.whole)
        self.merges += 1
        count = self[piece] = len(merged(piece.encode("utf-8", "surrogatepass"), self.ranks))
        return count


class TokenCounter:
    def __init__(self, proven: list[bytes], ranks: dict, added: list[str], pattern: str, unlike_class: str) -> None:
        from tokenizers import pre_tokenizers

        self.counts = Counts(proven, ranks)
        self.find = regex.compile(pattern).findall
        self.unlike = regex.compile(unlike_class).search
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.library = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)

    def _pieces(self, text: str) -> list[str]:
        if self.unlike(text):
            return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]
        return self.find(text)

    def _plain(self, text: str) -> int:
        get, total, start = self.counts.__getitem__, 0, 0
        while len(text) - start > _LONG:
            cut = _CUT.search(text, start + _LONG)
            if cut is None:
                break
            total += sum(map(get, self._pieces(text[start : cut.start()])))
            start = cut.start()
        return total + sum(map(get, self._pieces(text[start:] if start else text)))

    def count(self, text: str) -> int:
        if self.added is None:
            return self._plain(text)
        total, start = 0, 0
        for found in self.added.finditer(text):
            total += 1 + self._plain(text[start : found.start()])
            start = found.end()
        return total + self._plain(text[start:] if start else text)


_LOADED: dict[str, TokenCounter] = {}


def _counted(sent, key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _LOADED:
            _LOADED[key] = TokenCounter(*sent.value)
        count = _LOADED[key].count
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for start, end in portions(texts):
                part = texts[start:end]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, end - start), pa.array([len(t.encode("utf-8", "surrogatepass")) for t in part], pa.int64()),
                     pa.array(map(count, part), pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"],
                )

    return run


@lru_cache(maxsize=4)
def _prepared(raw: bytes) -> Vocabulary:
    return Vocabulary(raw)


def token_counts(docs: DataFrame, vocabulary_path: str, pattern: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of each row of ``docs(doc_id,
    text)``. The tokenizer file is read, and its whole tokens proven, on the
    driver; what counting needs goes to the workers."""
    with open(vocabulary_path, "rb") as f:
        raw = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(raw) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{vocabulary_path} has more than {MAX_VOCABULARY_BYTES} bytes")
    v = _prepared(raw)
    sent = docs.sparkSession.sparkContext.broadcast((v.proven, v.ranks, v.added, pattern, unlike(pattern)))
    key = hashlib.sha256(raw + pattern.encode()).hexdigest()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = rows.mapInArrow(_counted(sent, key), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
