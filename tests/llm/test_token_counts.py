import json
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tablefit.llm import token_counts as tc
from tablefit.llm.common import table

SF001 = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(tc.VOCABULARY)


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, "rb") as f:
        return tc.Vocabulary(f.read())


@pytest.fixture(scope="module")
def own(vocabulary):
    p = public_tokenizers.PATTERN
    return tc.TokenCounter(vocabulary.proven, vocabulary.ranks, vocabulary.added, p, tc.unlike(p))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def n(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


def test_counts_as_the_library_does(own, library):
    rnd = random.Random(12)
    texts = ["", "a", "hello  world\n\n x", "a" * 5000, "1234567890" * 300, "<|endoftext|>", "x<|endoftext|> <|endoftext|>y <|endoftext",
             "a  <|endoftext|>  b", "   x\x85\x1c\x1d y", "日本語のテキスト", "😀👍🏽" * 40, "!?" * 700, "it's we'll don't'S", "\x00\x01 \x7f",
             " " * 300, "x" + " " * 90 + "y", "\t\r\n\x0b\x0c ", "՘ՙ \U00010940\U00010941a", "é‍  z"]
    alphabet = "ab  cdeth1\n.é😀ß՘"
    texts += ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(200))) for _ in range(300)]
    texts += ["".join(rnd.choice("abcdeth") for _ in range(rnd.randrange(60, 140))) for _ in range(50)]
    texts += ["".join(chr(rnd.choice([rnd.randrange(32, 0x600), rnd.randrange(0x600, 0xD800), rnd.randrange(0xE000, 0x20000)]))
                      for _ in range(60)) for _ in range(200)]
    assert [own.count(t) for t in texts] == [n(library, t) for t in texts]


def test_every_character_in_context(own, library):
    step = 23
    for start in range(step):
        for lo in range(start, 0x30000, step * 500):
            codes = [c for c in range(lo, min(lo + step * 500, 0x30000), step) if not 0xD800 <= c < 0xE000]
            text = "".join(f"a{chr(c)}1 {chr(c)}{chr(c)}! " for c in codes)
            if start in (0, 7):
                assert own.count(text) == n(library, text), hex(lo)


def test_proof_holds_and_spares_merges(own, vocabulary, library):
    whole = {t.decode() for t in vocabulary.proven if t.isascii()}
    spec = json.load(open(PATH))
    for token in random.Random(2).sample(sorted(whole), 2000):
        if len(library.pre_tokenizer.pre_tokenize_str(token)) == 1:
            assert n(library, token) == 1
    assert len(vocabulary.proven) <= len(spec["model"]["vocab"])
    fresh = tc.TokenCounter(vocabulary.proven, vocabulary.ranks, vocabulary.added, public_tokenizers.PATTERN, tc.unlike(public_tokenizers.PATTERN))
    assert fresh.count(" the and of" * 50) == 150 and fresh.counts.merges == 0
    assert fresh.count(" zqxjkv zqxjkv") == n(library, " zqxjkv zqxjkv") and fresh.counts.merges == 1


def test_a_vocabulary_string_that_merges_stop_before():
    """``abc`` is in the vocabulary, but ``bc`` joins first and ``a`` + ``bc`` never."""
    chars = sorted(tc.byte_of_char())
    vocab = {c: i for i, c in enumerate([*chars, "bc", "ab", "abc"])}
    spec = {"added_tokens": [], "normalizer": None, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True},
            "model": {"type": "BPE", "vocab": vocab, "merges": ["b c", "a b", "ab c"]}}
    v = tc.Vocabulary(json.dumps(spec).encode())
    assert b"abc" not in v.proven and b"ab" in v.proven and len(v.proven) == 258
    own = tc.TokenCounter(v.proven, v.ranks, [], public_tokenizers.PATTERN, tc.unlike(public_tokenizers.PATTERN))
    other = Tokenizer.from_str(json.dumps({"version": "1.0", "truncation": None, "padding": None, "post_processor": None, "decoder": None, **spec}))
    assert own.count("abc") == n(other, "abc") == 2


@pytest.mark.parametrize("change", [
    {"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"model": {"type": "WordPiece"}},
    {"added_tokens": [{"id": 1, "content": "x", "lstrip": True}]},
])
def test_other_tokenizers_are_refused(change):
    spec = json.load(open(PATH)) | change
    with pytest.raises(ValueError):
        tc.Vocabulary(json.dumps(spec).encode())


def test_both_ways_to_merge_agree(vocabulary):
    rnd = random.Random(6)
    for _ in range(500):
        piece = bytes(rnd.choice(b"abcdeth ") for _ in range(rnd.randrange(0, 100)))
        assert tc.merged(piece, vocabulary.ranks) == tc._merged_by_heap(piece, vocabulary.ranks)


def test_the_cache_starts_anew(own, vocabulary, library, monkeypatch):
    monkeypatch.setattr(tc, "REST_CACHE", 3)
    counts = tc.Counts(vocabulary.proven, vocabulary.ranks)
    words = [" zq" + c * 3 for c in "abcdefgh"]
    assert [counts[w] for w in words * 2] == [n(library, w) for w in words * 2]
    assert len(counts) <= len(counts.whole) + 3


def test_long_texts_are_cut_where_nothing_changes(own, library, monkeypatch):
    rnd = random.Random(1)
    text = "".join(rnd.choice(["word", " it's", "  two", "\n", " 1", "é ", "!"]) for _ in range(60_000))
    monkeypatch.setattr(tc, "_LONG", 1000)
    assert own.count(text) == n(library, text)
    assert own.count("x" * 5000) == n(library, "x" * 5000)


def test_query_matches_the_library_on_all_documents(spark, library):
    rows = table(spark, SF001, "documents").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in tc.op12_token_counts(spark, SF001).collect()}
    assert len(got) == len(rows)
    for r in rows:
        g, text = got[r.doc_id], r.text or ""
        assert (g.n_bytes, g.n_tokens, g.over_limit) == (len(text.encode()), n(library, text), n(library, text) > 1024)


def test_odd_rows(spark, library):
    rows = [(1, None), (1, None), (2, ""), (None, "z"), (3, "q" * 300_000), (4, "<|endoftext|>" * 1025)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 AS n_tokens", "'x' AS over_limit")
    got = [tuple(r) for r in tc.token_counts(df, PATH, public_tokenizers.PATTERN).collect()]
    long = n(library, "q" * 300_000)
    assert got == [(1, 0, 0, False), (1, 0, 0, False), (2, 0, 0, False), (None, 1, 1, False), (3, 300_000, long, True), (4, 13 * 1025, 1025, True)]
    none = spark.createDataFrame([], "doc_id long, text string")
    assert tc.token_counts(none, PATH, public_tokenizers.PATTERN).count() == 0
