import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from tablefit.llm import byte_bpe
from tablefit.llm.common import table

SF001 = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(byte_bpe.VOCABULARY)


@pytest.fixture(scope="module")
def own():
    with open(PATH, "rb") as f:
        return byte_bpe.ByteBPE(f.read(), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def other():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encodes_as_the_library_does(own, other):
    rnd = random.Random(4)
    texts = ["", "a", "hello  world\n\n x", "a" * 5000, "1234567890" * 300, "<|endoftext|>", "   x\x85\x1c\x1d y", "日本語のテキスト", "😀👍🏽" * 40,
             "!?" * 700, "it's we'll don't'S", "\x00\x01 \x7f", " " * 300, "x" + " " * 90 + "y", "\t\r\n\x0b\x0c "]
    alphabet = "ab  cdeth1\n.é😀ß"
    texts += ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(200))) for _ in range(300)]
    texts += ["".join(rnd.choice("abcdeth") for _ in range(rnd.randrange(60, 140))) for _ in range(50)]
    got = own.encode(texts)
    assert got == [other.encode_ordinary(t) for t in texts]
    assert [own.decode(x).decode() for x in got] == texts


def test_both_forms_of_the_tree_agree(own):
    rnd = random.Random(5)
    pieces = [bytes(rnd.randrange(97, 105) for _ in range(rnd.randrange(2, 65))) for _ in range(400)]
    assert [own._merge_short([p])[0] for p in pieces[:40]] == [own._merge_long(p) for p in pieces[:40]]
    assert own._merge_short(pieces) == [own._merge_long(p) for p in pieces]


def test_query_matches_the_library_on_all_documents(spark, other):
    rows = table(spark, SF001, "documents").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in byte_bpe.op4_byte_bpe(spark, SF001).collect()}
    assert len(got) == len(rows)
    for r in rows:
        ids = other.encode_ordinary(r.text or "")
        g = got[r.doc_id]
        assert g.n_tokens == len(ids)
        assert g.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert g.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_null_empty_repeated_and_long_rows(spark):
    rows = [(1, None), (1, None), (2, ""), (None, "z"), (3, "q" * 300_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 AS ids", "'x' AS decoded")
    out = byte_bpe.digests(byte_bpe.tokenize(df, PATH, public_tokenizers.PATTERN)).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert [(r.doc_id, r.n_tokens) for r in out[:4]] == [(1, 0), (1, 0), (2, 0), (None, 1)]
    assert all(r.ids_sha256 == empty and r.decoded_sha256 == empty for r in out[:3])
    assert out[4].decoded_sha256 == hashlib.sha256(b"q" * 300_000).hexdigest()
    none = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.tokenize(none, PATH, public_tokenizers.PATTERN).count() == 0


def test_rows_are_decoded_together(own, monkeypatch):
    texts = ["", "a", "日本語 テキスト", "", "hello  world\n\n x", "q" * 3000, ""]
    rows = own.encode(texts)
    offsets = byte_bpe.np.cumsum([0, *map(len, rows)]).astype("int32")
    flat = byte_bpe.np.array([i for r in rows for i in r], "int32")
    monkeypatch.setattr(byte_bpe.ByteBPE, "decode", None)  # no token by token loop
    assert own.decode_all(flat, offsets).to_pylist() == [t.encode() for t in texts]
    assert own.decode_all(flat[:0], offsets[:1]).to_pylist() == []
    assert own.decode_all(flat[:0], byte_bpe.np.zeros(3, "int32")).to_pylist() == [b"", b""]
