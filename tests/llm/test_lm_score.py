import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tablefit.llm import lm_score
from tablefit.llm.common import table

SF001 = "/root/testdata/sf0.001"


def plain(rows, k=lm_score.CONCENTRATION):
    """{(doc_id, text): row} by the formulas, on one machine."""
    toks = [(d, t, (t or "").encode().lower().split() + [None]) for d, t in rows]
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    uni, bi = Counter(), Counter()
    for d, _, w in toks:
        if not held(d):
            uni.update(w)
            bi.update(zip([None] + w[:-1], w))
    n, v = sum(uni.values()), len(uni)
    u = (sum(c == 1 for c in uni.values()) + 1) / (n + 2) if n else 1.0
    p = lambda x: (1 - u) * uni[x] / n if uni[x] else u
    out = []
    for d, t, w in toks:
        base = sum(math.log10((uni[x] + 1) / (n + v + 1)) for x in w)
        total, prev = 0.0, None
        for x in w:
            q = (bi[prev, x] + k * p(x)) / (uni[prev] + k) if prev is None or uni[prev] else p(x)
            total, prev = total + math.log10(q), x
        out.append((d, held(d), len(w), sum(uni[x] > 0 for x in w), n, base, total if n else 0.0))
    return out


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[6])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-9) and a[6] == pytest.approx(b[6], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("block_docs", [2048, 30])
def test_all_documents_against_plain_counting(spark, block_docs, monkeypatch):
    monkeypatch.setattr(lm_score, "BLOCK_DOCS", block_docs)
    rows = [(r.doc_id, r.text) for r in table(spark, SF001, "documents").select("doc_id", "text").collect()]
    got = lm_score.op2_lm_score(spark, SF001).collect()
    same(got, plain(rows))
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_all_texts_together_have_probability_one(spark):
    """From the engine's scores of all texts of up to two words (``zzz``: all unknown words as one): with
    A(w) = P("w") and M(v, w) = P("v w") / A(v), texts of k words have A M^(k-1) 1 in total."""
    held = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 7 == 2]
    train = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 7 != 2]
    words = ["a", "b", "c", "d", "zzz"]
    asked = ["", *words, *(f"{v} {w}" for v in words for w in words)]
    rows = list(zip(train, ["a b a c", "a a b", "c", "", "b d"])) + list(zip(held, asked))
    out = lm_score.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    text = dict(rows)
    p = {text[r.doc_id]: 10.0**r.score for r in out if r.held_out}
    first = np.array([p[w] for w in words])
    step = np.array([[p[f"{v} {w}"] for w in words] for v in words]) / first[:, None]
    assert p[""] + first @ np.linalg.solve(np.eye(len(words)) - step, np.ones(len(words))) == pytest.approx(1.0, rel=1e-9)


def test_equal_rows_beyond_a_block(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "BLOCK_DOCS", 3)
    rows = [(None, None)] * 40 + [(7, "a b a")] * 20 + [(i, f"a w{i}") for i in range(20)]
    same(lm_score.score(spark.createDataFrame(rows, "doc_id long, text string")).collect(), plain(rows))


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "BLOCK_DOCS", 2)
    rows = [(1, None), (2, ""), (None, "A b\x0bÉ"), (3, "a b"), (3, "a b"), (4, "w " * 100_000), (5, " \t"), (9, "new words")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS block", "2 AS bucket", "3 AS words")
    same(lm_score.score(df).collect(), plain(rows))
    assert lm_score.score(df.limit(0)).count() == 0
    only = [(d, "a b") for d in range(200) if zlib.crc32(str(d).encode()) % 7 == 2]
    assert {(r.train_tokens, r.score, r.base_score) for r in lm_score.score(spark.createDataFrame(only, "doc_id long, text string")).collect()} == {(0, 0.0, 0.0)}


def test_the_texts_are_shuffled_once(spark):
    df = lm_score.op2_lm_score(spark, SF001)
    df.collect()
    assert df._jdf.queryExecution().executedPlan().toString().count("ReusedExchange") >= 2
