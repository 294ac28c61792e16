import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tablefit.llm import toxicity
from tablefit.llm.common import shingles_of, table

SF01, SF1 = "/root/testdata/sf0.01", "/root/testdata/sf0.1"


def rates(spark, sf):
    labels = {r.doc_id: r.toxic for r in table(spark, sf, "labels").collect()}
    rows = toxicity.op7_toxicity(spark, sf).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    found = sum(p for p, y in held if y) / sum(y for _, y in held)
    wrong = sum(p for p, y in held if not y) / sum(1 - y for _, y in held)
    return found, wrong


def test_held_out_rows_small(spark):
    found, wrong = rates(spark, SF01)
    assert found >= 0.4 and wrong <= 0.02


def test_held_out_rows(spark):
    found, wrong = rates(spark, SF1)
    assert found >= 0.85 and wrong <= 0.01


LEX = toxicity.Lexicon({"moron$": 5.0, "idio": 4.0, "trash$": 3.0}, ("trash can",), (1.0, 0, 0, 0), -2.0)


@pytest.mark.parametrize(
    "text, largest",
    [("you moron!", 5.0), ("m0r0n", 5.0), ("mоrоn", 5.0), ("ＭＯＲＯＮ", 5.0), ("m.o.r.o.n", 5.0), ("mo​ron", 5.0), ("moronic", 0.0), ("oxymoron", 0.0),
     ("1d1ot", 4.0), ("idiotic", 4.0), ("a trash can", 0.0), ("trash cans", 3.0), ("Trash", 3.0), ("tr4$h", 3.0), ("", 0.0), (None, 0.0),
     ("moron " * 100_000, 5.0)],
)
def test_folding_boundaries_and_exceptions(text, largest):
    assert toxicity.Matcher(LEX).numbers(text)[0] == largest


def test_length_normalises():
    m = toxicity.Matcher(LEX)
    assert m.numbers("moron " + "word " * 10)[2] > m.numbers("moron " + "word " * 1000)[2]


def test_matches_brute_force_on_documents(spark):
    texts = [r.text for r in table(spark, SF01, "documents").limit(300).collect()]
    lexicon = toxicity.Lexicon({"the$": 1.5, "th": 1.0, "ed$": 2.0, "ou": 0.5}, (), (0.0,) * 4, 0.0)
    m = toxicity.Matcher(lexicon)
    for t in texts:
        import re

        best = []
        for w in re.finditer(r"[^\W\d_]+", toxicity.fold(t)):
            got = [v for e, v in lexicon.weights.items() if (w[0] == e[:-1] if e[-1] == "$" else w[0].startswith(e))]
            best += [max(got)] if got else []
        assert m.numbers(t)[0] == max(best, default=0.0)
        assert abs(m.numbers(t)[1] - toxicity.math.log1p(sum(best))) < 1e-9


def test_no_labels_nulls_repeats_and_empty(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a"), (3, "x y"), (3, "x y")], "doc_id long, text string").selectExpr("*", "1 AS y", "2 AS label_id")
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    out = toxicity.scores(docs, toxicity.learn(docs, none)).collect()
    assert len(out) == 5 and {r.score for r in out} == {0.5}
    one = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, 1)], "doc_id long, toxic int")
    assert toxicity.scores(docs.limit(0), toxicity.learn(docs, one, held_out=9)).count() == 0


def test_learning_against_a_plain_version(spark):
    """The lexicon by plain counting on one machine, and the logistic fit by its gradient at the optimum."""
    texts = {r.doc_id: r.text for r in table(spark, SF1, "documents").select("doc_id", "text").collect()}
    labels = {r.doc_id: r.toxic for r in table(spark, SF1, "labels").collect() if r.toxic is not None and r.doc_id in texts}
    taught = [d for d in sorted(labels) if zlib.crc32(str(d).encode()) % 5]
    copies = {}
    for d in taught:  # one document per class and smallest shingle
        s = shingles_of(texts[d])
        copies.setdefault((labels[d], int(s[0]) if len(s) else 0), texts[d])
    n = Counter(y for y, _ in copies)
    seen = {0: Counter(), 1: Counter()}
    for (y, _), text in copies.items():
        words = set(re.findall(r"[^\W\d_]+", toxicity.fold(text)))
        seen[y].update({w + "$" for w in words} | {w[:k] for w in words for k in toxicity.PREFIXES if k < len(w)})
    known = [e for e in seen[0].keys() | seen[1].keys() if seen[0][e] + seen[1][e] > 1]
    want = {}
    for e in known:
        grid = np.array([[seen[1][e], seen[0][e]], [n[1] - seen[1][e], n[0] - seen[0][e]]], float)
        expected = np.outer(grid.sum(axis=1), grid.sum(axis=0)) / grid.sum()
        g = 2 * sum(a * math.log(a / b) for a, b in zip(grid.ravel(), expected.ravel()) if a)
        weight = math.log((seen[1][e] + 0.5) / (n[1] + 1)) - math.log((seen[0][e] + 0.5) / (n[0] + 1))
        if weight >= toxicity.LEAST_WEIGHT and g >= 2 * math.log(len(known) / toxicity.LEVEL):
            want[e] = weight
    got = toxicity.learn(table(spark, SF1, "documents"), table(spark, SF1, "labels"))
    assert len(want) > 20 and got.weights.keys() == want.keys()
    assert all(abs(got.weights[e] - w) < 1e-9 for e, w in want.items())

    matcher = toxicity.Matcher(got)
    x = np.array([matcher.numbers(t) for t in copies.values()])
    y = np.array([float(c) for c, _ in copies])
    wrong = 1 / (1 + np.exp(-(x @ np.array(got.coefficients) + got.intercept))) - y
    spread = x.std(axis=0, ddof=1)
    # In units of deviations, as the penalty is.
    slope = (wrong @ x / len(y) + 1e-3 * spread**2 * np.array(got.coefficients)) / np.where(spread > 0, spread, 1)
    assert abs(wrong.mean()) < 1e-4 and np.abs(slope).max() < 1e-4


def test_long_text_and_clashing_names(spark):
    lexicon = toxicity.Lexicon({"moron$": 5.0}, (), (1.0, 0.0, 0.0, 0.0), -2.0)
    docs = spark.createDataFrame([(1, "word " * 200_000 + "moron"), (2, "word")], "doc_id long, text string")
    docs = docs.selectExpr("'x' AS entry", "1 AS least", "text", "0.5 AS score", "2 AS numbers", "doc_id", "3 AS label_id", "4 AS clean")
    got = {r.doc_id: r.score for r in toxicity.scores(docs, lexicon).collect()}
    assert got[1] > 0.9 and got[2] < 0.2
    labels = spark.createDataFrame([(1, 1, "x", 1), (2, 0, "y", 2)], "doc_id long, toxic int, entry string, least int")
    assert toxicity.learn(docs, labels, held_out=9).weights == {}
