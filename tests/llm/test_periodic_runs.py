import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablefit.llm import periodic_runs as pr
from tablefit.llm.common import table

SF001 = "/root/testdata/sf0.001"


def brute(words, min_length=6, min_periods=4):
    """All runs by every period and every start."""
    n, runs = len(words), []
    for q in range(1, n // min_periods + 1):
        equal = [words[i] == words[i + q] for i in range(n - q)]
        i = 0
        while i < len(equal):
            if not equal[i]:
                i += 1
                continue
            end = i
            while end < len(equal) and equal[end]:
                end += 1
            part = words[i : end + q]
            if len(part) >= max(min_length, min_periods * q) and not any(part[:-p] == part[p:] for p in range(1, q)):
                runs.append((i, len(part), q))
            i = end
    return sorted(runs, key=lambda r: (r[0], r[2]))


def answer(doc_id, text):
    """The query's row, from the contract's words."""
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (
        doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest(),
    )


def ids(words):
    return pr.word_ids([w.encode() for w in words])


def texts():
    rnd = random.Random(11)
    for _ in range(1500):
        words = [rnd.choice("abc"[: rnd.randrange(1, 4)]) for _ in range(rnd.randrange(0, 60))]
        for _ in range(rnd.randrange(3)):
            q = rnd.randrange(1, 30)
            unit = [rnd.choice("abcdxyz") for _ in range(q)]
            at = rnd.randrange(len(words) + 1)
            words[at:at] = (unit * 7)[: rnd.randrange(1, 7 * q + 1)]
        yield words


def test_runs_equal_all_periods_and_starts():
    for words in texts():
        assert pr.find_runs(ids(words)) == brute(words), words


def test_other_bounds():
    for words in list(texts())[:200]:
        for bounds in ((2, 2), (3, 2), (10, 2), (30, 3), (1, 5)):
            assert pr.find_runs(ids(words), *bounds) == brute(words, *bounds), (words, bounds)
    with pytest.raises(ValueError):
        pr.find_runs(ids("ab"), 6, 1)


def test_long_periods_and_nested_runs():
    rnd = random.Random(3)
    unit = [str(rnd.randrange(50)) for _ in range(700)] + ["z"] * 9
    words = ["x"] + unit * 5 + ["y"]
    found = pr.find_runs(ids(words))
    assert (1, 5 * 709, 709) in found and sum(q == 1 for _, _, q in found) == 5
    assert found == brute(words)


def test_work_stays_linear_on_one_word_and_on_fibonacci_words(monkeypatch):
    calls = []
    real = pr._equal_after
    monkeypatch.setattr(pr, "_equal_after", lambda *a: calls.append(a) or real(*a))
    n = 200_000
    assert pr.find_runs(np.zeros(n, np.int64)) == [(0, n, 1)]
    assert len(calls) == 1  # the table of covered places skips all other seeds
    calls.clear()
    a, b = "a", "ab"
    while len(b) < 50_000:
        a, b = b, b + a
    pr.find_runs(ids(list(b)))
    assert len(calls) < len(b)


def test_every_run_is_seeded_by_its_class():
    assert [pr.guaranteed(lo, 6, 4) for lo in (1, 2, 6, 19, 58)] == [5, 6, 18, 57, 174]


def test_query_equals_brute_force(spark):
    docs = table(spark, SF001, "documents").where("length(text) < 4000")
    want = sorted(answer(r.doc_id, r.text) for r in docs.collect())
    got = sorted(map(tuple, pr.digests(pr.periodic_runs(pr.with_repeats(docs))).collect()))
    assert got == want and sum(r[1] > 0 for r in got) >= len(got) // 20
    every = pr.op11_periodic_runs(spark, SF001)
    assert every.count() == table(spark, SF001, "documents").count()
    assert every.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_odd_rows(spark):
    long = " ".join(["again and"] * 60_000)
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a a a a a a a"), (4, "b b"), (4, "b b"), (4, "é é " * 8), (5, long), (34, "a b c d e f g h"),
            (34, ""), (34, None)]
    rows += [(i, "one two three four five six seven eight nine ten") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS runs", "'x' AS words", "0 AS h", "0 AS n")
    got = sorted(map(tuple, pr.digests(pr.periodic_runs(pr.with_repeats(df))).collect()), key=str)
    # the long row by what it must be: one run of period two
    want = [answer(*r) for r in rows if r[0] != 5 or r[1] is not long]
    row = next(r for r in got if r[1] and r[3] == 120_000)
    assert row[2:6] == (0, 120_000, 2, 60_000_000) and row[7] == hashlib.sha256(b"again and").hexdigest()
    got.remove(row)
    assert got == sorted(want, key=str)
    none = df.limit(0)
    assert pr.digests(pr.periodic_runs(pr.with_repeats(none))).count() == 0


def test_operator_returns_spans_and_text(spark):
    df = spark.createDataFrame([(1, "go " + "x y " * 5 + "stop")], "doc_id long, text string").withColumn("collapsed", F.lit(1))
    (row,) = pr.periodic_runs(df).collect()
    assert row.n_words == 12 and [tuple(r) for r in row.runs] == [(1, 10, 2)] and row.collapsed == "go x y stop"
