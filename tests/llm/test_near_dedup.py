import random

import pytest

from tablefit.llm import near_dedup
from tablefit.llm.common import table

SF001 = "/root/testdata/sf0.001"


def brute(rows, width=5, percent=75):
    """{(doc_id, text): (n, component)} for unique, non-null doc_ids."""
    sets = {}
    for doc_id, text in rows:
        w = (text or "").encode().lower().split()
        grams = {tuple(w[i : i + width]) for i in range(max(len(w) - width + 1, 1))} if w else set()
        sets[doc_id] = grams
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            inter = len(sets[a] & sets[b])
            if inter and 100 * inter >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {d: (len(sets[d]), find(d)) for d in ids}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_matches_brute_force_on_documents(spark):
    docs = table(spark, SF001, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    out = near_dedup.op8_near_dedup(spark, SF001)
    assert result(out) == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out.collect())


def test_chains_of_edited_copies(spark):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    rows, doc_id = [], 0
    for _ in range(12):
        text = [rnd.choice(words) for _ in range(rnd.choice([6, 30, 80, 200]))]
        for _ in range(12):  # each is an edit of the one before: ends of the chain differ widely
            rows.append((doc_id, " ".join(text)))
            doc_id += 1
            for _ in range(max(1, len(text) // 60)):
                text[rnd.randrange(len(text))] = rnd.choice(words)
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(near_dedup.near_duplicates(df)) == brute(rows)


@pytest.mark.parametrize("text", [None, "", " \t\n\x0b"])
def test_texts_without_words_link_with_nothing(spark, text):
    df = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")
    assert sorted(map(tuple, near_dedup.near_duplicates(df).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_short_case_repeated_null_ids_and_extra_columns(spark):
    long = "x " * 50_000 + "end"
    rows = [(4, "A b C"), (3, "a\tB c"), (9, "a b"), (7, long), (8, long + " "), (None, "a b c"), (3, "a\tB c"), (5, "É b c"), (6, "é b c")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS component_id", "'q' AS sig", "2 AS a")
    got = sorted(map(tuple, near_dedup.near_duplicates(df).collect()), key=str)
    assert got == sorted(
        [(4, 1, 3, False), (3, 1, 3, True), (3, 1, 3, True), (9, 1, 9, True), (7, 2, 7, True), (8, 2, 7, False),
         (None, 1, None, True), (5, 1, 5, True), (6, 1, 6, True)],
        key=str,
    )


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert near_dedup.near_duplicates(df).count() == 0


def test_estimate_is_close_to_the_similarity(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 700).astype(np.uint64)
    a, b = np.unique(base[:600]), np.unique(base[100:])  # 500 of 700
    rows = [(near_dedup.pack(near_dedup.minima(a)).tolist(), near_dedup.pack(near_dedup.minima(b)).tolist())]
    df = spark.createDataFrame(rows, "x array<long>, y array<long>")
    assert abs(df.select(near_dedup.estimate("x", "y").alias("e")).first().e - 500 / 700) < 0.15


def edited_group(rnd, n, length, edits, base_copies=0):
    words = [f"w{i}" for i in range(10**6)]
    base = [rnd.choice(words) for _ in range(length)]
    out = [" ".join(base)] * base_copies
    for _ in range(n):
        text = list(base)
        for i in rnd.sample(range(length), rnd.choice(edits)):
            text[i] = rnd.choice(words)
        out.append(" ".join(text))
    return out


def counted(monkeypatch):
    """The pairs that each exact test gets."""
    sizes, real = [], near_dedup._links
    monkeypatch.setattr(near_dedup, "_links", lambda pairs, *a: sizes.append(pairs.count()) or real(pairs, *a))
    return sizes


def test_pairs_grow_linearly_in_a_group_that_stays_apart(spark, monkeypatch):
    """Copies with 2 of 60 words changed share most buckets and link with nothing."""
    sizes = counted(monkeypatch)
    totals = []
    for n in (200, 1200):
        rows = list(enumerate(edited_group(random.Random(1), n, 60, [2])))  # brute force: nothing links
        df = spark.createDataFrame(rows, "doc_id long, text string")
        sizes.clear()
        assert result(near_dedup.near_duplicates(df)) == brute(rows)
        totals.append(sum(sizes))
    assert totals[1] <= 8 * totals[0] + 1000, totals


def test_copies_with_few_and_many_edits(spark, monkeypatch):
    """Some link with the original, some with nothing: the last round gets few pairs."""
    sizes = counted(monkeypatch)
    rows = list(enumerate(edited_group(random.Random(2), 700, 150, [1, 2, 3, 4, 5, 6], base_copies=3)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(near_dedup.near_duplicates(df)) == brute(rows)
    assert sum(sizes) < 20 * len(rows), sizes


def test_own_shingles_are_counted_across_batches(spark, monkeypatch):
    rows = [(i, f"a b c d e f x{i} y{i} z{i} u{i} v{i}") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    own = df.mapInArrow(near_dedup._own_shingles(5), "h long, n long, id long").groupBy("h").sum("n").where("`sum(n)` = 1").count()
    assert own == 50 * 5
