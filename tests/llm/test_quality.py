import math
import string
import zlib

import numpy as np

from tablefit.llm import quality
from tablefit.llm.common import table

SF01 = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    out = quality.op9_quality(spark, SF01)
    labels = {r.doc_id: r.quality for r in table(spark, SF01, "labels").collect()}
    rows = out.collect()
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert len(held) > 50
    assert np.mean([p == y for p, y in held]) >= 0.95


def test_isotonic_against_brute_force():
    rng = np.random.default_rng(2)
    y = rng.random(40)
    w = rng.integers(1, 5, 40).astype(float)
    x, steps = quality.isotonic(np.arange(40.0), y, w)
    fitted = np.interp(np.arange(40.0), x, steps)
    mean = lambda i, j: np.average(y[i : j + 1], weights=w[i : j + 1])
    want = [max(min(mean(i, j) for j in range(k, 40)) for i in range(k + 1)) for k in range(40)]
    assert np.allclose(fitted, want)


def test_normal_equations_do_not_depend_on_partitions(spark):
    stats = quality.statistics(table(spark, SF01, "documents"))
    labels = table(spark, SF01, "labels")
    a = quality.fit(stats.repartition(1), labels)
    b = quality.fit(stats.repartition(7), labels)
    assert np.allclose(a.weights, b.weights, atol=1e-6)


def test_nulls_empty_long_repeated_and_extra_columns(spark):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "w " * 200_000), (3, "w " * 200_000), (4, "\n\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0.5D AS score", "1 AS stats", "1 AS y")
    model = quality.fit(quality.statistics(table(spark, SF01, "documents")), table(spark, SF01, "labels"))
    got = quality.scores(quality.statistics(docs), model).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert got[3].score == got[4].score
    assert quality.accept(docs, model).columns == docs.columns


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    model = quality.fit(quality.statistics(docs), none)
    assert quality.scores(quality.statistics(docs), model).collect()[0].score == 0.5
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert quality.scores(quality.statistics(empty), model).count() == 0


def plain_statistics(text):
    """The numbers of one text, character by character and word by word."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return [math.log(1 + len(raw)), 1.0] + [0.0] * 19
    sets = [string.ascii_uppercase, string.ascii_lowercase, string.digits, " \t\x0b\x0c\r", "\n", "!?", "#$%&*+/<=>@\\^_`{|}~", ".,;:'\"()-[]"]
    shares = [sum(chr(c) in s for c in raw) / len(raw) for s in sets] + [sum(c > 127 for c in raw) / len(raw)]
    n, sizes = len(words), [len(w) for w in words]
    mean = sum(sizes) / n
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return [
        math.log(1 + len(raw)), 0.0, *shares, mean, math.sqrt(sum((x - mean) ** 2 for x in sizes) / n), len(set(words)) / n,
        max(words.count(w) for w in set(words)) / n, sum(w.isalpha() for w in words) / n, sum(w.isupper() for w in words) / n,
        sum(x <= 2 for x in sizes) / n, math.log(1 + n / len(lines)), 1 - len(set(lines)) / len(lines), raw.count(b".") / n,
    ]


def test_query_against_a_plain_version(spark):
    """Statistics, ridge on the kernel features and calibration by numpy on one machine, from the texts and labels alone."""
    texts = {r.doc_id: r.text for r in table(spark, SF01, "documents").select("doc_id", "text").collect()}
    labels = {r.doc_id: r.quality for r in table(spark, SF01, "labels").collect() if r.quality is not None and r.doc_id in texts}
    fold = lambda d: zlib.crc32(str(d).encode()) % 4
    stats = {d: plain_statistics(t) for d, t in texts.items()}
    early, late = ([d for d in labels if fold(d) in folds] for folds in ((0, 1), (3,)))
    x = np.array([stats[d] for d in early])
    mean, spread = x.mean(axis=0), x.std(axis=0, ddof=1)
    spread[spread <= 1e-9] = 1.0
    rng = np.random.default_rng(9)
    directions, phases = rng.normal(0, 1 / math.sqrt(21), (21, quality.FEATURES)), rng.uniform(0, 2 * math.pi, quality.FEATURES)

    def kernel(ids):
        z = np.clip((np.array([stats[d] for d in ids]) - mean) / spread, -quality.REACH, quality.REACH)
        return math.sqrt(2 / quality.FEATURES) * np.cos(z @ directions + phases)

    # Ridge with a free intercept: centre both sides, then the penalised least squares as an ordinary one.
    k, y = kernel(early), np.array([float(labels[d]) for d in early])
    penalty = quality.RIDGE * len(early) / quality.FEATURES
    padded = np.vstack([k - k.mean(axis=0), math.sqrt(penalty) * np.eye(quality.FEATURES)])
    w = np.linalg.lstsq(padded, np.concatenate([y - y.mean(), np.zeros(quality.FEATURES)]), rcond=None)[0]
    raw = lambda ids: kernel(ids) @ w + y.mean() - k.mean(axis=0) @ w

    bins = np.rint(np.clip(raw(late), -2, 2) * quality.BINS).astype(int)
    places = sorted(set(bins.tolist()))
    groups = [[float(labels[d]) for d, b in zip(late, bins) if b == p] for p in places]
    total, size = np.cumsum([0.0, *map(sum, groups)]), np.cumsum([0, *map(len, groups)])
    m = len(places)
    average = lambda i, j: (total[j + 1] - total[i]) / (size[j + 1] - size[i])
    heights = [max(min(average(i, j) for j in range(c, m)) for i in range(c + 1)) for c in range(m)]
    ids = list(texts)
    want = dict(zip(ids, np.interp(raw(ids), np.array(places) / quality.BINS, heights)))
    got = {r.doc_id: r.score for r in quality.op9_quality(spark, SF01).collect()}
    assert got.keys() == want.keys()
    assert max(abs(got[d] - want[d]) for d in ids) < 1e-6
