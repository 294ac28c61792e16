import hashlib
import random
import re

from tablefit.llm import pii
from tablefit.llm.common import table

SF001 = "/root/testdata/sf0.001"


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(re.sub("[ -]", "", m)) <= 19 and luhn(re.sub("[ -]", "", m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15),
]


def brute(text):
    return [(k, m.start(), m.end()) for k, p, ok in BASE for m in re.finditer(p, text or "") if ok(m[0])]


def check(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pii.find(df).select("doc_id", "pii_spans").collect()
    for r in sorted(rows, key=lambda r: r.doc_id):
        got = [(s["kind"], s["start"], s["end"]) for s in r.pii_spans if s["kind"] in dict((b[0], 0) for b in BASE)]
        assert got == brute(texts[r.doc_id]), texts[r.doc_id][:300]


def test_query_matches_brute_force_on_all_documents(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF001, "documents").collect()}
    rows = pii.op6_pii(spark, SF001).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w[0] == k for w in want) for k, _, _ in BASE]
        written = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert r.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert r.spans.startswith(written)


def test_base_spans_on_random_texts(spark):
    rnd = random.Random(6)
    near = ["a@b.c", "@", ".", "x@y.z.", "+1 (234) 567-8901", "4111 1111 1111 1111", "4111111111111111", "1.2.3.4", "256.1.1.1", " ", "-", "_",
            "😀", "é", "0007.1.2.3", "+49", "12", "\n", "5500-0000-0000-0004", "%", "a@b.c+d@e.f", "1.2.3.4.5.6.7.8", "(", "a@@b.c", "++1234567890"]
    texts = ["".join(rnd.choice(near) for _ in range(rnd.randrange(1, 14))) for _ in range(1500)]
    texts += ["".join(rnd.choice("0123456789 .-+@a(") for _ in range(60)) for _ in range(500)]
    check(spark, texts)


def test_long_runs_and_many_matches(spark):
    check(spark, ["1 " * 60_000, "9" * 100_000, "a" * 100_000 + "@", "a.b" * 30_000 + "@c" + ".d" * 30_000, "+1" + " (2" * 20_000,
                  "é a@b.cd 1.2.3.4 " * 700, "1." * 20_000, "😀 +1 234 567 8901,\n" * 130])


def test_added_kinds_context_and_checksums(spark):
    texts = ["IBAN DE89 3704 0044 0532 0130 00.", "bank DE89370400440532013001", 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"',
             "hash 24be64439e3e49cf46b2d7c90f3602a3d0b907ff", "SSN 123-45-6789", "number 123-45-6789", "call +1 234 567 8901", "x +1 234 567 8901"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [(s["kind"], s["score"]) for s in r.pii_spans] for r in pii.find(df).collect()}
    assert got == {0: [("iban", 1.0)], 1: [], 2: [("secret", 0.6)], 3: [], 4: [("ssn", 0.6)], 5: [], 6: [("phone", 1.0)], 7: [("phone", 0.7)]}


def test_redaction_null_empty_repeated_and_extra_columns(spark):
    rows = [(1, None), (2, ""), (3, "a@b.c, +1 234 567 8901 and 4111 1111 1111 1111!"), (3, "none"), (None, "é1.2.3.4"), (4, "a@1.2.3.4 b")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'k' AS kind", "1 AS `start.x`", "2 AS n")
    out = pii.redact(df)
    assert out.columns == df.columns
    assert [r.text for r in out.collect()] == [None, "", "[EMAIL], [PHONE] and [CARD]!", "none", "é[IP]", "[EMAIL] b"]
    assert [len(r.pii_spans) for r in pii.find(df).collect()] == [0, 0, 3, 0, 1, 2]
    assert pii.find(df.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = pii.op6_pii(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
