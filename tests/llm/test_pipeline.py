import base64
import hashlib

import public_tokenizers
import tiktoken

import corpus_pipeline
from tablefit.llm import byte_bpe, quality
from tablefit.llm.common import table
from tests_llm_plain import dedup_plain, grams, pii_plain

SF001 = "/root/testdata/sf0.001"


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_every_stage_against_a_plain_version(spark, tmp_path):
    docs = table(spark, SF001, "documents")
    items = [r.text for r in table(spark, SF001, "benchmark").collect()]
    now = docs
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = texts(now)
        stage(spark, now, SF001).write.parquet(f"{tmp_path}/{i}")
        out = spark.read.parquet(f"{tmp_path}/{i}")
        if name != "byte-level BPE":
            assert out.columns == docs.columns
            after = texts(out)
        if name == "quality classifier":
            good = {r.doc_id for r in quality.op9_quality(spark, SF001).collect() if r.predicted}
            assert after == {d: t for d, t in before.items() if d in good} and len(after) < len(before)
        elif name == "MinHash near-dedup":
            keep = {d for d, (_, c) in dedup_plain(before.items()).items() if c == d}
            assert after == {d: t for d, t in before.items() if d in keep} and len(after) < len(before)
        elif name == "benchmark decontamination":
            held = {d for d, t in before.items() if any(100 * len(grams(q) & grams(t)) >= 75 * len(grams(q)) for q in items if grams(q))}
            assert set(after) == set(before) - held and held
        elif name == "PII":
            assert set(after) == set(before)
            for d, t in before.items():
                if not pii_plain(t):
                    assert after[d] == t or "[SECRET]" in after[d] or "[IBAN]" in after[d]
                else:
                    assert not pii_plain(after[d]) and after[d] != t
            assert all(r.n_chars == len(r.text) for r in out.collect())
        else:
            with open(public_tokenizers.path(byte_bpe.VOCABULARY), "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            rows = {r.doc_id: r for r in out.collect()}
            assert set(rows) == set(before)
            for d, t in before.items():
                ids = library.encode_ordinary(t)
                assert rows[d].ids == ids and rows[d].n_tokens == len(ids)
                assert rows[d].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
        now = out
    whole = {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, SF001).collect()}
    assert whole == {r.doc_id: r.ids_sha256 for r in now.collect()}


def test_odd_rows_and_an_empty_table(spark):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "A b c d e f g"), (None, None), (None, None), (None, "a b c d e f g"), (3, ""), (4, None)]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], table(spark, SF001, "documents").schema)
    docs = docs.selectExpr("*", "7 AS component_id", "8 AS `key`", "9 AS kind")
    for name, stage in corpus_pipeline.STAGES[1:]:
        out = stage(spark, docs, SF001)
        if name == "MinHash near-dedup":
            assert out.columns == docs.columns
            assert sorted((str(r.doc_id), r.text) for r in out.collect() if r.text) == [("1", "a b c d e f g"), ("None", "a b c d e f g")]
            assert out.count() == 6
        else:
            assert out.count() == len(rows)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF001).count() == 0


def test_different_texts_of_one_doc_id_are_judged_apart(spark):
    near = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
    rows = [(1, near), (5, near + " more"), (5, "a text of its own that nothing else is like at all"), (5, near + " more"), (5, None), (5, ""),
            (6, "another text that stands alone in this table of ours"), (6, "and one more that stands alone here for good")]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], table(spark, SF001, "documents").schema)
    out = corpus_pipeline.near_dedup_stage(spark, docs, SF001).collect()
    assert sorted((r.doc_id, r.text or "") for r in out) == [
        (1, near), (5, ""), (5, "a text of its own that nothing else is like at all"),
        (6, "and one more that stands alone here for good"), (6, "another text that stands alone in this table of ours")]
