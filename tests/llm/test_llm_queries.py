"""The registered training-data queries over the smallest tables, and the pipeline's stages."""

import duckdb
import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from ebbtide.llm import setjoin
from ebbtide.llm.queries import ORACLES, QUERIES
from tests.llm.test_text_operators import plain_groups, plain_removal, plain_spans

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()


def test_mixing_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    expected = con.sql(ORACLES["op3_source_mixing"])
    got = QUERIES["op3_source_mixing"](spark, SF_DIR).select(*expected.columns)
    assert sorted(map(tuple, got.collect())) == sorted(expected.fetchall())


@pytest.mark.parametrize("name", ["op1_quality_classifier", "op2_document_fingerprints", "op4_language_id"])
def test_one_row_for_each_document(spark, docs, name):
    got = QUERIES[name](spark, SF_DIR)
    assert sorted(r.doc_id for r in got.select("doc_id").collect()) == sorted(r.doc_id for r in docs)


def test_groups_equal_plain_ones(spark, docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op5_ngram_jaccard_join"](spark, SF_DIR).collect()}
    assert got == plain_groups([(r.doc_id, r.text) for r in docs])


def test_personal_data_equals_plain_patterns(spark, docs):
    got = {r.doc_id: r for r in QUERIES["op8_personal_data"](spark, SF_DIR).collect()}
    for r in docs:
        spans = plain_spans(r.text)
        counts = [sum(s[1] == k for s in spans) for k in range(4)]
        assert [got[r.doc_id][f"n_{k}"] for k in ("email", "ip", "card", "phone")] == counts
        assert {f"{k}:{a}:{b}" for a, _, b, k in spans} <= set(got[r.doc_id].spans.split(","))


def test_repeats_equal_plain_ones(spark, docs):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in QUERIES["op9_suffix_dedup"](spark, SF_DIR).collect()}
    expected = plain_removal([r.text.encode() for r in docs], 200)
    assert got == {r.doc_id: e[:3] for r, e in zip(docs, expected, strict=True)}


@pytest.mark.parametrize("name", ["op6_token_counts", "op7_benchmark_decontamination", "op10_license_scan"])
def test_other_queries_run(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_pipeline_stages(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = rows.count()
        after = stage(spark, rows, SF_DIR)
        assert after.columns == rows.columns, name
        rows = spark.createDataFrame(after.collect(), rows.schema)
        assert 0 < rows.count() <= before
        if name == "n-gram jaccard join":
            groups = setjoin.jaccard_groups(rows).collect()
            assert all(r.doc_id == r.component_id for r in groups)
        if name == "personal data":
            assert all(not plain_spans(r.text) and len(r.text) == r.n_chars for r in rows.collect())
    mixed = corpus_pipeline.STAGES[-1][1](spark, rows, SF_DIR)
    assert 0 < mixed.count() <= rows.count()
    assert corpus_pipeline.run(spark, SF_DIR).count() == mixed.count()
    empty = rows.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).count() == 0


def test_signatures_travel_in_bounded_pieces():
    """A batch of many texts is not packed at once: its signatures would be held several times over."""
    kept = {}

    class Rows:
        select = groupBy = lambda self, *_: self

        def mapInPandas(self, packed, _):
            kept["packed"] = packed
            return self

        def applyInPandas(self, joined, _):
            return self

    setjoin._shared(Rows(), 7)
    rng = np.random.default_rng(3)
    texts = [" ".join(map(str, rng.integers(0, 10**6, 400))) for _ in range(2500)]
    frames = list(kept["packed"](iter([pd.DataFrame({"text": texts})])))
    assert max(f["data"].str.len().sum() for f in frames) < 3 << 20
    pairs = [np.frombuffer(d, np.int64).reshape(-1, 2) for f in frames for d in f["data"]]
    expected = [(s, setjoin.set_key(h)) for h in setjoin.shingle_sets(texts) for s in setjoin.signatures(h)[0].view(np.int64)]
    assert sorted(map(tuple, np.concatenate(pairs).tolist())) == sorted((int(a), b) for a, b in expected)
