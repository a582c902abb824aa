"""The registered queries: SQL where there is some, the pipeline stage by stage."""

from collections import Counter

import pytest

import corpus_pipeline
from chatprep.llm import ORACLES, QUERIES
from tests.llm import brute
from tests.oracle import DATA, compare, connect

SF = "sf0.001"


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    df = QUERIES[name](spark, str(DATA / SF))
    if name in ORACLES:
        assert not compare(connect(SF), df, ORACLES[name])
    elif "doc_id" in df.columns:
        table = spark.read.parquet(str(DATA / SF / "documents.parquet"))
        assert Counter(r.doc_id for r in df.collect()) == Counter(r.doc_id for r in table.collect())


def test_queries_without_sql_equal_plain_versions(spark):
    sf = str(DATA / SF)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op4_repeated_windows"](spark, sf).collect()}
    assert got == {
        (i, n, n - len(kept.split()), brute.sha(kept)) for i, n, kept in brute.kept_words(docs, 13)
    }
    got = {(r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in QUERIES["op2_suffix_dedup"](spark, sf).collect()}
    assert got == {(i, n, n - len(kept), brute.sha(kept)) for i, n, kept in brute.kept_bytes(docs, 400)}
    prints = [(i, brute.fingerprint(t)) for i, t in docs]
    low = brute.components(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    got = {tuple(r) for r in QUERIES["op10_simhash_components"](spark, sf).collect()}
    assert got == {(i, f"{fp:016x}", c) for (i, fp), c in zip(prints, low)}


def test_pipeline(spark):
    sf = str(DATA / SF)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    good = corpus_pipeline.keep_good_quality(spark, docs, sf)
    rows = good.collect()
    kept = {r.doc_id for r in rows}
    assert sum(i in kept for i, q in labels.items() if q == 1) >= 0.9 * sum(q == 1 for q in labels.values())
    good = spark.createDataFrame(rows, docs.schema)
    single = corpus_pipeline.drop_exact_copies(spark, good, sf).collect()
    norms = Counter("".join(brute.words(r.text)) for r in rows)
    assert Counter("".join(brute.words(r.text)) for r in single) == Counter(norms.keys())
    single = spark.createDataFrame(single, docs.schema)
    apart = corpus_pipeline.drop_near_copies(spark, single, sf).collect()
    prints = [(r.doc_id, brute.fingerprint(r.text)) for r in single.collect()]
    low = brute.components(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    assert sorted(r.doc_id for r in apart) == sorted(set(low))
    apart = spark.createDataFrame(apart, docs.schema)
    mixed = corpus_pipeline.mix_sources(spark, apart, sf)
    assert mixed.schema.names == docs.schema.names
    ids = corpus_pipeline.encode(spark, mixed, sf).collect()
    assert Counter(r.doc_id for r in ids) == Counter(r.doc_id for r in mixed.collect())
    assert all(r.n_tokens == len(r.ids) for r in ids)
    assert [name for name, _ in corpus_pipeline.STAGES] and corpus_pipeline.ORACLE_SQL is None


def test_pipeline_stages_take_edge_rows(spark, edge_docs, no_docs):
    """Nulls, empty and long texts, repeated rows and clashing columns, stage by stage; then no rows."""
    sf = str(DATA / SF)
    docs, columns = edge_docs, edge_docs.columns
    texts = {r.text or "" for r in edge_docs.collect()}
    seen = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == columns, name
        docs = spark.createDataFrame(out.collect(), edge_docs.schema)
        seen.append(docs.count())
        if name != "source mixing":
            assert {r.text or "" for r in docs.collect()} <= texts and seen[-1] <= seen[-2]
    ids = corpus_pipeline.encode(spark, docs, sf).collect()
    assert len(ids) == seen[-1] > 0 and all(r.n_tokens == len(r.ids) for r in ids)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, sf).count() == 0, name
