"""A third of all rows share everything that could tell them apart: they are spread all the same."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from chatprep.llm import content_sort, quality, sharding
from tests.llm import brute

NAMES = "doc_id long, text string"
TEXTS = [(i, f"text {i} of its own") for i in range(600)]


@pytest.fixture(scope="module", params=[None, 7], ids=["no identifier", "one identifier"])
def hot_docs(request, spark):
    return spark.createDataFrame(TEXTS + [(request.param, "hot  text")] * 300, NAMES).repartition(5)


@pytest.fixture(autouse=True)
def all_partitions(spark):
    """Small partitions are not merged, so that they can be told apart."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


def test_exact_dedup_spreads_rows_of_one_identifier(hot_docs):
    cells = content_sort._sorted_cells(hot_docs, "doc_id", "text", carry=False)
    hot = cells.where(F.col("text_sha256") == brute.sha("hottext"))
    assert hot.select(F.spark_partition_id()).distinct().count() > 1
    rows = content_sort.exact_dedup(hot_docs).collect()
    sizes = Counter((r.group_size, r.kept) for r in rows)
    assert sizes == {(1, True): 600, (300, True): 1, (300, False): 299}
    assert content_sort.drop_copies(hot_docs).count() == 601


def test_shards_spread_rows_of_one_identifier(hot_docs, monkeypatch):
    tables = {}
    stored = sharding.stored
    monkeypatch.setattr(sharding, "stored", lambda df, name: tables.setdefault(name, stored(df, name)))
    rows = sharding.balanced_shards(hot_docs, shards=4, group_share=0).collect()
    hot = tables["shard-ranges"].where(F.col("size") == len("hot  text") + 1)
    assert hot.select("part").distinct().count() > 1
    assert len(rows) == 900
    by_shard = Counter()
    for r in rows:
        by_shard[r.shard] += r.size
    assert max(by_shard.values()) - min(by_shard.values()) <= 40
    for shard in by_shard:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))


def test_a_repeated_labelled_document_teaches_once(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b"), (2, "c d")] + [(3, f"copy {i % 2}") for i in range(300)], NAMES)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "fit", lambda pairs, share: seen.append(pairs))
    quality.learn(docs, labels, held_out=-1)
    assert sorted(label for _, label in seen[0]) == [0, 1, 1]
