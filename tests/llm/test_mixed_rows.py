"""The mix takes rows, not identifiers: null and repeated ones are documents like others."""

from collections import Counter

from chatprep.llm import mixing
from tests.llm import brute


def counted(rows):
    return sum(len(brute.words(r.text)) for r in rows)


def test_mixed_texts_of_all_edge_rows(edge_docs):
    rows = mixing.mixed_texts(edge_docs).collect()
    assert counted(rows) == sum(r.taken for r in mixing.mix_sources(edge_docs).collect())


def test_rows_of_one_identifier_keep_their_own_texts(spark):
    docs = [(i if i % 3 else (None if i % 2 else 7), "ab"[i % 2], " ".join(f"d{i}w{j}" for j in range(5 + i))) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    rows = mixing.mixed_texts(df, block=4).collect()
    assert counted(rows) == sum(r.taken for r in mixing.mix_sources(df, block=4).collect())
    whole = {t: (i, s) for i, s, t in docs}
    for r in rows:
        owner = [t for t in whole if f" {r.text} " in f" {t} "]
        assert len(owner) == 1 and whole[owner[0]] == (r.doc_id, r.source)
    # No word more often than the mix repeats it at most.
    assert max(Counter(w for r in rows for w in r.text.split()).values()) <= mixing.REPEATS
    again = mixing.mixed_texts(df.repartition(5), block=4).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))


def test_rows_without_identifier_are_dealt_over_shards(spark, monkeypatch):
    docs = [(None, "a", f"t{i} " * 50) for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    seen = []
    placed = mixing._placed
    monkeypatch.setattr(mixing, "_placed", lambda *a: seen.append(placed(*a)) or seen[-1])
    assert counted(mixing.mixed_texts(df, shard=1000).collect()) > 0
    assert seen[0].select("shard").distinct().count() == 11
