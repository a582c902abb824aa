"""Each operator against a plain version, and over rows that are easily mishandled."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chatprep.llm import (
    bpe, content_sort, induced, langid, mixing, quality, sharding, simhash, suffix, topk, windows,
)
from tests.llm import brute

NAMES = "doc_id long, text string"


def edge_rows(edge_docs):
    return [(r.doc_id, r.text) for r in edge_docs.select("doc_id", "text").collect()]


def test_every_operator_takes_an_empty_table(spark, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    results = [
        topk.top_k(vectors, F.col("vec_id") % 50 == 0),
        suffix.remove_repeated_strings(no_docs),
        langid.identify(no_docs),
        windows.remove_repeated_windows(no_docs),
        mixing.mix_sources(no_docs),
        mixing.mixed_texts(no_docs),
        sharding.balanced_shards(no_docs),
        quality.scored(no_docs, labels),
        quality.keep_good(no_docs, labels),
        content_sort.exact_dedup(no_docs),
        content_sort.drop_copies(no_docs),
        bpe.token_digests(no_docs, public_tokenizers.path("byte_bpe_50k.json")),
        simhash.near_duplicates(no_docs),
        simhash.drop_near_copies(no_docs),
    ]
    assert [df.count() for df in results] == [0] * len(results)


# ---- exact top-k --------------------------------------------------------------------------------


@pytest.mark.parametrize("block_bytes", [topk.BLOCK_BYTES, 200])
def test_top_k(spark, monkeypatch, block_bytes):
    rng = random.Random(2)
    vectors = [(i, [rng.choice([0.5, -0.25, 0.125, 1.0]) for _ in range(4)]) for i in range(400)]
    vectors += [(7, [9.0, 9.0, 9.0, 9.0])] * 7 + [(50, [1.0, 1.0, 1.0, 1.0]), (500, [1.0])]
    skipped = [(100, None), (150, [None, 1.0, 1.0, 1.0]), (200, [float("nan")] * 4), (None, [1.0] * 4),
               (250, [float("inf")] * 4)]
    df = spark.createDataFrame(vectors + skipped, "vec_id long, embedding array<double>")
    df = df.withColumns({c: F.lit(1) for c in ("id", "hash", "block", "shard", "vector", "node")})
    monkeypatch.setattr(topk, "BLOCK_BYTES", block_bytes)  # the second one gives several blocks
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    monkeypatch.setattr(topk, "CANDIDATE_ROWS", 4)
    got = [tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0, k=5).collect()]
    whole = [(i, [int(256 * x // 1) for x in v]) for i, v in vectors]
    assert Counter(got).keys() == brute.top_k(whole, 5)


def test_a_block_is_multiplied_in_tiles(monkeypatch):
    rng = np.random.default_rng(3)
    queries, candidates = rng.integers(-3, 4, (40, 5)), rng.integers(-3, 4, (90, 5))
    query_ids, ids = np.arange(40), rng.permutation(90)
    whole = topk.tile_lists(queries, query_ids, candidates, ids, 5)
    monkeypatch.setattr(topk, "QUERY_ROWS", 7)
    monkeypatch.setattr(topk, "CANDIDATE_ROWS", 11)
    tiles = topk.tile_lists(queries, query_ids, candidates, ids, 5)
    assert [x.tolist() for x in whole] == [x.tolist() for x in tiles]
    for query in query_ids:
        scores = [(-int(c @ queries[query]), int(i)) for c, i in zip(candidates, ids) if i != query]
        expected = [(i, -s) for s, i in sorted(scores)[:5]]
        mine = whole[0] == query
        assert list(zip(whole[1][mine].tolist(), whole[2][mine].tolist())) == expected


def test_scores_are_exact_at_any_size():
    big = np.array([[2**40, 3], [-(2**40), 5]], dtype=np.int64)
    exact = big.astype(object) @ big.astype(object).T
    assert topk.tile_scores(big, big).tolist() == np.clip(exact, -(2**63), 2**63 - 1).tolist()
    middle = np.array([[2**30 + 1, 2**30 - 1]], dtype=np.int64)
    assert topk.tile_scores(middle, middle).tolist() == [[2 * (2**60 + 1)]]


# ---- suffix arrays ------------------------------------------------------------------------------


def plain_order(text):
    text = text.tolist()
    order = sorted(range(len(text)), key=lambda i: text[i:])

    def common(a, b):
        n = 0
        while max(a, b) + n < len(text) and text[a + n] == text[b + n]:
            n += 1
        return n

    return order, [0] + [common(a, b) for a, b in zip(order, order[1:])]


@pytest.mark.parametrize("in_memory", [0, 5, 1 << 20])
def test_induced_order(tmp_path, in_memory):
    rng = random.Random(in_memory)
    for _ in range(150):
        kinds = rng.choice([1, 2, 3, 30])
        body = [rng.randrange(1, kinds + 1) for _ in range(rng.randrange(1, 60))]
        text = np.array(body * rng.choice([1, 1, 2]) + [0], dtype=rng.choice([np.uint16, np.uint32]))
        order, shared = induced.suffix_order(text, str(tmp_path), in_memory, queued=rng.choice([1, 9, 999]))
        assert (order.tolist(), shared.tolist()) == plain_order(text)
    assert not list(tmp_path.iterdir())


@pytest.mark.parametrize("window", [1, 7, 40])
def test_repeated_strings(spark, copied_docs, window):
    docs = copied_docs + [(900, None), (901, ""), (902, "xy" * 90), (903, "z" * 70)]
    df = spark.createDataFrame(docs, NAMES)
    got = {r.doc_id: r for r in suffix.remove_repeated_strings(df, window=window, group=10).collect()}
    for doc, size, kept in brute.kept_bytes(docs, window):
        assert (got[doc].n_bytes, bytes(got[doc].kept)) == (size, kept)
        assert sum(s.end - s.start for s in got[doc].spans) == size - len(kept)


@pytest.mark.parametrize("group", [1, 100])
def test_strings_longer_than_the_default(spark, copied_docs, group):
    passage = " ".join(t for _, t in copied_docs)[:1500]
    docs = [(0, passage), (1, "a " + passage[:700]), (2, passage[300:] + " b " + passage[:450]), (3, "c" * 999)]
    df = spark.createDataFrame(docs, NAMES)
    got = {r.doc_id: bytes(r.kept) for r in suffix.remove_repeated_strings(df, window=500, group=group).collect()}
    assert got == {doc: kept for doc, _, kept in brute.kept_bytes(docs, 500)}


def test_long_texts_are_hashed_in_pieces(spark, copied_docs, monkeypatch):
    shard_of = lambda: suffix._Shard(
        spark.createDataFrame(copied_docs, NAMES).select(F.col("doc_id").cast("string").alias("id"), "text").toPandas(), 40
    )
    whole = shard_of()
    runs, samples = whole.runs(), whole.samples()
    monkeypatch.setattr(suffix, "PIECE", 30)
    pieces = shard_of()
    spread = [np.repeat(r[2], r[1] - r[0]).tolist() for r in (runs, pieces.runs())]
    assert spread[0] == spread[1]
    assert [x.tolist() for x in samples] == [x.tolist() for x in pieces.samples()]


def test_repeated_strings_of_edge_rows(edge_docs):
    rows = edge_rows(edge_docs)
    got = Counter((r.doc_id, r.n_bytes, bytes(r.kept)) for r in suffix.remove_repeated_strings(edge_docs, window=400, group=4).collect())
    # Copies of the long texts go; what is shorter than a window stays.
    expected = Counter(
        (i, len((t or "").encode()), b"" if len((t or "").encode()) >= 400 else (t or "").encode()) for i, t in rows
    )
    assert got == expected


# ---- repeated windows ---------------------------------------------------------------------------


def test_repeated_windows(spark, copied_docs):
    docs = copied_docs + [(None, copied_docs[3][1]), (900, None)]
    df = spark.createDataFrame(docs, NAMES)
    got = Counter((r.doc_id, r.n_words, r.kept) for r in windows.remove_repeated_windows(df, window=5, group=10).collect())
    assert got == Counter(brute.kept_words(docs, 5))


def test_repeated_windows_of_edge_rows(edge_docs):
    got = Counter((r.doc_id, r.n_words, r.kept) for r in windows.remove_repeated_windows(edge_docs, group=4).collect())
    assert got == Counter(brute.kept_words(edge_rows(edge_docs), 13))


# ---- mixing -------------------------------------------------------------------------------------


def test_targets_and_taken_words(spark):
    rng = random.Random(4)
    sources = [None, "a", "b", "c", "d", "e"]
    docs = [
        (i, rng.choice(sources[:5] + ["a"] * 9), "w " * rng.randrange(0, 200)) for i in range(600)
    ] + [(1000 + i, "e", "v " * i) for i in range(3)] + [(2000, "f", None), (2000, "f", None)]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    small = {"shard": 2000, "block": 8}
    rows = mixing.mix_sources(df, **small).collect()
    again = mixing.mix_sources(df.repartition(7), **small).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))
    source_of = {i: s for i, s, _ in docs}
    sizes, taken = defaultdict(int), defaultdict(int)
    for i, s, t in docs:
        sizes[s] += len(brute.words(t))
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size and r.source_size == sizes[source_of[r.doc_id]]
        taken[source_of[r.doc_id]] += r.taken
    for source, target in brute.source_targets(sizes).items():
        given = {r.target for r in rows if source_of[r.doc_id] == source}
        assert list(given) == pytest.approx([target])
        shards = -(-(sizes[source] + 600) // 2000)
        assert abs(taken[source] - target) <= 16 * shards


def test_mixed_texts_are_what_is_taken(edge_docs, spark):
    rng = random.Random(5)
    docs = [(i, rng.choice("abc"), " w\t".join(map(str, range(rng.randrange(90)))), 1) for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string, n_chars int")
    taken = {r.doc_id: r.taken for r in mixing.mix_sources(df, block=8).collect()}
    rows = mixing.mixed_texts(df, block=8).collect()
    texts = {i: t for i, _, t, _ in docs}
    got = defaultdict(int)
    for r in rows:
        part = brute.words(r.text)
        got[r.doc_id] += len(part)
        assert " ".join(part) in " ".join(brute.words(texts[r.doc_id])) and r.n_chars == len(r.text)
    assert dict(got) == {i: n for i, n in taken.items() if n}
    unique = edge_docs.dropDuplicates(["doc_id"])
    assert mixing.mixed_texts(unique).columns == edge_docs.columns
    assert sum(len(brute.words(r.text)) for r in mixing.mixed_texts(unique).collect()) == sum(
        r.taken for r in mixing.mix_sources(unique).collect()
    )


# ---- sharding -----------------------------------------------------------------------------------


def test_shards(spark):
    rng = random.Random(6)
    docs = [(i, rng.choice([None, "", "é" * rng.randrange(50), "x" * rng.randrange(300)])) for i in range(3000)]
    docs += [(5000 + i, "copy") for i in range(1500)]
    rows = sharding.balanced_shards(spark.createDataFrame(docs, NAMES).repartition(5)).collect()
    text_of = dict(docs)
    total = defaultdict(int)
    slots = defaultdict(list)
    shards_of = defaultdict(set)
    for r in rows:
        content = (text_of[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(content) + 1, zlib.crc32(content), "bytes")
        assert r.grown_shard is None
        total[r.shard] += r.size
        slots[r.shard].append(r.slot)
        shards_of[content].add(r.shard)
    assert len(rows) == len(docs) and sorted(total) == list(range(8))
    assert max(total.values()) - min(total.values()) <= 0.03 * sum(total.values()) / 8
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # A group lies on a cut at most, and small ones on none.
    assert sum(len(s) - 1 for s in shards_of.values()) <= 7


def test_shards_of_edge_rows(edge_docs):
    rows = sharding.balanced_shards(edge_docs).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in edge_rows(edge_docs))
    assert {r.shard for r in rows} <= set(range(8))


# ---- exact dedup --------------------------------------------------------------------------------


def exact(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups["".join(brute.words(text))].append((-len(text or ""), doc is None, doc or 0))
    out = Counter()
    for norm, members in groups.items():
        best = min(members)
        for n, row in enumerate(sorted(members)):
            doc, keep = (None if m[1] else m[2] for m in (row, best))
            out[doc, keep, len(members), n == 0, brute.sha(norm)] += 1
    return out


@pytest.mark.parametrize("share", [0.25, 1e-9])
def test_exact_dedup(spark, copied_docs, edge_docs, monkeypatch, share):
    monkeypatch.setattr(content_sort, "CELL_SHARE", share)  # the second one spreads every group
    for df in (spark.createDataFrame(copied_docs * 2 + [(i + 500, "hot copy") for i in range(90)], NAMES), edge_docs):
        rows = edge_rows(df)
        assert Counter(map(tuple, content_sort.exact_dedup(df).collect())) == exact(rows)
        kept = content_sort.drop_copies(df)
        assert kept.columns == df.columns
        wanted = Counter(k[0] for k in exact(rows) if k[3])
        assert Counter(r.doc_id for r in kept.collect()) == wanted


# ---- SimHash ------------------------------------------------------------------------------------


def test_near_duplicates(spark, copied_docs, edge_docs):
    for df in (spark.createDataFrame(copied_docs, NAMES), edge_docs):
        rows = [(i, brute.fingerprint(t)) for i, t in edge_rows(df)]
        low = brute.components(rows, lambda a, b: (a ^ b).bit_count() <= 3)
        expected = Counter((i, f"{fp:016x}", c) for (i, fp), c in zip(rows, low))
        assert Counter(map(tuple, simhash.near_duplicates(df).collect())) == expected
        kept = simhash.drop_near_copies(df)
        assert kept.columns == df.columns
        groups = defaultdict(set)
        for (i, fp), c in zip(rows, low):
            groups[c].add(i)
        assert Counter(r.doc_id for r in kept.collect()) == Counter(groups.keys())


@pytest.mark.parametrize("joined", [64, 1])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, joined):
    monkeypatch.setattr(simhash, "JOINED", joined)  # with 1 nearly all buckets are cut into tiles
    monkeypatch.setattr(simhash, "TILE", 4)
    rng = random.Random(8)
    centres = [rng.getrandbits(64) for _ in range(6)]
    fps = {0, 1, 2**64 - 1}
    for _ in range(250):
        fp = rng.choice(centres)
        for _ in range(rng.randrange(9)):
            fp ^= 1 << rng.randrange(64)
        fps.add(fp)
    rows = [(fp - 2**64 if fp >= 2**63 else fp, fp) for fp in sorted(fps)]
    df = spark.createDataFrame([(a,) for a, _ in rows], "fp long")
    links = [tuple(r) for r in simhash.fingerprint_links(df).collect()]
    expected = brute.components(rows, lambda a, b: (a ^ b).bit_count() <= 3)
    mine = {frozenset(x) for x in links}
    got = brute.components([(a, a) for a, _ in rows], lambda a, b: frozenset((a, b)) in mine)
    assert got == expected
    stars = {r.a: r.b for r in simhash.stars(df.limit(0).select(F.col("fp").alias("a"), F.col("fp").alias("b")).union(
        spark.createDataFrame(links, "a long, b long"))).collect()}
    assert [stars.get(a, a) for a, _ in rows] == expected


def test_a_long_text_is_hashed_in_pieces(monkeypatch):
    text = " ".join(str(i * i % 97) for i in range(500))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert simhash.fingerprint(text) == whole == brute.fingerprint(text)


# ---- BPE ----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_bpe_equals_the_library(tokenizer, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 50)
    monkeypatch.setattr(bpe, "REMEMBERED", 300)
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        encoder = bpe.TrieEncoder(file.read())
    rng = random.Random(9)
    letters = "abetinors  \n\t\x1c\x1f\x85​ 　éß'st123<|endoftext|>中😀#!.\x00\x0bAA"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(120))) for _ in range(1500)]
    texts += ["", "a" * 3000, " " * 700, "the cat " * 300, "<|endoftext|>" * 3, "abc" * 999]
    for text, ids in zip(texts, encoder.encode_all(texts), strict=True):
        expected = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected
        assert encoder.decode(ids) == tokenizer.decode(expected, skip_special_tokens=False)


def test_bpe_of_edge_rows(edge_docs, tokenizer):
    df = bpe.token_digests(edge_docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)
    expected = Counter()
    for doc, text in edge_rows(edge_docs):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        expected[doc, len(ids), brute.sha(np.array(ids, "<u4").tobytes()), brute.sha(decoded), tuple(ids)] += 1
    assert Counter((*r[:4], tuple(r.ids)) for r in df.collect()) == expected


# ---- language and quality -----------------------------------------------------------------------


def test_rank_order_distance():
    profiles = langid.Profiles({"x": [ord("a"), ord("b"), ord("c")], "y": [ord("c"), ord("z")]}, size=3)
    codes, counts = langid.gram_counts("a b a!")
    assert dict(zip(codes.tolist(), counts.tolist()))[ord("a")] == 2
    # Of "c", " c" and "c " only the first is in a profile: 2 places off in x, none in y.
    assert langid.top_grams("c", 3).tolist() == sorted(langid.gram_counts("c")[0].tolist())[:3]
    lang, score = profiles.predict("c")
    grams = langid.top_grams("c", 3).tolist()
    off = {"x": abs(2 - grams.index(ord("c"))), "y": abs(0 - grams.index(ord("c")))}
    assert lang == min(off, key=off.get)
    assert score == pytest.approx(1 - (off[lang] + 3 + 3) / 9)
    assert profiles.predict(None) == profiles.predict("12 !?") == ("und", 0.0)


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_edge_rows(edge_docs, no_docs):
    rows = langid.identify(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    assert {r.lang_pred for r in rows} == {"en", "und"}
    assert langid.identify(edge_docs.withColumn("lang", F.lit(None).cast("string"))).where("lang_pred <> 'und'").count() == 0


def test_chunks_cover_the_text():
    for size in (0, 1, 255, 256, 257, 480, 481, 5000):
        chunks = quality.chunks_of("x" * size)
        assert chunks.shape[1] == quality.CHUNK and len(chunks) >= 1
        seen = {i * quality.STEP + j for i, c in enumerate(chunks) for j in np.flatnonzero(c)}
        assert seen == set(range(size))


def test_gradients():
    rng = np.random.default_rng(1)
    network = quality.ByteNetwork.initial()
    chunks = rng.integers(0, 256, (3, quality.CHUNK)).astype(np.uint8)
    document, labels, weights = np.array([0, 0, 1]), np.array([1.0, 0.0]), np.array([1.0, 2.0])

    def loss():
        p = [1 / (1 + np.exp(-network.logits(chunks[document == d]).astype(float).mean())) for d in (0, 1)]
        return -sum(w * (y * np.log(q) + (1 - y) * np.log(1 - q)) for w, y, q in zip(weights, labels, p)) / 3

    for parameter, slope in zip(network.parameters(), network.gradients(chunks, document, labels, weights)):
        at = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        before = parameter[at]
        parameter[at] = before + 1e-2
        high = loss()
        parameter[at] = before - 1e-2
        low = loss()
        parameter[at] = before
        assert (high - low) / 2e-2 == pytest.approx(slope[at], rel=0.2, abs=1e-4)


def test_quality_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = quality.scored(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.predicted == r.quality for r in held) >= 0.95 * len(held)
    good = [r for r in held if r.quality == 1]
    assert sum(r.predicted for r in good) >= 0.98 * len(good)


def test_quality_of_edge_rows(edge_docs, spark):
    labels = spark.createDataFrame(
        [(0, 1, 0), (1, None, 0), (5, 0, 0), (7, 1, 1), (7, 1, 1), (None, 1, 0), (999, 0, 0)],
        "doc_id long, quality int, toxic int",
    )
    rows = quality.scored(edge_docs, labels).collect()
    assert len(rows) == edge_docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert quality.keep_good(edge_docs, labels).columns == edge_docs.columns
