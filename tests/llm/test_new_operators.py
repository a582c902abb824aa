"""Periodic runs, token files and the filter audit against plain versions."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chatprep.llm import audit, periods, token_files
from chatprep.llm.queries import END_ID, QUERIES, WORD_TOKENIZER, with_planted_runs
from tests.llm import brute
from tests.oracle import DATA

SF = str(DATA / "sf0.001")


def _periodic_texts(rng):
    texts = []
    for i in range(120):
        alphabet = "ab" if i % 3 else "abcdefgh"
        text = [rng.choice(alphabet) for _ in range(rng.randrange(0, 60))]
        for _ in range(rng.randrange(3)):
            q = rng.choice([1, 2, 3, 5, 7, 8, 9, 12, 15, 16, 17, 23, 31, 40])
            block = [rng.choice(alphabet) for _ in range(q)]
            times = rng.randrange(2, 7)
            text += (block * times)[: q * times - rng.randrange(q)]
            text += [rng.choice(alphabet) for _ in range(rng.randrange(0, 9))]
        texts.append(text)
    return texts


def test_runs_equal_all_periods_tried():
    rng = random.Random(3)
    texts = _periodic_texts(rng)
    encoded = [[w.encode() for w in t] for t in texts]
    for text, found in zip(texts, periods._search(encoded, 4, 6)):
        assert [(s, e - s, q) for s, e, q in found.tolist()] == brute.runs(text)
    assert any(q > 16 for t in texts for _, _, q in brute.runs(t))


def test_long_periods_and_other_exponents():
    rng = random.Random(4)
    block = [b"%d" % rng.randrange(50) for _ in range(1500)]
    text = [b"x"] + block * 5 + [b"y"] + block[:700] * 4
    found = periods._search([text, text[:10], []], 5, 6)
    assert [(s, e - s, q) for s, e, q in found[0].tolist()] == [(1, 7500, 1500)]
    assert not len(found[1]) and not len(found[2])
    with pytest.raises(ValueError):
        periods.periodic_runs(None, exponent=3)


def test_runs_of_edge_rows(edge_docs, no_docs):
    got = periods.periodic_runs(edge_docs).select("doc_id", "n_words", "runs", "collapsed").collect()
    expected = Counter()
    for r in edge_docs.collect():
        w = brute.words(r.text)
        found = brute.runs(w) if len(w) < 100 else [(0, len(w), 4)]
        expected[(r.doc_id, len(w), tuple(found), brute.collapsed(w, found))] += 1
    assert Counter((r[0], r[1], tuple(map(tuple, r[2])), r[3]) for r in got) == expected
    assert periods.periodic_runs(no_docs).count() == 0


def test_op11_equals_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    # The plain version takes the square of a text's length.
    chosen = [r for r in docs if len(brute.words(r.text)) <= 700]
    assert len(chosen) > 100
    expected = {brute.run_row(r.doc_id, brute.planted_words(r.doc_id, r.text)) for r in chosen}
    names = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    got = QUERIES["op11_periodic_runs"](spark, SF).select(*names)
    ids = {r.doc_id for r in chosen}
    assert {tuple(r) for r in got.collect() if r.doc_id in ids} == expected
    assert any(r[1] for r in expected)


def test_planted_runs(spark):
    rows = [(i, " a\tb c  d e f g h "[: i % 19]) for i in range(200)] + [(None, "a b"), (70, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = df.select("doc_id", "text", with_planted_runs(F.col("doc_id"), F.col("text")).alias("x")).collect()
    assert all(brute.words(r.x) == brute.planted_words(r.doc_id, r.text) for r in got)


@pytest.mark.parametrize("size", [1, 2, 255, 256, 257, 3000])
@pytest.mark.parametrize("spread", [1, 7, 1 << 40])
def test_elias_fano(size, spread):
    rng = np.random.default_rng(size)
    values = np.sort(rng.integers(-5 * spread, 5 * spread, size))
    coded = token_files.EliasFano(*token_files.EliasFano.encode(values).parts())
    assert (coded.all() == values).all()
    assert [coded.select(i) for i in range(size)] == values.tolist()
    bits = 8 * (len(coded.low) + len(coded.high))
    assert bits <= size * (3 + np.log2(1 + (values[-1] - values[0]) / size)) + 24
    with pytest.raises(IndexError):
        coded.select(size)


def test_elias_fano_extremes():
    values = np.array([-(1 << 63), -5, -5, 0, (1 << 63) - 1])
    coded = token_files.EliasFano.encode(values)
    assert coded.all().tolist() == values.tolist()
    assert token_files.EliasFano.encode(values[:0]).all().tolist() == []


ODD_TEXTS = [
    "It's we're I'LL they've 'S 'd''t", "caf\u00e9 CAFE\u0301 \u212b \u0130stanbul \u1e9e \u00df \u03a3\u03a3 \u03c3\u03c2",
    "a\u00a0b\u2003c\u0085d\u2028e", "<|endoftext|> x<|startoftext|>y <|ENDOFTEXT|>", "\u4e2d\u6587 a\u4e2d \U0001f600ok",
    "\u201cquoted\u201d \u2014 dash\u2026 50\u00bd \u00b2", "x\x00y \x7f \x1c", "1234 5a6 __init__", "\u0178\u017f\u023a\u0244",
    " \u0301a \u0301", "",
]


def test_encoder_equals_library():
    vocabulary = open(WORD_TOKENIZER, encoding="utf-8").read()
    encoder = token_files.IdEncoder(vocabulary, token_files.id_width(vocabulary, END_ID))
    assert encoder.by_pieces and encoder.width == "<u2"
    library = Tokenizer.from_file(WORD_TOKENIZER)
    rng = random.Random(5)
    signs = "aB\u00e9\u00c9 '.,9\n\t\u0301\u00df\u0130\u03a3\u4e2d\u00a0-_s\u2019\u2028"
    texts = ODD_TEXTS + ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(3000)]
    for text in texts:
        ids = np.frombuffer(encoder.encode(text), encoder.width).tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids, text


def _token_rows(rows):
    """The file order: identifiers up, nulls last."""
    library = Tokenizer.from_file(WORD_TOKENIZER)
    start, out = 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [END_ID], "<u4")
        out.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_op12_equals_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op12_token_files"](spark, SF).collect()
    assert sorted(map(tuple, got)) == _token_rows([tuple(r) for r in docs])


def test_token_files_of_edge_rows(spark, edge_docs, no_docs, tmp_path):
    path = str(tmp_path / "files")
    token_files.write_token_files(edge_docs, path, WORD_TOKENIZER, END_ID, segment_bytes=64)
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    got = token_files.read_token_files(spark, path, with_ids=True).collect()
    # Rows of one identifier may stand in any order.
    plain = _token_rows(rows)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((d, n, c) for d, _, n, c in plain)
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == [d for d, *_ in plain]
    assert all(a.start + a.n_tokens == b.start for a, b in zip(ordered, ordered[1:])) and ordered[0].start == 0
    assert all(len(r.ids) == r.n_tokens and r.ids[-1] == END_ID for r in got)
    some = token_files.read_token_files(spark, path, doc_ids=[3, 11, 999]).collect()
    assert {tuple(r) for r in some} == {tuple(r)[:4] for r in got if r.doc_id in (3, 11)}
    assert token_files.token_files(no_docs, WORD_TOKENIZER, END_ID).count() == 0


def test_token_files_spread_one_identifier(spark):
    """A third of all rows without an identifier fills several ranges."""
    docs = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit("same words").alias("text")
    )
    base = spark.conf.get("spark.checkpoint.dir") + "/spread"
    token_files.write_token_files(docs, base, WORD_TOKENIZER, END_ID)
    sizes = spark.read.parquet(f"{base}/segments").groupBy("part").agg(F.sum("n_docs").alias("n")).collect()
    assert len(sizes) > 4 and max(r.n for r in sizes) < 1000
    assert token_files.read_token_files(spark, base).count() == 3000


def test_counts_of_texts():
    rng = random.Random(6)
    signs = ["a", "B", "ab", "\u00e9", "\U0001f600", " ", "\n", "\x0b", "#", "|", "\x1c", "\u2003", "word", "Word"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(60))) for _ in range(500)] + ["", " ", "x" * 999]
    got = list(zip(*[c.tolist() for c in audit.count_texts([t.encode() for t in texts])]))
    for text, row in zip(texts, got):
        w = brute.words(text)
        capitals = sum("A" <= c <= "Z" for c in text)
        assert row == (len(w), len(set(w)), capitals, len(text), sum(c in "#$%&*|" for c in text))


def test_table_survives_equal_hashes(monkeypatch):
    """With one hash for all words, only the comparison of spans tells them apart."""
    monkeypatch.setattr(audit, "_word_hashes", lambda content, starts, ends: np.zeros(len(starts), np.uint64))
    words, distinct, *_ = audit.count_texts([b"a b a c b ab", b"b a", b""])
    assert words.tolist() == [6, 2, 0] and distinct.tolist() == [4, 2, 0]


def test_blocks_of_a_long_text(monkeypatch):
    monkeypatch.setattr(audit, "TOGETHER", 50)
    rng = random.Random(7)
    text = " ".join(rng.choice(["alpha", "beta", "x" * 70, "b"]) for _ in range(400))
    words, distinct, *_ = audit.count_texts([text.encode(), b"alpha beta"])
    assert words.tolist() == [400, 2] and distinct.tolist() == [4, 2]


def test_audit_of_edge_rows(spark, edge_docs, no_docs):
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 0, 1), (5, 1, 1), (20, 1, None), (None, 1, 1), (7, None, None)],
        "doc_id long, quality long, toxic long",
    )
    docs = edge_docs.withColumn("lang", F.when(F.col("doc_id") % 3 > 0, F.col("lang")))
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    expected = Counter(brute.audit(rows, {1: (1, 1), 5: (1, 1), 20: (1, 0)}))
    assert Counter(map(tuple, audit.filter_audit(docs, labels).collect())) == expected
    assert audit.filter_audit(no_docs, labels).count() == 0


def test_op13_equals_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    known = {r.doc_id: (r.quality, r.toxic) for r in labels}
    got = Counter(map(tuple, QUERIES["op13_filter_audit"](spark, SF).collect()))
    assert got == Counter(brute.audit([tuple(r) for r in docs], known))
