"""Language identification, sharding and quality scores against plain loops."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest
import regex

from chatprep.llm import common, langid, quality, sharding, suffix, windows
from chatprep.llm.queries import QUERIES
from tests.oracle import DATA

SF = str(DATA / "sf0.001")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").collect()


# ---- language identification ---------------------------------------------------------------------


def _grams(text):
    """N-grams inside the words, each word with a blank on both sides; blanks alone are none."""
    found = Counter()
    for word in regex.findall(r"\p{L}+", (text or "").lower()):
        padded = f" {word} "
        for n in (1, 2, 3):
            found.update(padded[i : i + n] for i in range(len(padded) - n + 1) if padded[i : i + n] != " ")
    # The blank between two words belongs to both, and is one place of the text.
    return found


def _ranked(counts, size=300):
    def code(gram):
        number = 0
        for c in gram:
            number = number << 21 | ord(c)
        return number

    return sorted(counts, key=lambda g: (-counts[g], code(g)))[:size]


def test_op3_equals_out_of_place_counting(spark, docs):
    learned = defaultdict(Counter)
    for r in docs:
        if zlib.crc32(str(r.doc_id).encode()) % 3 != 1 and r.lang is not None and r.text is not None:
            learned[r.lang] += _grams(r.text)
    profiles = {lang: {g: i for i, g in enumerate(_ranked(c))} for lang, c in learned.items()}
    expected = {}
    for r in docs:
        grams = _ranked(_grams(r.text))
        distance = {
            lang: sum(abs(profile[g] - i) if g in profile else 300 for i, g in enumerate(grams))
            for lang, profile in profiles.items()
        }
        best = min(sorted(distance), key=distance.get) if grams else "und"
        score = 1 - distance[best] / (300 * len(grams)) if grams else 0.0
        expected[r.doc_id] = (best, round(score, 9))
    got = {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in QUERIES["op3_language_id"](spark, SF).collect()}
    assert got == expected


def test_long_texts_are_counted_in_pieces(monkeypatch):
    text = "Der alte Mann. \u03a3\u03a3\u03a3 on the\nsea\u3002\u4e2d\u6587\u3001x1y " * 40 + "unspaced" * 30
    whole = langid.gram_counts(text)
    for size in (1, 7, 64):
        monkeypatch.setattr(langid, "PIECE", size)
        assert len(list(langid._pieces(text))) > 5 and "".join(langid._pieces(text)) == text
        assert all((a == b).all() for a, b in zip(langid.gram_counts(text), whole))
    assert {g for g in _grams(text)} and whole[1].sum() == sum(_grams(text).values())
    monkeypatch.setattr(langid, "PIECE", 10)
    assert langid.gram_counts("1 2 " * 20)[0].size == 0


# ---- sharding ------------------------------------------------------------------------------------


def test_op6_equals_a_sweep(spark, docs):
    rows = []
    for r in docs:
        text = (r.text or "").encode()
        rows.append((zlib.crc32(text), hashlib.md5(text).digest(), r.doc_id, len(text) + 1))
    rows.sort()
    total, end, own = sum(r[3] for r in rows), 0, []
    for crc, digest, doc, size in rows:
        end += size
        own.append(min(7, math.floor((end - size / 2) * 8 / total)))
    groups = defaultdict(list)
    for row, shard in zip(rows, own):
        groups[row[1]].append((shard, row[3]))
    filled, expected = Counter(), set()
    for (crc, digest, doc, size), shard in zip(rows, own):
        group = groups[digest]
        if sum(s for _, s in group) <= total / 8 * sharding.GROUP_SHARE:
            shard = min(s for s, _ in group)
        expected.add((doc, size, crc, "bytes", shard, filled[shard], None))
        filled[shard] += 1
    assert {tuple(r) for r in QUERIES["op6_balanced_shards"](spark, SF).collect()} == expected


# ---- quality -------------------------------------------------------------------------------------


def _plain_score(network, text):
    """One byte, one filter and one position after the other."""
    content = (text or "").encode()
    logits, at = [], 0
    while True:
        chunk = list(content[at : at + quality.CHUNK])
        chunk += [0] * (quality.CHUNK - len(chunk))
        top = [-math.inf] * quality.FILTERS
        for start in range(0, quality.CHUNK - quality.WIDTH + 1, quality.STRIDE):
            seen = [float(x) for b in chunk[start : start + quality.WIDTH] for x in network.embedding[b]]
            for f in range(quality.FILTERS):
                top[f] = max(top[f], sum(x * w for x, w in zip(seen, network.filters[:, f].tolist())))
        active = [max(t + float(b), 0) for t, b in zip(top, network.bias)]
        logit = float(network.out_bias[0])
        for unit in range(quality.HIDDEN):
            inner = sum(a * float(w) for a, w in zip(active, network.hidden[:, unit]))
            logit += math.tanh(inner + float(network.hidden_bias[unit])) * float(network.out[unit])
        logits.append(logit)
        if at + quality.CHUNK >= len(content):
            return 1 / (1 + math.exp(-sum(logits) / len(logits)))
        at += quality.STEP


def test_op7_equals_a_plain_forward_pass(spark, docs):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    network = quality.learn(table, labels)
    got = {r.doc_id: r for r in QUERIES["op7_quality"](spark, SF).collect()}
    assert len(got) == len(docs)
    short = sorted(docs, key=lambda r: len(r.text or ""))
    for r in short[:4] + short[60:64]:
        row = got[r.doc_id]
        assert row.score == pytest.approx(_plain_score(network, r.text), abs=1e-4)
    for r in docs:
        row = got[r.doc_id]
        assert row.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert row.predicted == int(row.score >= 0.7)


# ---- sizes of groups -----------------------------------------------------------------------------


def test_groups_of_long_texts_are_small(spark, monkeypatch):
    """Groups and buckets go by bytes where documents are long, and the results stay the same."""
    docs = spark.range(300).selectExpr("id AS doc_id", "repeat(concat('w', id % 20, ' x', id % 7, ' '), 400) AS text")
    assert common.dealt_sizes(docs, "text", 512) == (1, 32)
    whole = {r.doc_id: r.kept for r in windows.remove_repeated_windows(docs).collect()}
    bytes_kept = {r.doc_id: bytes(r.kept) for r in suffix.remove_repeated_strings(docs).collect()}
    monkeypatch.setattr(common, "GROUP_BYTES", 20_000)
    monkeypatch.setattr(common, "BUCKET_BYTES", 10_000)
    parts, buckets = common.dealt_sizes(docs, "text", 512)
    assert parts > 30 and buckets > 60
    assert {r.doc_id: r.kept for r in windows.remove_repeated_windows(docs).collect()} == whole
    assert {r.doc_id: bytes(r.kept) for r in suffix.remove_repeated_strings(docs).collect()} == bytes_kept
