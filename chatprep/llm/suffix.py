"""Suffix-array dedup: bytes covered by a long string that also starts elsewhere are removed."""

from __future__ import annotations

import os
import tempfile

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatprep.llm import induced
from chatprep.llm.common import dealt_sizes, pack, text_of, unpack

WINDOW = 400
#: A sample of a window: its least hash of so many consecutive bytes, as a share of the window. Long
#: samples stand at few places, so few windows remain; short ones are fewer.
GRAM_SHARE = 0.5
#: Documents of a shard, whose candidates are sorted together.
GROUP = 512
#: Windows that are hashed at a time.
PIECE = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def _power(exponent: int) -> np.uint64:
    return np.uint64(pow(_BASE, exponent, 1 << 64))


def _mixed(hashes: np.ndarray) -> np.ndarray:
    hashes = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return hashes ^ (hashes >> np.uint64(29))


def string_hashes(content: np.ndarray, length: int) -> np.ndarray:
    """A polynomial hash of each string of ``length`` bytes, from those of powers of two."""
    power = content.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1)
    known, out, done = 1, None, 0
    while True:
        if length & known:
            if out is None:
                out, done = power, known
            else:
                # ``out`` covers ``done`` bytes, and ``power`` the ``known`` bytes before them.
                out = power[: len(out) - known] * _power(done) + out[known:]
                done += known
        if known * 2 > length:
            return _mixed(out)
        power = power[:-known] * _power(known) + power[known:]
        known *= 2


def _sliding(values: np.ndarray, width: int, least) -> np.ndarray:
    """The least (or largest) of each ``width`` consecutive values, by doubling."""
    known = 1
    while known * 2 <= width:
        values = least(values[:-known], values[known:])
        known *= 2
    return least(values[: len(values) - (width - known)], values[width - known :]) if width > known else values


def _pieces(content: np.ndarray, window: int):
    """Ranges of windows with the bytes they cover."""
    for low in range(0, len(content) - window + 1, PIECE):
        high = min(low + PIECE, len(content) - window + 1)
        yield low, high, content[low : high + window - 1]


class _Shard:
    """The documents of a shard as one byte array."""

    def __init__(self, docs: pd.DataFrame, window: int):
        # Rows are put in an order that does not depend on how they came, as later passes refer to
        # places in the shard.
        docs = docs.sort_values(["id", "text"], na_position="last", kind="stable")
        self.window = window
        self.gram = max(1, int(window * GRAM_SHARE))
        self.ids = docs["id"].tolist()
        contents = [t.encode("utf-8", "replace") for t in docs["text"]]
        self.offsets = np.concatenate([[0], np.cumsum([len(c) for c in contents])]).astype(np.int64)
        self.content = np.frombuffer(b"".join(contents), dtype=np.uint8)

    def documents(self):
        for low, high in zip(self.offsets[:-1], self.offsets[1:]):
            if high - low >= self.window:
                yield int(low), self.content[low:high]

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of windows with one sample: first window, end, sample."""
        starts, ends, samples = [], [], []
        for offset, content in self.documents():
            for low, _, piece in _pieces(content, self.window):
                grams = string_hashes(piece, self.gram)
                least = _sliding(grams, self.window - self.gram + 1, np.minimum)
                first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
                starts.append(first + (offset + low))
                ends.append(np.append(first[1:], len(least)) + (offset + low))
                samples.append(_mixed(least[first]))
        empty = np.empty(0, dtype=np.int64)
        return (
            np.concatenate(starts) if starts else empty,
            np.concatenate(ends) if ends else empty,
            np.concatenate(samples) if samples else empty.astype(np.uint64),
        )

    def samples(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct samples, and which of them stand at more than one place of the shard."""
        found = []
        reach = self.window - self.gram + 1
        for offset, content in self.documents():
            for low in range(0, len(content) - self.gram + 1, PIECE):
                # A place is a sample's if some window around it has that least hash.
                before, after = max(0, low - reach + 1), min(low + PIECE + self.window, len(content))
                grams = string_hashes(content[before:after], self.gram)
                if len(grams) < reach:
                    grams = string_hashes(content[max(0, after - self.window) : after], self.gram)
                    before = max(0, after - self.window)
                least = _sliding(grams, reach, np.minimum)
                padded = np.concatenate([np.zeros(reach - 1, np.uint64), least, np.zeros(reach - 1, np.uint64)])
                own = _sliding(padded, reach, np.maximum) == grams
                own = own[low - before : low - before + PIECE]
                found.append(grams[low - before : low - before + PIECE][own])
        values = np.concatenate(found) if found else np.empty(0, dtype=np.uint64)
        distinct, counts = np.unique(_mixed(values), return_counts=True)
        return distinct, counts > 1


def _rows(part: int, hashes: np.ndarray, buckets: int, extra: bytes) -> pd.DataFrame:
    """One row per bucket of sorted distinct hashes, and one that passes ``extra`` on."""
    tops = (hashes >> np.uint64(32)).astype(np.int64) * buckets >> 32
    edges = np.searchsorted(tops, np.arange(buckets + 1))
    rows = [(part % buckets, part, 0, 0, extra)]
    for bucket in np.flatnonzero(np.diff(edges)):
        low, high = int(edges[bucket]), int(edges[bucket + 1])
        rows.append((int(bucket), part, low, high - low, pack(hashes[low:high])))
    return pd.DataFrame(rows, columns=["bucket", "part", "first", "n", "packed"])


_ROWS = "bucket long, part long, first long, n long, packed binary"


def _shared(rows: pd.DataFrame) -> pd.DataFrame:
    """Tells each shard which of its hashes other shards have too; passes the other rows on."""
    passed = rows[rows["n"] == 0]
    out = [(r.part, 0, r.packed) for r in passed.itertuples()]
    sent = rows[rows["n"] > 0]
    if len(sent):
        hashes = np.concatenate([unpack(r.packed, np.uint64, r.n) for r in sent.itertuples()])
        ordered = np.sort(hashes)
        again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        shared = np.zeros(len(hashes), dtype=bool)
        if len(again):
            at = np.searchsorted(again, hashes)
            at[at == len(again)] = 0
            shared = again[at] == hashes
        at = 0
        for r in sent.itertuples():
            found = np.flatnonzero(shared[at : at + r.n])
            at += r.n
            if len(found):
                out.append((r.part, len(found), pack((found + r.first).astype(np.uint32))))
    return pd.DataFrame(out, columns=["part", "found", "shared"])


_REPLY = "part long, found long, shared binary"


def _sample(window: int, buckets: int):
    def run(docs: pd.DataFrame) -> pd.DataFrame:
        distinct, repeated = _Shard(docs, window).samples()
        return _rows(int(docs["part"].iloc[0]), distinct, buckets, np.packbits(repeated).tobytes())

    return run


def _flags(replies: pd.DataFrame, number: int) -> np.ndarray:
    flags = np.zeros(number, dtype=bool)
    for r in replies.itertuples():
        if r.found:
            flags[unpack(r.shared, np.uint32, r.found)] = True
    return flags


def _spans(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return edges[::2], edges[1::2]


def _window_hashes(content: np.ndarray, starts: np.ndarray, ends: np.ndarray, window: int) -> np.ndarray:
    """The hashes of the windows ``starts`` to ``ends`` (exclusive), span by span."""
    found = [
        string_hashes(content[piece : min(piece + PIECE, high) + window - 1], window)
        for low, high in zip(starts, ends)
        for piece in range(low, high, PIECE)
    ]
    return np.concatenate(found) if found else np.empty(0, dtype=np.uint64)


def repeated_windows(content: np.ndarray, starts: np.ndarray, ends: np.ndarray, window: int) -> np.ndarray:
    """Which of the windows in the spans equal another one of them, by the spans' suffix array.

    A span's bytes follow each other, a separator ends them; windows never hold one.
    """
    lengths = ends - starts + window - 1
    text = np.zeros(int(lengths.sum()) + len(lengths) + 1, dtype=np.uint16)
    windows = np.zeros(len(text), dtype=bool)
    at = 0
    for low, high in zip(starts, ends):
        size = high - low + window - 1
        text[at : at + size] = content[low : low + size]
        text[at : at + size] += 2
        text[at + size] = 1
        windows[at : at + high - low] = True
        at += size + 1
    if not len(starts):
        return np.empty(0, dtype=bool)
    # The queues' files are this task's own spill: below the folder that Spark gives its workers for
    # that, read by no other task, and gone at the end.
    spill = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
    with tempfile.TemporaryDirectory(dir=spill) as folder:
        order, shared = induced.suffix_order(text, folder, depth=window)
    same = shared >= window
    repeated = np.zeros(len(text), dtype=bool)
    repeated[order] = same | np.concatenate([same[1:], [False]])
    return repeated[windows]


def _candidates(window: int, buckets: int):
    def run(docs: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        if not len(docs):
            return pd.DataFrame(columns=["bucket", "part", "first", "n", "packed"])
        shard = _Shard(docs, window)
        starts, ends, samples = shard.runs()
        distinct = np.unique(samples)
        repeated = _flags(replies, len(distinct))
        local = [r.shared for r in replies.itertuples() if not r.found]
        for bits in local:
            repeated |= np.unpackbits(np.frombuffer(bits, np.uint8), count=len(distinct)).astype(bool)
        keep = repeated[np.searchsorted(distinct, samples)]
        starts, ends = starts[keep], ends[keep]
        # Adjacent runs are one span, unless a document ends between them.
        joins = np.flatnonzero(starts[1:] == ends[:-1])
        starts, ends = np.delete(starts, joins + 1), np.delete(ends, joins)
        marks = repeated_windows(shard.content, starts, ends, window)
        hashes = np.unique(_window_hashes(shard.content, starts, ends, window))
        header = np.array([len(starts)], dtype=np.int64).tobytes()
        extra = header + starts.tobytes() + ends.tobytes() + np.packbits(marks).tobytes()
        return _rows(int(docs["part"].iloc[0]), hashes, buckets, extra)

    return run


def _remove(window: int):
    def run(docs: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        if not len(docs):
            return pd.DataFrame(columns=["id", "n_bytes", "spans", "kept"])
        shard = _Shard(docs, window)
        extra = next(bytes(r.shared) for r in replies.itertuples() if not r.found)
        number = int(np.frombuffer(extra, np.int64, 1)[0])
        starts = np.frombuffer(extra, np.int64, number, 8)
        ends = np.frombuffer(extra, np.int64, number, 8 + 8 * number)
        total = int((ends - starts).sum())
        marks = np.unpackbits(np.frombuffer(extra, np.uint8, offset=8 + 16 * number), count=total)
        hashes = _window_hashes(shard.content, starts, ends, window)
        distinct, place = np.unique(hashes, return_inverse=True)
        repeated = marks.astype(bool) | _flags(replies, len(distinct))[place]
        at = np.repeat(starts - np.concatenate([[0], np.cumsum(ends - starts)[:-1]]), ends - starts)
        firsts = (np.arange(total) + at)[repeated]
        change = np.zeros(len(shard.content) + 1, dtype=np.int32)
        change[firsts] += 1
        np.subtract.at(change, firsts + window, 1)
        covered = np.cumsum(change[:-1]) > 0
        rows = []
        for doc, low, high in zip(shard.ids, shard.offsets[:-1], shard.offsets[1:]):
            gone = covered[low:high]
            spans = [{"start": int(a), "end": int(b)} for a, b in zip(*_spans(gone))]
            rows.append((doc, int(high - low), spans, shard.content[low:high][~gone].tobytes()))
        return pd.DataFrame(rows, columns=["id", "n_bytes", "spans", "kept"])

    return run


def remove_repeated_strings(
    docs: DataFrame,
    window: int = WINDOW,
    group: int = GROUP,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``(doc_id, n_bytes, spans, kept)``, one row per input row.

    Texts are UTF-8 bytes (null: none). A byte goes if a string of ``window`` bytes covers it that
    also starts anywhere else, in this document or another; overlaps count, strings do not cross
    documents and are judged on the input. ``spans`` are the maximal removed runs (start, end
    exclusive), ``kept`` the other bytes.

    Documents are dealt into shards of about ``group``, fewer if they are long. A window's sample, the least hash of the
    half as long strings in it, is the same for equal windows, so windows whose sample stands at one
    place of all texts only are done. The remaining ones of a shard are sorted by external induced
    sorting; neighbours that share ``window`` bytes are repeats inside the shard. Of each distinct
    string a shard sends one hash to buckets of hash ranges, which answer what other shards have: so
    a passage that a third of all documents share is one entry per shard. Bytes travel once.

    Rows with null or repeated identifiers are documents like others, so a repeated row removes what
    is long enough in both; an empty table gives no rows. Across shards strings are compared by
    64-bit hashes: of ``n`` distinct ones, about ``n**2 / 2**65`` pairs are mistaken for equal.
    """
    if window < 1:
        raise ValueError("a window has at least one byte")
    parts, buckets = dealt_sizes(docs, text_column, group)
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(
        # As text, since a null would turn a whole pandas column of numbers into floats.
        F.col(id_column).cast("string").alias("id"),
        text_of(F.col(text_column)).alias("text"),
        F.pmod(F.xxhash64(id_column, text_column), F.lit(parts)).alias("part"),
    )
    shards = rows.groupBy("part")
    sampled = (
        shards.applyInPandas(_sample(window, buckets), _ROWS)
        .groupBy("bucket")
        .applyInPandas(_shared, _REPLY)
    )
    strings = (
        shards.cogroup(sampled.groupBy("part"))
        .applyInPandas(_candidates(window, buckets), _ROWS)
        .groupBy("bucket")
        .applyInPandas(_shared, _REPLY)
    )
    out = shards.cogroup(strings.groupBy("part")).applyInPandas(
        _remove(window), "id string, n_bytes long, spans array<struct<start:int,end:int>>, kept binary"
    )
    return out.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_column)
