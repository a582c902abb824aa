"""Substring dedup by Rabin-Karp hashes of all windows of a fixed number of words."""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatprep.llm.common import dealt_sizes, pack, text_of, unpack

WINDOW = 13
#: Documents whose windows are sorted together.
GROUP = 512

_BASE = np.uint64(0x9E3779B97F4A7C15)
_LAST = np.iinfo(np.int64).max


def window_hashes(words: list[bytes], window: int) -> np.ndarray:
    """The Rabin-Karp hash, modulo 2**64, of each window; the bits are mixed at the end."""
    number = len(words) - window + 1
    if number < 1:
        return np.empty(0, dtype=np.uint64)
    word = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    rolled = np.zeros(number, dtype=np.uint64)
    for i in range(window):
        rolled *= _BASE
        rolled += word[i : i + number]
    rolled ^= rolled >> np.uint64(29)
    rolled *= np.uint64(0xBF58476D1CE4E5B9)
    return rolled ^ (rolled >> np.uint64(32))


class _Group:
    """The windows of a group of documents, and per distinct hash the smallest document."""

    def __init__(self, docs: pd.DataFrame, window: int):
        # Both passes over a group have to number its hashes alike; sorted hashes do not depend on
        # the order of the rows.
        self.words = [text.encode("utf-8", "replace").split() for text in docs["text"]]
        self.ids = docs["order_id"].to_numpy(dtype=np.int64)
        each = [window_hashes(w, window) for w in self.words]
        self.lengths = np.array([len(h) for h in each], dtype=np.int64)
        hashes = np.concatenate(each) if each else np.empty(0, dtype=np.uint64)
        owner = np.repeat(self.ids, self.lengths)
        self.distinct, self.number = np.unique(hashes, return_inverse=True)
        self.smallest = np.full(len(self.distinct), _LAST, dtype=np.int64)
        np.minimum.at(self.smallest, self.number, owner)
        self.owner = owner


def _emit(window: int, buckets: int):
    """Per group and bucket of hashes one row: the distinct hashes and their smallest documents."""

    def run(docs: pd.DataFrame) -> pd.DataFrame:
        group = _Group(docs, window)
        part = int(docs["part"].iloc[0])
        tops = (group.distinct >> np.uint64(32)).astype(np.int64) * buckets >> 32
        edges = np.searchsorted(tops, np.arange(buckets + 1))
        rows = []
        for bucket in range(buckets):
            low, high = int(edges[bucket]), int(edges[bucket + 1])
            if low == high:
                continue
            ids, ordinal = np.unique(group.smallest[low:high], return_inverse=True)
            rows.append(
                (
                    bucket, part, low, high - low, len(ids),
                    pack(group.distinct[low:high]),
                    pack(ordinal.astype(np.uint32)),
                    pack(ids),
                )
            )
        return pd.DataFrame(rows, columns=_PACKED)

    return run


_PACKED = ["bucket", "part", "first", "hashes", "docs", "packed", "ordinals", "ids"]
_PACKED_TYPE = (
    "bucket long, part long, first long, hashes int, docs int,"
    " packed binary, ordinals binary, ids binary"
)


def _count(rows: pd.DataFrame) -> pd.DataFrame:
    """Which hashes of each group also occur in a smaller document of another group."""
    hashes = np.concatenate([unpack(r.packed, np.uint64, r.hashes) for r in rows.itertuples()])
    ids = np.concatenate(
        [
            unpack(r.ids, np.int64, r.docs)[unpack(r.ordinals, np.uint32, r.hashes)]
            for r in rows.itertuples()
        ]
    )
    order = np.argsort(hashes, kind="stable")
    starts = np.flatnonzero(np.diff(hashes[order], prepend=~hashes[order[:1]]) != 0)
    smallest = np.minimum.reduceat(ids[order], starts)
    run = np.cumsum(np.bincount(starts, minlength=len(order))) - 1
    late = np.empty(len(order), dtype=bool)
    late[order] = ids[order] > smallest[run]
    out, at = [], 0
    for r in rows.itertuples():
        found = np.flatnonzero(late[at : at + r.hashes])
        at += r.hashes
        if len(found):
            out.append((r.part, len(found), pack((found + r.first).astype(np.uint32))))
    return pd.DataFrame(out, columns=["part", "found", "repeated"])


def _removed(window: int):
    def run(docs: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        if not len(docs):
            return pd.DataFrame(columns=["id", "n_words", "spans", "kept"])
        group = _Group(docs, window)
        elsewhere = np.zeros(len(group.distinct), dtype=bool)
        for r in replies.itertuples():
            elsewhere[unpack(r.repeated, np.uint32, r.found)] = True
        if len(group.distinct):
            repeated = elsewhere[group.number] | (group.owner > group.smallest[group.number])
        else:
            repeated = np.empty(0, dtype=bool)
        rows, at = [], 0
        for doc, words, length in zip(docs["id"], group.words, group.lengths):
            starts = np.flatnonzero(repeated[at : at + length])
            at += length
            # Windows that start less than a window apart cover one interval together.
            breaks = np.flatnonzero(np.diff(starts) > window)
            lows = starts[np.concatenate([[0], breaks + 1])] if len(starts) else starts
            highs = starts[np.concatenate([breaks, [-1]])] + window if len(starts) else starts
            kept, last = [], 0
            for low, high in zip(lows, highs):
                kept += words[last:low]
                last = high
            kept += words[last:]
            spans = [{"start": int(a), "end": int(b)} for a, b in zip(lows, highs)]
            rows.append((doc, len(words), spans, b" ".join(kept).decode()))
        return pd.DataFrame(rows, columns=["id", "n_words", "spans", "kept"])

    return run


def remove_repeated_windows(
    docs: DataFrame,
    window: int = WINDOW,
    group: int = GROUP,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``(doc_id, n_words, spans, kept)``, one row per input row.

    A word goes if a window of ``window`` consecutive words covers it whose word sequence also
    starts in a document with a smaller identifier. ``spans`` are the maximal intervals of removed
    words (start, end exclusive), ``kept`` the other words joined by one space.

    Documents are dealt into groups of about ``group``, fewer if they are long. Each group sends its distinct window hashes,
    with the smallest document of each, to buckets of hash ranges as packed arrays; a bucket finds
    which hashes have a smaller document elsewhere and answers each group. A passage that a third
    of all documents share is one entry per group. Texts travel once, to their group.

    Null texts have no words; a null identifier counts as larger than all others; rows with one
    identifier are one document for the rule, but give a row each; an empty table gives no rows.
    Hashes have 64 bits: among ``n`` distinct windows, about ``n**2 / 2**65`` pairs are mistaken for
    equal (0.0005 for 135 million).
    """
    parts, buckets = dealt_sizes(docs, text_column, group)
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(
        # As text, since a null would turn a whole pandas column of numbers into floats.
        F.col(id_column).cast("string").alias("id"),
        F.coalesce(F.col(id_column).cast("long"), F.lit(_LAST)).alias("order_id"),
        text_of(F.col(text_column)).alias("text"),
        F.pmod(F.xxhash64(id_column, text_column), F.lit(parts)).alias("part"),
    )
    by_part = rows.groupBy("part")
    replies = (
        by_part.applyInPandas(_emit(window, buckets), _PACKED_TYPE)
        .groupBy("bucket")
        .applyInPandas(_count, "part long, found int, repeated binary")
    )
    out = by_part.cogroup(replies.groupBy("part")).applyInPandas(
        _removed(window),
        "id string, n_words long, spans array<struct<start:int,end:int>>, kept string",
    )
    return out.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_column)
