"""Periodic runs of words by multi-scale minimizers."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatprep.llm.common import text_of

#: Periods below 2**SHORT are found by comparing the words at each lag.
SHORT = 3
#: Words of the documents that are searched together.
TOGETHER = 1 << 18
#: Words compared at once when a stretch is extended; each further step compares more.
STEP = 64

_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(30))
    values *= _MIX
    return values ^ (values >> np.uint64(27))


def _sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` (minimum or maximum) of each ``width`` consecutive values.

    Values are cut into blocks of that width; a window is the end of one block and the start of the
    next, so one accumulation in each direction is enough.
    """
    number = len(values) - width + 1
    blocks = -(-len(values) // width)
    # What fills the last block up is in no window that is returned.
    padded = np.resize(values, blocks * width).reshape(blocks, width)
    ahead = pick.accumulate(padded, axis=1).ravel()
    behind = pick.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(behind[:number], ahead[width - 1 : width - 1 + number])


def _minimizers(hashes: np.ndarray, width: int) -> np.ndarray:
    """Positions that have the smallest value of at least one window of ``width`` positions."""
    lowest = _sliding(hashes, width, np.minimum)
    edge = np.zeros(width - 1, dtype=hashes.dtype)
    highest = _sliding(np.concatenate([edge, lowest, edge]), width, np.maximum)
    return np.flatnonzero(highest == hashes)


def _matches(codes: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The longest stretch of positions around ``at`` whose words are those ``lag`` further on."""
    end = len(codes) - lag
    high, step = at, STEP
    while high < end:
        upto = min(high + step, end)
        differ = codes[high:upto] != codes[high + lag : upto + lag]
        if differ.any():
            high += int(differ.argmax())
            break
        high, step = upto, step * 4
    low, step = at, STEP
    while low > 0:
        down = max(low - step, 0)
        differ = codes[down:low] != codes[down + lag : low + lag]
        if differ.any():
            low -= int(differ[::-1].argmax())
            break
        low, step = down, step * 4
    return low, high


def _lag_runs(codes: np.ndarray, lag: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the maximal stretches of at least ``least`` words with period ``lag``."""
    same = np.flatnonzero(codes[lag:] == codes[:-lag])
    breaks = np.flatnonzero(np.diff(same) != 1)
    starts = same[np.concatenate([[0], breaks + 1])] if len(same) else same
    ends = same[np.concatenate([breaks, [-1]])] + 1 + lag if len(same) else same
    long = ends - starts >= least
    return starts[long], ends[long]


def find_runs(codes: np.ndarray, longest: int, exponent: int, min_length: int) -> np.ndarray:
    """``(start, end, period)``, by start and period: the runs among ``codes``.

    ``codes`` are whole numbers, one per word; documents lie one after the other, with a number of
    its own between each two. ``longest`` is the length of the longest one.

    Scale ``j`` is for the periods ``q`` from ``2**j`` to below ``2**(j+1)``. It hashes each
    ``k = 2**(j+1)`` consecutive words and takes the minimizers of each ``2**j`` consecutive hashes.
    Inside a run of ``exponent >= 4`` periods there are two windows ``q`` apart that hold the same
    words, so their minimizers are ``q`` apart. As ``k > q``, equal hashes inside the run stand at
    multiples of ``q`` only, else its period would be smaller. So it is enough to look at neighbours
    among the minimizers with one hash. Each such pair is a seed: its words are compared in both
    directions, so hashes decide nothing.
    """
    found: list[tuple[int, int, int]] = []
    for lag in range(1, min(1 << SHORT, longest // exponent + 1)):
        if len(codes) > lag:
            starts, ends = _lag_runs(codes, lag, max(min_length, exponent * lag))
            found += zip(starts.tolist(), ends.tolist(), [lag] * len(starts))
    hashes = _mixed(codes.astype(np.uint64) * _MULTIPLY)
    width, scale = 1, 0
    while exponent << scale <= longest:
        # From hashes of ``width`` words to those of twice as many.
        hashes = _mixed(hashes[:-width] * _MULTIPLY + hashes[width:])
        width *= 2
        if scale >= SHORT and len(hashes) >= 1 << scale:
            at = _minimizers(hashes, 1 << scale)
            at = at[np.argsort(hashes[at], kind="stable")]
            lags = np.diff(at)
            seeds = np.flatnonzero(
                (hashes[at[1:]] == hashes[at[:-1]]) & (lags >= 1 << scale) & (lags < 2 << scale)
            )
            at, lags = at[seeds], lags[seeds]
            known, end = -1, -1
            for seed in np.lexsort((at, lags)):
                place, lag = int(at[seed]), int(lags[seed])
                if lag == known and place < end:
                    continue
                start, end = _matches(codes, place, lag)
                known = lag
                if end - start + lag >= max(min_length, exponent * lag):
                    found.append((start, end + lag, lag))
        scale += 1
    # A stretch also has the multiples of its period; the smallest counts.
    runs = np.array(sorted(found), dtype=np.int64).reshape(-1, 3)
    first = np.ones(len(runs), dtype=bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[first]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _search(documents: list[list[bytes]], exponent: int, min_length: int) -> list[np.ndarray]:
    """The runs of each document. Documents of like length are searched together, since the longest
    one sets the number of scales."""
    out = [np.empty((0, 3), dtype=np.int64)] * len(documents)
    lengths = np.array([len(words) for words in documents], dtype=np.int64)
    order = np.argsort(lengths, kind="stable")
    order = order[lengths[order] >= max(min_length, exponent)]
    classes = np.array([int(n).bit_length() for n in lengths[order]])
    for group in np.split(order, np.flatnonzero(np.diff(classes)) + 1):
        if not len(group):
            continue
        code: dict[bytes, int] = defaultdict()
        code.default_factory = code.__len__
        sizes = lengths[group] + 1
        ends = np.cumsum(sizes)
        codes = np.empty(ends[-1], dtype=np.int64)
        for i, (doc, end) in enumerate(zip(group, ends)):
            words = documents[doc]
            codes[end - 1 - len(words) : end - 1] = list(map(code.__getitem__, words))
            codes[end - 1] = -1 - i
        runs = find_runs(codes, int(lengths[group[-1]]), exponent, min_length)
        owner = np.searchsorted(ends, runs[:, 0], side="right")
        runs[:, :2] -= (ends - sizes)[owner, None]
        edges = np.searchsorted(owner, np.arange(len(group) + 1))
        for i, doc in enumerate(group):
            out[doc] = runs[edges[i] : edges[i + 1]]
    return out


def _collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words outside all runs and in the first period of each, joined by one space."""
    if len(runs):
        cover = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
        np.add.at(cover, runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0)]
    return b" ".join(words)


def _batch(ids: pa.Array, documents: list[list[bytes]], exponent: int, min_length: int) -> pa.RecordBatch:
    found = _search(documents, exponent, min_length)
    flat = np.concatenate(found) if found else np.empty((0, 3), dtype=np.int64)
    offsets = np.cumsum([0, *map(len, found)], dtype=np.int32)
    fields = [flat[:, 0], flat[:, 1] - flat[:, 0], flat[:, 2]]
    runs = pa.StructArray.from_arrays(
        [pa.array(np.ascontiguousarray(f)) for f in fields], names=["start", "length", "period"]
    )
    texts = [_collapsed(w, r).decode("utf-8", "replace") for w, r in zip(documents, found)]
    columns = [
        ids,
        pa.array([len(w) for w in documents], pa.int64()),
        pa.ListArray.from_arrays(pa.array(offsets), runs),
        pa.array(texts, pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])


def _scan(exponent: int, min_length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            documents, size, first = [], 0, 0
            for row, text in enumerate(texts):
                # bytes.split() cuts at exactly the six separators.
                words = text.as_py().encode("utf-8", "replace").split()
                documents.append(words)
                size += len(words)
                if size >= TOGETHER:
                    yield _batch(ids.slice(first, len(documents)), documents, exponent, min_length)
                    documents, size, first = [], 0, row + 1
            if documents:
                yield _batch(ids.slice(first, len(documents)), documents, exponent, min_length)

    return run


def periodic_runs(
    docs: DataFrame,
    exponent: int = 4,
    min_length: int = 6,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)``, one row per input row.

    A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are the
    same) and at least ``max(min_length, exponent * q)`` words that no neighbouring word extends.
    ``runs`` holds all of them as ``(start, length, period)``, words counted from 0, by start and
    then period. ``collapsed`` is the text without what repeats: words that no run contains after
    its first ``q`` ones, joined by one space. ``exponent`` is 4 or more, which the method needs.

    Documents are searched where they are read; nothing is shuffled. A null text has no words, and
    so no runs; rows with null or repeated identifiers give a row each; an empty table gives no
    rows. A long text is held with its words, some 60 bytes each, in the memory of one task, and is
    searched in time ``n log n``.
    """
    if exponent < 4:
        raise ValueError(f"runs have 4 periods or more: {exponent}")
    rows = docs.select(F.col(id_column).alias("doc_id"), text_of(F.col(text_column)).alias("text"))
    kind = docs.schema[id_column].dataType.simpleString()
    out = rows.mapInArrow(
        _scan(exponent, min_length),
        f"doc_id {kind}, n_words long,"
        " runs array<struct<start:long,length:long,period:long>>, collapsed string",
    )
    return out.withColumnRenamed("doc_id", id_column)
