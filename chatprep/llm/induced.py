"""Suffix arrays with common prefixes by external induced sorting.

Suffixes that start an ascending run after a descending one ("leftmost smaller", LMS) are sorted
first: the pieces between them are named in order, and the string of names, a few times shorter, is
sorted by the same routine, or in memory once it is short. From them the order of all others is
induced: scanning suffixes in order, the suffix one position to the left follows in its first
symbol's bucket, behind those that were put there before. The scan is a priority queue by (first
symbol, arrival), and the value carried with each suffix is the length of the prefix it shares with
the one before it in the order: one more than the least such length between the two suffixes they
were induced from.

The queue is one first-in-first-out run per symbol, so whole runs are induced at once in numpy. Its
waiting runs are written to files beyond a bound of memory. The text, the names, a run that is
scanned and the finished order with its common prefixes are held in memory.
"""

from __future__ import annotations

import os
from collections import defaultdict

import numpy as np

#: Symbols that are sorted in memory, names included.
IN_MEMORY = 1 << 24
#: Entries of a queue that are held in memory.
QUEUED = 1 << 22
#: A common prefix is followed so far, unless another depth is asked for; suffixes that agree so far
#: may come in any order.
DEPTH = 400

#: Files that a queue is spread over.
FILES = 256

_ENTRY = np.dtype([("symbol", "<i4"), ("at", "<i8"), ("lcp", "<i4")])
_FAR = np.iinfo(np.int32).max


class SymbolQueue:
    """Runs of (position, common prefix) per symbol; beyond a bound they wait on disk.

    A file holds the runs of neighbouring symbols, so that there are few files for any alphabet.
    """

    def __init__(self, folder: str, name: str, bound: int, symbols: int):
        self.folder, self.name, self.bound = folder, name, bound
        self.per_file = -(-symbols // FILES)
        self.waiting: dict[int, list[np.ndarray]] = defaultdict(list)
        self.files: set[int] = set()
        self.held = 0

    def _path(self, file: int) -> str:
        return os.path.join(self.folder, f"{self.name}-{file}")

    def push(self, symbol: int, at: np.ndarray, lcp: np.ndarray) -> None:
        entries = np.empty(len(at), dtype=_ENTRY)
        entries["symbol"], entries["at"], entries["lcp"] = symbol, at, lcp
        self.waiting[symbol].append(entries)
        self.held += len(at)
        if self.held > self.bound:
            for waiting, parts in self.waiting.items():
                with open(self._path(waiting // self.per_file), "ab") as file:
                    for part in parts:
                        part.tofile(file)
                self.files.add(waiting // self.per_file)
            self.waiting.clear()
            self.held = 0

    def _load(self, file: int) -> None:
        entries = np.fromfile(self._path(file), dtype=_ENTRY)
        os.remove(self._path(file))
        self.files.remove(file)
        entries = entries[np.argsort(entries["symbol"], kind="stable")]
        self.held += len(entries)
        for part in np.split(entries, np.flatnonzero(np.diff(entries["symbol"])) + 1):
            self.waiting[int(part["symbol"][0])].insert(0, part)

    def pop(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        """All of a symbol's run, in the order in which it was pushed."""
        if symbol // self.per_file in self.files:
            self._load(symbol // self.per_file)
        parts = self.waiting.pop(symbol, [])
        self.held -= sum(map(len, parts))
        entries = np.concatenate(parts) if parts else np.empty(0, dtype=_ENTRY)
        return entries["at"], entries["lcp"]


def _ascending(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one (S-type); the last symbol is the smallest."""
    changes = np.flatnonzero(text[:-1] != text[1:])
    up = text[changes] < text[changes + 1]
    runs = np.diff(changes, prepend=-1)
    return np.concatenate([np.repeat(up, runs), np.ones(len(text) - runs.sum(), dtype=bool)])


def _run_lengths(text: np.ndarray, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return ends[np.searchsorted(ends, at)] - at + 1


def _refined(place: np.ndarray, group: np.ndarray, key: np.ndarray) -> np.ndarray:
    """``place`` after the rows ``group`` are ordered by (place, key): where each subgroup begins."""
    order = np.lexsort((key, place[group]))
    rows = group[order]
    old, new = place[rows], key[order]
    starts = np.flatnonzero(np.concatenate([[True], (old[1:] != old[:-1]) | (new[1:] != new[:-1])]))
    first_old = np.flatnonzero(np.concatenate([[True], old[1:] != old[:-1]]))
    index = np.arange(len(rows))
    begin = np.maximum.accumulate(np.where(np.isin(index, starts), index, 0))
    begin_old = np.maximum.accumulate(np.where(np.isin(index, first_old), index, 0))
    out = place.copy()
    out[rows] = old + begin - begin_old
    return out


def _tied(place: np.ndarray) -> np.ndarray:
    counts = np.bincount(place, minlength=len(place))
    return np.flatnonzero(counts[place] > 1)


def _names(text: np.ndarray, small: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The rank of each piece from one LMS position to the next, that one included.

    Symbols are compared with their types, by which no piece is a proper prefix of another.
    """
    length = np.diff(lms, append=lms[-1]) + 1
    place = np.zeros(len(lms), dtype=np.int64)
    group, offset = np.arange(len(lms)), 0
    wide = text.dtype.itemsize > 2
    while len(group):
        key = np.zeros(len(group), dtype=np.uint64)
        for i in range(1 if wide else 3):
            at = np.minimum(lms[group] + offset + i, len(text) - 1)
            symbol = (text[at].astype(np.uint64) + np.uint64(1)) * np.uint64(2) + small[at]
            key = key * np.uint64(1 << 18) + np.where(offset + i < length[group], symbol, 0).astype(np.uint64)
        place = _refined(place, group, key)
        offset += 1 if wide else 3
        tied = _tied(place)
        group = tied[length[tied] > offset]
    return place


def _doubled(place: np.ndarray, lms: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of the suffixes of the string of names, in memory, by doubling up to ``depth``."""
    step, end = 1, len(place)
    while True:
        group = _tied(place)
        reach = lms[np.minimum(group + step, end - 1)] - lms[group]
        group = group[(reach < depth) & (group + step < end)]
        if not len(group):
            return place
        # A whole group is refined, so that its subgroups' places are right.
        member = np.zeros(end + 1, dtype=bool)
        member[place[group]] = True
        group = np.flatnonzero(member[place])
        after = np.where(group + step < end, place[np.minimum(group + step, end - 1)] + 1, 0)
        place = _refined(place, group, after)
        step *= 2


def _common(text: np.ndarray, left: np.ndarray, right: np.ndarray, depth: int) -> np.ndarray:
    """The lengths of common prefixes of pairs of suffixes, up to ``depth``."""
    found = np.zeros(len(left), dtype=np.int32)
    active = np.arange(len(left))
    last = len(text) - 1
    packed = None
    if text.dtype.itemsize <= 2 and len(text) >= 4:
        wide = np.ascontiguousarray(text, dtype="<u2")
        packed = np.lib.stride_tricks.as_strided(
            wide.view(np.uint8), (len(wide) - 3, 8), (2, 1)
        )
        packed = np.ascontiguousarray(packed).view("<u8").ravel()
    while packed is not None and len(active):
        a, b = left[active] + found[active], right[active] + found[active]
        inside = np.maximum(a, b) < len(packed)
        same = inside & (packed[np.minimum(a, len(packed) - 1)] == packed[np.minimum(b, len(packed) - 1)])
        active = active[same]
        found[active] += 4
        active = active[found[active] < depth]
    active = np.flatnonzero(found < depth)
    while len(active):
        a, b = left[active] + found[active], right[active] + found[active]
        same = (np.maximum(a, b) <= last) & (text[np.minimum(a, last)] == text[np.minimum(b, last)])
        active = active[same]
        found[active] += 1
        active = active[found[active] < depth]
    return np.minimum(found, depth)


class _Scan:
    """One scan over the suffixes in order, that induces those to the left of them."""

    def __init__(self, text, wanted, queue: SymbolQueue, symbols: int, depth: int):
        self.text, self.wanted, self.queue, self.depth = text, wanted, queue, depth
        #: The least common prefix since the last push for a symbol; -1 before the first one.
        self.least = np.full(symbols, -1, dtype=np.int32)

    def induce(self, at: np.ndarray, lcp: np.ndarray) -> None:
        """``lcp`` is what each suffix shares with the one scanned before it."""
        if not len(at):
            return
        before = at - 1
        takes = (at > 0) & self.wanted[before]
        symbol = np.where(takes, self.text[before], -1).astype(np.int64)
        overall = lcp.min()
        first_least = self.least.copy()
        np.minimum(self.least, overall, out=self.least)
        rows = np.flatnonzero(takes)
        order = np.argsort(symbol[rows], kind="stable")
        rows = rows[order]
        names = symbol[rows]
        cuts = np.flatnonzero(np.diff(names)) + 1
        for part in np.split(rows, cuts) if len(rows) else ():
            s = int(symbol[part[0]])
            starts = np.concatenate([[0], part + 1])
            if starts[-1] == len(lcp):
                mins, rest = np.minimum.reduceat(lcp, starts[:-1]), _FAR
            else:
                mins = np.minimum.reduceat(lcp, starts)
                mins, rest = mins[:-1], mins[-1]
            mins[0] = min(mins[0], first_least[s])
            self.least[s] = rest
            self.queue.push(s, before[part], np.minimum(mins + 1, self.depth))


def suffix_order(
    text: np.ndarray,
    folder: str,
    in_memory: int = IN_MEMORY,
    queued: int = QUEUED,
    level: int = 0,
    depth: int = DEPTH,
) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all suffixes in order, and what each shares with the one before it.

    ``text`` holds small unsigned numbers; its last symbol must be smaller than all others. Common
    prefixes are followed, and orders right, up to ``depth`` symbols. ``folder`` takes the queues.
    """
    small = _ascending(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    symbols = int(text.max()) + 1
    ends = np.append(np.flatnonzero(text[:-1] != text[1:]), len(text) - 1)
    if len(lms) == 0:
        # Symbols only descend: suffixes come in reverse.
        at = np.arange(len(text))[::-1].copy()
        return at, np.concatenate([[0], _common(text, at[:-1], at[1:], depth)]).astype(np.int32)

    place = _names(text, small, lms)
    if len(_tied(place)):
        if len(place) <= in_memory:
            place = _doubled(place, lms, depth)
        else:
            names = np.unique(place, return_inverse=True)[1] + 1
            order, _ = suffix_order(
                np.append(names, 0).astype(np.uint32), folder, in_memory, queued, level + 1, depth
            )
            place = np.empty(len(lms), dtype=np.int64)
            place[order[1:]] = np.arange(len(lms))
    sorted_lms = lms[np.argsort(place, kind="stable")]
    seed_lcp = np.zeros(len(sorted_lms), dtype=np.int32)
    seed_lcp[1:] = _common(text, sorted_lms[:-1], sorted_lms[1:], depth)
    seed_symbol = text[sorted_lms].astype(np.int64)
    seed_edges = np.searchsorted(seed_symbol, np.arange(symbols + 1))

    def seam(last: np.ndarray, first: np.ndarray) -> int:
        """What the last descending and the first ascending suffix of a symbol share: their run."""
        if not len(last) or not len(first):
            return 0
        pair = np.array([last[-1], first[0]])
        return int(min(depth, _run_lengths(text, pair, ends).min()))

    # Ascending scan: LMS suffixes are the seeds, L-type suffixes are induced.
    queue = SymbolQueue(folder, f"up-{level}", queued, symbols)
    scan = _Scan(text, ~small, queue, symbols, depth)
    down_parts = SymbolQueue(folder, f"down-{level}", queued, symbols)
    for s in range(symbols):
        at, lcp = queue.pop(s)
        last = at[:0]
        while len(at):
            down_parts.push(s, at, lcp)
            scan.induce(at, lcp)
            last = at
            at, lcp = queue.pop(s)
        low, high = seed_edges[s], seed_edges[s + 1]
        seeds, lcp = sorted_lms[low:high], seed_lcp[low:high].copy()
        if len(seeds):
            lcp[0] = seam(last, seeds)
            scan.induce(seeds, lcp)
    del queue, scan

    # Descending scan: L-type suffixes are the seeds, S-type suffixes are induced. What a suffix
    # shares is now told of the larger neighbour, which was scanned before it.
    queue = SymbolQueue(folder, f"back-{level}", queued, symbols)
    scan = _Scan(text, small, queue, symbols, depth)
    found = []
    # The last symbol is the smallest suffix, of no scan.
    for s in range(symbols - 1, -1, -1):
        at, lcp = queue.pop(s)
        ups = []
        while len(at):
            ups.append((at, lcp))
            scan.induce(at, lcp)
            at, lcp = queue.pop(s)
        up_at = np.concatenate([a for a, _ in ups]) if ups else np.empty(0, dtype=np.int64)
        up_lcp = np.concatenate([v for _, v in ups]) if ups else np.empty(0, dtype=np.int32)
        if s == text[-1]:
            up_at, up_lcp = np.append(up_at, len(text) - 1), np.append(up_lcp, 0).astype(np.int32)
        down_at, down_lcp = down_parts.pop(s)
        if len(down_at):
            # Backwards, each descending suffix is told of the one after it.
            told = np.concatenate([down_lcp[1:], [seam(down_at, up_at[::-1])]])[::-1].astype(np.int32)
            scan.induce(down_at[::-1], told)
        if len(up_at):
            # ``up_lcp[i]`` is shared with the next larger suffix: shift it to the smaller side.
            forward = np.concatenate([[seam(down_at, up_at[::-1])], up_lcp[1:][::-1]])
            found.append((up_at[::-1], forward.astype(np.int32)))
        if len(down_at):
            found.append((down_at, down_lcp))
    found.reverse()
    order = np.concatenate([a for a, _ in found])
    shared = np.concatenate([v for _, v in found])
    return order, shared
