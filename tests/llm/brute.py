"""Plain versions of the operators' rules, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import permutations

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def top_k(rows, k):
    """``rows``: (id, integer vector)."""
    out = set()
    for query, vector in {(i, tuple(v)) for i, v in rows if i % 50 == 0}:
        scored = sorted(
            (-sum(a * b for a, b in zip(vector, other)), i)
            for i, other in rows
            if i != query and len(other) == len(vector)
        )
        out |= {(query, rank, i, -score) for rank, (score, i) in enumerate(scored[:k], 1)}
    return out


def kept_bytes(docs, window):
    contents = [(i, (t or "").encode()) for i, t in docs]
    starts = Counter(c[at : at + window] for _, c in contents for at in range(len(c) - window + 1))
    for doc, content in contents:
        gone = [False] * len(content)
        for at in range(len(content) - window + 1):
            if starts[content[at : at + window]] > 1:
                gone[at : at + window] = [True] * window
        yield doc, len(content), bytes(b for b, x in zip(content, gone) if not x)


def kept_words(docs, window):
    first = {}
    for doc, text in docs:
        w = words(text)
        for at in range(len(w) - window + 1):
            key = tuple(w[at : at + window])
            first[key] = min(first.get(key, (True, 0)), (doc is None, doc or 0))
    for doc, text in docs:
        w = words(text)
        gone = [False] * len(w)
        for at in range(len(w) - window + 1):
            if first[tuple(w[at : at + window])] < (doc is None, doc or 0):
                gone[at : at + window] = [True] * window
        yield doc, len(w), " ".join(x for x, y in zip(w, gone) if not y)


def fingerprint(text):
    w = words((text or "").translate({i: i + 32 for i in range(0x41, 0x5B)}))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(items, linked):
    """The smallest identifier of each item's component; nulls are never the smallest."""
    parent = list(range(len(items)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(items)):
        for j in range(i):
            if linked(items[i][1], items[j][1]):
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i, (doc, _) in enumerate(items):
        groups[root(i)].append(doc)
    low = {r: min((d for d in g if d is not None), default=None) for r, g in groups.items()}
    return [low[root(i)] for i in range(len(items))]


def source_targets(sizes):
    """Targets by sharing again and again until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, left = {}, sum(sizes.values())
    while True:
        share = sum(weight[s] for s in names if s not in target)
        over = [s for s in names if s not in target and left * weight[s] / share > 3 * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / share for s in names if s not in target}
        for s in over:
            target[s] = 3.0 * sizes[s]
        left = sum(sizes.values()) - sum(target.values())


def planted_words(doc_id, text):
    """Every tenth document repeats a passage of its own up to its end."""
    w = words(text)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def smallest_period(w):
    """By the borders of all prefixes."""
    border = [0] * (len(w) + 1)
    k = 0
    for i in range(1, len(w)):
        while k and w[i] != w[k]:
            k = border[k]
        k += w[i] == w[k]
        border[i + 1] = k
    return len(w) - border[len(w)]


def runs(w):
    """(start, length, period), each period tried at each place."""
    found = set()
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q) and smallest_period(w[i : j + q]) == q:
                found.add((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(w, found):
    gone = {i for start, length, q in found for i in range(start + q, start + length)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def run_row(doc_id, w):
    found = runs(w)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    milli = best[1] * 1000 // best[2] if found else None
    return (doc_id, len(found), *best, milli, sha(lines), sha(collapsed(w, found)))


def audit(docs, labels):
    """``docs``: (doc_id, text, lang); ``labels``: {doc_id: (quality, toxic)}."""
    smallest = {}
    for doc, text, _ in docs:
        key = text or ""
        smallest[key] = min(smallest.get(key, (True, 0)), (doc is None, doc or 0))
    parts = defaultdict(list)
    for doc, text, lang in docs:
        t, w = text or "", words(text)
        failed = {
            "A": len(w) < 100,
            "B": 100 * len(set(w)) < 80 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": not smallest[t][0] and smallest[t] < (doc is None, doc or 0),
        }
        parts[lang or ""].append(({f for f in failed if failed[f]}, *labels.get(doc, (0, 0))))
    for part, rows in parts.items():
        total = Counter()
        removals = {}
        for order in map("".join, permutations("ABCDE")):
            left = rows
            for f in order:
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                removals[order, f] = (gone, len(left))
                total[f] += len(gone)
        for (order, f), (gone, kept) in removals.items():
            fail = [r for r in rows if f in r[0]]
            yield (
                part, order, order.index(f) + 1, kept, len(gone), len(fail) - len(gone),
                sum(r[0] == {f} for r in fail), sum(r[1] == 1 for r in gone),
                sum(r[2] == 1 for r in gone), total[f],
            )
