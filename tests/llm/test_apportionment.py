"""Blocks of a mix by highest quotients, against giving out one seat after another."""

import random
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from chatprep.llm import mixing


def plain_seats(votes, house):
    """``votes``: {name: number}; equal quotients in the order of names."""
    seats = dict.fromkeys(votes, 0)
    for _ in range(house):
        best = max(votes, key=lambda n: (Fraction(votes[n], 2 * seats[n] + 1), [-ord(c) for c in n]))
        seats[best] += 1
    return seats


@pytest.mark.parametrize("seed", range(4))
def test_seats_equal_highest_quotients(spark, seed):
    rng = random.Random(seed)
    rows, houses = [], {}
    for g in range(12):
        scale = rng.choice([3, 40, 5000])
        n = rng.randrange(1, 30)
        votes = [rng.randrange(scale) for _ in range(n)]
        if g == 0:
            votes = [10] * 7
        if g == 1:
            votes = [100_000] + [1] * 20
        houses[g] = rng.choice([0, 1, n // 2, n, 3 * n + 1, 200])
        rows += [(g, f"n{i:02}", v) for i, v in enumerate(votes)]
    df = spark.createDataFrame(rows, "g int, name string, votes long").repartition(3)
    house = F.element_at(F.create_map(*[F.lit(x) for kv in houses.items() for x in kv]), F.col("g")).cast("long")
    got = mixing.apportioned(df, "votes", house, ["g"], ["g", "name"])
    assert got.columns == ["g", "name", "votes", "seats"]
    seats = defaultdict(dict)
    for r in got.collect():
        seats[r.g][r.name] = r.seats
    for g, house in houses.items():
        votes = {name: v for own, name, v in rows if own == g}
        if sum(votes.values()):
            assert seats[g] == plain_seats(votes, house), (g, votes, house)


def test_small_sources_come_near_their_targets(spark):
    sizes = {"a": 1, "b": 4000, "c": 17, "d": 18, "e": 5, "f": 33, "g": 9000, "h": 40, "i": 2, None: 7}
    docs, n = [], 0
    for source, size in sizes.items():
        while size:
            words = min(size, 1 + n % 37)
            docs.append((n, source, " ".join(f"w{i}" for i in range(words))))
            size, n = size - words, n + 1
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    rows = mixing.mix_sources(df, shard=500).collect()
    taken, target, shards = defaultdict(int), {}, defaultdict(int)
    for r, (_, source, _) in zip(sorted(rows, key=lambda r: r.doc_id), docs):
        assert r.taken <= 3 * r.size
        taken[source] += r.taken
        target[source] = r.target
        shards[source] = 1 + r.source_size // 500
    assert all(abs(taken[s] - target[s]) <= 2 * shards[s] for s in sizes), (dict(taken), target)
    assert all(abs(taken[s] - target[s]) <= 2 for s in sizes if sizes[s] < 500)
