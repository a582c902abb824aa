import random
from collections import Counter, defaultdict

import pytest

from chatprep.operators import packing as pk


def pack(sizes, block):
    pieces, at = [], 0
    for i, n in sizes:
        done = 0
        while done < n:
            take = min(n - done, block - at % block)
            pieces.append((i, at // block, at % block, done, take))
            done, at = done + take, at + take
    return pieces


@pytest.mark.parametrize("width", [1, 7, 1 << 16])
def test_packing_one_token_after_another(spark, width):
    rng = random.Random(1)
    sizes = [(i * 3, rng.choice([0, 1, 5, 16, 40, 100])) for i in range(60)]
    df = spark.createDataFrame(sizes, "id bigint, n int").repartition(4)
    got = sorted(tuple(r) for r in pk.pack_sequences(df, "id", "n", 16, width).collect())
    assert got == sorted(pack(sizes, 16))


def test_length_buckets(spark):
    df = spark.createDataFrame([(0,), (9,), (10,), (25,)], "n int")
    got = sorted(tuple(r) for r in pk.length_buckets(df, "n", 10).collect())
    assert got == [(0, 2, 0, 9), (1, 1, 10, 10), (2, 1, 25, 25)]


def plain_best_fit(sizes, block):
    """One example after another: what room is left in each block."""
    rooms = []
    for n in sorted(sizes, reverse=True):
        fitting = [r for r in rooms if r >= n]
        if fitting:
            rooms.remove(min(fitting))
            rooms.append(min(fitting) - n)
        else:
            rooms.append(block - n)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(8))
def test_plan_equals_best_fit_one_by_one(seed):
    rng = random.Random(seed)
    block = rng.choice([7, 16, 50, 128])
    sizes = [min(block, int(rng.expovariate(1 / rng.choice([3, 20]))) + 1) for _ in range(rng.randrange(400))]
    plan = pk.best_fit_plan(Counter(sizes), block)
    filled, seen = Counter(), Counter()
    for a in plan:
        assert a.first_rank == seen[a.length]
        seen[a.length] = a.end_rank
        for rank in range(a.first_rank, a.end_rank):
            nth = rank - a.first_rank
            filled[a.first_block + nth // a.per_block] += a.length
    assert seen == Counter(sizes)
    assert sorted(block - n for n in filled.values()) == plain_best_fit(sizes, block)


def test_plan_grows_with_lengths_only():
    counts = {n: 10**12 + n for n in range(1, 513)}
    plan = pk.best_fit_plan(counts, 512)
    assert len(plan) < 5000 and sum(a.end_rank - a.first_rank for a in plan) == sum(counts.values())


def test_whole_examples(spark, monkeypatch):
    monkeypatch.setattr(pk, "RANKED_TOGETHER", 7)
    rng = random.Random(3)
    sizes = [(i, rng.choice([3, 3, 3, 9, 14, 30])) for i in range(300)]
    sizes += [(1000, 0), (1001, 31), (1002, None), (5, 3), (5, 3), (None, 9)]
    df = spark.createDataFrame(sizes, "id bigint, n int").repartition(4)
    got = pk.pack_whole(df, "id", "n", 30)
    rows = got.collect()
    assert Counter((r.id, r.n_tokens) for r in rows) == Counter(sizes)
    assert {r.id for r in rows if r.block is None} == {1000, 1001, 1002}
    taken = Counter((r.block, r.block_offset + i) for r in rows if r.block is not None for i in range(r.n_tokens))
    assert max(taken.values()) == 1 and max(at for _, at in taken) < 30
    packed = [n for _, n in sizes if n and n <= 30]
    fill = pk.packing_fill(got, 30).first()
    assert fill.n_blocks == len(plain_best_fit(packed, 30)) and fill.n_tokens == sum(packed)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, rows), key=str)
    assert pk.pack_whole(df.where("false"), "id", "n", 30).count() == 0


def test_batches_of_like_length(spark):
    rng = random.Random(4)
    sizes = [(i, rng.randrange(1, 200)) for i in range(500)] + [(900, None), (901, 5000)]
    df = spark.createDataFrame(sizes, "id bigint, n int")
    batches = pk.length_batches(df.repartition(5), "id", "n", 1000, mega_batch=100)
    rows = batches.collect()
    assert Counter(r.id for r in rows) == Counter(i for i, _ in sizes)
    groups = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.batch, r.place)):
        groups[r.batch].append(r)
    assert sorted(groups) == list(range(len(groups)))
    for group in groups.values():
        lengths = [r.length for r in group]
        assert len(group) * lengths[0] <= 1000 or len(group) == 1
        assert lengths == sorted(lengths, reverse=True) and len({r.mega for r in group}) == 1
        assert [r.place for r in group] == list(range(len(group)))
    assert max(Counter(r.mega for r in rows).values()) == 100
    again = pk.length_batches(df, "id", "n", 1000, mega_batch=100).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))
    random_order = pk.length_batches(df, "id", "n", 1000, mega_batch=1).collect()
    assert len({r.batch for r in random_order}) == 502
    assert pk.padding_share(batches).first().padding < 0.2
