import hashlib
import math
import random
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chatprep.operators import ranks
from chatprep.operators import sample as sm


def order(ids, seed):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{i}:{seed}".encode()).hexdigest(), i))


@pytest.mark.parametrize(
    "n, ratio, train", [(10, 0.9, 0), (20, 0.15, 17), (100, 0.15, 85), (0, 0.1, 0), (1, 0.1, 0),
                        (10, 0.0, 10), (5000, 0.2, 4000)]
)
def test_split_sizes_and_order(spark, n, ratio, train):
    df = spark.range(n).withColumn("x", F.col("id") * 2)
    split = sm.split_dataset(df, ["id"], ratio, seed=5)
    got = {r.id for r in split.where("split = 'train'").collect()}
    assert got == set(order(range(n), 5)[:train])
    assert split.count() == n and split.columns == ["id", "x", "split"]
    counts = {r.split: r.n for r in sm.split_counts(split).collect()}
    assert counts == {k: v for k, v in (("train", train), ("validation", n - train)) if v}


def test_split_does_not_depend_on_partitions(spark):
    def ids(parts):
        split = sm.split_dataset(spark.range(500).repartition(parts), ["id"], 0.3)
        return {r.id for r in split.where("split = 'train'").collect()}

    assert ids(1) == ids(13)


def test_split_needs_a_key_that_identifies_rows(spark):
    df = spark.range(10).withColumn("id", F.lit(1))
    with pytest.raises(Exception, match="does not identify a row"):
        sm.split_dataset(df, ["id"], 0.5).collect()


def test_sample(spark):
    got = {r.id for r in sm.sample_n(spark.range(300), 40, ["id"], seed=1).collect()}
    assert got == set(order(range(300), 1)[:40])
    assert sm.sample_n(spark.range(3), 3, ["id"]).count() == 3
    assert sm.sample_n(spark.range(3), 0, ["id"]).count() == 0
    with pytest.raises(Exception, match="larger than the data set"):
        sm.sample_n(spark.range(3), 4, ["id"]).collect()


def test_mix(spark):
    a, b = spark.range(10), spark.range(100, 107)
    mix = sm.mix_datasets({"a": a, "b": b, "surplus": spark.range(5)}, [0.7, 0.3], ["id"], 3)
    got = {s: {r.id for r in mix.where(F.col("source") == s).collect()} for s in ("a", "b")}
    assert got == {"a": set(order(range(10), 3)[:7]), "b": set(order(range(100, 107), 3)[:2])}
    assert mix.count() == 9


def test_mix_with_one_huge_source(spark):
    df = spark.range(3000).withColumn("source", F.when(F.col("id") < 2900, "big").otherwise("small"))
    mix = sm.mix_sources(df, {"big": 0.5, "small": 0.25}, ["id"])
    assert {r.source: r["count"] for r in mix.groupBy("source").count().collect()} == {
        "big": 1450, "small": 25,
    }


def test_head_limit(spark):
    df = spark.range(20).orderBy(F.desc("id"))
    assert sorted(r.id for r in sm.head_limit(df, 3, "id").collect()) == [0, 1, 2]
    assert sm.head_limit(df, None, "id").count() == 20
    assert sm.head_limit(df, 0, "id").count() == 20


def values_of(kind, n, rng):
    return {
        "uniform": lambda: [rng.random() for _ in range(n)],
        "one value": lambda: [2.5] * n,
        "mostly one": lambda: [1.0] * (n * 2 // 3) + [rng.random() * 9 for _ in range(n - n * 2 // 3)],
        "far apart": lambda: [math.exp(rng.random() * 600 - 300) for _ in range(n)],
        "negative": lambda: [rng.gauss(0, 1) for _ in range(n)],
        "whole": lambda: [float(rng.randrange(5)) for _ in range(n)],
    }[kind]()


@pytest.mark.parametrize("n", [1, 2, 7, 200])
def test_medians(spark, n):
    rng = random.Random(n)
    kinds = ["uniform", "one value", "mostly one", "far apart", "negative", "whole"]
    columns = {k.replace(" ", "_"): values_of(k, n, rng) for k in kinds}
    df = spark.createDataFrame(list(zip(*columns.values())), list(columns))
    got = {r.metric: r for r in ranks.summarize(df, list(columns)).collect()}
    for name, values in columns.items():
        assert got[name]["median"] == statistics.median(values), name
        assert got[name].n == n and got[name].hi == max(values)


def test_medians_of_heavy_tails(spark):
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 1000 == 0, F.pow(F.lit(10.0), F.col("id") / 200))
        .otherwise(F.rand(3))
        .alias("tailed"),
        F.pmod(F.xxhash64("id"), F.lit(50_000)).cast("double").alias("many"),
    )
    df = spark.createDataFrame(rows.collect(), rows.schema).repartition(5)
    got = {r.metric: r["median"] for r in ranks.summarize(df, ["tailed", "many"]).collect()}
    values = df.collect()
    assert got == {c: statistics.median(r[c] for r in values) for c in ("tailed", "many")}


def test_medians_skip_nulls(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None)], "a double, b double")
    assert [(r.metric, r.n, r["median"]) for r in ranks.summarize(df, ["a", "b"]).collect()] == [
        ("a", 2, 2.0)
    ]


@pytest.mark.parametrize("ratio", [0.0, 0.1, 0.37, 0.5, 1.0])
@pytest.mark.parametrize("seed", [1, 2])
def test_groups_are_never_split(spark, ratio, seed):
    rng = random.Random(seed)
    rows = [(f"g{i}" if i % 9 else None, j) for i in range(60) for j in range(rng.choice([1, 1, 2, 40]))]
    df = spark.createDataFrame(rows, "g string, j int").repartition(3)
    got = sm.split_by_group(df, ["g"], ratio, seed).collect()
    assert len(got) == len(rows)
    sides = {}
    for r in got:
        assert sides.setdefault(r.g, r.split) == r.split
    sizes = Counter(g for g, _ in rows)
    order = sorted(sizes, key=lambda g: (hashlib.md5(":".join(x for x in (g, str(seed)) if x is not None).encode()).hexdigest(), g or ""))
    sums = [0]
    for g in order:
        sums.append(sums[-1] + sizes[g])
    goal = int(len(rows) * (1 - ratio))
    best = min(sums, key=lambda s: (abs(s - goal), s))
    assert sum(r.split == "train" for r in got) == best


def test_splitting_no_groups(spark):
    df = spark.createDataFrame([], "g string")
    assert sm.split_by_group(df, ["g"]).count() == 0
    one = spark.createDataFrame([("a",)] * 10, "g string")
    assert {r.split for r in sm.split_by_group(one, ["g"], 0.4).collect()} == {"train"}
