"""Split, sample and mix with exact sizes, repeatable under any partitioning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatprep.operators.ranks import before_cut, group_cut, hash_cut, nth_id


def train_rows(n: Column, val_ratio: float) -> Column:
    """``int(n * (1 - val_ratio))`` in double arithmetic."""
    return F.floor(n.cast("double") * (F.lit(1.0) - F.lit(float(val_ratio))))


def split_dataset(
    df: DataFrame, key: Sequence[str], val_ratio: float = 0.1, seed: int = 42
) -> DataFrame:
    """``df`` with a column ``split``: 'train' for the first rows in hash order, else 'validation'.

    ``key`` identifies a row.
    """
    if not 0 <= val_ratio <= 1:
        raise ValueError(f"a share of the rows is between 0 and 1: {val_ratio}")
    cut = hash_cut(df, key, lambda n: train_rows(n, val_ratio), seed)
    df, in_train = before_cut(df, key, cut, seed)
    return df.withColumn("split", F.when(in_train, "train").otherwise("validation"))


def split_by_group(
    df: DataFrame, group: Sequence[str], val_ratio: float = 0.1, seed: int = 42
) -> DataFrame:
    """``df`` with a column ``split``, as ``split_dataset`` gives it, but with all rows of a group on
    one side: all turns of a conversation, or all copies of a text.

    Groups are taken in hash order as long as that brings the number of training rows nearer to the
    exact size, so it is off by half a group at most. Rows whose group is null are one group.
    """
    if not 0 <= val_ratio <= 1:
        raise ValueError(f"a share of the rows is between 0 and 1: {val_ratio}")
    cut = group_cut(df, group, lambda n: train_rows(n, val_ratio), seed)
    df, in_train = before_cut(df, group, cut, seed)
    return df.withColumn("split", F.when(in_train, "train").otherwise("validation"))


def split_counts(split: DataFrame) -> DataFrame:
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def sample_n(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows without replacement; asking for more than there are is an error."""

    if n < 0:
        raise ValueError(f"a sample has no negative size: {n}")
    problem = F.raise_error(F.lit(f"sample of {n} is larger than the data set"))

    def take(total: Column) -> Column:
        return F.when(total < n, problem.cast("bigint")).otherwise(F.lit(n).cast("bigint"))

    cut = hash_cut(df, key, take, seed)
    rows, taken = before_cut(df, key, cut, seed)
    # An empty table has no bucket in which that could fail; its count does.
    enough = F.when(F.count(F.lit(1)) < n, problem.cast("boolean")).otherwise(F.lit(False))
    short = df.agg(enough.alias("short"))
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema]
    return rows.where(taken).unionByName(short.where("short").select(*nothing))


def mix_datasets(
    datasets: Mapping[str, DataFrame],
    weights: Sequence[float],
    key: Sequence[str],
    seed: int = 42,
) -> DataFrame:
    """``int(len * weight)`` rows of each data set, with their ``source``.

    A weight is a share of that data set, not of the mix. Surplus data sets or weights are ignored.
    """
    chosen = list(zip(datasets.items(), weights))
    tagged = [frame.withColumn("source", F.lit(name)) for (name, frame), _ in chosen]
    return mix_sources(
        reduce(DataFrame.unionByName, tagged),
        {name: weight for (name, _), weight in chosen},
        key,
        seed,
    )


def mix_sources(
    df: DataFrame,
    weights: Mapping[str, float],
    key: Sequence[str],
    seed: int = 42,
    source: str = "source",
) -> DataFrame:
    """The same for one table that holds all data sets, told apart by ``source``. Sources without a
    weight are left out."""
    for name, weight in weights.items():
        if not 0 <= weight <= 1:
            raise ValueError(f"a share of '{name}' is between 0 and 1: {weight}")
    share = F.create_map(*[F.lit(x) for kv in weights.items() for x in (kv[0], float(kv[1]))])
    df = df.where(F.col(source).isin(*weights))

    def take(total: Column) -> Column:
        return F.floor(total.cast("double") * share[F.col(source)])

    cut = hash_cut(df, key, take, seed, by=source, groups=len(weights))
    columns = df.columns
    df, taken = before_cut(df, key, cut, seed, by=source, groups=len(weights))
    return df.where(taken).select(*columns)


def head_limit(df: DataFrame, max_samples: int | None, row_id: str) -> DataFrame:
    """The first ``max_samples`` records by row id, an integer that is unique and never null; no
    limit for 0 or None.

    The last id taken is found from counts per range of ids, and each row compared with it, so the
    rows stay where they are.
    """
    if not max_samples:
        return df
    cut = nth_id(df, row_id, max_samples)
    return df.where(F.coalesce(F.col(row_id) <= cut.scalar(), F.lit(True)))
