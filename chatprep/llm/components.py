"""Connected components of a large graph by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatprep.llm.common import stored


def _to_smallest(pairs: DataFrame, upward: bool) -> DataFrame:
    """For each node: join its neighbours (the larger ones if ``upward``) to its smallest one."""
    smallest = pairs.groupBy("a").agg(F.min("b").alias("low"))
    smallest = smallest.withColumn("low", F.least("a", "low"))
    joined = pairs.join(smallest, "a")
    if upward:
        links = joined.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        links = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            smallest.select("a", F.col("low").alias("b"))
        )
    return links.where("a != b").distinct()


def stars(links: DataFrame) -> DataFrame:
    """``(a, b)``: each linked node ``a`` with the smallest node ``b`` of its component, ``b < a``.

    ``links`` has columns ``a, b`` (long) in any order. A round hangs every node's larger neighbours
    on its smallest neighbour, then its smaller neighbours; edges never multiply, and the rounds
    grow with the logarithm of the number of nodes. Each round is stored, so lineage stays short.
    """
    edges = stored(
        links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        edges = stored(_to_smallest(both, upward=True), "links")
        edges = stored(_to_smallest(edges, upward=False), "links")
        now = edges.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
        ).first()
        if now == state:
            return edges
        state = now
