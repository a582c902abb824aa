"""Exact top-k search: matrix products of tiles, selection per tile, tree merge of the lists."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256
#: Bytes of the vectors of a block of queries, and of a shard of candidates, on average. Every vector
#: is sent once per block or shard of the other side, so large ones keep the exchange small.
BLOCK_BYTES = 32 << 20
#: Rows that are multiplied at a time: queries, candidates.
QUERY_ROWS = 512
CANDIDATE_ROWS = 8192
#: Tiles that a search is cut into if the candidates allow it, so that all tasks have some.
SPREAD = 64
#: Lists that one step of the merge brings together.
FAN_IN = 8

_LONG = np.iinfo(np.int64)


def quantised(vector: Column) -> Column:
    """``floor(256 * x)`` of each component, as long (values beyond a long are cut to its range)."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))


def usable(vector: Column) -> Column:
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))),
    )
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def tile_scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """All inner products, exactly: float64 while every partial sum is an integer below 2**53."""
    if not queries.shape[1]:
        return np.zeros((len(queries), len(candidates)), dtype=np.int64)
    peak = [max(abs(int(m.max())), abs(int(m.min()))) for m in (queries, candidates)]
    bound = peak[0] * peak[1] * queries.shape[1]
    if bound < 2**53:
        return (queries.astype(np.float64) @ candidates.astype(np.float64).T).astype(np.int64)
    if bound <= _LONG.max:
        return queries @ candidates.T
    exact = queries.astype(object) @ candidates.astype(object).T
    return np.clip(exact, _LONG.min, _LONG.max).astype(np.int64)


def select(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id; partial selection, then a sort."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        kept = np.flatnonzero(scores >= least)
    else:
        kept = np.arange(len(scores))
    return kept[np.lexsort((ids[kept], -scores[kept].astype(object)))][:k] if len(kept) else kept


def tile_lists(
    queries: np.ndarray, query_ids: np.ndarray, candidates: np.ndarray, ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each query its ``k`` best candidates with another identifier: query position, id, score.

    Tiles of ``QUERY_ROWS`` by ``CANDIDATE_ROWS`` scores are in memory, one at a time; a query's lists
    of the tiles are merged by one more selection.
    """
    places, found, best = [], [], []
    for low in range(0, len(queries), QUERY_ROWS):
        asked = query_ids[low : low + QUERY_ROWS]
        lists = [([], []) for _ in asked]
        for at in range(0, len(candidates), CANDIDATE_ROWS):
            names = ids[at : at + CANDIDATE_ROWS]
            scores = tile_scores(queries[low : low + QUERY_ROWS], candidates[at : at + CANDIDATE_ROWS])
            own = np.isin(asked, names)
            for row, query, met, (some_ids, some_scores) in zip(scores, asked, own, lists):
                others = names
                if met:
                    other = names != query
                    others, row = names[other], row[other]
                top = select(row, others, k)
                some_ids.append(others[top])
                some_scores.append(row[top])
        for place, (some_ids, some_scores) in enumerate(lists, low):
            some_ids, some_scores = np.concatenate(some_ids), np.concatenate(some_scores)
            top = select(some_scores, some_ids, k)
            places.append(np.full(len(top), place))
            found.append(some_ids[top])
            best.append(some_scores[top])
    return np.concatenate(places), np.concatenate(found), np.concatenate(best)


def _score_tile(k: int):
    def score(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(candidates):
            return empty
        copies = candidates["copies"].clip(upper=k).to_numpy()
        ids = candidates["id"].to_numpy().repeat(copies)
        left = np.stack(queries["vector"].to_numpy()).astype(np.int64, copy=False)
        right = np.stack(candidates["vector"].to_numpy()).astype(np.int64, copy=False).repeat(copies, axis=0)
        query_ids = queries["id"].to_numpy()
        place, vec_id, found = tile_lists(left, query_ids, right, ids, k)
        return pd.DataFrame(
            {
                "query_id": query_ids[place],
                "query_hash": queries["hash"].to_numpy()[place],
                "node": candidates["shard"].iloc[0],
                "vec_id": vec_id,
                "score": found,
            }
        )

    empty = pd.DataFrame(
        {n: pd.Series(dtype="int64") for n in ("query_id", "query_hash", "node", "vec_id", "score")}
    )
    return score


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each query row its ``k`` highest inner products.

    Rows are ``floor(256 x)`` vectors; queries are the rows for which ``is_query`` holds, candidates
    all rows with another identifier. Queries are dealt into blocks and candidates into shards by a
    hash of their content, each of about ``BLOCK_BYTES``. A task gets one block and one shard,
    multiplies them tile by tile and keeps the best ``k`` of each query; lists of ``FAN_IN``
    neighbouring shards merge level by level. All queries have to meet all candidates, so the
    products grow with both, and so does what is exchanged, but slowly: a candidate is sent once per
    block of queries, which is once for the first 65,536 queries of 64 components.

    Ties go to the smaller identifier. Rows without identifier or with a null vector, component or
    value that is not finite take no part. Vectors meet only vectors of their own length. Equal
    rows are counted before they are dealt: as candidates they fill several ranks, as a query they
    answer once; rows with one identifier and different vectors are queries of their own. An empty
    table gives no rows, a query without candidates none, and scores beyond a long are cut to it.
    """
    vector, identifier = F.col(vector_column), F.col(id_column)
    rows = (
        vectors.where(usable(vector) & identifier.isNotNull())
        .select(
            identifier.cast("long").alias("id"),
            quantised(vector).alias("vector"),
            F.coalesce(is_query, F.lit(False)).alias("asks"),
        )
        .groupBy("id", "vector", "asks")
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("hash", F.xxhash64("id", "vector"))
        .withColumn("width", F.size("vector"))
    )
    # Two numbers per vector length decide how many blocks there are.
    counts = rows.groupBy("width").agg(
        F.count(F.lit(1)).alias("candidates"), F.count_if("asks").alias("queries")
    )
    values = F.greatest("width", F.lit(1))
    sizes = counts.select(
        F.max("candidates").alias("candidates"),
        F.max(F.col("candidates") * values).alias("candidate_values"),
        F.max(F.col("queries") * values).alias("query_values"),
    ).first()

    def blocks_of(values: int | None) -> int:
        return math.ceil((values or 0) * 8 / BLOCK_BYTES) or 1

    shards = max(blocks_of(sizes["candidate_values"]), min(SPREAD, sizes["candidates"] or 1))
    blocks = blocks_of(sizes["query_values"])

    def dealt(name: str, number: int) -> Column:
        return F.pmod(F.xxhash64(F.col("hash"), F.lit(name)), F.lit(number)).alias(name)

    def all_of(name: str, number: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(number - 1).cast("long"))).alias(
            name
        )

    # Both sides come from one table, so each column gets a name of its own on either side.
    tile = ["width", "block", "shard"]
    sides = [
        part.select(*[F.col(c).alias(c) for c in ("id", "hash", "copies", "vector", "width")], *more)
        for part, more in (
            (rows.where("asks"), (dealt("block", blocks), all_of("shard", shards))),
            (rows, (dealt("shard", shards), all_of("block", blocks))),
        )
    ]
    queries, candidates = sides
    lists = (
        queries.groupBy(*tile)
        .cogroup(candidates.groupBy(*tile))
        .applyInPandas(
            _score_tile(k), "query_id long, query_hash long, node long, vec_id long, score long"
        )
    )

    entry = F.struct((-F.col("score").cast("decimal(20,0)")).alias("less"), "vec_id", "score")
    query = ["query_id", "query_hash"]
    nodes = shards
    while True:
        nodes = math.ceil(nodes / FAN_IN)
        lists = (
            lists.withColumn("node", F.floor(F.col("node") / FAN_IN))
            .groupBy(*query, "node")
            .agg(F.slice(F.sort_array(F.collect_list(entry)), 1, k).alias("best"))
            .select(*query, "node", F.posexplode("best").alias("place", "entry"))
            .select(*query, "node", "place", "entry.vec_id", "entry.score")
        )
        if nodes == 1:
            break
    return lists.select("query_id", (F.col("place") + 1).alias("rank"), "vec_id", "score")
