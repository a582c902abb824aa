"""The registered queries of these operators, over whole tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatprep.functions.binding import let
from chatprep.llm import (
    audit,
    bpe,
    content_sort,
    langid,
    mixing,
    periods,
    quality,
    sharding,
    simhash,
    suffix,
    token_files,
    topk,
    windows,
)
from chatprep.llm.common import SPACE

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: The id that ends a document in the token files.
END_ID = 1


def _query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query(
    "op1_exact_topk",
    """
    WITH rows AS (
        SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS vec
        FROM embeddings
        WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
          AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id,
            coalesce(list_sum([p[1] * p[2] FOR p IN list_zip(q.vec, c.vec)]), 0)::BIGINT AS score
        FROM rows q JOIN rows c ON q.vec_id <> c.vec_id AND len(q.vec) = len(c.vec)
        WHERE q.vec_id % 50 = 0
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
        FROM scored
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
)
def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


@_query("op2_suffix_dedup")
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix.remove_repeated_strings(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@_query("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


@_query("op4_repeated_windows")
def op4_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = windows.remove_repeated_windows(_table(spark, sf_dir, "documents"))
    removed = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]).cast("long")
    )
    return found.select(
        "doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256")
    )


def _apportioned(table: str, votes: str, house: str, group: str, order: str) -> str:
    """Sainte-Lague seats of each row of a table, as ``apportioned`` gives them."""
    return f"""{table}_base AS (
        SELECT *, {house} AS house, CASE WHEN sum({votes}) OVER {group} > 0
            THEN {votes} / sum({votes}) OVER {group} ELSE 0.0 END AS part FROM {table}
    ), {table}_rounded AS (
        SELECT *, floor(part * house + 0.5)::BIGINT AS base, count(*) OVER {group} AS listed,
            row_number() OVER ({group[1:-1]} ORDER BY {order}) AS spot FROM {table}_base
    ), {table}_missing AS (
        SELECT *, (house - sum(base) OVER {group})::BIGINT AS missing FROM {table}_rounded
    ), {table}_listed AS (
        SELECT *, unnest(range(1, 2 + 1 + ceil(part * (abs(missing) + listed))::BIGINT)) AS nth
        FROM {table}_missing WHERE missing <> 0 AND {votes} > 0
    ), {table}_turns AS (
        SELECT *, row_number() OVER (PARTITION BY {order.split(",")[0] if "," in order else "1"} ORDER BY
            CASE WHEN missing > 0 THEN -({votes} / (2 * (base + nth) - 1))
                ELSE {votes} / (2 * (base - nth + 1) - 1) END,
            CASE WHEN missing > 0 THEN spot ELSE -spot END) AS turn
        FROM {table}_listed WHERE missing > 0 OR nth <= base
    ), {table}_seats AS (
        SELECT *, base + sign(missing)::BIGINT * (SELECT count(*) FROM {table}_turns t
            WHERE turn <= abs(t.missing) AND {" AND ".join(f"t.{c} IS NOT DISTINCT FROM m.{c}" for c in order.split(","))}
            ) AS seats FROM {table}_missing m
    )"""


@_query(
    "op5_source_mix",
    f"""
    WITH sizes AS (
        SELECT doc_id, source,
            coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
            md5('5:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))) AS key
        FROM documents
    ), sources AS (
        SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n FROM sizes GROUP BY source
    ), weighted AS (
        SELECT *, ([5, 2, 1])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER]
                AS weight,
            sum(source_size) OVER () AS total, source_size * 3 AS cap
        FROM sources
    ), filled AS (
        SELECT *,
            (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight
            >= cap * sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS capped
        FROM weighted
    ), planned AS (
        SELECT source, source_size, n,
            CASE WHEN capped THEN cap::DOUBLE ELSE
                ((total - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ()) * weight)::DOUBLE
                / sum(CASE WHEN capped THEN 0 ELSE weight END) OVER () END AS target,
            CASE WHEN bool_and(capped) OVER () THEN sum(cap) OVER () ELSE total END::DOUBLE AS mix_size,
            greatest(ceil((source_size + n) / greatest({mixing.SHARD},
                ceil(sum(source_size + n) OVER () / {mixing.SHARDS}))), 1)::BIGINT AS shards
        FROM filled
    ), {_apportioned("planned", "target", f"floor(mix_size / {mixing.BLOCK} + 0.5)::BIGINT", "()", "source")},
    dealt AS (
        SELECT s.*, p.source_size, p.target, p.seats AS source_seats,
            ('0x' || substr(key, 1, 8))::BIGINT % p.shards AS shard
        FROM sizes s JOIN planned_seats p ON s.source IS NOT DISTINCT FROM p.source
    ), cells AS (
        SELECT source, shard, sum(size)::BIGINT AS shard_size, max(source_seats) AS source_seats
        FROM dealt GROUP BY source, shard
    ), {_apportioned("cells", "shard_size", "source_seats", "(PARTITION BY source)", "source,shard")},
    chosen AS (
        SELECT source, shard, shard_size, greatest(shard_size, 1) AS turns,
            least(seats * {mixing.BLOCK}, 3 * shard_size) AS words,
            ('0x' || substr(md5('5:' || coalesce(source, '') || ':' || shard::VARCHAR || ':offset'), 1, 8))::BIGINT
                % greatest(ceil(shard_size / {mixing.BLOCK}), 1)::BIGINT * {mixing.BLOCK} AS low
        FROM cells_seats
    ), running AS (
        SELECT d.*, c.shard_size, words // turns AS passes, words % turns AS extra, low,
            sum(size) OVER (PARTITION BY d.source, d.shard ORDER BY key, doc_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS hi
        FROM dealt d JOIN chosen c ON d.source IS NOT DISTINCT FROM c.source AND d.shard = c.shard
    )
    SELECT doc_id, size, source_size, target, (passes * size
        + greatest(least(hi, low + extra, shard_size) - greatest(hi - size, low), 0)
        + greatest(least(hi, greatest(low + extra - shard_size, 0)) - (hi - size), 0))::BIGINT AS taken
    FROM running
    """,
)
def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


@_query("op6_balanced_shards")
def op6_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.balanced_shards(_table(spark, sf_dir, "documents"), shards=8)


@_query("op7_quality")
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query(
    "op8_exact_dedup",
    """
    WITH rows AS (
        SELECT doc_id, length(coalesce(text, '')) AS points,
            sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g')) AS text_sha256
        FROM documents
    )
    SELECT doc_id,
        first_value(doc_id) OVER best AS keep_id,
        count(*) OVER (PARTITION BY text_sha256) AS group_size,
        row_number() OVER best = 1 AS kept,
        text_sha256
    FROM rows
    WINDOW best AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST)
    """,
)
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.exact_dedup(_table(spark, sf_dir, "documents"))


@_query("op9_bpe_round_trip")
def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(_table(spark, sf_dir, "documents"), TOKENIZER)


@_query("op10_simhash_components")
def op10_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def with_planted_runs(doc_id: Column, text: Column) -> Column:
    """The text of a document, every tenth of which, by a hash of its id, repeats a passage of its
    own from some word on to its end."""
    hashed = F.crc32(doc_id.cast("string"))
    words = F.filter(F.split(text, SPACE), lambda w: w != "")

    def repeat(known: Column) -> Column:
        words, drawn = known["words"], known["drawn"]
        n = F.size(words).cast("long")
        first = drawn % n
        period = F.floor((n - first) / (drawn % 8 + 3)) + 1

        def word(word: Column, i: Column) -> Column:
            return F.when(i < first, word).otherwise(
                F.get(words, (first + (i - first) % period).cast("int"))
            )

        return F.when(n == 0, text).otherwise(F.array_join(F.transform(words, word), " "))

    known = F.struct(words.alias("words"), F.floor(hashed / 10).alias("drawn"))
    return F.when(hashed % 10 == 0, let(known, repeat)).otherwise(text)


@_query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    planted = docs.withColumn("text", with_planted_runs(F.col("doc_id"), F.col("text")))
    found = periods.periodic_runs(planted)

    def longer(best: Column, run: Column) -> Column:
        # Lengths over periods, compared as whole numbers; runs come by start and period.
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    best = F.aggregate("runs", none, longer)
    line = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@_query("op12_token_files")
def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(_table(spark, sf_dir, "documents"), WORD_TOKENIZER, END_ID)


@_query(
    "op13_filter_audit",
    """
    WITH counted AS (
        SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
            regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
            length(coalesce(text, '')) AS points
        FROM documents
    ), marked AS (
        SELECT c.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
            (len(words) < 100)::INTEGER AS a,
            (100 * len(list_distinct(words)) < 80 * len(words))::INTEGER AS b,
            (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * points)::INTEGER AS c,
            regexp_matches(text, '[#$%&*|]')::INTEGER AS d,
            coalesce(c.doc_id > min(c.doc_id) OVER (PARTITION BY text), FALSE)::INTEGER AS e
        FROM counted c LEFT JOIN (
            SELECT doc_id, max((quality = 1)::INTEGER) AS good, max((toxic = 1)::INTEGER) AS toxic
            FROM labels GROUP BY doc_id) l ON c.doc_id = l.doc_id
    ), cells AS (
        SELECT part, a + 2 * b + 4 * c + 8 * d + 16 * e AS mask, a + b + c + d + e AS fails,
            count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
        FROM marked GROUP BY ALL
    ), letters AS (
        SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS l(letter, bit)
    ), orders AS (
        SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
        FROM letters a, letters b, letters c, letters d, letters e
        WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
            AND a.bit | b.bit | c.bit | d.bit | e.bit = 31
    ), steps AS (
        SELECT filter_order, step, l.bit, (SELECT coalesce(sum(e.bit), 0) FROM letters e
            WHERE instr(o.filter_order, e.letter) < step)::BIGINT AS before
        FROM orders o, range(1, 6) AS r(step), letters l
        WHERE l.letter = substr(o.filter_order, step, 1)
    )
    SELECT part, filter_order, step::INTEGER AS step,
        coalesce(sum(n) FILTER (mask & (bit | before) = 0), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (mask & bit > 0 AND mask & before = 0), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (mask & bit > 0 AND mask & before > 0), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
        coalesce(sum(good) FILTER (mask & bit > 0 AND mask & before = 0), 0)::BIGINT AS good_lost,
        coalesce(sum(toxic) FILTER (mask & bit > 0 AND mask & before = 0), 0)::BIGINT AS toxic_lost,
        coalesce(sum(n * 120 // greatest(fails, 1)) FILTER (mask & bit > 0), 0)::BIGINT AS shapley
    FROM cells, steps GROUP BY part, filter_order, step
    """,
)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.filter_audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
