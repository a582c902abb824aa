"""Turn conversations into scored generations and aggregate the scores."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatprep.functions.chat import conversation_id, conversation_prompt, eval_pair
from chatprep.functions.scores import coherence_score, response_length, tokens_per_second
from chatprep.operators.joins import null_safe_join
from chatprep.operators.ranks import summarize
from chatprep.operators.sample import head_limit
from chatprep.schema import GENERATION

Messages = list[dict[str, str]]
#: Takes a batch of conversations, gives (response, seconds, tokens) of each.
Generator = Callable[[list[Messages]], Sequence[tuple[str, float, int]]]
#: Called once per task with the generation options; loads the model and gives the generator.
GeneratorFactory = Callable[[Mapping], Generator]

RESULT_COLUMNS = ("response", "generation_time", "tokens_generated", "tokens_per_second")
BATCH_SIZE = 64
ALL_METRICS = ("response_length", "generation_time", "coherence_score")


def _generate(
    messages: Column,
    factory: GeneratorFactory,
    batch_size: int,
    defaults: Mapping | None = None,
    **overrides,
) -> Column:
    """``struct<response, generation_time, tokens_generated>`` by the caller's generator.

    The one Python step: Arrow batches of the ``messages`` column alone go to the worker, all other
    columns stay in the JVM. The generator is called with up to ``batch_size`` conversations and must
    give as many results. ``overrides`` win over ``defaults``. Generation may differ from call to
    call, so the expression is marked as non-deterministic and never evaluated twice per row by the
    optimizer; store its result before reading it more than once.
    """
    options = {**(defaults or {}), **overrides}

    @F.pandas_udf(GENERATION)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        generate = factory(options)
        for batch in batches:
            rows = []
            for at in range(0, len(batch), batch_size):
                asked = [
                    [{"role": m["role"], "content": m["content"]} for m in conversation]
                    for conversation in batch[at : at + batch_size]
                ]
                answers = generate(asked)
                if len(answers) != len(asked):
                    raise ValueError(f"{len(asked)} conversations got {len(answers)} results")
                rows.extend(answers)
            yield pd.DataFrame(rows, columns=GENERATION.fieldNames())

    return run.asNondeterministic()(messages)


def batch_generate(
    df: DataFrame,
    factory: GeneratorFactory,
    messages: str = "messages",
    partitions: int | None = None,
    batch_size: int = BATCH_SIZE,
    defaults: Mapping | None = None,
    **overrides,
) -> DataFrame:
    """``df`` with the generation result columns.

    The conversations stay in their partitions. Generation costs far more than moving the prompts,
    so where the input has too few or uneven ones, name a number of ``partitions`` to spread the
    conversations over.
    """
    # The generator keeps the expression that builds the prompts out of the Python step.
    asked = {messages: F.explode(F.array(F.col(messages))).alias(messages)}
    spread = df.repartition(partitions) if partitions else df.select(
        *[asked.get(c, F.col(c)) for c in df.columns]
    )
    result = spread.withColumn(
        "_result", _generate(F.col(messages), factory, batch_size, defaults, **overrides)
    )
    return result.select(*df.columns, "_result.*").withColumn(
        "tokens_per_second", tokens_per_second(F.col("tokens_generated"), F.col("generation_time"))
    )


def eval_pairs(df: DataFrame, messages: str = "messages", keep_all: bool = False) -> DataFrame:
    """Adds ``prompt_messages`` and ``expected_response``.

    Conversations without an expected response are dropped unless ``keep_all``. They are dropped by
    a generator, because a filter on a computed column is pushed below it and computes it twice.
    """
    pairs = F.array(eval_pair(F.col(messages)))
    if not keep_all:
        pairs = F.filter(pairs, lambda p: F.length(p["expected_response"]) > 0)
    return df.select(*df.columns, F.inline(pairs))


def evaluation_details(
    df: DataFrame,
    row_id: str,
    factory: GeneratorFactory,
    max_samples: int | None = None,
    partitions: int | None = None,
    **options,
) -> DataFrame:
    """One row per sample that has an expected answer.

    ``row_id`` is the record's 0-based place; ``sample_id`` counts from 1 and keeps the gaps that
    skipped samples leave.
    """
    limited = head_limit(df.select(row_id, "messages"), max_samples, row_id)
    pairs = eval_pairs(limited)
    results = batch_generate(
        pairs.select(
            (F.col(row_id) + 1).alias("sample_id"), "prompt_messages", "expected_response"
        ),
        factory,
        "prompt_messages",
        partitions,
        **options,
    )
    return results.withColumnRenamed("response", "generated_response")


def evaluate_on_dataset(
    df: DataFrame,
    row_id: str,
    factory: GeneratorFactory,
    output_path: str,
    max_samples: int | None = None,
    partitions: int | None = None,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """``(details, metrics)``. The details are stored at ``output_path`` first, so that each
    response is generated once and a lost executor costs no finished part."""
    details = evaluation_details(df, row_id, factory, max_samples, partitions, **options)
    details.write.mode("overwrite").parquet(output_path)
    stored = df.sparkSession.read.parquet(output_path)
    return stored, eval_metrics(stored)


def evaluate_quick(
    df: DataFrame, row_id: str, factory: GeneratorFactory, output_path: str, max_samples: int | None
) -> DataFrame:
    """The metrics alone, of the first ``max_samples`` records (None: of all)."""
    return evaluate_on_dataset(df, row_id, factory, output_path, max_samples)[1]


def evaluate_conversations(
    df: DataFrame,
    row_id: str,
    factory: GeneratorFactory,
    metrics: Iterable[str] = ALL_METRICS,
    metadata: str | None = None,
    partitions: int | None = None,
    **options,
) -> DataFrame:
    """One row per conversation: the generation, and the extra scores asked for."""
    ident = F.col(row_id).cast("string")
    if metadata:
        ident = conversation_id(F.col(metadata), F.col(row_id))
    prompts = df.select(
        ident.alias("conversation_id"), conversation_prompt(F.col("messages")).alias("prompt")
    )
    results = batch_generate(prompts, factory, "prompt", partitions, **options)
    results = results.drop("prompt").withColumnRenamed("response", "generated_response")
    extra = {
        "response_length": response_length(F.col("generated_response")),
        "coherence_score": coherence_score(F.col("generated_response")),
    }
    return results.withColumns({k: v for k, v in extra.items() if k in set(metrics)})


def zip_results(conversations: DataFrame, results: DataFrame, row_id: str) -> DataFrame:
    """Conversation and result of the same row. Ids are unique, so the join cannot be skewed."""
    return conversations.join(results, row_id)


METRIC_COLUMNS = ("generation_time", "tokens_per_second", "tokens_generated")


def eval_metrics(details: DataFrame) -> DataFrame:
    """One row: count, sums, means and exact medians. Reads ``details`` several times; store it.

    ``total_samples`` counts rows; nulls are left out of sums, means and medians.
    """
    long = summarize(details, METRIC_COLUMNS)
    rows = details.agg(F.count(F.lit(1)).alias("total_samples"))

    def of(metric: str, column: str) -> Column:
        return F.max(F.when(F.col("metric") == metric, F.col(column)))

    time, speed, tokens = METRIC_COLUMNS
    return long.agg(
        F.lit(rows.scalar()).alias("total_samples"),
        of(time, "total").alias("total_generation_time"),
        of(tokens, "total").cast("bigint").alias("total_tokens_generated"),
        of(time, "mean").alias("avg_generation_time"),
        of(time, "median").alias("median_generation_time"),
        of(speed, "mean").alias("avg_tokens_per_second"),
        of(speed, "median").alias("median_tokens_per_second"),
        of(tokens, "mean").alias("avg_tokens_per_response"),
        of(tokens, "median").alias("median_tokens_per_response"),
    )


#: Size parameter of the quantile sketches of a summary.
SKETCH_SIZE = 2048


def rank_error(size: int = SKETCH_SIZE) -> float:
    """The error of the ranks that sketches of this size give, as a share of all values, that is not
    exceeded in 99 of 100 cases, however often they are merged."""
    # The published error curve of these sketches.
    return 2.296 / size**0.9723


def eval_summaries(
    details: DataFrame, by: Sequence[str] = (), size: int = SKETCH_SIZE
) -> DataFrame:
    """``(*by, metric, n, total, lo, hi, sketch)``: per group and metric what a later run needs of
    these details: count, sum, extremes, and a quantile sketch of bounded size.

    Stored per run or shard, summaries of new details are merged with those of earlier ones by
    ``merge_summaries``, and earlier details need not be read again. Nulls are left out; a group
    without values of a metric has no row for it.
    """
    pairs = [
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
        for c in METRIC_COLUMNS
    ]
    values = details.select(*by, F.inline(F.array(*pairs))).where("value IS NOT NULL")
    return values.groupBy(*by, "metric").agg(
        F.count("value").alias("n"),
        F.sum("value").alias("total"),
        F.min("value").alias("lo"),
        F.max("value").alias("hi"),
        F.kll_sketch_agg_double("value", F.lit(size)).alias("sketch"),
    )


def merge_summaries(
    summaries: DataFrame, by: Sequence[str] = (), size: int = SKETCH_SIZE
) -> DataFrame:
    """``(*by, metric, n, total, mean, lo, hi, median, rank_error)`` of all details that are summed up.

    The median's true rank lies within ``rank_error * n`` of the middle one (see ``rank_error``); it
    is one of the values. ``eval_metrics`` gives the exact one, for which it reads the details.
    """
    merged = summaries.groupBy(*by, "metric").agg(
        F.sum("n").alias("n"),
        F.sum("total").alias("total"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch"),
    )
    return merged.select(
        *by,
        "metric",
        "n",
        "total",
        (F.col("total") / F.col("n")).alias("mean"),
        "lo",
        "hi",
        F.kll_sketch_get_quantile_double("sketch", F.lit(0.5)).alias("median"),
        F.lit(rank_error(size)).alias("rank_error"),
    )


def median_ranks(details: DataFrame, merged: DataFrame) -> DataFrame:
    """``(metric, below, upto)``: the shares of values below and up to the merged medians, to be
    compared with a half. ``merged`` has one row per metric."""
    pairs = [
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
        for c in METRIC_COLUMNS
    ]
    values = details.select(F.inline(F.array(*pairs))).where("value IS NOT NULL")
    placed = values.join(F.broadcast(merged.select("metric", "median")), "metric")
    return placed.groupBy("metric").agg(
        F.avg((F.col("value") < F.col("median")).cast("double")).alias("below"),
        F.avg((F.col("value") <= F.col("median")).cast("double")).alias("upto"),
    )


def speed_summary(timings: DataFrame) -> DataFrame:
    """One row over recorded generations (``generation_time``, ``tokens_per_second``)."""

    def spread(column: str) -> list[Column]:
        return [
            F.avg(column).alias(f"avg_{column}"),
            F.min(column).alias(f"min_{column}"),
            F.max(column).alias(f"max_{column}"),
        ]

    return timings.agg(
        F.sum("generation_time").alias("total_benchmark_time"),
        F.count(F.lit(1)).alias("num_samples"),
        *spread("generation_time"),
        *spread("tokens_per_second"),
    )


def flag_summary(
    df: DataFrame, flags: Sequence[str], length: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """``total``, and per flag ``<flag>_count`` and ``<flag>_pct``; the mean length if named."""
    counts = [F.count_if(F.col(f)).alias(f"{f}_count") for f in flags]
    mean = [F.avg(length).alias("avg_response_length")] if length else []
    summary = df.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), *counts, *mean)
    percents = {
        f"{f}_pct": F.try_divide(F.col(f"{f}_count") * 100.0, F.col("total")) for f in flags
    }
    return summary.withColumns(percents)


def quality_gate(summary: DataFrame, thresholds: Mapping[str, float]) -> DataFrame:
    """Adds ``success``: every flag is set at least ``total * threshold`` times."""
    passed = [
        F.col(f"{flag}_count") >= F.col("total") * F.lit(float(share))
        for flag, share in thresholds.items()
    ]
    return summary.withColumn("success", reduce(lambda a, b: a & b, passed))


def accuracy(
    df: DataFrame, predicted: str, gold: str, by: Sequence[str] = ()
) -> DataFrame:
    """Percent of samples whose prediction equals the gold value. No prediction is wrong."""
    right = F.when(F.col(predicted) == F.col(gold), 1.0).otherwise(0.0)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_samples"), (F.avg(right) * 100).alias("accuracy")
    )


def best_checkpoint(
    log: DataFrame, by: Sequence[str], step: str, train_loss: str, eval_loss: str
) -> DataFrame:
    """The step with the smallest gap between the two losses, the earliest one if equal.

    Two hash aggregates over numbers, where one over a struct would sort the log.
    """
    gap = F.abs(F.col(eval_loss) - F.col(train_loss))
    scored = log.select(*by, gap.alias("gap"), F.col(step).alias("_step")).where("gap IS NOT NULL")
    least = scored.groupBy(*by).agg(F.min("gap").alias("gap"))
    best = null_safe_join(scored, least, [*by, "gap"])
    return best.groupBy(*by, "gap").agg(F.min("_step").alias("best_step")).select(
        *by, "best_step", "gap"
    )


def ensemble_results(
    scores: DataFrame, methods: Sequence[str], model: str = "model",
    method: str = "method", score: str = "score",
) -> DataFrame:
    """One row per model with a column per method. ``(model, method)`` is unique: two scores of one
    pair are an error, null ones aside."""
    several = F.raise_error(
        F.concat_ws(" ", F.lit("several scores of"), F.col(model), F.col(method))
    ).cast("double")
    one = F.when(F.count(score) > 1, several).otherwise(F.max(score)).alias(score)
    scores = scores.groupBy(model, method).agg(one)
    return scores.groupBy(model).pivot(method, list(methods)).agg(F.max(score))
