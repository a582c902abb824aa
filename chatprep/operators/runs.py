"""Training runs and their metrics as tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatprep.functions.binding import let
from chatprep.operators.joins import null_safe_join

RUN_ID = ("project", "experiment", "run")

# The notes at the two ends of a run.
STARTED_NOTE = "Training started at step "
COMPLETED_NOTE = "Training completed at step "


# ---- metric log --------------------------------------------------------------------------------


def numeric_value(value: Column) -> Column:
    """A variant as a double if it holds a number or a boolean, else null."""
    kind = F.schema_of_variant(value)
    number = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    flag = F.try_variant_get(value, "$", "boolean").cast("int").cast("double")
    return F.when(number, F.try_variant_get(value, "$", "double")).when(kind == "BOOLEAN", flag)


def filter_numeric_metrics(
    df: DataFrame, metrics: str = "metrics", keep: Sequence[str] = ()
) -> DataFrame:
    """``(key, value)`` of the numeric entries of a JSON object column; booleans count as 0 / 1.

    A null (or a JSON null) has no entries; a text that is no JSON object is an error.
    """
    kind = T.MapType(T.StringType(), T.VariantType())
    text = F.col(metrics)
    problem = F.raise_error(F.concat(F.lit("not a JSON object of metrics: "), F.left(text, F.lit(200))))
    entries = F.from_json(text, kind)
    malformed = text.isNotNull() & entries.isNull() & (F.trim(text) != "null")
    entries = F.when(malformed, problem.cast(kind)).otherwise(entries)
    exploded = df.select(*keep, F.explode(entries).alias("key", "v"))
    return exploded.select(*keep, "key", numeric_value(F.col("v")).alias("value")).where(
        F.col("value").isNotNull()
    )


def log_metrics(
    df: DataFrame, metrics: str = "metrics", step: str = "step", run: Sequence[str] = RUN_ID
) -> DataFrame:
    """The metric log: one row ``(*run, step, key, value)`` per numeric entry."""
    return filter_numeric_metrics(df, metrics, keep=(*run, step))


def log_text(log: DataFrame, run: Sequence[str] = RUN_ID, step: str = "step") -> DataFrame:
    """``(*run, key, text)``: a note at the first and one at the last step of each run."""
    ends = log.groupBy(*run).agg(F.min(step).alias("first"), F.max(step).alias("last"))
    notes = F.array(
        F.concat(F.lit(STARTED_NOTE), F.col("first").cast("string")),
        F.concat(F.lit(COMPLETED_NOTE), F.col("last").cast("string")),
    )
    return ends.select(*run, F.lit("training_log").alias("key"), F.explode(notes).alias("text"))


def elapsed_minutes(log: DataFrame, run: Sequence[str], ts: str = "ts") -> DataFrame:
    """Adds ``training_time_minutes`` since the run's first entry.

    The starts, one row per run from partial aggregates, are joined back. Spark broadcasts them if
    their size, which it knows by then, allows; else entries and starts meet by run, and its
    adaptive skew join cuts a run with very many entries into several tasks. Entries of a null run
    are one run; an entry without a time gets a null.
    """
    start = log.groupBy(*run).agg(F.min(ts).alias("_start"))
    micros = F.timestamp_diff("MICROSECOND", F.col("_start"), F.col(ts))
    timed = null_safe_join(log, start, list(run))
    return timed.withColumn("training_time_minutes", micros / 60_000_000).drop("_start")


def closing_entries(
    log: DataFrame, run: Sequence[str] = RUN_ID, step: str = "step", ts: str = "ts"
) -> DataFrame:
    """``(*run, step, key, value)``: the metric entries that end each run, its whole time in minutes
    and its last step."""
    ends = log.groupBy(*run).agg(
        F.max(step).alias(step),
        (F.timestamp_diff("MICROSECOND", F.min(ts), F.max(ts)) / 60_000_000).alias("_minutes"),
    )
    entries = F.array(
        F.struct(F.lit("total_training_time_minutes").alias("key"), F.col("_minutes").alias("value")),
        F.struct(F.lit("final_global_step").alias("key"), F.col(step).cast("double").alias("value")),
    )
    return ends.select(*run, step, F.inline(entries))


# ---- configuration -----------------------------------------------------------------------------


def flatten_hparams(params: Column) -> Column:
    """``map<string, string>`` of a JSON object: scalars as they read, all else as JSON text."""
    entries = F.from_json(params, T.MapType(T.StringType(), T.StringType()))
    return F.transform_values(entries, lambda _key, value: F.coalesce(value, F.lit("None")))


def _merge_two(earlier: Column, later: Column) -> Column:
    kept = F.map_filter(earlier, lambda key, _value: ~F.map_contains_key(later, key))
    return F.map_concat(kept, later)


def merge_maps(*maps: Column) -> Column:
    """One map; where keys repeat, the later map wins."""
    return reduce(_merge_two, maps)


def training_plan(
    df: DataFrame,
    n: str = "n",
    per_device: str = "per_device",
    accumulation: str = "accumulation",
    epochs: str = "epochs",
    max_steps: str = "max_steps",
) -> DataFrame:
    """Adds the step counts; ``epochs_completed`` is null where an epoch has no full batch."""
    batch = F.col(per_device) * F.col(accumulation)
    planned = df.withColumn("effective_batch_size", batch.cast("bigint")).withColumn(
        "steps_per_epoch", F.expr(f"`{n}` div effective_batch_size")
    )
    by_epochs = F.floor(F.col("steps_per_epoch") * F.col(epochs))
    total = F.when(F.col(max_steps) > 0, F.col(max_steps).cast("bigint")).otherwise(by_epochs)
    return planned.withColumn("total_steps", total).withColumn(
        "epochs_completed", F.try_divide(F.col("total_steps"), F.col("steps_per_epoch"))
    )


# ---- results of a run --------------------------------------------------------------------------


def final_stats(
    log: DataFrame, run: Sequence[str], step: str, loss: str, eval_loss: str, ts: str
) -> DataFrame:
    """Steps, seconds, mean loss, and the evaluation loss of the very last entry if it has one."""
    return log.groupBy(*run).agg(
        F.max(step).alias("total_steps"),
        (F.timestamp_diff("MICROSECOND", F.min(ts), F.max(ts)) / 1_000_000).alias("training_time"),
        F.avg(loss).alias("training_loss"),
        F.max_by(eval_loss, step).alias("final_eval_loss"),
    )


_STATE = "struct<best double, bad int, seen bigint, stop bigint>"


def _state(best: Column, bad: Column, seen: Column, stop: Column) -> Column:
    return F.struct(
        best.cast("double").alias("best"),
        bad.cast("int").alias("bad"),
        seen.cast("bigint").alias("seen"),
        stop.cast("bigint").alias("stop"),
    ).cast(_STATE)


def _nothing() -> Column:
    return F.lit(None)


def _improves(state: Column, loss: Column, threshold: float) -> Column:
    # Spark holds NaN above all numbers; here it beats nothing, and nothing beats it.
    comparable = ~F.isnan(loss) & ~F.isnan(state["best"])
    return state["best"].isNull() | (
        comparable & (loss < state["best"] - F.lit(float(threshold)))
    )


def _after(state: Column, loss: Column, patience: int, threshold: float) -> Column:
    """State after one more evaluation: best loss, evaluations since, evaluations seen, and the
    number of the one that stopped the run."""
    better = _improves(state, loss, threshold)
    bad = F.when(better, 0).otherwise(state["bad"] + 1)
    seen = state["seen"] + 1
    moved = _state(
        F.when(better, loss).otherwise(state["best"]),
        bad,
        seen,
        F.when(bad >= patience, seen),
    )
    return F.when(state["stop"].isNotNull(), state).otherwise(moved)


def early_stop(
    log: DataFrame,
    run: Sequence[str],
    step: str,
    loss: str,
    patience: int = 5,
    threshold: float = 0.0,
    steps_per_chunk: int = 1 << 16,
) -> DataFrame:
    """``(*run, n_evals, stop_eval, best_loss)``: the evaluation, counted from 1, at which
    ``patience`` evaluations in a row had failed to beat the best loss by more than ``threshold``;
    null if the run goes on to its end. Null losses are skipped. ``(run, step)`` is unique.

    The rule is a fold over the run, but it need not be done in one piece. Entering a chunk of
    steps, the run either stops or improves within the chunk's first ``patience`` evaluations, and
    an improvement forgets what was before. So each chunk is summed up on its own by the outcomes of
    starting afresh at each of those evaluations, in parallel, with at most ``steps_per_chunk`` rows
    in hand; then the short list of summaries is folded per run.
    """
    evals = log.where(F.col(loss).isNotNull()).select(
        *run,
        F.expr(f"`{step}` div {steps_per_chunk}").alias("_chunk"),
        F.struct(
            F.col(step).cast("bigint").alias("step"), F.col(loss).cast("double").alias("loss")
        ).alias("_e"),
    )
    chunks = evals.groupBy(*run, "_chunk").agg(
        F.array_sort(F.collect_list("_e"))["loss"].alias("_losses")
    )

    def restart(losses: Column, at: Column, first_loss: Column) -> Column:
        start = _state(first_loss, F.lit(0), at + 1, _nothing())
        rest = F.slice(losses, at + 2, F.size(losses))
        return F.aggregate(rest, start, lambda s, x: _after(s, x, patience, threshold))

    losses = F.col("_losses")
    head = F.slice(losses, 1, patience)
    summaries = chunks.select(
        *run,
        F.struct(
            F.col("_chunk").alias("chunk"),
            F.size(losses).alias("n"),
            head.alias("head"),
            F.transform(head, lambda x, i: restart(losses, i, x)).alias("outcomes"),
        ).alias("_s"),
    )

    def through(state: Column, chunk: Column) -> Column:
        """State after a whole chunk."""
        walk_type = f"struct<state {_STATE}, jump int>"

        def walk(w: Column, loss: Column, place: Column) -> Column:
            done = w["jump"].isNotNull() | w["state"]["stop"].isNotNull()
            better = _improves(w["state"], loss, threshold)
            jumped = F.struct(w["state"].alias("state"), place.cast("int").alias("jump"))
            moved = F.struct(
                _after(w["state"], loss, patience, threshold).alias("state"),
                w["jump"].alias("jump"),
            )
            return (
                F.when(done, w)
                .when(better, jumped.cast(walk_type))
                .otherwise(moved.cast(walk_type))
            )

        numbered = F.transform(
            chunk["head"], lambda x, i: F.struct(x.alias("loss"), i.alias("place"))
        )
        start = F.struct(state.alias("state"), F.lit(None).cast("int").alias("jump"))
        walked = F.aggregate(
            numbered, start.cast(walk_type), lambda w, x: walk(w, x["loss"], x["place"])
        )

        def leave(w: Column) -> Column:
            outcome = F.get(chunk["outcomes"], w["jump"])
            seen = state["seen"] + chunk["n"]
            afresh = _state(
                outcome["best"], outcome["bad"], seen, state["seen"] + outcome["stop"]
            )
            going_on = _state(w["state"]["best"], w["state"]["bad"], seen, w["state"]["stop"])
            return F.when(w["jump"].isNotNull(), afresh).otherwise(going_on)

        return F.when(state["stop"].isNotNull(), state).otherwise(let(walked, leave))

    runs = summaries.groupBy(*run).agg(
        F.sum("_s.n").alias("n_evals"), F.array_sort(F.collect_list("_s")).alias("_chunks")
    )
    fresh = _state(_nothing(), F.lit(0), F.lit(0), _nothing())
    final = F.aggregate("_chunks", fresh, through)
    return runs.select(*run, "n_evals", final.alias("_f")).select(
        *run,
        "n_evals",
        F.col("_f.stop").alias("stop_eval"),
        F.col("_f.best").alias("best_loss"),
    )
