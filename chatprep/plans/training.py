"""Queries: run metrics and configurations."""

from __future__ import annotations

from pyspark.sql import functions as F

from chatprep.operators import runs as rn
from chatprep.plans import inputs, sql
from chatprep.plans.registry import query
from chatprep.sources import files
from chatprep.sources.files import write_jsonl
from chatprep.sources.scratch import scratch_path
from chatprep.streaming import metrics as st
from chatprep.streaming import stopping as ss

_LOG = """log AS (
  SELECT 'shop' AS project, event_type AS experiment, user_id::VARCHAR AS run, event_id AS step,
    unnest(['loss', 'k', 'failed']) AS key,
    unnest([value, (props->>'$.k')::DOUBLE, (event_type = 'error')::INTEGER::DOUBLE]) AS value
  FROM events)"""


@query("log_metrics", f"WITH {_LOG} SELECT * FROM log")
def log_metrics(spark, sf_dir):
    return rn.log_metrics(inputs.log_entries(spark, sf_dir))


@query("log_metrics_stream", f"WITH {_LOG} SELECT * FROM log")
def log_metrics_stream(spark, sf_dir):
    """The same log by a stream over files of entries."""
    base = scratch_path(spark, "metric-stream")
    write_jsonl(inputs.log_entries(spark, sf_dir), f"{base}/in")
    entries = st.read_log_stream(spark, f"{base}/in", max_files_per_trigger=2)
    st.stream_metrics(entries, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/out")


@query(
    "fanout_sink",
    f"""WITH {_LOG} SELECT sink, log.* FROM log
JOIN (VALUES ('columns'), ('rows')) AS sinks(sink) ON true""",
)
def fanout_sink(spark, sf_dir):
    """Two sinks get every entry; a third, whose format does not exist, cannot be opened."""
    base = scratch_path(spark, "fanout")
    write_jsonl(inputs.log_entries(spark, sf_dir), f"{base}/in")
    sinks = {
        "columns": st.TableSink(f"{base}/columns", "parquet"),
        "broken": st.TableSink(f"{base}/broken", "no_such_format"),
        "rows": st.TableSink(f"{base}/rows", "orc"),
    }
    entries = st.read_log_stream(spark, f"{base}/in", max_files_per_trigger=2)
    st.fanout_sink(entries, sinks, f"{base}/checkpoint").awaitTermination()
    names = ("project", "experiment", "run", "step", "key", "value")
    parts = [
        st.read_sink(spark, sinks[name], names).withColumn("sink", F.lit(name))
        for name in ("columns", "rows")
    ]
    return parts[0].unionByName(parts[1])


@query("fanout_compacted", f"WITH {_LOG} SELECT log.* FROM log")
def fanout_compacted(spark, sf_dir):
    """Batches of a stream, of which the first ones are compacted before the others arrive."""
    base = scratch_path(spark, "compacted")
    entries = inputs.log_entries(spark, sf_dir)
    early = F.col("step") % 2 == 0
    sink = st.CompactedSink(f"{base}/table", fan_in=2)
    for part in (entries.where(early), entries.where(~early)):
        part.write.mode("append").option("ignoreNullFields", False).json(f"{base}/in")
        arriving = st.read_log_stream(spark, f"{base}/in", max_files_per_trigger=1)
        st.fanout_sink(arriving, {"table": sink}, f"{base}/checkpoint").awaitTermination()
        if not sink.manifest(spark)["version"]:
            sink.compact(spark)
    return st.read_sink(spark, sink, ("project", "experiment", "run", "step", "key", "value"))


@query(
    "log_text",
    """WITH ends AS (SELECT user_id::VARCHAR AS run, event_type AS experiment,
  min(event_id) AS a, max(event_id) AS z FROM events GROUP BY ALL)
SELECT 'shop' AS project, experiment, run, 'training_log' AS key,
  unnest(['Training started at step ' || a, 'Training completed at step ' || z]) AS text
FROM ends""",
)
def log_text(spark, sf_dir):
    return rn.log_text(inputs.log_entries(spark, sf_dir))


@query(
    "log_text_table",
    """WITH ends AS (SELECT user_id::VARCHAR AS run, event_type AS experiment,
  min(event_id) AS a, max(event_id) AS z FROM events GROUP BY ALL)
SELECT 'shop' AS project, experiment, run, 'training_log' AS key,
  unnest(['Training started at step ' || a, 'Training completed at step ' || z]) AS text
FROM ends
UNION ALL SELECT DISTINCT 'shop', event_type, user_id::VARCHAR, 'status', 'archived' FROM events""",
)
def log_text_table(spark, sf_dir):
    """Notes put into a table in two goes, of which the first is repeated, and read back."""
    path = scratch_path(spark, "notes")
    notes = rn.log_text(inputs.log_entries(spark, sf_dir))
    files.append_notes(notes, path)
    files.append_notes(notes, path)
    runs = notes.select(*rn.RUN_ID).distinct()
    archived = runs.withColumns({"key": F.lit("status"), "text": F.lit("archived")})
    files.append_notes(archived, path)
    return files.read_rows(spark, path)


@query(
    "closing_entries",
    f"""WITH {sql.RUN_LOG}, ends AS (SELECT run, max(step) AS step,
    date_diff('microsecond', min(ts), max(ts)) / 60000000::DOUBLE AS minutes
  FROM run_log GROUP BY run)
SELECT run, step, unnest(['total_training_time_minutes', 'final_global_step']) AS key,
  unnest([minutes, step::DOUBLE]) AS value FROM ends""",
)
def closing_entries(spark, sf_dir):
    return rn.closing_entries(inputs.run_log(spark, sf_dir), ["run"])


@query(
    "flatten_hparams",
    """SELECT p_partkey, p_size::VARCHAR AS size, p_retailprice::VARCHAR AS price, p_name AS name,
  to_json([p_brand, p_type])::VARCHAR AS tags, 'None' AS extra, (p_size > 25)::VARCHAR AS large
FROM part""",
)
def flatten_hparams(spark, sf_dir):
    """Parts as configurations."""
    params = F.to_json(
        F.struct(
            F.col("p_size").alias("size"),
            F.col("p_retailprice").alias("price"),
            F.col("p_name").alias("name"),
            F.array("p_brand", "p_type").alias("tags"),
            F.lit(None).cast("string").alias("extra"),
            (F.col("p_size") > 25).alias("large"),
        ),
        {"ignoreNullFields": "false"},
    )
    names = ("size", "price", "name", "tags", "extra", "large")
    parts = inputs.table(spark, sf_dir, "part")
    flat = parts.select("p_partkey", rn.flatten_hparams(params).alias("m"))
    return flat.select("p_partkey", *[F.try_element_at("m", F.lit(n)).alias(n) for n in names])


@query(
    "merge_run_config",
    """SELECT p_partkey, CASE WHEN p_size > 25 THEN 'rank-' || p_size ELSE p_type END AS name,
  p_size::VARCHAR AS batch, p_retailprice::DECIMAL(18,2)::VARCHAR AS max_length,
  CASE WHEN p_size > 25 THEN 5 ELSE 4 END::INTEGER AS n_keys FROM
  (SELECT *, CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS big FROM part)""",
)
def merge_run_config(spark, sf_dir):
    """Parts as runs: training, model and adapter settings that share the key ``name``."""
    size = F.col("p_size").cast("string")
    price = F.col("p_retailprice").cast("decimal(18,2)").cast("string")
    training = F.create_map(F.lit("batch"), size, F.lit("name"), F.col("p_brand"),
                            F.lit("brand"), F.col("p_brand"))
    model = F.create_map(F.lit("name"), F.col("p_type"), F.lit("max_length"), price)
    adapter = F.map_filter(
        F.create_map(F.lit("name"), F.concat(F.lit("rank-"), size), F.lit("rank"), size),
        lambda _k, _v: F.col("p_size") > 25,
    )
    merged = rn.merge_maps(training, model, adapter)
    parts = inputs.table(spark, sf_dir, "part").select("p_partkey", merged.alias("m"))
    return parts.select(
        "p_partkey",
        *[F.try_element_at("m", F.lit(k)).alias(k) for k in ("name", "batch", "max_length")],
        F.size("m").alias("n_keys"),
    )


@query(
    "elapsed_minutes",
    f"""WITH {sql.RUN_LOG} SELECT run, step, date_diff('microsecond',
  min(ts) OVER (PARTITION BY run), ts) / 60000000::DOUBLE AS training_time_minutes
FROM run_log""",
)
def elapsed_minutes(spark, sf_dir):
    log = rn.elapsed_minutes(inputs.run_log(spark, sf_dir), ["run"])
    return log.select("run", "step", "training_time_minutes")


def _early_stop_sql(patience: int, threshold: float) -> str:
    return f"""WITH RECURSIVE {sql.RUN_LOG}, evals AS (
  SELECT run, eval_loss AS loss, row_number() OVER (PARTITION BY run ORDER BY step) AS rn
  FROM run_log WHERE eval_loss IS NOT NULL),
fold AS (
  SELECT run, rn, loss AS best, 0 AS bad FROM evals WHERE rn = 1
  UNION ALL
  SELECT f.run, e.rn,
    CASE WHEN e.loss < f.best - {threshold}::DOUBLE THEN e.loss ELSE f.best END,
    CASE WHEN e.loss < f.best - {threshold}::DOUBLE THEN 0 ELSE f.bad + 1 END
  FROM fold f JOIN evals e ON e.run = f.run AND e.rn = f.rn + 1 WHERE f.bad < {patience})
SELECT run, (SELECT count(*) FROM evals e WHERE e.run = f.run) AS n_evals,
  max(CASE WHEN bad >= {patience} THEN rn END) AS stop_eval, min(best) AS best_loss
FROM fold f GROUP BY run"""


@query("early_stop", _early_stop_sql(3, 20.0))
def early_stop(spark, sf_dir):
    log = inputs.run_log(spark, sf_dir)
    return rn.early_stop(log, ["run"], "step", "eval_loss", patience=3, threshold=20.0)


@query("early_stop_default", _early_stop_sql(5, 0.0))
def early_stop_default(spark, sf_dir):
    """Default rule; short chunks, so that runs span many of them."""
    log = inputs.run_log(spark, sf_dir)
    return rn.early_stop(log, ["run"], "step", "eval_loss", steps_per_chunk=512)


@query("early_stop_stream", _early_stop_sql(3, 20.0))
def early_stop_stream(spark, sf_dir):
    """The evaluations arrive in files, a few per trigger; the last verdict of each run counts."""
    base = scratch_path(spark, "evaluations")
    log = inputs.run_log(spark, sf_dir)
    log.repartitionByRange(6, "step").write.parquet(f"{base}/in")
    arriving = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 2)
    verdicts = ss.early_stop_stream(
        arriving.parquet(f"{base}/in"), ["run"], "step", "eval_loss", "ts", "30 days", 3, 20.0
    )
    sink = st.TableSink(f"{base}/verdicts")
    ss.write_verdicts(verdicts, sink, f"{base}/checkpoint").awaitTermination()
    return ss.latest_verdicts(spark, sink, ["run"])


_STATS = f"""{sql.RUN_LOG}, last AS (
  SELECT run, eval_loss, row_number() OVER (PARTITION BY run ORDER BY step DESC) AS rn
  FROM run_log),
stats AS (SELECT run_log.run, max(step) AS total_steps,
    round(date_diff('microsecond', min(ts), max(ts)) / 1000000::DOUBLE, 6) AS training_time,
    round(avg(loss), 6) AS training_loss, max(last.eval_loss) AS final_eval_loss
  FROM run_log JOIN last ON last.run = run_log.run AND last.rn = 1 GROUP BY run_log.run)"""


def _final_stats(spark, sf_dir):
    stats = rn.final_stats(
        inputs.run_log(spark, sf_dir), ["run"], "step", "loss", "eval_loss", "ts"
    )
    return stats.withColumns(
        {c: F.round(c, 6) for c in ("training_time", "training_loss")}
    )


@query("final_stats", f"WITH {_STATS} SELECT * FROM stats")
def final_stats(spark, sf_dir):
    return _final_stats(spark, sf_dir)


@query(
    "write_run_stats",
    f"WITH {_STATS} SELECT *, 2 * run AS batch_size FROM stats",
)
def write_run_stats(spark, sf_dir):
    """Statistics and configuration of finished runs in two goes; the second has all runs, so it
    replaces those of the first."""
    path = scratch_path(spark, "runs")
    rows = _final_stats(spark, sf_dir).withColumn("batch_size", 2 * F.col("run"))
    files.write_run_stats(rows.where("final_eval_loss IS NULL"), path, ["run"])
    files.write_run_stats(rows, path, ["run"])
    return files.read_rows(spark, path)


_PLAN = """SELECT source, n, (per_device * accumulation)::BIGINT AS effective_batch_size,
  n // (per_device * accumulation) AS steps_per_epoch,
  CASE WHEN max_steps > 0 THEN max_steps
    ELSE floor(n // (per_device * accumulation) * 2.5::DOUBLE)::BIGINT END::BIGINT AS total_steps,
  round(CASE WHEN max_steps > 0 THEN max_steps
    ELSE floor(n // (per_device * accumulation) * 2.5::DOUBLE) END
    / nullif(n // (per_device * accumulation), 0)::DOUBLE, 6) AS epochs_completed
FROM (SELECT source, count(*) AS n, 2 AS per_device,
    CASE WHEN source < 'src15' THEN 3 ELSE 40 END AS accumulation,
    CASE WHEN source > 'src5' THEN 100 ELSE 0 END AS max_steps FROM documents GROUP BY source)"""


@query("training_plan", _PLAN)
def training_plan(spark, sf_dir):
    """Document sources as data sets; some are too small for a full batch."""
    counts = inputs.table(spark, sf_dir, "documents").groupBy("source").agg(
        F.count(F.lit(1)).alias("n")
    )
    settings = {
        "per_device": F.lit(2),
        "accumulation": F.when(F.col("source") < "src15", 3).otherwise(40),
        "epochs": F.lit(2.5),
        "max_steps": F.when(F.col("source") > "src5", 100).otherwise(0),
    }
    plan = rn.training_plan(counts.withColumns(settings))
    return plan.select(
        "source",
        "n",
        "effective_batch_size",
        "steps_per_epoch",
        "total_steps",
        F.round("epochs_completed", 6).alias("epochs_completed"),
    )
