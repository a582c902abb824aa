"""Metric logs that arrive as files of JSON lines, turned into tables as they come.

The batch projections of ``operators.runs`` apply unchanged: they keep no state, so no watermark is
needed and late entries are as welcome as others.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from chatprep.operators.runs import RUN_ID, log_metrics
from chatprep.sources import store

logger = logging.getLogger(__name__)

LOG_ENTRY = StructType(
    [StructField(name, StringType()) for name in RUN_ID]
    + [StructField("step", LongType()), StructField("metrics", StringType())]
)


def read_log_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int = 1000
) -> DataFrame:
    return (
        spark.readStream.schema(LOG_ENTRY)
        .option("mode", "FAILFAST")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .json(path)
    )


def stream_metrics(
    entries: DataFrame, output_path: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Append the numeric entries to a Parquet table; each is written exactly once.

    Works off what is there and stops, unless another trigger is given, such as
    ``processingTime="1 minute"``.
    """
    return (
        log_metrics(entries)
        .writeStream.format("parquet")
        .option("path", output_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


@dataclass(frozen=True)
class TableSink:
    """A table written batch by batch. Writing a batch again replaces it, so that a batch that is
    retried after a failure leaves no second copy."""

    path: str
    format: str = "parquet"

    def open(self, spark: SparkSession) -> None:
        """Fail early where the place cannot be written. Readers skip names with an underscore."""
        ready = spark.range(0)
        ready.write.mode("overwrite").format(self.format).save(f"{self.path}/_ready")

    def write(self, batch: DataFrame, batch_id: int) -> None:
        target = f"{self.path}/batch_id={batch_id}"
        batch.write.mode("overwrite").format(self.format).save(target)


@dataclass(frozen=True)
class CompactedSink(TableSink):
    """A table of batches that can be put together into larger folders while it is written and read.

    A manifest names the folders that count; batches up to its ``upto`` are in ``compacted`` folders,
    later ones in their own. Each compaction writes a new folder first and then publishes a new
    manifest, by one rename, so that readers see either all of it or nothing. A batch that is retried
    after it was compacted is not written again: a retry has the same rows. Compactions of one sink
    run one after the other.
    """

    fan_in: int = 8

    def manifest(self, spark: SparkSession) -> dict:
        """The last published one: ``version``, ``upto``, and ``folders`` as ``[name, level]``."""
        versions = [
            int(name.removesuffix(".json"))
            for name in store.names(spark, f"{self.path}/_manifests")
            if name.endswith(".json")
        ]
        if not versions:
            return {"version": 0, "upto": -1, "folders": []}
        return json.loads(store.read_text(spark, f"{self.path}/_manifests/{max(versions)}.json"))

    def write(self, batch: DataFrame, batch_id: int) -> None:
        if batch_id > self.manifest(batch.sparkSession)["upto"]:
            super().write(batch, batch_id)

    def _finished(self, spark: SparkSession, after: int) -> list[int]:
        """The batches from ``after`` on, up to the first that is not there whole."""
        found = []
        while store.exists(spark, f"{self.path}/batch_id={after + len(found) + 1}/_SUCCESS"):
            found.append(after + len(found) + 1)
        return found

    def compact(self, spark: SparkSession) -> dict:
        """Put the finished batches into one folder, together with earlier folders of their level once
        there are ``fan_in`` of it; so a row is rewritten a logarithmic number of times. Gives the
        manifest that counts from now on."""
        old = self.manifest(spark)
        batches = self._finished(spark, old["upto"])
        if not batches:
            return old
        parts = [f"{self.path}/batch_id={b}" for b in batches]
        folders, level = list(old["folders"]), 0
        while [x for _, x in folders[1 - self.fan_in :]] == [level] * (self.fan_in - 1):
            parts += [f"{self.path}/{name}" for name, _ in folders[1 - self.fan_in :]]
            folders = folders[: 1 - self.fan_in]
            level += 1
        version = old["version"] + 1
        name = f"_compacted/{version}"
        rows = spark.read.format(self.format).load(parts)
        # As many files as the rows need; one that a failed compaction left is written over.
        rows.hint("rebalance").write.mode("overwrite").format(self.format).save(f"{self.path}/{name}")
        new = {"version": version, "upto": batches[-1], "folders": [*folders, [name, level]]}
        store.publish(spark, f"{self.path}/_manifests/{version}.json", json.dumps(new))
        return new

    def clean(self, spark: SparkSession) -> None:
        """Remove what the manifest no longer names, once no reader of an earlier one is left."""
        now = self.manifest(spark)
        named = {name for name, _ in now["folders"]}
        for version in store.names(spark, f"{self.path}/_compacted"):
            if int(version) <= now["version"] and f"_compacted/{version}" not in named:
                store.remove(spark, f"{self.path}/_compacted/{version}")
        for name in store.names(spark, self.path):
            if name.startswith("batch_id=") and int(name.removeprefix("batch_id=")) <= now["upto"]:
                store.remove(spark, f"{self.path}/{name}")

    def paths(self, spark: SparkSession) -> list[str]:
        """The folders that count, named by the manifest or finished after it."""
        now = self.manifest(spark)
        later = self._finished(spark, now["upto"])
        return [f"{self.path}/{name}" for name, _ in now["folders"]] + [
            f"{self.path}/batch_id={b}" for b in later
        ]


def open_sinks(spark: SparkSession, sinks: Mapping[str, TableSink]) -> dict[str, TableSink]:
    """The sinks that could be opened; one that fails does not stop the others."""
    opened = {}
    for name, sink in sinks.items():
        try:
            sink.open(spark)
        except Exception:
            logger.exception("sink %s could not be opened", name)
        else:
            opened[name] = sink
    return opened


def write_to_all(batch: DataFrame, batch_id: int, sinks: Mapping[str, TableSink]) -> None:
    """Write one batch to every sink. All are tried; then a failure of any is raised, so that the
    stream retries the batch instead of losing it in that sink."""
    failed = []
    batch.persist()
    try:
        for name, sink in sinks.items():
            try:
                sink.write(batch, batch_id)
            except Exception as error:
                logger.exception("sink %s failed in batch %s", name, batch_id)
                failed.append((name, error))
    finally:
        batch.unpersist()
    if failed:
        names = ", ".join(name for name, _ in failed)
        raise RuntimeError(f"batch {batch_id} not written to: {names}") from failed[0][1]


def fanout_sink(
    entries: DataFrame, sinks: Mapping[str, TableSink], checkpoint: str, **trigger
) -> StreamingQuery | None:
    """Send each metric entry to all sinks that can be opened; None if there is none. Triggers as
    for ``stream_metrics``."""
    opened = open_sinks(entries.sparkSession, sinks)
    if not opened:
        return None
    return (
        log_metrics(entries)
        .writeStream.foreachBatch(lambda batch, batch_id: write_to_all(batch, batch_id, opened))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_sink(spark: SparkSession, sink: TableSink, columns: Sequence[str]) -> DataFrame:
    if isinstance(sink, CompactedSink):
        stored = spark.read.format(sink.format).load(sink.paths(spark))
    else:
        stored = spark.read.option("basePath", sink.path).format(sink.format).load(sink.path)
    return stored.select(*[F.col(c) for c in columns])
