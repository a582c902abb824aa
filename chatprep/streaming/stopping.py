"""Early stopping decided while evaluations arrive."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from chatprep.streaming.metrics import TableSink

#: State with a map needs this store.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_VERDICT = "n_evals bigint, stop_eval bigint, best_loss double"


class _Rule(StatefulProcessor):
    """The fold of one run.

    Evaluations that the watermark has passed are folded into a few numbers, by step; a timer at the
    time of each tells when. Later ones wait by step, since an earlier step may still arrive, so
    what is kept of a run is bounded by the watermark's delay. The verdict that is put out counts
    both: it is the one of all evaluations that have arrived.
    """

    def __init__(self, run: Sequence[str], patience: int, threshold: float):
        self.patience, self.threshold = patience, threshold
        self.verdict = Row(*run, "n_evals", "stop_eval", "best_loss")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.folded = handle.getValueState("folded", "best double, bad int, n bigint, stop bigint")
        self.waiting = handle.getMapState("waiting", "step bigint", "loss double, due bigint")

    def _after(self, state: tuple, loss: float) -> tuple:
        best, bad, n, stop = state
        if stop is not None:
            return best, bad, n + 1, stop
        # A NaN beats nothing, and nothing beats it.
        comparable = best is not None and not math.isnan(loss) and not math.isnan(best)
        if best is None or (comparable and loss < best - self.threshold):
            best, bad = loss, 0
        else:
            bad += 1
        return best, bad, n + 1, n + 1 if bad >= self.patience else None

    def _state(self) -> tuple:
        return tuple(self.folded.get()) if self.folded.exists() else (None, 0, 0, None)

    def _in_order(self) -> list[tuple[int, float, int]]:
        return sorted((key[0], value[0], value[1]) for key, value in self.waiting.iterator())

    def handleInputRows(self, key, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        for row in rows:
            self.waiting.updateValue((row.step,), (row.loss, row.due))
            self.handle.registerTimer(row.due)
        state = self._state()
        for _, loss, _ in self._in_order():
            state = self._after(state, loss)
        best, _, n, stop = state
        yield self.verdict(*key, n, stop, best)

    def handleExpiredTimer(
        self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo
    ) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs()
        state = self._state()
        for step, loss, due in self._in_order():
            if due > passed:
                break
            state = self._after(state, loss)
            self.waiting.removeKey((step,))
        self.folded.update(state)
        yield from ()

    def close(self) -> None:
        pass


def early_stop_stream(
    log: DataFrame,
    run: Sequence[str],
    step: str,
    loss: str,
    ts: str,
    delay: str = "1 hour",
    patience: int = 5,
    threshold: float = 0.0,
) -> DataFrame:
    """``(*run, n_evals, stop_eval, best_loss)`` of a stream of evaluations: a run's row is put out
    again whenever evaluations of it arrive, and is what ``operators.runs.early_stop`` gives for
    those that are there by then.

    Evaluations of a run may arrive in any order within ``delay`` of the latest time seen; later ones
    are dropped, as watermarks have it. Null losses are skipped; ``(run, step)`` is unique, and an
    evaluation that is sent again replaces itself. Runs are spread over the tasks; a run is one key.
    """
    evals = (
        log.where(F.col(loss).isNotNull())
        .select(
            *run,
            F.col(step).cast("bigint").alias("step"),
            F.col(loss).cast("double").alias("loss"),
            F.col(ts).cast("timestamp").alias("ts"),
        )
        .withColumn("due", F.unix_millis("ts"))
        .withWatermark("ts", delay)
    )
    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in evals.select(*run).schema)
    return evals.groupBy(*run).transformWithState(
        _Rule(run, patience, threshold), f"{names}, {_VERDICT}", "update", "eventTime"
    )


def write_verdicts(verdicts: DataFrame, sink: TableSink, checkpoint: str, **trigger) -> StreamingQuery:
    """Write what each trigger puts out to a folder of its own, which a retry replaces. Works off what
    is there and stops, unless another trigger is given."""
    spark = verdicts.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return (
        verdicts.writeStream.foreachBatch(sink.write)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def latest_verdicts(spark: SparkSession, sink: TableSink, run: Sequence[str]) -> DataFrame:
    """The last verdict of each run."""
    stored = spark.read.option("basePath", sink.path).format(sink.format).load(sink.path)
    last = F.max_by(F.struct("n_evals", "stop_eval", "best_loss"), "batch_id").alias("last")
    return stored.groupBy(*run).agg(last).select(*run, "last.*")
