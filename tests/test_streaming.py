import random
from datetime import datetime, timedelta

import pytest

from chatprep.operators import runs
from chatprep.sources import store
from chatprep.streaming import metrics as st
from chatprep.streaming import stopping

ENTRY = '{"project":"p","experiment":"e","run":"r","step":%d,"metrics":"{\\"loss\\":%d,\\"t\\":\\"x\\"}"}\n'


@pytest.fixture
def entries(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(5):
        (tmp_path / "in" / f"{i}.json").write_text(ENTRY % (i, 10 * i))
    return st.read_log_stream(spark, str(tmp_path / "in"), max_files_per_trigger=2)


def test_stream_appends_new_files_once(spark, tmp_path, entries):
    def run():
        st.stream_metrics(entries, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        return spark.read.parquet(str(tmp_path / "out"))

    assert {(r.step, r.key, r.value) for r in run().collect()} == {
        (i, "loss", 10.0 * i) for i in range(5)
    }
    (tmp_path / "in" / "new.json").write_text(ENTRY % (9, 90))
    assert run().count() == 6


class Broken(st.TableSink):
    def write(self, batch, batch_id):
        raise OSError("disk full")


def test_fanout(spark, tmp_path, entries):
    sinks = {
        "a": st.TableSink(str(tmp_path / "a")),
        "bad": st.TableSink(str(tmp_path / "bad"), "no_such_format"),
        "b": st.TableSink(str(tmp_path / "b"), "orc"),
    }
    st.fanout_sink(entries, sinks, str(tmp_path / "cp")).awaitTermination()
    for name in ("a", "b"):
        stored = st.read_sink(spark, sinks[name], ["step", "value"])
        assert sorted(tuple(r) for r in stored.collect()) == [(i, 10.0 * i) for i in range(5)]
    assert st.fanout_sink(entries, {"bad": sinks["bad"]}, str(tmp_path / "none")) is None


def test_failed_batch_is_retried_without_copies(spark, tmp_path, entries):
    good = st.TableSink(str(tmp_path / "good"))
    bad = Broken(str(tmp_path / "late"))
    checkpoint = str(tmp_path / "cp")
    with pytest.raises(Exception):
        st.fanout_sink(entries, {"late": bad, "good": good}, checkpoint).awaitTermination()
    mended = {"late": st.TableSink(bad.path), "good": good}
    st.fanout_sink(entries, mended, checkpoint).awaitTermination()
    for sink in mended.values():
        assert st.read_sink(spark, sink, ["step"]).count() == 5


def test_compaction_between_two_tries_of_a_batch(spark, tmp_path, entries):
    """One sink has the batch, another one failed; the first is compacted before the retry."""
    good = st.CompactedSink(str(tmp_path / "good"), fan_in=2)
    bad = Broken(str(tmp_path / "late"))
    checkpoint = str(tmp_path / "cp")
    with pytest.raises(Exception):
        st.fanout_sink(entries, {"late": bad, "good": good}, checkpoint).awaitTermination()
    assert good.compact(spark)["upto"] == 0
    mended = {"late": st.TableSink(bad.path), "good": good}
    st.fanout_sink(entries, mended, checkpoint).awaitTermination()
    for sink in mended.values():
        stored = st.read_sink(spark, sink, ["step", "value"])
        assert sorted(tuple(r) for r in stored.collect()) == [(i, 10.0 * i) for i in range(5)]
    assert len(good.paths(spark)) == 3


def test_compacted_folders(spark, tmp_path):
    sink = st.CompactedSink(str(tmp_path / "t"), fan_in=2)
    assert sink.compact(spark) == {"version": 0, "upto": -1, "folders": []}
    for batch in range(6):
        sink.write(spark.range(batch, batch + 1), batch)
        if batch % 2:
            before = sink.paths(spark)
            sink.compact(spark)
            # What a reader of the earlier manifest reads is still there.
            assert spark.read.parquet(*before).count() == batch + 1
    manifest = sink.manifest(spark)
    assert manifest["upto"] == 5 and [level for _, level in manifest["folders"]] == [1, 0]
    sink.write(spark.range(6, 7), 6)
    sink.write(spark.range(99, 100), 5)
    # A batch of which a part is missing is not taken yet, nor those behind it.
    (tmp_path / "t" / "batch_id=8").mkdir()
    sink.clean(spark)
    names = {p.name for p in (tmp_path / "t").iterdir()}
    assert "batch_id=5" not in names and {"batch_id=6", "batch_id=8"} <= names
    assert sorted(r.id for r in st.read_sink(spark, sink, ["id"]).collect()) == list(range(7))


def test_a_published_file_is_not_replaced(spark, tmp_path):
    store.publish(spark, str(tmp_path / "1.json"), "é")
    assert store.read_text(spark, str(tmp_path / "1.json")) == "é"
    with pytest.raises(FileExistsError):
        store.publish(spark, str(tmp_path / "1.json"), "b")
    assert store.names(spark, str(tmp_path / "none")) == []


def _evaluations():
    rng = random.Random(9)
    rows = []
    for run in ("a", "b", None):
        for step in range(40):
            loss = rng.choice([None, float("nan")]) if rng.random() < 0.1 else 100 / (step + 5) + rng.random() * 20
            rows.append((run, step, loss, datetime(2024, 1, 1) + timedelta(minutes=step)))
    return rows


def test_verdicts_of_a_stream_equal_those_of_the_table(spark, tmp_path):
    """Evaluations arrive in several triggers, some out of order, with a restart in between."""
    kind = "run string, step int, loss double, ts timestamp"
    rows = _evaluations()
    source, sink = str(tmp_path / "in"), st.TableSink(str(tmp_path / "out"))

    def arrive(chosen):
        spark.createDataFrame(chosen, kind).coalesce(1).write.mode("append").parquet(source)

    def work():
        log = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(source)
        verdicts = stopping.early_stop_stream(log, ["run"], "step", "loss", "ts", "10 minutes", 3, 0.5)
        stopping.write_verdicts(verdicts, sink, str(tmp_path / "cp")).awaitTermination()
        got = stopping.latest_verdicts(spark, sink, ["run"]).collect()
        return {r.run: (r.n_evals, r.stop_eval, r.best_loss) for r in got}

    def whole(chosen):
        log = spark.createDataFrame(chosen, kind)
        found = runs.early_stop(log, ["run"], "step", "loss", 3, 0.5).collect()
        return {r.run: (r.n_evals, r.stop_eval, r.best_loss) for r in found}

    # Steps 7 and 8 come after 9 to 14.
    early = [r for r in rows if r[1] < 7 or 9 <= r[1] < 15]
    late = [r for r in rows if 7 <= r[1] < 9]
    arrive(early)
    assert _known(work()) == _known(whole(early))
    arrive(late)
    assert _known(work()) == _known(whole(early + late))
    arrive([r for r in rows if 15 <= r[1] < 27])
    arrive([r for r in rows if r[1] >= 27])
    assert _known(work()) == _known(whole(rows))
    assert len(whole(rows)) == 3


def _known(verdicts):
    return {run: tuple(map(str, verdict)) for run, verdict in verdicts.items()}
