import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from chatprep.operators import runs as rn


def stop_at(losses, patience, threshold):
    """Hop from each best loss to the next better one, if that comes soon enough."""
    evals = [x for x in losses if x is not None]
    at = 0
    while True:
        near = range(at + 1, min(at + 1 + patience, len(evals)))
        better = [j for j in near if evals[j] < evals[at] - threshold]
        if not better:
            return (at + 1 + patience if len(near) == patience else None), evals[at]
        at = better[0]


@pytest.mark.parametrize("chunk", [1, 2, 7, 1000])
@pytest.mark.parametrize("patience, threshold", [(1, 0.0), (3, 0.2), (5, 0.0)])
def test_early_stop(spark, chunk, patience, threshold):
    rng = random.Random(patience)
    histories = [
        [5, 4, 3.95, 3.9, 3.85, 3.0],
        [5, 4, None, 3.95, 3.9, 3.85, 3.0],
        [None, None],
        [1.0],
    ]
    for _ in range(60):
        level, losses = 10.0, []
        for _ in range(rng.randrange(1, 40)):
            level *= rng.choice([0.9, 0.97, 1.0, 1.02])
            losses.append(None if rng.random() < 0.1 else round(level + rng.gauss(0, 0.2), 2))
        histories.append(losses)
    rows = [(r, 3 * s, x if x is None else float(x))
            for r, h in enumerate(histories) for s, x in enumerate(h)]
    log = spark.createDataFrame(rows, "run int, step int, loss double").repartition(5)
    stops = rn.early_stop(log, ["run"], "step", "loss", patience, threshold, steps_per_chunk=chunk)
    got = {r.run: (r.stop_eval, r.best_loss, r.n_evals) for r in stops.collect()}
    expected = {
        r: (*stop_at(h, patience, threshold), sum(x is not None for x in h))
        for r, h in enumerate(histories)
        if any(x is not None for x in h)
    }
    assert got == expected
    if (patience, threshold) == (3, 0.2):
        assert got[0][0] == 5 and got[1][0] == 5


def test_numeric_metrics(spark):
    metrics = {"loss": 0.5, "n": 3, "ok": True, "no": False, "name": "x", "text": "5", "none": None,
               "list": [1], "big": 12345678901234567890, "tiny": 1e-30}
    df = spark.createDataFrame([(7, json.dumps(metrics)), (8, "{}")], "step int, metrics string")
    got = {r.key: r.value for r in rn.filter_numeric_metrics(df, keep=["step"]).collect()}
    assert got == {"loss": 0.5, "n": 3.0, "ok": 1.0, "no": 0.0, "big": 12345678901234567890.0,
                   "tiny": 1e-30}


def test_hparams_and_config(over):
    params = '{"lr":1e-4,"n":3,"p":900.0,"name":"x","on":true,"tags":["a",1],"d":{"k":null},"z":null}'
    assert over([params], "string", rn.flatten_hparams) == [
        {"lr": "1.0E-4", "n": "3", "p": "900.0", "name": "x", "on": "true", "tags": '["a",1]',
         "d": '{"k":null}', "z": "None"}
    ] or over([params], "string", rn.flatten_hparams)[0]["lr"] == "1e-4"
    maps = [({"a": "1", "b": "1"}, {"b": "2"}, {"b": "3", "c": "3"})]
    kind = "struct<a:map<string,string>,b:map<string,string>,c:map<string,string>>"
    got = over(maps, kind, lambda x: rn.merge_maps(x["a"], x["b"], x["c"]))
    assert got == [{"a": "1", "b": "3", "c": "3"}]


def test_training_plan(spark):
    rows = [(100, 2, 8, 2.0, -1), (10, 2, 8, 2.0, -1), (100, 2, 8, 2.0, 50), (100, 3, 4, 1.3, 0)]
    df = spark.createDataFrame(
        rows, "n bigint, per_device int, accumulation int, epochs double, max_steps int"
    )
    got = [
        (r.effective_batch_size, r.steps_per_epoch, r.total_steps, r.epochs_completed)
        for r in rn.training_plan(df.coalesce(1)).collect()
    ]
    assert got == [(16, 6, 12, 2.0), (16, 0, 0, None), (16, 6, 50, 50 / 6), (12, 8, 10, 1.25)]


def test_run_results(spark):
    start = datetime.datetime(2024, 1, 1)
    rows = [
        ("a", 1, start, 3.0, 2.5),
        ("a", 3, start + datetime.timedelta(minutes=3), 1.0, None),
        ("a", 2, start + datetime.timedelta(seconds=30), 2.0, 1.5),
        ("b", 1, start, 5.0, 4.0),
    ]
    log = spark.createDataFrame(
        rows, "run string, step int, ts timestamp, loss double, eval_loss double"
    )
    stats = {r.run: r for r in
             rn.final_stats(log, ["run"], "step", "loss", "eval_loss", "ts").collect()}
    assert stats["a"].total_steps == 3 and stats["a"].training_time == 180.0
    assert stats["a"].training_loss == 2.0 and stats["a"].final_eval_loss is None
    assert stats["b"].final_eval_loss == 4.0
    minutes = {(r.run, r.step): r.training_time_minutes
               for r in rn.elapsed_minutes(log, ["run"]).collect()}
    assert minutes == {("a", 1): 0.0, ("a", 2): 0.5, ("a", 3): 3.0, ("b", 1): 0.0}
    notes = {r.text for r in rn.log_text(log.where("run = 'a'"), ["run"]).collect()}
    assert notes == {"Training started at step 1", "Training completed at step 3"}


def test_numeric_value_of_other_kinds(over):
    got = over(['"x"', "2.5", "true", "null", "[1]"], "string",
               lambda x: rn.numeric_value(F.parse_json(x)))
    assert got == [None, 2.5, 1.0, None, None]
