"""Rows that must not vanish, and requests that must fail rather than give less."""

import pytest
from pyspark.sql import functions as F

from chatprep.functions import chat as ch
from chatprep.operators import examples as ex
from chatprep.operators import packing as pk
from chatprep.operators import ranks, runs, sample, turns, validate
from chatprep.sources import files, scratch

KIND = "array<struct<role string, content string>>"


def test_a_message_without_content_is_rendered(spark):
    df = spark.createDataFrame([([("user", "a"), ("assistant", None)],)], f"m {KIND}")
    text = df.select(ch.render_chat(F.col("m")).alias("t")).first().t
    assert text == "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nNone<|im_end|>\n"
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", None)]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, content string")
    assert "".join(r.text for r in turns.render_turns(df).orderBy("turn").collect()) == text


def test_shares_beyond_the_data_set_fail(spark):
    df = spark.range(10).withColumn("source", F.lit("a"))
    for share in (1.5, -0.1):
        with pytest.raises(ValueError):
            sample.mix_sources(df, {"a": share}, ["id"])
        with pytest.raises(ValueError):
            sample.split_dataset(df, ["id"], val_ratio=share)
    for rows in (11, -1):
        cut = ranks.hash_cut(df, ["id"], lambda n, rows=rows: F.lit(rows).cast("bigint"), 1)
        with pytest.raises(Exception, match="cannot take"):
            cut.collect()


def test_sample_of_an_empty_table_fails(spark):
    empty = spark.range(0)
    with pytest.raises(Exception, match="larger than the data set"):
        sample.sample_n(empty, 5, ["id"]).collect()
    assert sample.sample_n(empty, 0, ["id"]).count() == 0


def test_malformed_metrics_fail(spark):
    rows = [(1, '{"a": 1, "b": true, "c": "x"}'), (2, None), (3, "{}"), (4, "null")]
    df = spark.createDataFrame(rows, "step int, metrics string")
    got = runs.filter_numeric_metrics(df, keep=["step"]).collect()
    assert sorted(map(tuple, got)) == [(1, "a", 1.0), (1, "b", 1.0)]
    for text in ("oops", "", "[1]"):
        bad = spark.createDataFrame([(1, text)], "step int, metrics string")
        with pytest.raises(Exception, match="not a JSON object"):
            runs.filter_numeric_metrics(bad).collect()


def test_entries_of_a_null_run_and_a_long_run_are_timed(spark):
    rows = [(None, 0, 60), (None, 1, 120)] + [("r", i, 600 * i) for i in range(50)]
    df = spark.createDataFrame(rows, "run string, step int, s long")
    df = df.withColumn("ts", F.timestamp_seconds("s"))
    got = {(r.run, r.step): r.training_time_minutes for r in runs.elapsed_minutes(df, ["run"]).collect()}
    assert len(got) == 52 and got[None, 1] == 1.0 and got["r", 49] == 490.0


def test_turns_of_a_null_conversation_and_far_apart_turns(spark):
    start = 1_700_000_000_000
    rows = [
        (None, 0, "user", "q"), (None, 1, "assistant", "a"),
        ("c", start, "user", "x"), ("c", start + 10**12, "assistant", "y"),
    ]
    df = spark.createDataFrame(rows, "conv_id string, turn long, role string, content string")
    pairs = turns.eval_pairs(df)
    assert {(r.conv_id, r.expected_response) for r in pairs.collect()} == {(None, "a"), ("c", "y")}
    prompts = turns.prompt_turns(df, pairs).collect()
    assert {(r.conv_id, r.content) for r in prompts} == {(None, "q"), ("c", "x")}
    sized = turns.eval_pairs_sized(df).collect()
    assert {(r.conv_id, r.expected_response, r.prompt_turns) for r in sized} == {
        (None, "a", 1), ("c", "y", 1),
    }


def test_folder_of_mixed_json_fails(spark, tmp_path):
    (tmp_path / "a.json").write_text('\n [{"a": 1}]')
    (tmp_path / "b.json").write_text('{"a": [5]}')
    with pytest.raises(ValueError, match="others columns"):
        files.read_json(spark, str(tmp_path), "a int")
    assert files.read_json(spark, str(tmp_path / "a.json"), "a int").collect() == [(1,)]


def test_caps_are_asked_for(spark):
    text = "\n".join(f"line {i} has whwh and some more words to be long enough, it is useful" for i in range(30))
    df = spark.createDataFrame([(1, text)], "doc_id int, text string")
    rules = ex.MiningRules(separator="\n", indicators=("whwh",), clean_first=False)
    capped = ex.MiningRules(separator="\n", indicators=("whwh",), clean_first=False, per_document=20)
    assert ex.make_training_examples(df, rules).count() == 30
    assert ex.make_training_examples(df, capped).count() == 20
    cut = df.select(ex.chunks_cut(F.col("text"), capped).alias("n"), ex.chunks_cut(F.col("text"), rules).alias("m"))
    assert tuple(cut.first()) == (10, 0)


def test_head_limit_is_a_filter(spark):
    ids = [-(2**62), -5, 0, 3, 7, 2**40, 2**62]
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(3)
    for n in range(1, 10):
        got = sorted(r.id for r in sample.head_limit(df, n, "id").collect())
        assert got == sorted(ids)[:n]
    text = sample.head_limit(df, 3, "id")._jdf.queryExecution().toString()
    assert "TakeOrdered" not in text and "Limit" not in text


def test_packing_of_sparse_ids(spark):
    ids = [-(2**50), -7, 0, 9, 2**33, 2**48, 2**62]
    df = spark.createDataFrame([(i, 3) for i in ids], "id bigint, n int").repartition(3)
    got = {r.id: r.before for r in pk.running_total(df, "id", "n", 1 << 16).collect()}
    assert got == {i: 3 * k for k, i in enumerate(ids)}


def test_last_answer_mark_is_found_from_the_left(over):
    assert over(["a ##### 5", "b #### 6", "7"], "string", ch.gsm8k_gold) == ["# 5", "6", "7"]


def test_a_first_loss_that_is_not_a_number_stops_the_run(spark):
    losses = [float("nan"), 5.0, 4.0, 3.0]
    df = spark.createDataFrame([("r", i, x) for i, x in enumerate(losses)], "run string, step int, loss double")
    got = runs.early_stop(df, ["run"], "step", "loss", patience=3).first()
    assert got.stop_eval == 4


def test_expected_answers_are_filtered(spark):
    df = spark.createDataFrame([(1, "a"), (2, ""), (3, None)], "id int, expected_response string")
    assert [r.id for r in validate.filter_has_expected(df).collect()] == [1]


def test_scratch_lies_below_the_warehouse_without_a_checkpoint_folder():
    class Conf:
        def get(self, key, default=None):
            return {"spark.sql.warehouse.dir": "hdfs://store/warehouse"}.get(key, default)

    class Session:
        conf = Conf()

    assert scratch.scratch_path(Session(), "x").startswith("hdfs://store/warehouse/_scratch/x-")
