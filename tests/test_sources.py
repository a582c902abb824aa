import json

import pytest
from pyspark.sql import functions as F

from chatprep.schema import ALPACA
from chatprep.sources import files
from chatprep.sources.scratch import scratch_path


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_jsonl(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text('{"messages":[{"role":"user","content":"é\\n"}]}\n')
    assert files.read_chat(spark, str(path)).first().messages[0].content == "é\n"
    path.write_text('{"a":1}\nbroken\n')
    with pytest.raises(Exception):
        files.read_jsonl(spark, str(path), "a int").collect()


def test_jsonl_keeps_nulls(spark, tmp_path):
    out = str(tmp_path / "out.jsonl")
    files.write_jsonl(spark.createDataFrame([(1, None)], "a int, b string"), out)
    assert [r.value for r in files.read_lines(spark, out).collect()] == ['{"a":1,"b":null}']


def test_csv(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('user_prompt,agent_reply\n" say ""hi"",\nnow ",NA\n,x\n')
    assert rows(files.read_csv(spark, str(path)).fillna("<null>")) == [
        (' say "hi",\nnow ', "<null>"), ("<null>", "x"),
    ]
    out = str(tmp_path / "chat.jsonl")
    files.csv_to_jsonl(spark, str(path), out)
    got = [[m.content for m in r.messages[1:]] for r in files.read_chat(spark, out).collect()]
    assert sorted(got) == [["nan", "x"], ['say "hi",\nnow', "nan"]]


def test_json_forms(spark, tmp_path):
    records = [{"a": 1, "b": ["x"]}, {"a": 2, "b": []}]
    (tmp_path / "list.json").write_text(" \n" + json.dumps(records, indent=2))
    (tmp_path / "dict.json").write_text('{\n "a": [1, 2],\n "b": [["x"], []]\n}')
    (tmp_path / "one.json").write_text("3")
    (tmp_path / "uneven.json").write_text('{"a": [1], "b": [1, 2]}')
    expected = [(1, ["x"]), (2, [])]
    assert rows(files.read_json(spark, str(tmp_path / "list.json"))) == expected
    assert rows(files.read_json(spark, str(tmp_path / "dict.json"))) == expected
    with pytest.raises(ValueError, match="neither an array"):
        files.read_json(spark, str(tmp_path / "one.json"))
    with pytest.raises(Exception, match="different lengths"):
        files.read_json(spark, str(tmp_path / "uneven.json")).collect()
    with pytest.raises(ValueError, match="not an array of records"):
        files.json_to_jsonl(spark, str(tmp_path / "dict.json"), str(tmp_path / "x.jsonl"))
    files.json_to_jsonl(spark, str(tmp_path / "list.json"), str(tmp_path / "y.jsonl"))
    assert files.read_jsonl(spark, str(tmp_path / "y.jsonl")).count() == 2


def test_chat_lists_stay_records(spark, tmp_path):
    chat = [{"messages": [{"role": "user", "content": "a"}] * 2}]
    (tmp_path / "chat.json").write_text(json.dumps(chat))
    assert files.load_data(spark, str(tmp_path / "chat.json")).count() == 1


def test_load_data_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.load_data(spark, str(tmp_path / "none.jsonl"))
    (tmp_path / "a.xml").write_text("<a/>")
    with pytest.raises(ValueError, match="no reader for '.xml'"):
        files.load_data(spark, str(tmp_path / "a.xml"))
    with pytest.raises(ValueError, match="unknown data set"):
        files.load_named_dataset(spark, {}, "x")


def test_alpaca_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"instruction":" i ","output":"o"},{"instruction":"j","input":"k"}]')
    files.alpaca_to_jsonl(spark, str(tmp_path / "a.json"), str(tmp_path / "a.out"))
    got = [[m.content for m in r.messages[1:]]
           for r in files.read_chat(spark, str(tmp_path / "a.out")).collect()]
    assert sorted(got) == [[" i ", "o"], ["j\nk", ""]]
    with pytest.raises(ValueError, match="instruction records"):
        files.alpaca_to_jsonl(spark, str(tmp_path / "a.csv"), "x")
    assert ALPACA.fieldNames() == ["instruction", "input", "output"]


def test_write_split(spark, tmp_path):
    df = spark.range(10).withColumn("split", F.when(F.col("id") < 7, "train").otherwise("validation"))
    files.write_split(df, str(tmp_path / "t"), str(tmp_path / "v"))
    assert spark.read.json(str(tmp_path / "t")).count() == 7
    assert spark.read.json(str(tmp_path / "v")).columns == ["id"]


def test_scratch_is_below_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(base) and first != second


def test_rows_are_replaced_by_key(spark, tmp_path):
    path = str(tmp_path / "runs")
    kind = "run string, key string, text string"
    first = spark.createDataFrame([("a", "k", "1"), ("a", "k", "2"), (None, "k", "3"), ("b", "l", "4")], kind)
    for _ in range(2):
        files.replace_rows(first, path, ["run", "key"], buckets=3)
        assert rows(files.read_rows(spark, path).fillna("-")) == [
            ("-", "k", "3"), ("a", "k", "1"), ("a", "k", "2"), ("b", "l", "4"),
        ]
    later = spark.createDataFrame([("a", "k", "5", 1), (None, "k", "6", None)], kind + ", n int")
    files.replace_rows(later, path, ["run", "key"], buckets=3)
    got = files.read_rows(spark, path).select("run", "text", "n").fillna("-").fillna(0)
    assert rows(got) == [("-", "6", 0), ("a", "5", 1), ("b", "4", 0)]
