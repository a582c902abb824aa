"""Files cut into blocks of a few bytes give the rows that reading them whole gives."""

import csv
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chatprep.operators import validate
from chatprep.sources import files, pieces

CELL = ['x', '"', '""', '\n', ',', ' ', 'é', '\r\n', 'long text ' * 3, '', "'", '\\', '}', '{', '[', ']']


@pytest.fixture
def small_blocks(spark):
    """Blocks of ``size`` bytes; Spark sees eight cores, so small files are cut too."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}

    def cut(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")

    yield cut
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("size", [60, 100_000])
def test_line_numbers(spark, tmp_path, small_blocks, size):
    rng = random.Random(size)
    expected = set()
    for name in ("a", "b", "c"):
        lines = [f"{name} {i} " + "x" * rng.randrange(30) for i in range(rng.randrange(1, 120))]
        lines[rng.randrange(len(lines))] = ""
        (tmp_path / f"{name}.txt").write_bytes("\n".join(lines).encode() + b"\n")
        expected |= {(name, i, line) for i, line in enumerate(lines, 1)}
    small_blocks(size)
    found = pieces.numbered_lines(spark, str(tmp_path))
    got = {(r.file[-5], r.line, r.value) for r in found.collect()}
    assert got == expected
    blocks = pieces.read_pieces(spark, str(tmp_path)).groupBy("file").agg(F.countDistinct("block").alias("n"))
    assert size > 99_999 or max(r.n for r in blocks.collect()) > 3


def test_violations_are_found_by_file_and_line(spark, tmp_path, small_blocks):
    good = '{"messages":[{"role":"user","content":"a"}]}'
    (tmp_path / "a.jsonl").write_text("\n".join([good] * 40 + ["oops"] + [good] * 9 + [""]))
    (tmp_path / "b.jsonl").write_text(good + '\r\n{"messages":[{"role":"user","content":"a"},{"role":"bot","content":""}]}\n')
    small_blocks(200)
    found = validate.validate_chat_files(pieces.numbered_lines(spark, str(tmp_path)))
    got = {(r.file[-7:], r.line, r.msg_idx, r.reason) for r in found.collect()}
    assert got == {("a.jsonl", 41, None, "parse_error"), ("b.jsonl", 2, 1, "invalid_role")}


def _cells(rng):
    return "".join(rng.choice(CELL) for _ in range(rng.randrange(6)))


@pytest.mark.parametrize("size, ending", [(60, "\n"), (200, "\r\n"), (100_000, "\n")])
def test_csv_pieces_equal_whole_files(spark, tmp_path, small_blocks, size, ending):
    rng = random.Random(size)
    rows = []
    for name in ("a.csv", "b.csv"):
        own = [(str(i), _cells(rng), _cells(rng)) for i in range(80)] + [("80", "\n" * 300, '"' * 50)]
        with open(tmp_path / name, "w", encoding="utf-8", newline="") as file:
            writer = csv.writer(file, lineterminator=ending, quoting=csv.QUOTE_ALL if size == 60 else csv.QUOTE_MINIMAL)
            # Spark takes the first line break of a file, in a cell or not, for the one that ends lines.
            writer.writerows([("number", f"first{ending}cell", "second"), *own])
        rows += own
    whole = files.read_csv(spark, str(tmp_path), pieces=False)
    expected = Counter(tuple(None if cell in files.NA_VALUES else cell for cell in row) for row in rows)
    # Reading whole files makes one character of a line break of two, in cells too.
    assert ending == "\r\n" or Counter(map(tuple, whole.collect())) == expected
    small_blocks(size)
    got = files.read_csv(spark, str(tmp_path), pieces=True)
    assert got.schema == whole.schema
    assert Counter(map(tuple, got.collect())) == expected
    if size < 1000:
        assert files.read_csv(spark, str(tmp_path)).count() == len(rows)
        assert pieces.read_pieces(spark, str(tmp_path), "\n").select("block").distinct().count() > 5


def test_csv_pieces_with_a_schema(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,"x\n\ny"\n\n2,NA\n3\n')
    got = files.read_csv(spark, str(tmp_path), "a int, b string", pieces=True)
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "x\n\ny"), (2, None), (3, None)]
    (tmp_path / "a.csv").write_text("a,b\n")
    assert files.read_csv(spark, str(tmp_path), pieces=True).count() == 0


def _value(rng, depth=0):
    kind = rng.randrange(7 if depth < 3 else 4)
    if kind < 3:
        return "".join(rng.choice(CELL) for _ in range(rng.randrange(6)))
    if kind == 3:
        return rng.randrange(1000)
    if kind == 4:
        return [_value(rng, depth + 1) for _ in range(rng.randrange(3))]
    return {f"k{i}": _value(rng, depth + 1) for i in range(rng.randrange(3))}


@pytest.mark.parametrize("size, indent", [(60, None), (200, 2), (100_000, None)])
def test_json_pieces_equal_whole_files(spark, tmp_path, small_blocks, size, indent):
    rng = random.Random(size)
    expected = Counter()
    for name in ("a", "b"):
        records = [{"n": i, "v": json.dumps(_value(rng)), "w": {"s": _cells(rng), "t": [{"u": "}" * rng.randrange(3)}]}}
                   for i in range(60)]
        records[30]["v"] = '{"' * 200
        text = json.dumps(records, indent=indent, ensure_ascii=name == "a")
        (tmp_path / f"{name}.json").write_text(("﻿" if name == "b" else " ") + text + "\n", encoding="utf-8")
        expected.update((r["n"], r["v"], r["w"]["s"], r["w"]["t"][0]["u"]) for r in records)
    small_blocks(size)
    for schema in ("n long, v string, w struct<s: string, t: array<struct<u: string>>>", None):
        got = files.read_json(spark, str(tmp_path), schema, pieces=True)
        assert Counter((r.n, r.v, r.w.s, r.w.t[0].u) for r in got.collect()) == expected


@pytest.mark.parametrize("text", ['[{"a": 1}', '[{"a": 1', '[{"a": 1}, 2]', '[1]', '[{"a": 1}]]', '[{"a": "]', '[{"a": 1} {"a": 2}]'])
def test_json_pieces_fail_on_other_values(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception, match="not an array of records"):
        files.read_json(spark, str(tmp_path), "a int", pieces=True).collect()


def test_json_pieces_of_empty_arrays(spark, tmp_path):
    (tmp_path / "a.json").write_text("[ ]\n")
    (tmp_path / "b.json").write_text('[{}, {"a": 3}]')
    got = files.read_json(spark, str(tmp_path), "a int", pieces=True)
    assert sorted(map(tuple, got.collect()), key=str) == [(3,), (None,)]
    with pytest.raises(Exception):
        (tmp_path / "b.json").write_text('[{"a": x}]')
        files.read_json(spark, str(tmp_path), "a int", pieces=True).collect()


def test_csv_records_inside_a_block_are_not_exchanged(spark, tmp_path, small_blocks):
    """Neither to bring the blocks' states to the lines, nor to put lines together."""
    rng = random.Random(8)
    rows = [(str(i), "".join(rng.choices("ab\n", k=300))) for i in range(4000)]
    with open(tmp_path / "a.csv", "w", newline="") as file:
        csv.writer(file, lineterminator="\n").writerows([("number", "text"), *rows])
    small_blocks(200_000)
    records = pieces.csv_records(spark, str(tmp_path / "a.csv"))
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Window [sum(quotes" not in plan and "Window [sum(starts" not in plan
    assert records.count() == len(rows) + 1
