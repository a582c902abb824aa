"""Files of one JSON value each hold a bounded part of a table, whatever its size or identifiers."""

from collections import Counter

import pytest

from chatprep.plans import storage


@pytest.mark.parametrize("query", [storage.read_json, storage.read_json_columns, storage.json_to_jsonl])
def test_files_grow_in_number_not_in_size(spark, tmp_path, monkeypatch, query):
    docs = [(None if i % 3 else 16 * i, "en", f"{i} " + "x" * 500) for i in range(900)] + [(5, None, None)] * 9
    names = "doc_id long, lang string, text string"
    spark.createDataFrame(docs, names).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(storage, "JSON_FILE_BYTES", 10_000, raising=False)
    paths = []
    scratch = storage.scratch_path
    monkeypatch.setattr(storage, "scratch_path", lambda *a: paths.append(scratch(*a)) or paths[-1])
    assert Counter(map(tuple, query(spark, str(tmp_path)).collect())) == Counter(docs)
    files = spark.read.text(f"{paths[0]}.json", wholetext=True).selectExpr("octet_length(value) AS n").collect()
    assert len(files) > 40 and max(r.n for r in files) < 60_000
