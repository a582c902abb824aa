"""Compare a registered query with its SQL in DuckDB, as bags of rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

DATA = Path("/root/testdata")


def connect(sf: str):
    con = duckdb.connect()
    for path in sorted((DATA / sf).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


_KINDS = {"bigint": "int64", "int": "int32", "double": "double", "string": "str", "boolean": "bool"}
_DUCK = {
    "BIGINT": "int64", "INTEGER": "int32", "DOUBLE": "double", "VARCHAR": "str", "BOOLEAN": "bool",
}


def compare(con, df, sql):
    """Return a list of differences, empty if equal."""
    problems = []
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected_rows = cursor.fetchall()
    kinds = {r[0]: _DUCK.get(r[1], r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    ours = {n: _KINDS.get(t, t) for n, t in df.dtypes}
    if ours != kinds:
        problems.append(f"schema: spark {ours} sql {kinds}")
    got = bag(df.columns, [tuple(r) for r in df.collect()])
    expected = bag(names, expected_rows)
    if got != expected:
        extra, missing = got - expected, expected - got
        problems.append(
            f"rows: spark {got.total()} sql {expected.total()}; "
            f"only spark {extra.total()}, e.g. {str(list(extra)[:1])[:600]}; "
            f"only sql {missing.total()}, e.g. {str(list(missing)[:1])[:600]}"
        )
    if not expected_rows:
        problems.append("no rows")
    return problems
