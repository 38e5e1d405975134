"""Every query with SQL against DuckDB on the smallest tables; the others must run and give rows."""

import os
from numbers import Number

import duckdb
import pytest

from quillspark.queries import QUERIES, SQL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(folder):
    base = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{folder}/{name}.parquet"):
            base.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return base


def plain(value):
    if isinstance(value, (list, tuple)):
        return tuple(plain(x) for x in value)
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, Number) or type(value).__name__ == "Decimal":
        return f"{float(value):.6f}"
    return str(value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, folder, duck, name):
    frame = QUERIES[name](spark, folder)
    columns = sorted(frame.columns)
    got = sorted((tuple(plain(row[c]) for c in columns) for row in (r.asDict(recursive=True) for r in frame.collect())), key=repr)
    assert name not in SQL or SQL[name]
    if name in SQL:
        found = duck.execute(SQL[name])
        names = [x[0] for x in found.description]
        assert sorted(names) == columns
        want = [tuple(plain(dict(zip(names, row, strict=True))[c]) for c in columns) for row in found.fetchall()]
        assert got == sorted(want, key=repr)
    else:
        assert got
