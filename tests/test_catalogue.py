"""Each registered query of the corpus operators against its SQL twin in DuckDB, on the smallest tables."""

import math
from pathlib import Path

import pytest

from threadloom.plans import catalogue

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no driver tables here")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "null"
    if isinstance(value, (bool, str)):
        return str(value)
    try:
        return f"{float(value):.6g}"
    except (TypeError, ValueError):
        return str(value)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    assert len(set(df.columns)) == len(df.columns)
    if name in catalogue.ORACLE_SQL:
        rows = duck.execute(catalogue.ORACLE_SQL[name])
        names = [d[0] for d in rows.description]
        assert sorted(names) == columns
        at = [names.index(c) for c in columns]
        assert got == sorted(tuple(plain(r[i]) for i in at) for r in rows.fetchall())
    else:
        assert got
