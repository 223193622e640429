"""Every registered query against its DuckDB oracle at sf0.001 (the round's
verify runs the same comparison at sf0.01)."""

import os

import duckdb
import pytest

from __spark_entry__ import entry
from tidewater.oracle import ORACLE
from tidewater.queries import QUERIES

from .conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events".split()


def norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        return repr(v)  # bit-exact; a NaN is not a null
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ")
    return str(v)


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert len(QUERIES) >= 44


SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    duck_types = {r[0]: r[1] for r in con.execute(f"describe {ORACLE[name]}").fetchall()}
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes} == duck_types
    got = canon(df.columns, df.collect())
    result = con.execute(ORACLE[name])
    want = canon([c[0] for c in result.description], result.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "avg_wave_height" in df.columns
