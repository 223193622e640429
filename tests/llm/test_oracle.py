"""Queries against their DuckDB SQL, over whole tables."""

import duckdb
import pytest

from tests.conftest import SF_MEDIUM, SF_SMALL
from tidewater.llm.oracle import ORACLE
from tidewater.llm.queries import QUERIES

TABLES = ("documents", "embeddings", "conversations", "labels", "benchmark", "pages")


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple("" if r[i] is None else f"{r[i]:.9g}" if isinstance(r[i], float) else str(r[i]).lower() for i in order) for r in rows)


@pytest.mark.parametrize("sf_dir", [SF_SMALL, SF_MEDIUM])
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    want = con.execute(ORACLE[name])
    columns = [c[0] for c in want.description]
    got = QUERIES[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(columns)
    assert _rows(got.columns, [tuple(r) for r in got.collect()]) == _rows(columns, want.fetchall())
