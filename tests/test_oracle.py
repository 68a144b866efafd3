"""The correctness gate: every query of the library's catalog against its DuckDB SQL (sf0.001).

The training-data queries, which may use Python and need not have SQL, have their own tests in tests/llm."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from plenaria import vocab
from plenaria.catalog import QUERIES
from plenaria.oracle import ORACLE_SQL
from plenaria.sources.bridge import DRIVER_TABLES

SF = "/root/testdata/sf0.001"


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 6)
        return v
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE_SQL[name])
    d_cols, d_rows = [c[0] for c in res.description], res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert _canon(s_cols, s_rows) == _canon(d_cols, d_rows)


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() == len(vocab.LEGISLATURES) and df.columns == ["legislatura", "ordem", "n"]
