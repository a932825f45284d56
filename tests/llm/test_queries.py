"""Queries whose rows SQL can state, against DuckDB."""

import os

import duckdb
import pytest

from tessera.llm.queries import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def normal(frame, columns):
    def value(v):
        return None if v is None or v != v else round(v, 9) if isinstance(v, float) else v
    return sorted((tuple(map(value, r)) for r in frame[columns].itertuples(index=False, name=None)), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = QUERIES[name](spark, SF).toPandas(), con.execute(ORACLES[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert normal(got, columns) == normal(want, columns)


def test_one_query_for_each_operator():
    assert sorted({int(n[2:].split("_")[0]) for n in QUERIES}) == list(range(1, 14))
