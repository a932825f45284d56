"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver's gate runs the same comparison at sf0.01)."""

import math
import os

import pytest

import __spark_entry__ as E

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = {n: q for n, q in E.queries().items() if q.__module__.startswith("tessera.plans")}
ORACLE = E.oracle_sql()


def _norm(v):
    import numpy as np
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (float, np.floating)):
        return round(float(v), 6)
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, np.bool_):
        return bool(v)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records")), key=repr)


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in ("documents pages benchmark labels conversations events").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["doc_id", "line_no", "rank", "translation"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    sp = QUERIES[name](spark, SF).toPandas()
    if name not in ORACLE:
        # no SQL states these; they are held against brute force in tests of their own
        assert len(sp) > 0 and len(set(sp.columns)) == len(sp.columns)
        return
    dk = duck.execute(ORACLE[name]).df()
    c1, r1 = _rows(sp)
    c2, r2 = _rows(dk)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2
