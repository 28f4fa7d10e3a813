"""Every registered query against its DuckDB oracle on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in Path(SF).glob("*.parquet"):
        c.execute(f"CREATE VIEW {t.stem} AS SELECT * FROM read_parquet('{t}')")
    return c


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def _rows(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records), key=repr)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = [dict(zip(dcols, r)) for r in cur.fetchall()]
    assert sorted(sdf.columns) == sorted(dcols)
    cols = sorted(dcols)
    assert _rows([r.asDict() for r in sdf.collect()], cols) == _rows(drows, cols)


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql())))
def test_rows_only_queries_run(spark, name):
    assert E.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["CD_CLIENTE", "cluster", "RECOMENDACOES"] and df.count() > 0
