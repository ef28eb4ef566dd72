"""Driver contract: entry smoke, registry consistency, Spark vs DuckDB."""

import duckdb
import pytest

import __spark_entry__ as E
from aeolus.plans.catalog import QUERIES
from conftest import SF001
from tools.check_oracle import TABLES, digest

SQL = E.oracle_sql()
# Model fits and k selection have no SQL form; they are covered by
# test_ml_parity.py. Everything else is compared with DuckDB here.
NO_SQL = {"linreg", "ridge", "lasso", "logreg", "predictions", "kmeans_select", "kmeans_centers",
          "kpt_models"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:3] == ["window_date", "window_hour", "city"]


def test_registry_consistent():
    q = E.queries()
    assert set(SQL) <= set(q)
    assert set(QUERIES) - set(SQL) == NO_SQL
    assert len(q) >= 60


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]
