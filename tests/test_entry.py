import duckdb
import pytest

import __spark_entry__ as E
from tillspark.sources.testdata import TABLES

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "total_revenue" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("key", ["q01_monthly_revenue", "q04_top_products", "q07_rfm", "clean_sales",
                                 "seasonal_decompose", "q09_risk_trend", "dim_product", "boxplot_by_month"])
def test_oracle_match_small(spark, duck, key):
    df = E.queries()[key](spark, SF)
    cur = duck.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, cur.fetchall())
