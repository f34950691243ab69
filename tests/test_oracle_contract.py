"""Registered queries against their DuckDB SQL on the smallest driver tables."""

import datetime as dt
import decimal
import math
import os

import pytest

from conftest import SF0001

duckdb = pytest.importorskip("duckdb")

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
SAMPLE = ("silver_sales_fact", "customer_intelligence", "customer_rolling_metrics", "location_sales_trends",
          "loyalty_roi_analysis", "discount_effectiveness", "store_performance", "profile_order_items",
          "cdc_apply", "trend_weekly", "winback_formatted", "segment_share")


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        path = f"{SF0001}/{t}.parquet"
        if os.path.exists(path):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return c


def test_every_query_has_sql():
    import __spark_entry__ as E
    from tavola.plans.registry import all_oracles, all_queries
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, con, name):
    import __spark_entry__ as E
    df = E.queries()[name](spark, SF0001)
    got = [tuple(_norm(v) for v in r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    idx = [cols.index(c) for c in df.columns]
    want = [tuple(_norm(r[i]) for i in idx) for r in res.fetchall()]
    assert _sorted(got) == _sorted(want)
