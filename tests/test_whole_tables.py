"""Written tables of the registered queries hold the whole job, beyond what their reports show."""

import os

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from tavola.plans import tablework
from tavola.plans.registry import all_queries, sales
from tavola.sources import sinks


@pytest.fixture()
def few_days(tmp_out):
    """The smallest tables with the orders of a few days, inside the report's quarter and outside it."""
    os.makedirs(f"{tmp_out}/star")
    for name in ("lineitem", "orders", "customer", "part"):
        t = pq.read_table(f"{SF0001}/{name}.parquet")
        if name == "orders":
            day = pc.strftime(t["o_orderdate"], format="%m-%d")
            t = t.filter(pc.is_in(day, value_set=pa.array(["01-02", "02-28", "03-01", "03-02", "03-31", "04-01", "12-31"])))
        pq.write_table(t, f"{tmp_out}/star/{name}.parquet")
    return f"{tmp_out}/star"


def _written(spark, monkeypatch, star, query):
    """Run a query with its folder at a known place."""
    root = os.path.dirname(star)
    monkeypatch.setattr(tablework, "_folder", lambda spark, name: f"{root}/{query}")
    all_queries()[query](spark, star)
    return f"{root}/{query}"


def _totals(df):
    return df.agg(F.count(F.lit(1)), F.count_distinct("order_date"), F.sum("total_line_item_revenue"), F.sum("item_quantity")).first()


def _files(root):
    """Data files under a folder with their time of change."""
    return {os.path.relpath(os.path.join(d, f), root): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_overwrites_compaction_and_catalog_hold_every_line_of_every_day(spark, few_days, monkeypatch):
    s = sales(spark, few_days).withColumn("march", F.month("order_date") == 3).cache()
    want = _totals(s)
    assert s.filter(~F.col("order_date").between(*tablework.RANGE)).count() > s.count() / 2
    march = _totals(s.filter("march"))
    dynamic = _totals(spark.read.parquet(_written(spark, monkeypatch, few_days, "overwrite_days_dynamic")))
    assert dynamic == (want[0], want[1], want[2] + march[2], want[3])
    static = _totals(spark.read.parquet(_written(spark, monkeypatch, few_days, "overwrite_days_static")))
    assert static == (march[0], march[1], 2 * march[2], march[3])
    assert _totals(spark.read.parquet(_written(spark, monkeypatch, few_days, "compacted_days"))) == want
    _written(spark, monkeypatch, few_days, "catalog_revenue")
    assert _totals(spark.table("tavola_reports.sales_fact")) == want
    s.unpersist()


def test_compaction_touches_only_partitions_in_too_many_files(spark, tmp_out):
    path = f"{tmp_out}/t"
    rows = spark.range(400).select("id", F.when(F.col("id") % 4 > 0, F.col("id") % 4).alias("p"))   # one value is null
    rows.filter("p = 1 or p is null").repartition(5).write.partitionBy("p").parquet(path)
    rows.filter("p > 1").coalesce(1).write.mode("append").partitionBy("p").parquet(path)
    before = _files(path)
    found = {r["value"]: (r["files"], r["rewritten"]) for r in sinks.compact_partitions(spark, path, "p").collect()}
    assert found == {"1": (5, True), sinks.NO_VALUE: (5, True), "2": (1, False), "3": (1, False)}
    after = _files(path)
    untouched = {f: t for f, t in before.items() if f.startswith(("p=2/", "p=3/"))}
    assert {f: t for f, t in after.items() if f in before} == untouched
    assert len(after) == 4
    assert sorted(map(tuple, spark.read.parquet(path).select("id", "p").collect())) == sorted(map(tuple, rows.collect()))
    assert not any(r["rewritten"] for r in sinks.compact_partitions(spark, path, "p").collect()) and _files(path) == after
    # A large partition may keep as many files as its size asks for.
    assert not any(r["rewritten"] for r in sinks.compact_partitions(spark, path, "p", file_bytes=1).collect())


def test_longer_periods_are_pruned_by_day(spark, tmp_out):
    days = spark.sql("SELECT explode(sequence(DATE'2020-01-15', DATE'2021-03-02')) AS order_date")
    sinks.write_partitioned(days, f"{tmp_out}/s", "order_date", grain="month")
    assert len({os.path.dirname(f) for f in _files(f"{tmp_out}/s")}) == 15
    got = sinks.read_silver(spark, f"{tmp_out}/s", "2020-02-28", "2020-03-01")
    assert len(got.inputFiles()) == 15 and sorted(r[0].isoformat() for r in got.select("order_date").collect()) == \
        ["2020-02-28", "2020-02-29", "2020-03-01"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_date_month" in plan


def test_registering_again_keeps_the_table(spark, tmp_out):
    spark.range(3).withColumn("p", F.col("id") % 2).write.partitionBy("p").parquet(f"{tmp_out}/kept")
    first = sinks.register_tables(spark, tmp_out, ["kept"], database="tavola_kept")["kept"]
    created = lambda: spark.sql("DESCRIBE TABLE EXTENDED tavola_kept.kept").filter("col_name = 'Created Time'").first()
    at = created()
    spark.range(3, 6).withColumn("p", F.lit(7)).write.mode("append").partitionBy("p").parquet(f"{tmp_out}/kept")
    again = sinks.register_tables(spark, tmp_out, ["kept"], database="tavola_kept")["kept"]
    assert first.columns == again.columns and again.count() == 6 and created() == at
    spark.range(3).withColumn("q", F.lit("x")).write.mode("overwrite").parquet(f"{tmp_out}/kept")
    assert sinks.register_tables(spark, tmp_out, ["kept"], database="tavola_kept")["kept"].columns == ["id", "q"]
