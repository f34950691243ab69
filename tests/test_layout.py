"""Pruning through the calendar, order counts that add up, bucketed tables, range directories."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from tavola.operators.ordering import RangeConfig, multi_ntile
from tavola.plans import layout as L
from tavola.plans.registry import sales
from tavola.plans.tablework import one_row_per_day, sales_by_calendar
from tavola.sources import sinks


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan()


def files_read(plan):
    """Files that the scan of a partitioned table read."""
    text = plan.toString()
    assert "dynamicpruning" in text.lower()
    stack, seen = [plan], []
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name.startswith("Scan parquet") and "order_date" in node.toString() and "dynamicpruning" in node.toString().lower():
            seen.append(node.metrics().get("numFiles").get().value())
        if name == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
        elif "QueryStage" in name:
            stack.append(node.plan())
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return seen


@pytest.mark.parametrize("grain", [None, "month"])
def test_holidays_read_only_their_folders(spark, tmp_out, grain):
    days = spark.sql("SELECT explode(sequence(DATE'2020-01-01', DATE'2020-06-30')) AS order_date").withColumn("x", F.dayofyear("order_date"))
    # Enough rows that the calendar is the smaller side.
    sinks.write_partitioned(days.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(400)))).withColumn("r", F.rand(1)), f"{tmp_out}/s",
                            "order_date", grain=grain)
    cal = days.select(F.col("order_date").alias("date_key"), F.col("x").isin(5, 40).alias("is_holiday"), F.lit("h").alias("holiday_name"))
    cal.write.parquet(f"{tmp_out}/d")
    wanted = one_row_per_day(spark.read.parquet(f"{tmp_out}/d"), "is_holiday", "holiday_name").filter("is_holiday")
    got = L.sales_on_days(sinks.read_silver(spark, f"{tmp_out}/s"), wanted)
    plan = executed(got)
    assert files_read(plan) == [2]
    assert sorted(r["x"] for r in got.collect()) == [5] * 400 + [40] * 400


def test_a_repeated_day_counts_once(spark):
    s = spark.createDataFrame([("o1", dt.date(2024, 1, 1), 5), ("o2", None, 7)], "order_id string, order_date date, total_line_item_revenue int")
    cal = spark.createDataFrame([(dt.date(2024, 1, 1), "Mon", False, True), (dt.date(2024, 1, 1), "Mon", False, True), (None, "x", True, True)],
                                "date_key date, day_of_week string, is_weekend boolean, is_holiday boolean")
    got = sorted(map(tuple, sales_by_calendar(s, cal).collect()), key=str)
    assert got == [("Mon", False, True, 5, 1, 1), (None, None, None, 7, 1, 1)]


def test_order_counts_from_daily_bitmaps(spark):
    rows = [(dt.date(2024, 1 + i % 3, 1 + i % 20) if i % 11 else None, f"R{i % 4}" if i % 7 else None, f"o{i % 57}" if i % 13 else None)
            for i in range(500)]
    s = spark.createDataFrame(rows, "order_date date, restaurant_id string, order_id string")
    numbers = L.order_numbers(s, RangeConfig(rows_per_part=7, min_parts=3))
    found = sorted(r["order_no"] for r in numbers.collect())
    assert found == list(range(57))
    daily = L.daily_order_bitmaps(s, numbers).withColumn("month", F.trunc("order_date", "month"))
    s = s.withColumn("month", F.trunc("order_date", "month"))
    for by in (("restaurant_id", "month"), ("restaurant_id",), ("month",), ()):
        want = s.filter("order_id is not null").groupBy(*by).agg(F.count_distinct("order_id").alias("orders"))
        assert sorted(map(tuple, L.order_counts(daily, *by).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_bucketed_timeline_needs_no_shuffle_by_customer(spark):
    from tavola.plans import metrics as M
    timeline, _ = L.timeline_by_customer(spark, sales(spark, SF0001))
    plan = executed(M.customer_base(timeline, dt.date(2000, 1, 1))).toString().split("== Initial Plan ==")[0]
    assert "Exchange" not in plan and "Bucketed: true" in plan
    stats = spark.sql(f"DESCRIBE EXTENDED {timeline._jdf.queryExecution().analyzed().collectLeaves().apply(0).catalogTable().get().identifier().quotedString()} user_id")
    assert {r[0]: r[1] for r in stats.collect()}["distinct_count"] != "NULL"


def test_plan_does_not_grow_with_the_ranges(spark):
    df = spark.range(3000).withColumn("v", F.col("id") % 17)
    sizes = []
    for rows in (1000, 10):
        out = multi_ntile(df, {"a": ["v", "id"], "b": ["id"]}, 5, RangeConfig(rows_per_part=rows, min_parts=1))
        sizes.append(len(out._jdf.queryExecution().optimizedPlan().toString()))
    assert abs(sizes[0] - sizes[1]) < 400


def test_discounts_derive_silver_once(spark):
    from tavola.plans.registry import all_queries
    scans = lambda df: sum(line.count("lineitem.parquet") for line in executed(df).toString().split("== Initial Plan ==")[0].splitlines()
                           if "FileScan parquet" in line)
    silver = all_queries()["silver_sales_fact"](spark, SF0001)
    assert scans(silver) == 2   # lines and their options both come from it
    assert scans(all_queries()["discount_effectiveness"](spark, SF0001)) == 0   # read from the written roll-up


def test_tables_bucketed_by_order_are_joined_in_place(spark):
    from tavola.sources import star
    items, options = L.tables_by_order(spark, star.bronze(spark, SF0001), buckets=6)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed(L.order_totals(items, options)).toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("SelectedBucketsCount: 6 out of 6") == 2


def test_every_segment_occurs(spark):
    from tavola.plans.registry import all_queries
    rows = all_queries()["segments_with_newcomers"](spark, SF0001.replace("0.001", "0.01")).collect()
    assert {r["segment"] for r in rows} == {"VIP", "New Customer", "Churn Risk", "Standard"}
