"""FIXTURES §4.4 and other one-line semantics."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tavola.functions.buckets import equal_width_bin
from tavola.functions.dates import month_end, parse_date_key, to_utc, week_ending_sunday
from tavola.functions.labels import loyalty_label, money
from tavola.functions.numeric import pct_change, to_number_or_zero


def test_date_key_parse(spark):
    rows = spark.createDataFrame([("31-01-2024",), ("2024-01-31",), ("junk",)], "k string") \
        .select(parse_date_key("k").alias("d")).collect()
    assert [r["d"] for r in rows] == [dt.date(2024, 1, 31), None, None]


def test_week_and_month_labels(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 18),), (dt.date(2024, 2, 19),)], "d date")
    out = df.select(week_ending_sunday("d").alias("w"), month_end("d").alias("m")).collect()
    assert [r["w"] for r in out] == [dt.date(2024, 2, 18), dt.date(2024, 2, 25)]
    assert {r["m"] for r in out} == {dt.date(2024, 2, 29)}


def test_loyalty_labels(spark):
    df = spark.createDataFrame([("True",), ("true",), ("1",), ("False",), ("0",), ("maybe",), (None,)], "b string")
    got = [r["s"] for r in df.select(loyalty_label("b").alias("s")).collect()]
    assert got == ["Loyalty Member"] * 3 + ["Non-Member"] * 2 + [None, None]


def test_money_format(spark):
    df = spark.createDataFrame([(Decimal("1234567.50"),), (Decimal("0.00"),), (None,)], "v decimal(20,2)")
    assert [r["m"] for r in df.select(money("v").alias("m")).collect()] == ["$1,234,567.50", "$0.00", None]


def test_numeric_coercion_and_safe_ratio(spark):
    df = spark.createDataFrame([("12.5", Decimal("4.00"), Decimal("2.00")), ("x", Decimal("1.00"), Decimal("0.00")),
                                (None, None, Decimal("1.00"))], "s string, a decimal(10,2), b decimal(10,2)")
    out = df.select(to_number_or_zero("s").alias("n"), pct_change("a", "b").alias("p")).collect()
    assert [r["n"] for r in out] == [12.5, 0.0, 0.0]
    assert [r["p"] for r in out] == [100.0, None, None]


def test_equal_width_bins(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,)], "f double")
    got = [r["b"] for r in df.select(equal_width_bin(F.col("f"), F.lit(0.0), F.lit(10.0), 20).alias("b")).collect()]
    assert got == [1, 11, 20]
    const = df.select(equal_width_bin(F.col("f"), F.lit(3.0), F.lit(3.0), 20).alias("b")).collect()
    assert {r["b"] for r in const} == {1}


def test_timezone_normalisation(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 9, 0),)], "t timestamp")
    assert df.select(to_utc("t", "America/New_York").alias("u")).first()["u"] == dt.datetime(2024, 1, 1, 14, 0)


def test_null_option_names_share_one_group(spark):
    from frames import items_frame, options_frame
    from tavola.plans import clean as C, metrics as M
    items = C.clean_order_items(items_frame(spark, [("o1", "l1", "u1", "2024-01-01", False, "A", "5.00", 1),
                                                   ("o2", "l1", "u1", "2024-01-02", False, "A", "5.00", 1)]))
    opts = C.clean_order_item_options(options_frame(spark, [("o1", "l1", None, "0.00", 1),
                                                           ("o2", "l1", None, "3.00", 1)]))
    flags = {r["order_id"]: (r["max_option_price_ever"], r["is_true_discount"])
             for r in M.discount_flags(C.sales_fact(items, opts)).collect()}
    assert flags == {"o1": (Decimal("3.00"), 1), "o2": (Decimal("3.00"), 0)}


def test_silver_row_count_property(spark):
    from frames import trap_sales, TRAP_ITEMS, TRAP_OPTIONS
    sales = trap_sales(spark)
    lines = {(o, l) for o, l, *_ in TRAP_ITEMS}
    per_line = {k: sum(1 for o, l, *_ in TRAP_OPTIONS if (o, l) == k) for k in lines}
    assert sales.count() == sum(max(1, c) for c in per_line.values())


def test_location_count_exact_and_approx(spark):
    from tavola.plans.reports import location_count
    df = spark.createDataFrame([(f"R{i % 37}",) for i in range(500)], "restaurant_id string")
    assert location_count(df).first()["locations"] == 37
    assert abs(location_count(df, approx=True).first()["locations"] - 37) <= 2
