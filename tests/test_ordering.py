"""Distributed NTILE and per-group scans equal Spark's single-partition windows."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tavola.operators.ordering import Key, RangeConfig, grouped_scan, multi_ntile, with_range

SMALL = RangeConfig(rows_per_part=5, min_parts=3, sample_per_part=8)


def global_ntile(df, spec, k, out, cfg):
    return multi_ntile(df, {out: spec}, k, cfg)


def frame(spark, n, ties=3, nulls=False, seed=1):
    rnd = random.Random(seed)
    rows = [(f"u{i:05d}", None if nulls and rnd.random() < 0.1 else rnd.randrange(ties)) for i in range(n)]
    return spark.createDataFrame(rows, "user_id string, v int")


@pytest.mark.parametrize("n", [0, 1, 3, 5, 7, 23, 1003])
def test_ntile_matches_builtin(spark, n):
    df = frame(spark, n, ties=4, nulls=True)
    for key in (Key("v"), Key("v", ascending=False)):
        got = global_ntile(df, [key, Key("user_id")], 5, "b", SMALL)
        w = Window.orderBy(key.sort_expr(), F.col("user_id"))
        want = df.withColumn("b", F.ntile(5).over(w))
        assert sorted(got.collect()) == sorted(want.collect())


def test_ntile_bucket_sizes_differ_by_at_most_one(spark):
    got = global_ntile(frame(spark, 1003, ties=2), [Key("v"), Key("user_id")], 5, "b", SMALL)
    sizes = [r["count"] for r in got.groupBy("b").count().collect()]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == 1003


def test_ranges_are_contiguous_and_balanced(spark):
    df = frame(spark, 400, ties=1)   # one tie value: the unique user_id still spreads rows
    parted, parts, n = with_range(df, [Key("v"), Key("user_id")], RangeConfig(rows_per_part=50, min_parts=4))
    assert parts > 1 and n == 400
    bounds = parted.groupBy("_part").agg(F.min("user_id").alias("lo"), F.max("user_id").alias("hi"),
                                         F.count("*").alias("c")).orderBy("_part").collect()
    for a, b in zip(bounds, bounds[1:]):
        assert a["hi"] < b["lo"]
    assert max(r["c"] for r in bounds) < 400


def test_grouped_scan_matches_windows_with_hot_group(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(300):   # one customer holds a third of the rows and spans several ranges
        user = "hot" if i % 3 == 0 else f"u{rnd.randrange(40):02d}"
        amount = None if rnd.random() < 0.05 else Decimal(rnd.randrange(0, 5000)) / 100
        rows.append((user, f"o{i:04d}", rnd.randrange(30), amount))
    schema = "user_id string, order_id string, day int, amount decimal(20,2)"
    df = spark.createDataFrame(rows, schema)
    got = grouped_scan(df, "user_id", [Key("day"), Key("order_id")],
                       lags={"prev_day": "day", "prev_amount": "amount"}, running={"run": "amount"},
                       cfg=RangeConfig(rows_per_part=20, min_parts=4, sample_per_part=10))
    w = Window.partitionBy("user_id").orderBy("day", "order_id")
    want = (df.withColumn("prev_day", F.lag("day").over(w)).withColumn("prev_amount", F.lag("amount").over(w))
            .withColumn("run", F.sum("amount").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    cols = ["user_id", "order_id", "day", "amount", "prev_day", "prev_amount", "run"]
    assert sorted(got.select(cols).collect()) == sorted(want.select(cols).collect())


def test_running_total_at_last_row_equals_customer_total(spark):
    from tavola.plans import metrics as M
    from frames import trap_sales
    sales = trap_sales(spark)
    tl = M.order_timeline(M.order_summary(sales))
    last = {r["user_id"]: r["running_clv"] for r in
            tl.groupBy("user_id").agg(F.max_by("running_clv", F.struct("order_date", "order_id")).alias("running_clv"))
            .collect()}
    totals = {r["user_id"]: r["current_clv"] for r in M.customer_intelligence(sales).collect()}
    assert last == totals


@pytest.mark.parametrize("n", [0, 1, 7, 23, 1003])
def test_multi_ntile_matches_builtin(spark, n):
    from tavola.operators.ordering import multi_ntile
    df = frame(spark, n, ties=4, nulls=True).withColumn("w", (F.col("v") * 7) % 3)
    specs = {"a": [Key("v", ascending=False), Key("user_id")], "b": [Key("w"), Key("user_id")]}
    got = multi_ntile(df, specs, 5, SMALL)
    want = (df.withColumn("a", F.ntile(5).over(Window.orderBy(F.col("v").desc(), "user_id")))
            .withColumn("b", F.ntile(5).over(Window.orderBy("w", "user_id"))))
    assert sorted(got.collect()) == sorted(want.select(got.columns).collect())


def test_more_than_256_ranges(spark):
    df = frame(spark, 2000, ties=7, nulls=True)
    spec, fine = [Key("v", ascending=False), Key("user_id")], RangeConfig(rows_per_part=4, sample_per_part=8)
    parted, parts, _ = with_range(df, spec, fine)
    assert parts > 400 and parted.select("_part").distinct().count() > 256
    got = global_ntile(df, spec, 5, "b", fine)
    want = df.withColumn("b", F.ntile(5).over(Window.orderBy(F.col("v").desc(), "user_id")))
    assert sorted(got.collect()) == sorted(want.collect())
    rows = df.withColumn("order_id", F.col("user_id")).withColumn("user", F.lit("hot")).withColumn("amount", F.col("v").cast("decimal(9,2)"))
    got = grouped_scan(rows, "user", [Key("order_id")], lags={"p": "v"}, running={"run": "amount"}, cfg=fine)
    w = Window.partitionBy("user").orderBy("order_id")
    want = rows.withColumn("p", F.lag("v").over(w)).withColumn("run", F.sum("amount").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    assert sorted(got.select(want.columns).collect()) == sorted(want.collect())


def test_ntile_with_awkward_key_values(spark):
    rnd = random.Random(11)
    texts = ["it's", "a\\b", "", "日本", "z", None, 'q"q']
    floats = [float("nan"), float("inf"), -float("inf"), -0.0, 0.0, 1e-5, 2.5, None]
    rows = [(rnd.choice(texts), rnd.choice(floats), i) for i in range(400)]
    df = spark.createDataFrame(rows, "s string, f double, i int")
    for spec in ([Key("s"), Key("i")], [Key("f", ascending=False), Key("s", nulls_first=False), Key("i")]):
        got = global_ntile(df, spec, 5, "b", SMALL)
        want = df.withColumn("b", F.ntile(5).over(Window.orderBy(*[k.sort_expr() for k in spec])))
        key = lambda r: (r["i"], r["b"])
        assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))
