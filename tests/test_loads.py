"""Newest load, rescued drift, checks over sets, profiles that add up, stored results, owned folders."""

import datetime as dt
import os
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from tavola import schemas
from tavola.operators import materialize as W
from tavola.operators.profile import column_profile, merged_profile, profile_sketches
from tavola.operators.quality import set_checks
from tavola.sources import bronze as B
from tavola.sources.cache import cached, drop_expired, plan_key


def land(df, path, finished=True):
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", str(finished).lower()).parquet(path)


def test_newest_complete_load_is_read(spark, tmp_out):
    root = f"{tmp_out}/order_item_options"
    row = lambda name: spark.createDataFrame([("o", "l", "g", name, Decimal("1.00"), 1)], schemas.ORDER_ITEM_OPTIONS)
    land(row("old"), f"{root}/2023/12/31")
    land(row("new"), f"{root}/2024/01/02")
    land(row("half"), f"{root}/2024/01/10", finished=False)
    assert B.latest_load(spark, root) == f"{root}/2024/01/02"
    found = {r["load"]: r["complete"] for r in B.list_loads(spark, root).collect()}
    assert found == {"2023/12/31": True, "2024/01/02": True, "2024/01/10": False}
    for name in ("order_items", "date_dim"):
        spark.createDataFrame([], getattr(schemas, name.upper())).write.parquet(f"{tmp_out}/{name}")   # no date folders
    got = B.read_bronze(spark, tmp_out)
    assert [r["option_name"] for r in got.order_item_options.collect()] == ["new"] and got.order_items.columns == schemas.ORDER_ITEMS.names
    assert B.read_bronze(spark, tmp_out, load="all").order_item_options.count() == 3


def test_loads_without_any_marker_all_count(spark, tmp_out):
    for day in ("2024/01/01", "2024/01/02"):
        land(spark.range(1), f"{tmp_out}/t/{day}", finished=False)
    assert B.latest_load(spark, f"{tmp_out}/t").endswith("2024/01/02")
    os.makedirs(f"{tmp_out}/empty")
    with pytest.raises(FileNotFoundError):
        B.latest_load(spark, f"{tmp_out}/empty")


def test_what_the_schema_cannot_hold_is_rescued(spark):
    df = spark.createDataFrame([("o1", "l1", "g", "a", Decimal("1.2500"), "2", "t1", 7), ("o2", "l1", "g", "b", Decimal("1.2550"), "2.0", None, None),
                                ("o3", None, None, None, None, "many", None, None), ("o4", "l1", "g", "c", Decimal("99999999999.9900"), None, "", 1)],
                               "order_id string, lineitem_id string, option_group_name string, option_name string, option_price decimal(18,4),"
                               " option_quantity string, table_no string, seats int")
    got = {r["order_id"]: r for r in B.conform(df, schemas.ORDER_ITEM_OPTIONS, rescue="_rescued").collect()}
    assert got["o1"]["_rescued"] == '{"table_no":"t1","seats":7}' and got["o1"]["option_price"] == Decimal("1.25")
    assert got["o2"]["_rescued"] == '{"option_price":1.2550}' and got["o2"]["option_quantity"] == 2
    assert got["o3"]["_rescued"] == '{"option_quantity":"many"}' and got["o3"]["option_quantity"] is None
    assert got["o4"]["_rescued"] == '{"option_price":99999999999.9900,"table_no":"","seats":1}' and got["o4"]["option_price"] is None
    same = spark.createDataFrame([("o", "l", "g", "n", Decimal("1.00"), 1)], schemas.ORDER_ITEM_OPTIONS)
    assert B.conform(same, schemas.ORDER_ITEM_OPTIONS, rescue="_rescued").collect()[0]["_rescued"] is None


def test_set_checks(spark):
    day = dt.date(2024, 1, 1)
    items = spark.createDataFrame([("o1", "a", day), ("o1", "a", day), ("o1", "b", dt.date(2024, 1, 2)), ("o2", "a", None), (None, "a", day),
                                   (None, "a", day)], "order_id string, lineitem_id string, order_date date")
    options = spark.createDataFrame([("o1", "a"), ("o1", "z"), ("o1", "z"), (None, "a"), ("o9", "a")], "order_id string, lineitem_id string")
    got = {r["check_name"]: (r["failures"], r["rows"], r["passed"]) for r in set_checks(items, options, spark.range(20)).collect()}
    assert got == {"options_without_line": (4, 5, False), "repeated_lines": (2, 6, False), "orders_on_two_dates": (1, 6, False),
                   "volume": (4, 6, False)}
    none = {r["check_name"]: (r["failures"], r["passed"]) for r in set_checks(items.limit(0), options.limit(0), spark.range(0)).collect()}
    assert none == dict.fromkeys(got, (0, True))


def test_clean_job_gathers_its_metrics_while_writing(spark, tmp_out):
    from tavola.plans.pipeline import clean_job
    from tavola.sources import star
    paths = clean_job(spark, star.bronze(spark, SF0001), tmp_out)
    got = spark.read.parquet(paths["metrics"]).first()
    want = spark.read.parquet(paths["sales_fact"]).agg(F.count(F.lit(1)), F.count_if(F.col("option_name").isNull()), F.sum("total_line_item_revenue"),
                                                       F.min("order_date"), F.max("order_date")).first()
    assert tuple(got) == tuple(want)


def awkward(spark):
    rows = [(1, 0.0, "a", [1], None), (1, -0.0, "a", [1], None), (2, float("nan"), "", [], None), (2, float("nan"), None, None, None),
            (2, float("nan"), None, None, None), (None, None, "b", [2], None)]
    return spark.createDataFrame(rows, "i int, d double, s string, l array<int>, n string")


def test_exact_profile_without_an_expand(spark):
    got = {r["column_name"]: tuple(r)[1:] for r in column_profile(awkward(spark)).collect()}
    assert got == {"i": (5, 1, "int", 2, 2), "d": (5, 1, "double", 2, 2), "s": (4, 2, "string", 3, 2), "l": (4, 2, "array<int>", 3, 2),
                   "n": (0, 6, "string", 0, 2)}
    assert "Expand" not in column_profile(awkward(spark))._jdf.queryExecution().executedPlan().toString()
    empty = {r["column_name"]: (r["non_null_count"], r["null_count"], r["duplicates"]) for r in column_profile(awkward(spark).limit(0)).collect()}
    assert empty == dict.fromkeys("idsln", (0, 0, 0))


def test_stored_sketches_add_up(spark, tmp_out):
    df = spark.range(30000).selectExpr("id % 12000 AS k", "CAST(id % 7 AS string) AS s", "CASE WHEN id % 3 = 0 THEN id END AS n")
    for day, part in (("01", df.filter("k < 7000")), ("02", df.filter("k >= 5000"))):   # the loads share rows
        profile_sketches(part).write.parquet(f"{tmp_out}/{day}")
    both = df.filter("k < 7000").unionByName(df.filter("k >= 5000"))
    got = {r["column_name"]: r for r in merged_profile(spark.read.option("recursiveFileLookup", "true").parquet(tmp_out)).collect()}
    for r in column_profile(both).collect():
        g = got[r["column_name"]]
        assert (g["non_null_count"], g["null_count"], g["data_type"]) == (r["non_null_count"], r["null_count"], r["data_type"])
        assert abs(g["unique_values"] - r["unique_values"]) <= .02 * r["unique_values"]
        assert abs(g["duplicates"] - r["duplicates"]) <= .02 * both.count()


def test_stored_results_expire_and_follow_their_inputs(spark, tmp_out):
    source, root = f"{tmp_out}/in", f"{tmp_out}/results"
    spark.range(5).write.parquet(source)
    query = lambda: spark.read.parquet(source).groupBy((F.col("id") % 2).alias("k")).agg(F.sum("id").alias("s"))
    results = lambda: sum(len(os.listdir(f"{root}/{d}")) for d in os.listdir(root))
    first = sorted(map(tuple, cached(query(), root, 100, now=lambda: 1000.0).collect()))
    again = cached(query(), root, 100, now=lambda: 1050.0)
    assert sorted(map(tuple, again.collect())) == first == [(0, 6), (1, 4)] and results() == 1
    assert all(root in f for f in again.inputFiles())
    assert plan_key(query()) == plan_key(query()) != plan_key(query().filter("k = 1"))
    cached(query(), root, 100, now=lambda: 1101.0)   # too old: computed again
    assert results() == 2
    spark.range(5, 7).write.mode("append").parquet(source)   # the input has changed
    assert sorted(map(tuple, cached(query(), root, 100, now=lambda: 1102.0).collect())) == [(0, 12), (1, 9)] and results() == 3
    half = f"{root}/result-{plan_key(query())}/1150000"   # a result that was never finished
    os.makedirs(half)
    assert cached(query(), root, 100, now=lambda: 1160.0).count() == 2 and results() == 4
    assert drop_expired(spark, root, 100, now=lambda: 1210.0) == 3 and results() == 1


def test_owned_folders_are_released_and_old_ones_swept(spark):
    before = list(W.owned(spark))
    W.owned(spark).clear()   # this test's folders only
    kept = W.materialize(spark.range(3), "released")
    path = W.owned(spark)[-1]
    assert kept.count() == 3 and W.written_bytes(kept) > 0
    assert W.sweep(spark, hours=1) >= 0 and kept.count() == 3
    assert W.release(spark) == 1 and W.owned(spark) == []
    assert not spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).exists(
        spark._jvm.org.apache.hadoop.fs.Path(path))
    old = W.scratch_folder(spark, "old")
    spark.range(1).write.parquet(old)
    plain = old.replace("file:", "")
    os.utime(plain, (time.time() - 9e6,) * 2)
    assert W.sweep(spark, hours=2400) >= 1 and not os.path.exists(plain)
    W.owned(spark)[:] = before


def test_entry_survives_a_subpackage_that_cannot_be_imported():
    import subprocess
    import sys
    code = ("import sys; sys.modules['public_tokenizers'] = None\n"
            "import __spark_entry__ as e\n"
            "q = e.queries(); print(len(q), 'customer_intelligence' in q, any(n.startswith('op') and n[2].isdigit() for n in q), set(e.oracle_sql()) <= set(q))")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    n, has, llm, sql = out.stdout.split()
    assert int(n) > 80 and (has, llm, sql) == ("True", "False", "True"), out.stderr
