"""Change feed (batch and streaming), quality, profile, sources, sinks and pipeline."""

import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import SF0001
from tavola.operators.cdc import apply_changes, merge_changes, live
from tavola.operators.profile import column_profile
from tavola.operators.quality import dq_report, split_valid

FEED = "k string, v int, commit_ts timestamp, op string"


def feed(spark, rows):
    return spark.createDataFrame([(k, v, dt.datetime(2024, 1, d), op) for k, v, d, op in rows], FEED)


def test_change_feed_latest_wins_and_deletes_drop(spark):
    base = feed(spark, [("a", 1, 1, "I"), ("b", 1, 1, "I"), ("c", 1, 1, "I")])
    changes = feed(spark, [("a", 2, 2, "U"), ("a", 3, 3, "U"), ("b", 2, 2, "U"), ("b", 0, 3, "D"),
                           ("d", 9, 2, "I")])
    out = {r["k"]: r["v"] for r in apply_changes(base, changes, ["k"], ["commit_ts"]).collect()}
    assert out == {"a": 3, "c": 1, "d": 9}


def test_change_feed_is_idempotent_and_order_insensitive(spark):
    base = feed(spark, [("a", 1, 1, "I")])
    late = feed(spark, [("a", 0, 5, "D")])
    early = feed(spark, [("a", 2, 3, "U")])
    s1 = merge_changes(merge_changes(base, late, ["k"], ["commit_ts"]), early, ["k"], ["commit_ts"])
    s2 = merge_changes(merge_changes(base, early, ["k"], ["commit_ts"]), late, ["k"], ["commit_ts"])
    again = merge_changes(s1, late, ["k"], ["commit_ts"])
    assert live(s1).count() == live(s2).count() == live(again).count() == 0


def test_streaming_ingest_equals_batch(spark, tmp_out):
    from tavola.streaming import ingest
    base = feed(spark, [("a", 1, 1, "I"), ("b", 1, 1, "I")])
    changes = feed(spark, [("a", 2, 2, "U"), ("b", 0, 3, "D"), ("c", 5, 2, "I"), ("a", 7, 4, "U")])
    changes.repartition(3).write.parquet(f"{tmp_out}/src")
    ingest.write_initial_state(base, f"{tmp_out}/state", ["k"])
    for _ in range(2):   # second run: nothing new, state unchanged (replay-safe)
        q = ingest.start_ingest(spark, f"{tmp_out}/src", changes.schema, f"{tmp_out}/state", f"{tmp_out}/ckpt",
                                ["k"], ["commit_ts"], max_files_per_trigger=1)
        q.awaitTermination()
    got = {r["k"]: r["v"] for r in ingest.current_rows(spark, f"{tmp_out}/state").collect()}
    want = {r["k"]: r["v"] for r in apply_changes(base, changes, ["k"], ["commit_ts"]).collect()}
    assert got == want == {"a": 7, "c": 5}


def test_replay_after_a_crash_applies_the_whole_batch(spark, tmp_out):
    from tavola.streaming import ingest
    root = f"{tmp_out}/state"
    ingest.write_initial_state(feed(spark, [("a", 1, 1, "I"), ("b", 1, 1, "I")]), root, ["k"], buckets=4)
    batch = feed(spark, [("a", 5, 2, "U"), ("c", 9, 2, "I")])
    # A crash while version 1 was being written: some data, no commit file.
    ingest._with_bucket(batch.limit(1), ["k"], 4).write.partitionBy(ingest.BUCKET).parquet(f"{root}/data/1")
    assert ingest.committed_versions(spark, root) == [0]
    rows = lambda: {r["k"]: r["v"] for r in ingest.current_rows(spark, root).collect()}
    assert rows() == {"a": 1, "b": 1}
    ingest.merge_batch(batch, 0, root, ["k"], ["commit_ts"])
    assert rows() == {"a": 5, "b": 1, "c": 9}
    ingest.merge_batch(feed(spark, [("a", 0, 9, "D")]), 0, root, ["k"], ["commit_ts"])   # committed before: skipped
    assert rows() == {"a": 5, "b": 1, "c": 9}


def test_versions_are_kept_for_a_while_and_only_touched_buckets_rewritten(spark, tmp_out):
    from tavola.streaming import ingest
    root = f"{tmp_out}/state"
    ingest.write_initial_state(feed(spark, [(f"k{i}", i, 1, "I") for i in range(50)]), root, ["k"], buckets=8)
    for n in range(6):
        ingest.merge_batch(feed(spark, [("k7", 100 + n, 2 + n, "U")]), n, root, ["k"], ["commit_ts"], keep=2)
    assert ingest.committed_versions(spark, root) == [5, 6]
    folders = sorted(os.listdir(f"{root}/data"))
    assert folders == ["0", "5", "6"] and len([d for d in os.listdir(f"{root}/data/6") if d.startswith(ingest.BUCKET)]) == 1
    rows = {r["k"]: r["v"] for r in ingest.current_rows(spark, root).collect()}
    assert len(rows) == 50 and rows["k7"] == 105
    assert {r["k"]: r["v"] for r in ingest.read_state(spark, root, 5).collect()}["k7"] == 104


def test_quality_rules_split_and_report(spark):
    from frames import items_frame
    df = items_frame(spark, [("o1", "l1", "u", "2024-01-01", True, "A", "1.00", 1),
                             ("o2", None, "u", "2024-01-01", True, "A", "1.00", 1),
                             ("o3", "l1", "u", None, True, "A", "1.00", 1),
                             ("o4", "l1", "u", "2024-01-01", True, "A", "-1.00", 1),
                             ("o5", "l1", "u", "2024-01-01", True, "A", "1.00", 0)])
    valid, rejected = split_valid(df)
    assert valid.count() == 1 and rejected.count() == 4
    report = {r["outcome"]: r["rows"] for r in dq_report(df).collect()}
    assert report == {"valid": 1, "missing_key": 1, "missing_timestamp": 1, "bad_price": 1, "bad_quantity": 1}


def test_column_profile(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("b", None)], "s string, n int")
    prof = {r["column_name"]: r for r in column_profile(df).collect()}
    assert (prof["s"]["non_null_count"], prof["s"]["null_count"], prof["s"]["unique_values"]) == (3, 1, 2)
    assert (prof["n"]["non_null_count"], prof["n"]["null_count"], prof["n"]["unique_values"]) == (3, 1, 2)
    assert prof["s"]["duplicates"] == 1 and prof["n"]["data_type"] == "int"
    approx = {r["column_name"]: r["unique_values"] for r in column_profile(df, approx=True).collect()}
    assert approx == {"s": 2, "n": 2}


def test_bronze_readers_nested_layout_and_csv(spark, tmp_out):
    from tavola import schemas
    from tavola.sources.bronze import read_csv, read_parquet
    df = spark.createDataFrame([("O1", "L1", "x", 1)], "ORDER_ID string, LINEITEM_ID string, OPTION_NAME string, "
                                                       "OPTION_QUANTITY int")
    df.write.parquet(f"{tmp_out}/opts/2024/01/02")
    got = read_parquet(spark, f"{tmp_out}/opts", schemas.ORDER_ITEM_OPTIONS)
    assert got.columns == [f.name for f in schemas.ORDER_ITEM_OPTIONS.fields]
    r = got.first()
    assert (r["order_id"], r["option_quantity"], r["option_price"]) == ("O1", 1, None)
    os.makedirs(f"{tmp_out}/csv")
    with open(f"{tmp_out}/csv/part.csv", "w") as fh:
        fh.write("ORDER_ID,LINEITEM_ID,OPTION_GROUP_NAME,OPTION_NAME,OPTION_PRICE,OPTION_QUANTITY\n")
        fh.write("o1,l1,g,x,1.50,2\no2,l1,g,y,oops,1\n")
    from tavola.plans.clean import clean_order_item_options
    from tavola.sources.bronze import conform
    opts = clean_order_item_options(conform(read_csv(spark, f"{tmp_out}/csv", schemas.ORDER_ITEM_OPTIONS), schemas.ORDER_ITEM_OPTIONS))
    prices = sorted((r["order_id"], r["option_price"]) for r in opts.collect())
    assert str(prices[0][1]) == "1.50" and prices[1][1] is None


def test_csv_bronze_runs_through_the_pipeline(spark, tmp_out):
    from tavola.plans.pipeline import run_pipeline
    from tavola.sources.bronze import read_bronze
    files = {
        "order_items": ["APP_NAME,RESTAURANT_ID,CREATION_TIME_UTC,ORDER_ID,USER_ID,PRINTED_CARD_NUMBER,IS_LOYALTY,CURRENCY,"
                        "LINEITEM_ID,ITEM_CATEGORY,ITEM_NAME,ITEM_PRICE,ITEM_QUANTITY",
                        "app,R1,2024-01-01T10:00:00.000Z,o1,u1,,True,USD,l1,Cat,Soup,4.50,2",
                        "app,R1,2024-01-01 11:00:00,o1,u1,,1,USD,l2,Cat,Tea,oops,1",
                        "app,R1,2024-01-02 11:00:00,o2,,,false,USD,l1,Cat,Tea,3.00,many",
                        "app,R2,2024-01-02 11:00:00,o3,u2,,0,USD,l1,Cat,Tea,3.00,1", "too,short"],
        "order_item_options": ["ORDER_ID,LINEITEM_ID,OPTION_GROUP_NAME,OPTION_NAME,OPTION_PRICE,OPTION_QUANTITY",
                               "o1,l1,g,x,1.50,2", "o3,l1,g,y,bad,1"],
        "date_dim": ["DATE_KEY,DAY_OF_WEEK,WEEK,MONTH,YEAR,IS_WEEKEND,IS_HOLIDAY,HOLIDAY_NAME", "01-01-2024,Monday,1,January,2024,False,True,New Year"],
    }
    for name, lines in files.items():
        os.makedirs(f"{tmp_out}/bronze/{name}")
        with open(f"{tmp_out}/bronze/{name}/part.csv", "w") as fh:
            fh.write("\n".join(lines) + "\n")
    bronze = read_bronze(spark, f"{tmp_out}/bronze", "csv")
    run_pipeline(spark, bronze, f"{tmp_out}/out")
    sales = spark.read.parquet(f"{tmp_out}/out/silver/sales_fact")
    assert dict(sales.dtypes)["item_total"].startswith("decimal")
    got = sorted((r["order_id"], str(r["item_total"]), str(r["option_total"]), r["is_loyalty"]) for r in sales.collect())
    assert got == [("o1", "9.00", "3.00", True), ("o3", "3.00", "0.00", False)]
    reasons = sorted(r["reject_reason"] for r in spark.read.parquet(f"{tmp_out}/out/quarantine/order_items").collect())
    assert reasons == ["bad_price", "bad_quantity"]
    assert [r["line"] for r in spark.read.parquet(f"{tmp_out}/out/quarantine/corrupt").collect()] == ["too,short"]
    assert spark.read.parquet(f"{tmp_out}/out/silver/date_dim").first()["is_holiday"] is True


def test_quarantine_and_silver_hold_every_line_once(spark, tmp_out):
    from frames import items_frame, options_frame
    from tavola.plans.pipeline import clean_job
    from tavola.sources.bronze import Bronze
    rows = [("o1", "l1", "u", "2024-01-01", True, "A", "1.00", 1), ("o2", None, "u", "2024-01-01", True, "A", "1.00", 1),
            ("o3", "l1", "u", None, True, "A", "1.00", 1), ("o4", "l1", "u", "2024-01-01", True, "A", "-1.00", 1)]
    dates = spark.createDataFrame([], "date_key string, day_of_week string, week int, month string, year int, is_weekend boolean,"
                                      " is_holiday boolean, holiday_name string")
    bronze = Bronze(items_frame(spark, rows), options_frame(spark, []), dates)
    paths = clean_job(spark, bronze, tmp_out, source_tz="Europe/Berlin")
    sales, rejected = (spark.read.parquet(paths[k]) for k in ("sales_fact", "quarantine"))
    assert sales.count() + rejected.count() == len(rows) and rejected.count() == 3
    assert sales.first()["creation_time_utc"] == dt.datetime(2024, 1, 1, 11)


def test_no_stale_rows_and_nothing_left_persisted(spark, tmp_out):
    import shutil
    from tavola.plans.registry import all_queries
    for name in ("lineitem", "orders", "customer", "part"):
        shutil.copy(f"{SF0001}/{name}.parquet", f"{tmp_out}/{name}.parquet")
    run = lambda: sorted(map(str, all_queries()["sales_fact_dedup_options"](spark, tmp_out).collect()))
    before = run()
    import pyarrow.parquet as pq
    lines = pq.read_table(f"{SF0001}/lineitem.parquet")
    os.chmod(f"{tmp_out}/lineitem.parquet", 0o644)
    pq.write_table(lines.slice(0, lines.num_rows // 3), f"{tmp_out}/lineitem.parquet")
    spark.catalog.refreshByPath(tmp_out)
    after = run()
    assert 0 < len(after) < len(before)
    fresh = all_queries()["sales_fact_dedup_options"](spark.newSession(), tmp_out)
    assert after == sorted(map(str, fresh.collect()))
    all_queries()["customer_rolling_metrics"](spark, tmp_out).count()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_hot_line_is_salted_without_losing_rows(spark):
    from tavola.operators.joins import hot_keys, left_join_fanout
    left = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4)], "k string, v int")
    right = spark.createDataFrame([("a", i) for i in range(500)] + [("b", 1), (None, 9), ("d", 7)], "k string, o int")
    plain = sorted(map(str, left_join_fanout(left, right, ["k"]).collect()))
    salted = sorted(map(str, left_join_fanout(left, right, ["k"], hot_keys(right, ["k"], 50)).collect()))
    assert plain == salted and len(plain) == 503


def test_pipeline_writes_partitioned_silver_and_gold(spark, tmp_out):
    from tavola.plans.pipeline import run_pipeline
    from tavola.schemas import GOLD_TABLES
    from tavola.sources import sinks, star
    times = run_pipeline(spark, star.bronze(spark, SF0001), tmp_out)
    assert set(times) == {"clean_job", "metrics_job"}
    for name in GOLD_TABLES:
        assert spark.read.parquet(f"{tmp_out}/gold/{name}").count() > 0
    sales = sinks.read_silver(spark, f"{tmp_out}/silver/sales_fact", "2000-01-01", "2000-01-31")
    plan = sales._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_date" in plan
    assert sales.count() == spark.read.parquet(f"{tmp_out}/silver/sales_fact") \
        .filter(F.col("order_date").between("2000-01-01", "2000-01-31")).count()
    trends = spark.read.parquet(f"{tmp_out}/gold/location_sales_trends")
    silver_rev = spark.read.parquet(f"{tmp_out}/silver/sales_fact").agg(F.sum("total_line_item_revenue")).first()[0]
    assert trends.agg(F.sum("daily_revenue")).first()[0] == silver_rev
    ci = spark.read.parquet(f"{tmp_out}/gold/customer_intelligence")
    seg = ci.groupBy("segment").count().agg(F.sum("count")).first()[0]
    assert seg == ci.count()


def test_compaction_rewrites_to_new_path(spark, tmp_out):
    from tavola.sources.sinks import compact
    spark.range(100).repartition(10).write.parquet(f"{tmp_out}/many")
    compact(spark, f"{tmp_out}/many", f"{tmp_out}/few", 2)
    files = [f for f in os.listdir(f"{tmp_out}/few") if f.endswith(".parquet")]
    assert len(files) == 2 and spark.read.parquet(f"{tmp_out}/few").count() == 100


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "segment" in df.columns
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs) and len(qs) >= 60


def test_register_gold_tables_for_sql(spark, tmp_out):
    from tavola.sources.sinks import register_tables, write_table
    write_table(spark.createDataFrame([("R1", 2.0), ("R2", 3.0)], "restaurant_id string, v double"),
                f"{tmp_out}/t_demo")
    register_tables(spark, tmp_out, ["t_demo"], cache=True)
    assert spark.sql("SELECT sum(v) AS s FROM t_demo").first()["s"] == 5.0
    assert spark.catalog.isCached("t_demo")
    spark.catalog.uncacheTable("t_demo")


def test_partitioned_write_splits_a_hot_day(spark, tmp_out):
    import datetime as _dt
    from tavola.sources.sinks import write_partitioned
    hot = [(_dt.date(2024, 1, 1), i) for i in range(4000)]
    small = [(_dt.date(2024, 1, d), i) for d in range(2, 12) for i in range(10)]
    df = spark.createDataFrame(hot + small, "order_date date, v int")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    try:
        write_partitioned(df.repartition(16), f"{tmp_out}/t", "order_date")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = lambda d: [f for f in os.listdir(f"{tmp_out}/t/order_date={d}") if f.endswith(".parquet")]
    assert len(files("2024-01-01")) >= 3                      # the hot day is written by several tasks
    assert all(len(files(f"2024-01-{d:02d}")) == 1 for d in range(2, 12))   # small days stay in one file
    assert spark.read.parquet(f"{tmp_out}/t").count() == 4100


def test_schema_drift_is_tolerated(spark, tmp_out):
    from tavola import schemas
    from tavola.sources.bronze import read_parquet
    spark.createDataFrame([("o1", "l1", "x")], "order_id string, lineitem_id string, option_name string") \
        .write.parquet(f"{tmp_out}/drift/part=a")
    spark.createDataFrame([("o2", "l1", "y", 2)], "ORDER_ID string, LINEITEM_ID string, OPTION_NAME string, "
                                                    "OPTION_QUANTITY int").write.parquet(f"{tmp_out}/drift/part=b")
    got = read_parquet(spark, f"{tmp_out}/drift", schemas.ORDER_ITEM_OPTIONS, merge_schema=True)
    rows = sorted((r["order_id"], r["option_quantity"]) for r in got.collect())
    assert rows == [("o1", None), ("o2", 2)]


def test_compaction_of_a_partitioned_table(spark, tmp_out):
    import datetime as _dt
    from tavola.sources.sinks import compact
    df = spark.createDataFrame([(_dt.date(2024, 1, 1 + i % 3), i) for i in range(90)], "order_date date, v int")
    df.repartition(9).write.partitionBy("order_date").parquet(f"{tmp_out}/many")
    compact(spark, f"{tmp_out}/many", f"{tmp_out}/few", 3, partition_by="order_date")
    for d in range(1, 4):
        files = [f for f in os.listdir(f"{tmp_out}/few/order_date=2024-01-0{d}") if f.endswith(".parquet")]
        assert len(files) == 1
    assert spark.read.parquet(f"{tmp_out}/few").count() == 90
