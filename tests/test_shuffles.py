"""Shuffles the table queries do without: work that grew faster than the tables."""

import pytest
from conftest import SF0001
from frames import items_frame, options_frame, ts
from pyspark.sql import functions as F

from tavola.operators import cdc
from tavola.plans import clean as C
from tavola.plans import incremental as I
from tavola.plans import layout, tablework
from tavola.plans.registry import bronze
from tavola.schemas import ITEM_KEYS
from tavola.sources import star
from tavola.streaming import ingest


@pytest.fixture()
def no_broadcast(spark):
    """Plans as over large tables: every join shuffles unless its sides lie alike."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in zip(keys, ("-1", "false")):
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_silver_shuffles_lines_by_part_and_by_order_only(spark, no_broadcast):
    """F7-F11, F13-F17: part, order, customer and option joins and the dedup take 7 shuffles, 3 of them of lines or options."""
    sales = C.clean(bronze(spark, SF0001))[0]
    plan = sales._jdf.queryExecution().executedPlan().toString()
    assert _exchanges(sales) == 7, plan
    assert "hashpartitioning(l_custkey" not in plan and plan.count("hashpartitioning(l_partkey") == 1


def test_reordered_items_keep_rows_of_the_plain_joins(spark):
    li, o, c, p = (star.read_table(spark, SF0001, t) for t in ("lineitem", "orders", "customer", "part"))
    want = (li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey).join(p, li.l_partkey == p.p_partkey)
            .select(F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), "p_name", "o_orderpriority",
                    F.col("l_quantity").cast("int"), "l_extendedprice"))
    got = star.order_items(spark, SF0001).select("order_id", "lineitem_id", "item_name", "app_name", "item_quantity", "l_extendedprice")
    assert got.exceptAll(want.toDF(*got.columns)).count() == 0 and got.count() == want.count()


@pytest.mark.parametrize("reduce", [False, True])
def test_merge_dealt_by_bucket_shuffles_the_state_once(spark, no_broadcast, reduce):
    """merge and write share one shuffle; the rows are those of the plain merge, null keys and late changes included."""
    row = "k string, v int, op string, b int"
    state = spark.createDataFrame([("a", 1, "I", 0), ("b", 5, "I", 1), (None, 1, "I", 0)], row)
    new = spark.createDataFrame([("a", 2, "U", 0), ("a", 3, "D", 0), ("b", 4, "U", 1), (None, 2, "U", 0), ("c", 1, "U", 1)], row)
    got = cdc.merge_changes(state, new, ["k"], ["v"], deal_by="b", reduce=reduce)
    assert sorted(map(str, got.collect())) == sorted(map(str, cdc.merge_changes(state, new, ["k"], ["v"]).collect()))
    assert _exchanges(got) == (2 if reduce else 1)


def test_feed_lands_in_enough_files_for_its_batches(spark, tmp_out):
    """a feed of several tasks lands as they write it; one of a single task is dealt over files."""
    many = spark.range(100).repartition(6)
    one = spark.range(100).coalesce(1)
    for df, dealt in ((many, False), (one, True)):
        source, files = tablework._land(df, f"{tmp_out}/{dealt}")
        assert files >= tablework.FEED_BATCHES and source.endswith("dealt") == dealt
        assert spark.read.parquet(source).count() == 100


def test_buckets_are_small_enough_for_a_task():
    """three buckets a gigabyte left most cores idle."""
    assert layout.BUCKET_BYTES <= 64 << 20 and ingest.BUCKET_BYTES <= 64 << 20


def test_divided_is_touched_and_untouched(spark):
    """one written join gives both parts, lines with null keys stay among the untouched."""
    lines = spark.createDataFrame([("o1", "l1", 1), ("o1", "l2", 2), (None, "l1", 3)], "order_id string, lineitem_id string, v int")
    changes = spark.createDataFrame([("o1", "l2"), ("o1", "l2"), (None, "l1")], "order_id string, lineitem_id string")
    parts = I.divided(lines, changes)
    for got, want in zip(parts, (I.touched(lines, changes), I.untouched(lines, changes))):
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert [p.columns for p in parts] == [lines.columns] * 2 and list(ITEM_KEYS) == ["order_id", "lineitem_id"]


def test_signed_sales_join_the_options_once(spark, no_broadcast):
    """old and new lines meet the options in one join."""
    items = C.clean_order_items(items_frame(spark, [("o1", "l1", "u", "2024-01-01", True, "A", "5.00", 2)]))
    lines = tablework.change_base(items, *I.GROUP)
    options = C.clean_order_item_options(options_frame(spark, [("o1", "l1", "x", "1.00", 1)]))
    signed = I.signed_sales(lines, lines.withColumn("commit_ts", F.lit(ts("2024-02-01"))), options)
    assert signed._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin") == 1
    assert sorted((r["sign"], float(r["total_line_item_revenue"])) for r in signed.collect()) == [(-1, 11.0), (1, 11.0)]


def test_drift_and_profile_read_their_items_once(spark, monkeypatch):
    """the two folders and the exact counts come from one written table, not from the joins again."""
    from tavola.plans import loads
    for module, name, query in ((tablework, "drift-items", "parquet_drift_items"), (loads, "drift-items", "drift_rescued"),
                                (loads, "profiled", "profile_two_loads")):
        written = []
        plain = module.materialize
        monkeypatch.setattr(module, "materialize", lambda df, label="table", _p=plain: (written.append(label), _p(df, label))[1])
        from tavola.plans.registry import all_queries
        all_queries()[query](spark, SF0001)
        monkeypatch.setattr(module, "materialize", plain)
        assert written.count(name) == 1, query


def test_loads_of_a_month_keep_orders_together(spark, monkeypatch):
    """an order's rows lie in one load, so they are shuffled and written next to each other."""
    seen = {}
    monkeypatch.setattr(tablework.sinks, "compact_partitions", lambda s, path, part: seen.update(path=path, part=part))
    tablework.q_compacted_days(spark, SF0001)
    got = spark.read.parquet(seen["path"]).withColumn("_f", F.input_file_name())
    files = got.filter(F.year("order_date") % 2 == 1).groupBy("order_id", seen["part"]).agg(F.count_distinct("_f").alias("n"))
    assert files.agg(F.max("n")).first()[0] == 1
