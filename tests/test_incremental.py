"""Gold kept current from the change feed: equal to a rebuild, and only touched partitions read and written."""

import datetime as dt
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from frames import options_frame
from tavola.operators.materialize import materialize
from tavola.plans import clean as C
from tavola.plans import incremental as I
from tavola.plans import metrics as M
from tavola.schemas import ITEM_KEYS

ORDER = ("commit_ts", "seq")
VERSION = ["item_name", "item_price", "item_quantity", "commit_ts", "seq", "op"]
LINE = ("order_id string, lineitem_id string, order_date date, restaurant_id string, item_category string, item_name string, "
        "item_price decimal(12,2), item_quantity int, commit_ts timestamp, seq int, op string")
CHANGE = ("order_id string, lineitem_id string, item_name string, item_price decimal(12,2), item_quantity int, commit_ts timestamp, "
          "seq int, op string")
T0 = dt.datetime(2024, 1, 1)


def line(order, no, day, price="2.00", qty=1, rest="R1", cat="c"):
    return (order, no, day and dt.date.fromisoformat(day), rest, cat, "n", price and Decimal(price), qty, T0, 0, "I")


def change(order, no, at, price="5.00", qty=1, op="U"):
    return (order, no, "n", price and Decimal(price), qty, T0 + dt.timedelta(days=at), 1, op)


def rebuilt(lines, options):
    return sorted(map(str, M.location_sales_trends(I.line_sales(lines, options)).collect()))


def stepped(view, spark, lines, changes, options, batch):
    after = materialize(I.next_lines(lines, changes, ORDER, VERSION))
    done = view.apply(I.signed_sales(I.touched(lines, changes), after, options), batch)
    return materialize(I.untouched(lines, changes).unionByName(after)), done


def files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


@pytest.mark.parametrize("grain", [None, "month"])
def test_batches_equal_a_rebuild(spark, tmp_out, grain):
    rng = random.Random(3)
    days = ["2024-01-30", "2024-01-31", "2024-02-01", "2024-03-05", None]
    rows = [line(f"o{i // 3}", f"l{i % 3}", days[(i // 3) % 5], rng.choice(["0.00", "2.50", None]), rng.randint(1, 3), rng.choice(["R1", "R2", None]),
                 rng.choice(["c", "d"])) for i in range(60)]
    lines = spark.createDataFrame(rows, LINE)
    options = C.clean_order_item_options(options_frame(spark, [(f"o{i}", f"l{i % 3}", "x", "1.00", 1) for i in range(20)]
                                                       + [(f"o{i}", "l0", "y", None, 2) for i in range(0, 20, 4)]))
    view = I.TrendView(f"{tmp_out}/view", grain)
    view.create(I.line_sales(lines, options))
    assert sorted(map(str, view.read(spark).collect())) == rebuilt(lines, options)
    for batch in range(3):
        feed = [change(f"o{rng.randrange(20)}", f"l{rng.randrange(3)}", 1 + batch, rng.choice(["0.00", "9.99", None]), 1, rng.choice("UUD"))
                for _ in range(15)]
        feed += feed[:3]   # repeated changes
        lines, _ = stepped(view, spark, lines, spark.createDataFrame(feed, CHANGE), options, batch)
        assert sorted(map(str, view.read(spark).collect())) == rebuilt(lines, options)


def test_untouched_days_are_neither_read_nor_written(spark, tmp_out):
    lines = spark.createDataFrame([line(f"o{d}", k, f"2024-01-{d:02d}") for d in range(1, 9) for k in ("a", "b")], LINE)
    options = C.clean_order_item_options(options_frame(spark, []))
    view = I.TrendView(f"{tmp_out}/view")
    view.create(I.line_sales(lines, options))
    before = files(tmp_out)
    changes = spark.createDataFrame([change("o3", "a", 1), change("o5", "a", 1, op="D"), change("o5", "b", 1, op="D"),
                                     change("o7", "a", 1, "2.00")], CHANGE)   # the last one changes nothing
    lines, done = stepped(view, spark, lines, changes, options, 0)
    assert sorted(done) == [dt.date(2024, 1, 3), dt.date(2024, 1, 5)]
    after = files(tmp_out)
    gone = {f.split("order_date=")[1][:10] for f in before if f not in after}
    assert gone == {"2024-01-03", "2024-01-05"} and {f: t for f, t in before.items() if f in after} == {f: t for f, t in after.items() if f in before}
    assert sorted(map(str, view.read(spark).collect())) == rebuilt(lines, options)   # the emptied day is gone
    plan = view.read_orders(spark, done)
    plan.collect()
    assert "PartitionFilters: [order_date" in plan._jdf.queryExecution().executedPlan().toString()


def test_a_batch_applied_again_changes_nothing(spark, tmp_out):
    lines = spark.createDataFrame([line("o1", "a", "2024-01-01"), line("o2", "a", "2024-01-02")], LINE)
    options = C.clean_order_item_options(options_frame(spark, []))
    view = I.TrendView(f"{tmp_out}/view")
    view.create(I.line_sales(lines, options))
    changes = spark.createDataFrame([change("o1", "a", 1), change("o2", "a", 1, op="D")], CHANGE)
    after = materialize(I.next_lines(lines, changes, ORDER, VERSION))
    signed = I.signed_sales(I.touched(lines, changes), after, options)
    # A run that failed after one of the two days.
    view.apply(signed.filter("order_id = 'o1'"), 0)
    assert view.apply(signed, 0) == [dt.date(2024, 1, 2)]
    want = rebuilt(after, options)
    assert sorted(map(str, view.read(spark).collect())) == want
    assert view.apply(signed, 0) == [] and sorted(map(str, view.read(spark).collect())) == want


def test_the_stream_keeps_the_view_current(spark, tmp_out):
    from tavola.streaming import ingest
    lines = spark.createDataFrame([line(f"o{i}", "a", f"2024-01-0{1 + i % 4}") for i in range(12)], LINE)
    options = C.clean_order_item_options(options_frame(spark, [("o1", "a", "x", "1.00", 1)]))
    changes = spark.createDataFrame([change(f"o{i}", "a", 1 + k, f"{i + k}.00", op="D" if i + k == 5 else "U")
                                     for k in range(2) for i in range(k, 8)], CHANGE)
    for k in range(2):
        changes.filter(F.col("commit_ts") == T0 + dt.timedelta(days=1 + k)).coalesce(1).write.mode("append").parquet(f"{tmp_out}/source")
    view = I.TrendView(f"{tmp_out}/view")
    view.create(I.line_sales(lines, options))
    ingest.write_initial_state(lines, f"{tmp_out}/state", ITEM_KEYS, buckets=4)
    ingest.start_ingest(spark, f"{tmp_out}/source", changes.schema, f"{tmp_out}/state", f"{tmp_out}/checkpoint", ITEM_KEYS, ORDER,
                        max_files_per_trigger=1, merge=I.feed_merge(ORDER, VERSION), on_merged=I.feed_refresh(view, options)).awaitTermination()
    assert len(ingest.committed_versions(spark, f"{tmp_out}/state")) == 3
    want = rebuilt(I.untouched(lines, changes).unionByName(I.next_lines(lines, changes, ORDER, VERSION)), options)
    assert sorted(map(str, view.read(spark).collect())) == want
    # Lines that the feed brings whole, into buckets that hold nothing yet.
    new = spark.createDataFrame([line(f"new{i}", "z", "2024-02-01", f"{i}.00") for i in range(9)], LINE)
    ingest.merge_batch(new, 2, f"{tmp_out}/state", ITEM_KEYS, ORDER, merge=I.feed_merge(ORDER, VERSION), on_merged=I.feed_refresh(view, options))
    got = [r for r in view.read(spark).collect() if r["order_date"] == dt.date(2024, 2, 1)]
    assert [(r["daily_revenue"], r["daily_order_count"]) for r in got] == [(Decimal("36.00"), 9)]


def test_state_buckets_follow_its_size(spark, tmp_out):
    from tavola.streaming import ingest
    rows = lambda a, b, v: spark.range(a, b).selectExpr("CAST(id AS string) AS k", f"{v} AS v", f"timestamp'2024-01-0{v} 00:00:00' AS commit_ts", "'U' AS op")
    root = f"{tmp_out}/state"
    ingest.write_initial_state(rows(0, 40, 1), root, ["k"], bucket_bytes=1000)
    store = ingest.StateStore(spark, root)
    sizes = [store.read_commit(0)["buckets"]]
    for n in range(4):
        ingest.merge_batch(rows(0, 40 * 8 ** (n + 1) if n < 2 else 3, n + 2), n, root, ["k"], ["commit_ts"], bucket_bytes=1000)
        sizes.append(store.read_commit(n + 1)["buckets"])
    assert sizes == sorted(sizes) and sizes[-1] > sizes[0] and sizes[-1] & (sizes[-1] - 1) == 0
    got = {r["k"]: r["v"] for r in ingest.read_state(spark, root).collect()}
    assert len(got) == 40 * 64 and {got["0"], got["2"]} == {5} and got["3"] == 3 and got["2559"] == 3
