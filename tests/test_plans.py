"""Plan-level guards: no single-partition exchange in the Gold plans, pruned scans."""

from conftest import SF0001


def _executed(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_gold_plans_have_no_single_partition_exchange(spark, tmp_out):
    from tavola.plans import metrics as M
    from tavola.plans.pipeline import clean_job
    from tavola.sources import star
    paths = clean_job(spark, star.bronze(spark, SF0001), tmp_out)
    sales = spark.read.parquet(paths["sales_fact"])
    for name, df in M.gold(sales).items():
        plan = _executed(df)
        assert "SinglePartition" not in plan, name
        # every scan of Silver reads a pruned column set, never all 22 columns
        for line in plan.splitlines():
            if "FileScan parquet" in line and "sales_fact" in line:
                cols = line.split("FileScan parquet [", 1)[1].split("]", 1)[0].split(",")
                assert len(cols) < 12, (name, cols)


def test_trends_scan_each_bronze_table_once_and_only_what_they_need(spark):
    from tavola.plans.registry import all_queries
    plan = _executed(all_queries()["location_sales_trends"](spark, SF0001))
    final = plan.split("== Initial Plan ==")[0]
    scans = [line for line in final.splitlines() if "FileScan parquet" in line]
    tables = sorted(line.split(SF0001)[1].split(".parquet")[0].strip("/") for line in scans)
    # Order lines and their options both come from lineitem here; the lines with a null key are a filtered second branch.
    assert tables.count("orders") <= 2 and tables.count("part") <= 2
    for unused in ("o_orderpriority", "c_name", "c_mktsegment"):
        assert unused not in "".join(scans)


def test_written_silver_is_read_by_partition(spark, tmp_out):
    from tavola.plans.registry import sales
    from tavola.sources import sinks
    sinks.write_partitioned(sales(spark, SF0001), f"{tmp_out}/s", "order_date")
    plan = _executed(sinks.read_silver(spark, f"{tmp_out}/s", "2000-01-01", "2000-01-31"))
    assert "PartitionFilters: [isnotnull(order_date" in plan
