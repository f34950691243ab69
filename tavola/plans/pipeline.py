"""End-to-end batch: Bronze → Silver (written) → Gold (written).

The Silver write is the lineage cut between the two jobs: Gold reads the
written ``sales_fact`` back, so a lost executor during the metrics job
never sends work back to the raw tables.

usage: python -m tavola.plans.pipeline --star DIR --out DIR   (driver's star tables)
       python -m tavola.plans.pipeline --bronze DIR --out DIR [--csv]
"""

from __future__ import annotations

import argparse
import datetime as _dt
import time
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators.joins import hot_keys
from ..operators.materialize import materialize
from ..operators.quality import observed, split_valid
from ..schemas import GOLD_TABLES, ITEM_KEYS
from ..sources import sinks, star
from ..sources.bronze import lower_case_columns, read_bronze
from . import clean as C
from . import metrics as M


METRICS = "rows long, without_option long, revenue decimal(38,2), first_date date, last_date date"


def clean_job(spark: SparkSession, bronze, out: str, legacy_format: bool = False, quarantine: bool = True,
              source_tz: str | None = None) -> dict[str, str]:
    """Job 1: write Silver ``sales_fact`` (partitioned by order_date), ``date_dim`` and the quarantine.

    Order lines that break a quality rule go to ``quarantine/order_items`` with
    their reason and stay out of Silver (``quarantine=False`` lets them in, as
    the source pipeline does); text lines that did not parse go to
    ``quarantine/corrupt``. ``source_tz`` names the zone of the recorded times.
    ``silver/metrics`` holds the rows, rows without an option, revenue and date
    range of ``sales_fact``, gathered while it was written.
    """
    paths = {"sales_fact": f"{out}/silver/sales_fact", "date_dim": f"{out}/silver/date_dim"}
    items = lower_case_columns(bronze.order_items)
    if source_tz:
        items = C.to_utc_times(items, source_tz)
    if quarantine:
        items, rejected = split_valid(items)
        paths["quarantine"] = f"{out}/quarantine/order_items"
        sinks.write_table(rejected.drop(*bronze.drop_after_dedup), paths["quarantine"])
        if bronze.corrupt is not None:
            paths["corrupt"] = f"{out}/quarantine/corrupt"
            sinks.write_table(bronze.corrupt, paths["corrupt"])
    hot = materialize(hot_keys(lower_case_columns(bronze.order_item_options), ITEM_KEYS), "hot-lines")
    sales, dates = C.clean(replace(bronze, order_items=items), hot=hot)
    sales, seen = observed(sales, "sales_fact", rows=F.count(F.lit(1)), without_option=F.count_if(F.col("option_name").isNull()),
                           revenue=F.sum("total_line_item_revenue"), first_date=F.min("order_date"), last_date=F.max("order_date"))
    sinks.write_partitioned(sales, paths["sales_fact"], "order_date", legacy_format=legacy_format)
    sinks.write_table(dates, paths["date_dim"], legacy_format=legacy_format)
    paths["metrics"] = f"{out}/silver/metrics"
    sinks.write_table(spark.createDataFrame([seen.get], METRICS), paths["metrics"])
    return paths


def metrics_job(spark: SparkSession, silver_sales: str, out: str, as_of: _dt.date | None = None) -> dict[str, str]:
    """Job 2: the five Gold tables from written Silver."""
    sales = spark.read.parquet(silver_sales)
    tables = M.gold(sales, as_of)
    paths = {}
    for name in GOLD_TABLES:
        path = f"{out}/gold/{name}"
        if name == "location_sales_trends":
            sinks.write_partitioned(tables[name], path, "order_date")
        else:
            sinks.write_table(tables[name], path)
        paths[name] = path
    return paths


def run_pipeline(spark: SparkSession, bronze, out: str, as_of: _dt.date | None = None) -> dict[str, float]:
    """Both jobs; returns wall time per job in seconds."""
    t0 = time.perf_counter()
    silver = clean_job(spark, bronze, out)
    t1 = time.perf_counter()
    metrics_job(spark, silver["sales_fact"], out, as_of)
    t2 = time.perf_counter()
    return {"clean_job": t1 - t0, "metrics_job": t2 - t1}


def main(argv=None) -> None:
    ap = argparse.ArgumentParser()
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--star", help="directory of the star-schema parquet tables")
    src.add_argument("--bronze", help="directory with order_items/, order_item_options/, date_dim/")
    ap.add_argument("--csv", action="store_true", help="Bronze is CSV with a header")
    ap.add_argument("--load", choices=("latest", "all"), default="latest",
                    help="of tables in date folders, read the newest complete load or all of them")
    ap.add_argument("--out", required=True)
    ap.add_argument("--as-of", help="reference date YYYY-MM-DD (default: latest order date)")
    args = ap.parse_args(argv)
    from ..session import get_session
    spark = get_session()
    bronze = star.bronze(spark, args.star) if args.star else read_bronze(spark, args.bronze,
                                                                        "csv" if args.csv else "parquet", args.load)
    as_of = _dt.date.fromisoformat(args.as_of) if args.as_of else None
    print(run_pipeline(spark, bronze, args.out.rstrip("/"), as_of))


if __name__ == "__main__":
    main()
