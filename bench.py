"""Headline queries, timed. Prints one JSON line.

Each query is run to completion once to warm up and then three times; its time is
the median. ``plain_shape`` is for comparison only: the same content check written
as two counts and two distinct-subtract-counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twintally.catalogue import QUERIES
from twintally.catalogue.tables import lineitem_target, table

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3

HEADLINE = (
    "row_count_check",
    "windowed_row_count_monthly",
    "windowed_row_count_daily",
    "windowed_row_count_hourly",
    "batch_row_count",
    "content_check",
    "content_check_lineitem",
    "content_check_lineitem_typed",
    "content_check_narrowed",
    "content_check_tree",
    "content_check_multiset",
    "content_check_documents",
    "content_check_same_table",
    "content_missing_in_target",
    "content_extra_in_target",
    "content_missing_typed",
    "distinct_fingerprints",
    "row_fingerprint_documents",
    "truncate_hourly",
    "process_time",
    "render_template",
    "scan_parquet",
    "scan_csv",
    "scan_csv_multiline",
    "summary_log_append",
    "check_run_content",
)


def finish(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def plain_shape(spark: SparkSession) -> None:
    source = table(spark, SF_DIR, "lineitem")
    target = lineitem_target(source)
    left, right = (side.select(F.concat_ws("||", "*").alias("row")).distinct() for side in (source, target))
    source.count(), target.count(), left.subtract(right).count(), right.subtract(left).count()


def timed(run) -> float:
    times = []
    for _ in range(RUNS + 1):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[1:]), 4)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        # The files are small: without this a scan is cut into fewer tasks than there are cores.
        .config("spark.sql.files.openCostInBytes", "64k")
        .config("spark.sql.files.maxPartitionBytes", "2m")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds = {name: timed(lambda name=name: finish(QUERIES[name](spark, SF_DIR))) for name in names}
    result = {
        "metric": "total seconds of the headline queries, median of three runs each",
        "value": round(sum(seconds.values()), 4),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "plain_shape": {"content_check_lineitem": timed(lambda: plain_shape(spark))},
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
