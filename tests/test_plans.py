"""The physical plans are the ones meant: scans, shuffles, broadcasts."""

import re

import pytest
from pyspark.sql import functions as F

from twintally import CountCheck, batch_row_count, content_check, row_count_check, rows_missing, windowed_row_count
from twintally.catalogue import QUERIES
from twintally.functions import render_column, truncate


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def final_plan(frame):
    """The plan that ran, after adaptive execution."""
    execution = frame._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    return execution.executedPlan().toString().split("+- == Initial Plan ==")[0]


def shuffles(text):
    return len(re.findall(r"Exchange (hashpartitioning|RoundRobin|rangepartitioning)", text))


def scans(text):
    return len(re.findall(r"FileScan", text))


@pytest.fixture
def orders(spark, small_dir):
    return spark.read.parquet(f"{small_dir}/orders.parquet")


def test_counts_read_no_column_and_shuffle_nothing_but_totals(orders):
    text = plan(row_count_check(orders, orders, 5))
    assert text.count("ReadSchema: struct<>") == scans(text) == 2
    assert shuffles(text) == 0 and text.count("SinglePartition") == 1
    assert "Join" not in text


def test_windows_read_the_time_only(orders):
    text = plan(windowed_row_count(orders, orders, 5, "daily", "o_orderdate"))
    assert text.count("ReadSchema: struct<o_orderdate:timestamp_ntz>") == scans(text) == 2
    assert shuffles(text) == 1 and "partial_sum" in text and "Join" not in text


def test_a_batch_shares_one_shuffle(orders):
    checks = [CountCheck(str(i), orders, orders.filter(f"o_custkey > {i}"), 0) for i in range(5)]
    text = plan(batch_row_count(checks))
    assert scans(text) == 10 and shuffles(text) == 1 and "partial_sum" in text


@pytest.mark.parametrize("how", [{}, {"key": "full"}, {"mode": "typed"}, {"multiset": True}])
def test_contents_take_one_scan_a_side_and_one_shuffle(orders, how):
    text = plan(content_check(orders, orders.filter("o_custkey > 9"), **how))
    assert scans(text) == 2 and shuffles(text) == 1
    before, after = text.split("Exchange hashpartitioning")
    assert "partial_sum" in after  # equal rows are added up before the shuffle
    assert "Join" not in text and "Sort" not in text


def test_rows_take_one_shuffle(orders):
    text = plan(rows_missing(orders, orders.filter("o_custkey > 9")))
    assert scans(text) == 2 and shuffles(text) == 1 and "Join" not in text


def test_chosen_columns_only_are_read(orders):
    text = plan(content_check(orders, orders, columns=["o_orderkey", "o_custkey"]))
    assert text.count("ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>") == 2


def test_narrowing_broadcasts_few_buckets(orders):
    text = final_plan(rows_missing(orders, orders.filter("o_custkey > 9"), buckets=1 << 10))
    assert text.count("BroadcastHashJoin") == 2
    assert scans(text) == 4


def test_narrowed_counts_come_from_the_checksums(spark, orders, tmp_path):
    path = str(tmp_path / "csv")
    orders.write.csv(path)
    text = spark.read.schema(orders.schema).csv(path)
    ran = final_plan(content_check(text, text.filter("o_custkey > 9"), buckets=1 << 10))
    assert scans(ran) == 4 and "ReusedExchange" in ran


def test_narrowing_shuffles_no_row_of_equal_tables(orders):
    frame = rows_missing(orders, orders.repartition(3), buckets=1 << 10)
    assert frame.count() == 0
    text = final_plan(frame)
    # nothing differs, so adaptive execution sees an empty broadcast and drops the second pass
    assert "concat_ws" not in text or "EmptyRelation" in text or "LocalTableScan <empty>" in text


def test_filters_reach_the_scan(orders):
    text = plan(row_count_check(orders.filter("o_orderstatus = 'F'"), orders, 5))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in text
    assert "ReadSchema: struct<o_orderstatus:string>" in text


def test_time_columns_stay_in_the_jvm(spark, small_dir):
    events = spark.read.parquet(f"{small_dir}/events.parquet")
    text = plan(events.select(truncate(F.col("ts"), "hourly"), render_column(F.col("ts"), "%Y-%m-%d %B %f")))
    assert "*(1) Project" in text and "Python" not in text and "Exchange" not in text


def test_a_dated_path_reads_one_folder(spark, small_dir):
    files = QUERIES["scan_templated_path"](spark, small_dir).inputFiles()
    assert files and all("/month=199506/" in file for file in files)


def test_no_query_uses_python_tasks_or_cross_joins(spark, small_dir):
    for name, build in QUERIES.items():
        text = plan(build(spark, small_dir))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
        assert not re.search(r"Python|Pandas", text), name
