import pytest
from pyspark.sql import functions as F

from twintally import CountCheck, batch_row_count, row_count_check, windowed_row_count


def verdict(source, target, threshold):
    return tuple(row_count_check(source, target, threshold).first())


def test_fields_and_types(spark):
    assert row_count_check(spark.range(1), spark.range(1), 0).dtypes == [
        ("count_source", "bigint"), ("count_target", "bigint"), ("count_diff", "bigint"),
        ("percentage_diff", "double"), ("threshold", "int"), ("is_passed", "boolean"),
    ]


@pytest.mark.parametrize(
    ("source", "target", "threshold"), [(100, 95, 5), (100, 105, 5), (100, 94, 5), (7, 6, 14), (3, 3, 0), (3, 1, 66)]
)
def test_percentage_is_that_of_python(spark, source, target, threshold):
    percentage = abs(source - target) / source * 100
    expected = (source, target, abs(source - target), percentage, threshold, percentage <= threshold)
    assert verdict(spark.range(source), spark.range(target), threshold) == expected


def test_bound_is_inclusive_and_relative_to_the_source(spark):
    assert verdict(spark.range(100), spark.range(95), 5)[-1] is True
    assert verdict(spark.range(95), spark.range(100), 5)[-1] is False


def test_empty_source(spark):
    none = spark.range(0)
    assert verdict(none, spark.range(2), 100) == (0, 2, 2, None, 100, False)
    assert verdict(none, none, 0) == (0, 0, 0, None, 0, True)
    assert verdict(spark.range(2), none, 100) == (2, 0, 2, 100.0, 100, True)


def test_windows_seen_on_one_side_only(spark):
    source = spark.sql("select timestamp_ntz'2024-01-31 23:59:59' ts union all select timestamp_ntz'2024-02-01 00:00:00'")
    target = spark.sql(
        "select timestamp_ntz'2024-02-29 12:00:00' at union all select timestamp_ntz'2024-03-01 00:00:00'"
        " union all select null"
    )
    found = windowed_row_count(source, target, 0, "monthly", "ts", "at").orderBy("window_start").collect()
    shown = [(str(r.window_start), r.count_source, r.count_target, r.percentage_diff, r.is_passed) for r in found]
    assert shown == [
        ("None", 0, 1, None, False),
        ("2024-01-01 00:00:00", 1, 0, 100.0, False),
        ("2024-02-01 00:00:00", 1, 1, 0.0, True),
        ("2024-03-01 00:00:00", 0, 1, None, False),
    ]


@pytest.mark.parametrize("granularity", ["monthly", "daily", "hourly"])
def test_windows_add_up(spark, small_dir, granularity):
    events = spark.read.parquet(f"{small_dir}/events.parquet")
    windows = windowed_row_count(events, events.filter("event_id % 2 = 0"), 10, granularity, F.col("ts"))
    totals = windows.agg(F.sum("count_source"), F.sum("count_target")).first()
    assert tuple(totals) == (events.count(), events.filter("event_id % 2 = 0").count())


def test_expected_windows(spark, sf_dir):
    from twintally.catalogue.tables import orders_target, table

    orders = table(spark, sf_dir, "orders")
    for granularity, windows, failing in (("monthly", 80, 31), ("daily", 2399, 315)):
        found = windowed_row_count(orders, orders_target(orders), 1, granularity, "o_orderdate")
        assert (found.count(), found.filter("not is_passed").count()) == (windows, failing)


def test_unknown_granularity(spark):
    with pytest.raises(ValueError):
        windowed_row_count(spark.range(1), spark.range(1), 1, "weekly", "id")


def test_batch_equals_single_checks(spark):
    pairs = {"same": (5, 5, 0), "less": (10, 9, 5), "none": (0, 0, 0), "new": (0, 3, 100), "gone": (4, 0, 100)}
    checks = [CountCheck(n, spark.range(s), spark.range(t), limit) for n, (s, t, limit) in pairs.items()]
    found = {row[0]: tuple(row)[1:] for row in batch_row_count(checks).collect()}
    assert found == {c.name: verdict(c.source, c.target, c.threshold) for c in checks}


def test_batch_names(spark):
    check = CountCheck("a", spark.range(1), spark.range(1), 0)
    with pytest.raises(ValueError):
        batch_row_count([check, check])
    with pytest.raises(ValueError):
        batch_row_count([])


@pytest.mark.parametrize("threshold", [2.5, -3, 101, "5", True, None])
def test_thresholds_are_whole_percent(spark, threshold):
    side = spark.range(3).select(F.current_timestamp().alias("t"))
    for check in (
        lambda: row_count_check(side, side, threshold),
        lambda: windowed_row_count(side, side, threshold, "daily", "t"),
        lambda: batch_row_count([CountCheck("a", side, side, threshold)]),
    ):
        with pytest.raises(ValueError, match="threshold"):
            check()


def test_all_granularities_share_a_shuffle(spark):
    from twintally import rolled_up_row_count

    rows = [("2024-01-31 23:10:00", 2), ("2024-02-01 00:10:00", 1), ("2024-02-01 00:50:00", 1), (None, 1)]
    source = spark.createDataFrame([(t,) for t, n in rows for _ in range(n)], "t string").selectExpr("cast(t as timestamp) t")
    target = source.where("t < '2024-02-01' or t is null")
    found = rolled_up_row_count(source, target, 0, "t")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    told = {(r.granularity, str(r.window_start)): (r.count_source, r.count_target, r.is_passed) for r in found.collect()}
    assert told == {
        ("hourly", "2024-01-31 23:00:00"): (2, 2, True), ("hourly", "2024-02-01 00:00:00"): (2, 0, False),
        ("daily", "2024-01-31 00:00:00"): (2, 2, True), ("daily", "2024-02-01 00:00:00"): (2, 0, False),
        ("monthly", "2024-01-01 00:00:00"): (2, 2, True), ("monthly", "2024-02-01 00:00:00"): (2, 0, False),
        ("hourly", "None"): (1, 1, True), ("daily", "None"): (1, 1, True), ("monthly", "None"): (1, 1, True), ("all", "None"): (5, 3, False),
    }
