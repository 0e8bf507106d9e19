from contextlib import contextmanager
from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from twintally.functions import parse_process_time, process_time, render, render_column, truncate
from twintally.functions.template import DIRECTIVES
from twintally.functions.timing import GRANULARITIES, resolve_process_time, session_now, truncate_time

NOW = datetime(2024, 3, 10, 13, 45, 10, 123456)


@contextmanager
def session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def moments(spark):
    """Times spread over several years, across midnights, noons and year ends."""
    step = "interval 7 hours 13 minutes 11 seconds 123457 microseconds"
    times = f"sequence(timestamp_ntz'2018-12-20 00:00:00', timestamp_ntz'2025-01-10 00:00:00', {step})"
    return spark.sql(f"select explode({times}) as t")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
@pytest.mark.parametrize("granularity", [*GRANULARITIES, None])
def test_truncate_column_equals_driver_form(spark, zone, granularity):
    with session_zone(spark, zone):
        rows = moments(spark).select("t", truncate(F.col("t"), granularity).alias("w")).collect()
        assert len(rows) > 7000
        assert all(row.w == truncate_time(row.t, granularity) for row in rows)


def test_truncate_keeps_times_the_session_zone_skips(spark):
    with session_zone(spark, "America/New_York"):
        row = spark.sql("select timestamp_ntz'2024-03-10 02:30:00' t")
        assert row.select(truncate(F.col("t"), "hourly")).first()[0] == datetime(2024, 3, 10, 2)
        assert row.select(render_column(F.col("t"), "%H:%M")).first()[0] == "02:30"


def test_truncate_by_a_column(spark):
    rows = spark.createDataFrame([("monthly",), ("daily",), ("hourly",), (None,)], "g string")
    when = F.lit("2024-03-10 13:45:10").cast("timestamp_ntz")
    found = [r.w for r in rows.select("g", truncate(when, F.col("g")).alias("w")).collect()]
    assert found == [datetime(2024, 3, 1), datetime(2024, 3, 10), *[datetime(2024, 3, 10, 13)] * 2]
    bad = spark.createDataFrame([("weekly",)], "g string").select(truncate(when, F.col("g")))
    with pytest.raises(Exception, match="unknown granularity"):
        bad.collect()


@pytest.mark.parametrize("text", ["2024-01-02 03:04:05", "2024-1-2 3:4:5"])
def test_parse(spark, text):
    row = spark.createDataFrame([(text,)], "x string").select(parse_process_time(F.col("x")).alias("t"))
    assert row.dtypes == [("t", "timestamp_ntz")]
    assert row.first().t == datetime(2024, 1, 2, 3, 4, 5) == resolve_second(text)


def resolve_second(text):
    return datetime.strptime(text, "%Y-%m-%d %H:%M:%S")


@pytest.mark.parametrize("text", ["2024-01-02", "2024-02-30 00:00:00", "24-1-2 3:4:5", "2024-01-02T03:04:05", "x"])
def test_parse_raises(spark, text):
    with pytest.raises(ValueError):
        resolve_second(text)
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        spark.createDataFrame([(text,)], "x string").select(parse_process_time(F.col("x"))).collect()


def test_process_time_choice(spark):
    rows = [(e, d, g) for e in ("2024-1-2 3:4:5", "", None) for d in (0, 3600, 86400) for g in (*GRANULARITIES, None)]
    table = spark.createDataFrame(rows, "e string, d int, g string")
    now = F.lit(NOW.isoformat(sep=" ")).cast("timestamp_ntz")
    found = table.select("*", process_time(F.col("e"), now, F.col("d"), F.col("g")).alias("p")).collect()
    assert [r.p for r in found] == [resolve_process_time(r.e, NOW, r.d, r.g) for r in found]
    assert resolve_process_time(None, NOW, 3600, None) == datetime(2024, 3, 10, 12)
    assert resolve_process_time("2024-1-2 3:4:5", NOW, 3600, "monthly") == datetime(2024, 1, 1)


def test_session_now_is_naive_and_local(spark):
    for zone in ("Asia/Kolkata", "+05:30"):
        with session_zone(spark, zone):
            ahead = session_now(spark)
        assert ahead.tzinfo is None
        assert timedelta(hours=5, minutes=29) < ahead - session_now(spark) < timedelta(hours=5, minutes=31)


@pytest.mark.parametrize("letter", sorted(DIRECTIVES))
def test_directive_equals_strftime(spark, letter):
    template = f"<%{letter}>"
    rows = moments(spark).select("t", render_column(F.col("t"), template).alias("x")).collect()
    for row in rows:
        assert row.x == row.t.strftime(template) == render(template, row.t)


def test_templates(spark):
    when = datetime(2024, 1, 2, 13, 0)
    assert render("/log/date_record=%Y%m%d", when) == "/log/date_record=20240102"
    assert render("like '%%foo' and h = %H%M", when) == "like '%foo' and h = 1300"
    assert render("plain", when) == "plain"
    assert spark.range(1).select(render_column(F.lit(None).cast("timestamp_ntz"), "")).first()[0] == ""


@pytest.mark.parametrize("template", ["%q", "100%", "% d", "%-d", "%\n"])
def test_unknown_directives_raise(spark, template):
    with pytest.raises(ValueError, match="unknown directive"):
        render(template, NOW)
    with pytest.raises(ValueError, match="unknown directive"):
        render_column(F.lit(None), template)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_an_explicit_time_that_cannot_be_read_is_an_error(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        now = F.lit("2024-01-02 03:04:05").cast("timestamp_ntz")
        for text in ("not a time", "2024-13-01 00:00:00"):
            with pytest.raises(PySparkException):
                spark.range(1).select(process_time(F.lit(text), now, F.lit(0), "daily")).collect()
        unset = spark.range(1).select(process_time(F.lit(None).cast("string"), now, F.lit(0), "daily"), process_time(F.lit(""), now, F.lit(0), None))
        assert [t.hour for t in unset.first()] == [0, 3]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
