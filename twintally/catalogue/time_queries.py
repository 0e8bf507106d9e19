"""Process time: truncation, choice and templates, on every event."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twintally.catalogue.registry import query
from twintally.catalogue.tables import table
from twintally.functions.template import render_column
from twintally.functions.timing import process_time, truncate


def _truncate_sql(unit: str) -> str:
    return f"select event_id, cast(date_trunc('{unit}', ts) as timestamp) as window_start from events"


def _truncated(spark: SparkSession, sf_dir: str, granularity: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select("event_id", truncate(F.col("ts"), granularity).alias("window_start"))


@query("truncate_monthly", _truncate_sql("month"))
def truncate_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _truncated(spark, sf_dir, "monthly")


@query("truncate_daily", _truncate_sql("day"))
def truncate_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _truncated(spark, sf_dir, "daily")


@query("truncate_hourly", _truncate_sql("hour"))
def truncate_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _truncated(spark, sf_dir, "hourly")


# Clicks carry an explicit time, unpadded; for all others the event's time is the
# clock and the user's number the delay in seconds.
@query(
    "process_time",
    """
with chosen as (
  select event_id, event_type,
         case when event_type = 'click' then date_trunc('second', ts)
              else ts - to_seconds(user_id) end as chosen
  from events
)
select event_id,
       cast(case event_type when 'view' then date_trunc('month', chosen)
                            when 'purchase' then date_trunc('day', chosen)
                            else date_trunc('hour', chosen) end as timestamp) as process_time
from chosen""",
)
def process_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    explicit = F.when(kind == "click", F.date_format("ts", "yyyy-M-d H:m:s"))
    granularity = F.when(kind == "view", "monthly").when(kind == "purchase", "daily").when(kind == "click", "hourly")
    when = process_time(explicit, F.col("ts"), F.col("user_id").cast("int"), granularity)
    return events.select("event_id", when.alias("process_time"))


# No event carries a time: the default alone, hourly where no granularity is named.
@query(
    "process_time_default_only",
    "select event_id, cast(date_trunc('hour', ts - to_seconds(3600)) as timestamp) as process_time from events",
)
def default_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    when = process_time(F.lit(None).cast("string"), F.col("ts"), F.lit(3600), None)
    return events.select("event_id", when.alias("process_time"))


_TEMPLATE = "/log/%Y/%m-%d/%H%M%S.%f y=%y j=%j %I%p %b %B %a %A w=%w u=%u U=%U W=%W V=%V G=%G 100%%"


@query("render_template", f"select event_id, strftime(ts, '{_TEMPLATE}') as rendered from events")
def rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select("event_id", render_column(F.col("ts"), _TEMPLATE).alias("rendered"))


@query(
    "render_template_orders",
    "select o_orderkey, strftime(o_orderdate, 'date_record=%Y%m%d (%A %d %B, week %V)') as rendered from orders",
)
def rendered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    template = "date_record=%Y%m%d (%A %d %B, week %V)"
    return orders.select("o_orderkey", render_column(F.col("o_orderdate"), template).alias("rendered"))
