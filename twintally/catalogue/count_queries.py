"""Row-count reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twintally.catalogue.registry import query
from twintally.catalogue.tables import ORDERS_TARGET_SQL, TABLES, orders_target, table
from twintally.operators import CountCheck, batch_row_count, rolled_up_row_count, row_count_check, windowed_row_count

_VERDICT = """
  count_source, count_target, abs(count_source - count_target) as count_diff,
  case when count_source = 0 then null
       else abs(count_source - count_target) / count_source * 100 end as percentage_diff,
  cast({threshold} as integer) as threshold,
  case when count_source = 0 then count_target = 0
       else abs(count_source - count_target) / count_source * 100 <= {threshold} end as is_passed"""


def _row_count_sql(source: str, threshold: int) -> str:
    return f"""
with {ORDERS_TARGET_SQL},
counts as (select (select count(*) from {source}) as count_source, (select count(*) from tgt) as count_target)
select {_VERDICT.format(threshold=threshold)} from counts"""


def _orders_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    return orders, orders_target(orders)


@query("row_count_check", _row_count_sql("orders", 5))
def check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count_check(*_orders_pair(spark, sf_dir), 5)


@query("row_count_check_breach", _row_count_sql("orders", 0))
def check_breach(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count_check(*_orders_pair(spark, sf_dir), 0)


@query("row_count_check_empty_source", _row_count_sql("(select * from orders where o_totalprice < 0)", 5))
def check_empty_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, target = _orders_pair(spark, sf_dir)
    return row_count_check(orders.filter("o_totalprice < 0"), target, 5)


def _windowed_sql(unit: str, time: str, source: str, target: str, extra: str = "") -> str:
    return f"""
with {extra}
s as (select cast(date_trunc('{unit}', {time}) as timestamp) as w, count(*) as n from {source} group by 1),
t as (select cast(date_trunc('{unit}', {time}) as timestamp) as w, count(*) as n from {target} group by 1),
counts as (
  select coalesce(s.w, t.w) as window_start, coalesce(s.n, 0) as count_source, coalesce(t.n, 0) as count_target
  from s full join t on s.w = t.w
)
select window_start, {_VERDICT.format(threshold=1)} from counts"""


@query("windowed_row_count_monthly", _windowed_sql("month", "o_orderdate", "orders", "tgt", ORDERS_TARGET_SQL + ","))
def windowed_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windowed_row_count(*_orders_pair(spark, sf_dir), 1, "monthly", "o_orderdate")


@query("windowed_row_count_daily", _windowed_sql("day", "o_orderdate", "orders", "tgt", ORDERS_TARGET_SQL + ","))
def windowed_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windowed_row_count(*_orders_pair(spark, sf_dir), 1, "daily", "o_orderdate")


@query(
    "windowed_row_count_hourly",
    _windowed_sql("hour", "ts", "events", "(select ts from events where event_type <> 'purchase')"),
)
def windowed_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return windowed_row_count(events, events.filter("event_type <> 'purchase'"), 1, "hourly", "ts")


_ROLLUP = [("hourly", "hour"), ("daily", "day"), ("monthly", "month")]


@query(
    "windowed_row_count_rollup",
    f"""
with {ORDERS_TARGET_SQL},
both_sides as (
  select o_orderdate as d, 1 as s, 0 as t from orders union all select o_orderdate, 0, 1 from tgt
), counts as (
  {" union all ".join(f"select '{name}' as granularity, cast(date_trunc('{unit}', d) as timestamp) as window_start, sum(s) as count_source, sum(t) as count_target from both_sides group by 2" for name, unit in _ROLLUP)}
  union all select 'all', null, sum(s), sum(t) from both_sides
)
select granularity, window_start, {_VERDICT.format(threshold=1)}
from (select granularity, window_start, cast(count_source as bigint) as count_source, cast(count_target as bigint) as count_target from counts)""",
)
def windowed_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolled_up_row_count(*_orders_pair(spark, sf_dir), 1, "o_orderdate")


# The target of each pair holds the rows of its table that satisfy a condition.
_BATCH = {
    "region": "r_name <> 'ASIA'",
    "nation": "n_regionkey <> 1",
    "customer": "c_acctbal > 0",
    "supplier": "s_acctbal > 0",
    "part": "p_size > 5",
    "orders": "o_orderstatus <> 'P'",
    "lineitem": "l_returnflag <> 'R'",
    "events": "event_type <> 'purchase'",
    "documents": "n_chars >= 100",
    "embeddings": "label > 0",
    "pages": "length(html) > 0",
    "benchmark": "length(text) > 200",
    "labels": "toxic = 0",
    "conversations": "role = 'user'",
}
_BATCH_THRESHOLD = 10


@query(
    "batch_row_count",
    "with counts as ("
    + " union all ".join(
        f"select '{name}' as check_name, count(*) as count_source,"
        f" count(*) filter (where {kept}) as count_target from {name}"
        for name, kept in _BATCH.items()
    )
    + f") select check_name, {_VERDICT.format(threshold=_BATCH_THRESHOLD)} from counts",
)
def batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = []
    for name in TABLES:
        rows = table(spark, sf_dir, name)
        checks.append(CountCheck(name, rows, rows.filter(F.expr(_BATCH[name])), _BATCH_THRESHOLD))
    return batch_row_count(checks)
