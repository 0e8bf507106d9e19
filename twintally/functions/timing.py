"""Process time: parse, delay, choose, truncate.

Each step exists twice. The column form works on every row of a table; the
driver form resolves the one process time of a check. Both deal in naive clock
times (``timestamp_ntz`` / naive ``datetime``), so a daylight-saving gap in the
session zone never moves a window.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Granularity names and the layout of an explicit process time.
MONTHLY, DAILY, HOURLY = "monthly", "daily", "hourly"
GRANULARITIES = (MONTHLY, DAILY, HOURLY)
PROCESS_TIME_LAYOUT = "%Y-%m-%d %H:%M:%S"

# The same layout as a Spark datetime pattern; single letters take unpadded fields.
_PROCESS_TIME_PATTERN = "yyyy-M-d H:m:s"

# How many leading date-time fields (year, month, day, hour) a window keeps.
_FIELDS_KEPT = {MONTHLY: 2, DAILY: 3, HOURLY: 4}


def check_granularity(granularity: str | None) -> str:
    """The granularity in force; none given means hourly."""
    if granularity is None:
        return HOURLY
    if granularity not in GRANULARITIES:
        raise ValueError(f"granularity must be one of {', '.join(GRANULARITIES)}, not {granularity!r}")
    return granularity


# Column forms


def parse_process_time(text: Column) -> Column:
    """``2024-01-02 03:04:05`` (unpadded fields allowed) as ``timestamp_ntz``.

    Other text fails the query under ANSI mode and is NULL without; NULL stays NULL.
    """
    return F.to_timestamp_ntz(text, F.lit(_PROCESS_TIME_PATTERN))


def delayed(now: Column, delay_seconds: Column) -> Column:
    zero = F.lit(0)
    return now.cast("timestamp_ntz") - F.make_dt_interval(zero, zero, zero, delay_seconds)


def truncate(when: Column, granularity: str | Column | None) -> Column:
    """Start of the month, day or hour ``when`` falls in, as ``timestamp_ntz``.

    Built from the date and the hour field instead of ``date_trunc``, which
    would take a zone-free time through the session time zone and back. A
    granularity column may hold NULL, which means hourly.
    """
    naive = when.cast("timestamp_ntz")
    midnight = naive.cast("date").cast("timestamp_ntz")
    starts = {
        MONTHLY: F.trunc(naive, "month").cast("timestamp_ntz"),
        DAILY: midnight,
        HOURLY: midnight + F.make_dt_interval(F.lit(0), F.hour(naive)),
    }
    if not isinstance(granularity, Column):
        return starts[check_granularity(granularity)]
    name = F.coalesce(granularity, F.lit(HOURLY))
    chosen = F.when(name == MONTHLY, starts[MONTHLY]).when(name == DAILY, starts[DAILY])
    return chosen.when(name == HOURLY, starts[HOURLY]).otherwise(
        F.raise_error(F.concat(F.lit("unknown granularity "), name)).cast("timestamp_ntz")
    )


def process_time(
    explicit: Column, now: Column, delay_seconds: Column, granularity: str | Column | None
) -> Column:
    """The explicit time if there is one, else ``now`` minus the delay; truncated.

    An explicit time that cannot be read fails the query, with and without ANSI mode.
    """
    given = F.nullif(explicit, F.lit(""))
    malformed = F.raise_error(F.concat(F.lit("not a process time: "), given)).cast("timestamp_ntz")
    chosen = F.when(given.isNull(), delayed(now, delay_seconds)).otherwise(F.coalesce(parse_process_time(given), malformed))
    return truncate(chosen, granularity)


# Driver forms


def session_now(spark: SparkSession) -> datetime:
    """The naive wall clock of the session time zone."""
    return spark.range(1).select(F.localtimestamp()).first()[0]


def truncate_time(when: datetime, granularity: str | None) -> datetime:
    kept = when.timetuple()[: _FIELDS_KEPT[check_granularity(granularity)]]
    first_of_month = (1,) if len(kept) == 2 else ()
    return datetime(*kept, *first_of_month)


def resolve_process_time(
    explicit: str | None, now: datetime, delay_seconds: int, granularity: str | None
) -> datetime:
    if explicit:
        chosen = datetime.strptime(explicit, PROCESS_TIME_LAYOUT)
    else:
        chosen = now - timedelta(seconds=delay_seconds)
    return truncate_time(chosen, granularity)


def windows_between(first: datetime, last: datetime, granularity: str | None) -> list[datetime]:
    """The starts of all windows from that of ``first`` to that of ``last``."""
    when, last = truncate_time(first, granularity), truncate_time(last, granularity)
    found = []
    while when <= last:
        found.append(when)
        step = {MONTHLY: timedelta(days=32), DAILY: timedelta(days=1), HOURLY: timedelta(hours=1)}[check_granularity(granularity)]
        when = truncate_time(when + step, granularity)
    return found
