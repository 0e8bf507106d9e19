"""Row-count reconciliation: one pair, every window of a pair, many pairs.

Every side is turned into a *tally*: ``(s, t)`` numbers that add up to the source
and target counts. A tally of a table reads no column at all, the sum is combined
in each task before the one shuffle, and both sides run in the same stage.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twintally.functions.measures import check_threshold, with_count_verdict
from twintally.functions.timing import truncate
from twintally.sources.read import read_count, read_source
from twintally.sources.spec import JdbcSource, Source

Side = DataFrame | Source


def tally(table: DataFrame, *, of_source: bool, each: str = "1L", by: Sequence[Column] = ()) -> DataFrame:
    """``by`` columns, then bigints ``s`` and ``t``: ``each`` on the side's own, 0 on the other."""
    s, t = (each, "0L") if of_source else ("0L", each)
    return table.select(*by, F.expr(f"{s} as s"), F.expr(f"{t} as t"))


def side_tally(side: Side, *, of_source: bool, by: Sequence[Column] = ()) -> DataFrame:
    """The tally of a table or of a source; a database counts its own rows."""
    if isinstance(side, DataFrame):
        return tally(side, of_source=of_source, by=by)
    spark = SparkSession.active()
    if isinstance(side, JdbcSource):
        return tally(read_count(spark, side), of_source=of_source, each="n", by=by)
    return tally(read_source(spark, side), of_source=of_source, by=by)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """The union of frames with the same columns.

    Neighbours are joined pairwise: a union is analysed as soon as it is made, so
    adding one frame at a time would analyse the first ones again and again.
    """
    while len(frames) > 1:
        pairs = [left.unionAll(right) for left, right in zip(frames[::2], frames[1::2])]
        frames = pairs + list(frames[2 * len(pairs) :])
    return frames[0]


def _totals() -> tuple[Column, Column]:
    zero = F.lit(0).cast("bigint")
    return (
        F.coalesce(F.sum("s"), zero).alias("count_source"),
        F.coalesce(F.sum("t"), zero).alias("count_target"),
    )


def sum_tallies(tallies: DataFrame) -> DataFrame:
    """One row: ``count_source``, ``count_target`` (0 when nothing was tallied)."""
    return tallies.agg(*_totals())


def count_rows(source: Side, target: Side) -> DataFrame:
    """One row: ``count_source``, ``count_target``."""
    return sum_tallies(side_tally(source, of_source=True).unionAll(side_tally(target, of_source=False)))


def row_count_check(source: Side, target: Side, threshold: int) -> DataFrame:
    """Do the row counts differ by at most ``threshold`` percent of the source?

    Sides are tables or sources. A table read over JDBC fetches an empty row for each
    row it counts; give the source instead and the database counts.

    One row: ``count_source, count_target, count_diff, percentage_diff, threshold,
    is_passed``. With an empty source the percentage is NULL and the check passes
    only if the target is empty too.
    """
    return with_count_verdict(count_rows(source, target), threshold)


def windowed_row_count(
    source: DataFrame,
    target: DataFrame,
    threshold: int,
    granularity: str,
    source_time: str | Column,
    target_time: str | Column | None = None,
) -> DataFrame:
    """:func:`row_count_check` for every month, day or hour at once.

    One row per ``window_start`` seen on either side; rows without a time form the
    NULL window. Only the time columns are read, and a task sends one row per
    window to the shuffle, so a window that holds most of the rows costs no more
    than any other.
    """

    def window(time: str | Column) -> Column:
        when = F.col(time) if isinstance(time, str) else time
        return truncate(when, granularity).alias("window_start")

    check_threshold(threshold)
    other_time = source_time if target_time is None else target_time
    both = tally(source, of_source=True, by=[window(source_time)]).unionAll(
        tally(target, of_source=False, by=[window(other_time)])
    )
    return with_count_verdict(both.groupBy("window_start").agg(*_totals()), threshold)


def rolled_up_row_count(
    source: DataFrame,
    target: DataFrame,
    threshold: int,
    source_time: str | Column,
    target_time: str | Column | None = None,
) -> DataFrame:
    """:func:`windowed_row_count` at all granularities from one scan and one shuffle.

    ``granularity`` is ``hourly``, ``daily``, ``monthly`` or ``all``, which has one row and no ``window_start``.
    """
    levels = ("monthly", "daily", "hourly")

    def windows(time: str | Column) -> list[Column]:
        when = F.col(time) if isinstance(time, str) else time
        return [truncate(when, level).alias(level) for level in levels]

    check_threshold(threshold)
    other_time = source_time if target_time is None else target_time
    both = tally(source, of_source=True, by=windows(source_time)).unionAll(
        tally(target, of_source=False, by=windows(other_time))
    )
    counted = both.rollup(*levels).agg(F.grouping_id().alias("rolled"), *_totals())
    # A bit is set for each level that was rolled up; a window may be NULL by itself.
    names = {0: "hourly", 1: "daily", 3: "monthly"}
    level, start = F.lit("all"), F.lit(None).cast(both.schema["hourly"].dataType)
    for bits, name in names.items():
        level = F.when(F.col("rolled") == bits, name).otherwise(level)
        start = F.when(F.col("rolled") == bits, F.col(name)).otherwise(start)
    told = counted.select(level.alias("granularity"), start.alias("window_start"), "count_source", "count_target")
    return with_count_verdict(told, threshold)


@dataclass(frozen=True)
class CountCheck:
    """One pair of a batch."""

    name: str
    source: Side
    target: Side
    threshold: int

    def __post_init__(self) -> None:
        check_threshold(self.threshold)


def batch_row_count(checks: Sequence[CountCheck]) -> DataFrame:
    """:func:`row_count_check` for many pairs in one job; one row per ``check_name``.

    All pairs share one shuffle, to which a task sends at most one row per pair.
    """
    if not checks:
        raise ValueError("a batch needs at least one check")
    if len({check.name for check in checks}) < len(checks):
        raise ValueError("check names must be unique within a batch")
    spark = SparkSession.active()
    # A zero row for each pair keeps pairs whose sides are both empty.
    thresholds = F.array(*[
        F.struct(F.lit(c.name).alias("check_name"), F.lit(c.threshold).alias("threshold")) for c in checks
    ])
    by = [F.col("check_name"), F.col("threshold")]
    sides = [tally(spark.range(0, 1, 1, 1).select(F.inline(thresholds)), of_source=True, each="0L", by=by)]
    for check in checks:
        by = [F.lit(check.name).alias("check_name"), F.lit(check.threshold).alias("threshold")]
        sides.append(side_tally(check.source, of_source=True, by=by))
        sides.append(side_tally(check.target, of_source=False, by=by))
    counted = union_all(sides).groupBy("check_name", "threshold").agg(*_totals())
    return with_count_verdict(counted, F.col("threshold"))
