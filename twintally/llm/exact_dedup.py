"""Exact dedup by a tree of merges over sorted digest runs.

Every row is cut down to a digest and an identifier and dealt to one of ``runs``
runs by its identifier. A run holds its entries in order of their digests, one for each digest, cut
into ``RANGES`` ranges of digests. In each round ``fan_in`` runs, those whose numbers are the same
modulo the number of runs that are left, send each range of theirs to one task. The task merges them in order,
and of equal digests the chosen identifier stays, until one run is left: ``log(runs) / log(fan_in)``
rounds whatever the number of rows, each with as many tasks as there are runs and ranges. A text that makes up a third of
all rows is dealt to all runs; after the first step it is one entry per run.

An entry is the SHA-256 of the text together with two checks that are independent
of it, the text's length in bytes and its XXH64. Entries are merged only if all
three agree, at every level, so two texts that shared a SHA-256 would still stay
apart.

Built-in functions only: no row passes through Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twintally.llm.scratch import Scratch, numbered, one_of_each, quoted

_ENTRY = ["digest", "n_bytes", "check"]

# Of digests, by their first byte; a power of two up to 256.
RANGES = 256


def text_entry(text: Column) -> list[Column]:
    """What stands for a text in the runs; null counts as the empty text."""
    whole = F.coalesce(text.cast("string"), F.lit("")).cast("binary")
    return [
        F.unhex(F.sha2(whole, 256)).alias("digest"),
        F.octet_length(whole).alias("n_bytes"),
        F.xxhash64(whole).alias("check"),
    ]


def _in_order(entries: DataFrame) -> DataFrame:
    """Each range of each run in one task, in order of the entries."""
    key = ["run", "range", *_ENTRY]
    return entries.repartition("run", "range").sortWithinPartitions(*key)


def _merged(entries: DataFrame, chosen, number) -> DataFrame:
    """Neighbours that are equal as one. The identifier is held in a struct, which Spark adds up in the order of the rows, without a hash table."""
    kept = chosen(F.struct("id")).alias("kept")
    merged = _in_order(entries).groupBy("run", "range", *_ENTRY).agg(kept, number.alias("n"))
    return merged.select("run", "range", *_ENTRY, F.col("kept.id").alias("id"), "n")


def merge_runs(entries: DataFrame, runs: int, fan_in: int, keep: str) -> DataFrame:
    """One row per distinct entry: ``keep_id`` and ``group_size``, merged run by run.

    ``entries`` has the entry columns, ``id`` and ``run`` (0 to ``runs`` - 1).
    """
    # Nulls are the smallest of all in a struct, and are not to be preferred.
    least = lambda s: F.min(F.struct(s["id"].isNull().alias("none"), s["id"].alias("id")))
    chosen = {"smallest": least, "largest": F.max}[keep]
    ranged = entries.withColumn("range", F.conv(F.hex(F.substring("digest", 1, 1)), 16, 10).cast("int") % F.lit(RANGES))
    merged = _merged(ranged.withColumn("n", F.lit(1).cast("bigint")), chosen, F.sum("n"))
    while runs > 1:
        runs = -(-runs // fan_in)
        merged = _merged(merged.withColumn("run", F.col("run") % runs), chosen, F.sum("n"))
    return merged.select(*_ENTRY, F.col("id").alias("keep_id"), F.col("n").alias("group_size"))


def _groups(rows: DataFrame, keep: str = "smallest", runs: int = 64, fan_in: int = 8) -> DataFrame:
    """The groups of :func:`merge_runs`, of rows with ``id`` and the entry columns."""
    entries = rows.withColumn("run", F.pmod(F.xxhash64("id"), F.lit(runs)).cast("int"))
    return merge_runs(entries, runs, fan_in, keep)


def exact_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: str = "smallest",
    runs: int = 64,
    fan_in: int = 8,
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their bytes are. ``kept`` marks the row whose identifier is
    the group's smallest (or largest, ``keep="largest"``). Other columns are not read.

    - A null text is the empty text.
    - A null identifier is never preferred to another; a group of nothing else has a
      null ``keep_id``.
    - Rows that repeat an identifier are rows of their own in ``group_size``; all of
      those that carry ``keep_id`` are ``kept`` (drop repeated rows first if
      identifiers repeat).
    - An empty table gives no rows.
    """
    rows = docs.select(quoted(id_column).cast("long").alias("id"), *text_entry(quoted(text_column)))
    groups = _groups(rows, keep, runs, fan_in)
    return rows.join(groups, _ENTRY).select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of ``docs``.

    Of each group one row stays: of those that carry ``keep_id``, the first in the written
    table. So a repeated identifier takes no other text with it, and repeated rows and copies
    without an identifier are one row after that. Settings are those of :func:`exact_groups`.
    """
    rows = numbered(docs, Scratch(docs.sparkSession, "exact"))
    id_name, text_name = (f"column_{docs.columns.index(c)}" for c in (id_column, text_column))
    entries = rows.select("row", F.col(id_name).cast("long").alias("id"), *text_entry(F.col(text_name)))
    groups = _groups(entries.drop("row"), **settings)
    candidates = entries.join(groups, _ENTRY).where(F.col("id").eqNullSafe(F.col("keep_id")))
    return one_of_each(rows, candidates, _ENTRY).toDF(*docs.columns)
