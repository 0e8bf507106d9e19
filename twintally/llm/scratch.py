"""Written intermediate tables, and connected components over them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twintally.storage import fresh_folder


# Places that a component's members are dealt to.
SHARES = 16

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Tables of one run, written below the folder named in ``spark.checkpoint.dir``.

    Writing a table cuts its lineage: a lost executor costs the tasks that were
    running, not the plan behind the table. All executors read the same files. With ``clean``, what a write
    has shuffled is deleted as soon as the table is there, not when the driver collects its garbage.
    """

    def __init__(self, spark: SparkSession, label: str, clean: bool = False):
        self.spark = spark
        self.root = fresh_folder(spark, label)
        self.clean = clean

    def keep(self, frame: DataFrame, name: str) -> DataFrame:
        """``frame``, written to Parquet and read back."""
        path = f"{self.root}/{name}"
        before = self.spark.conf.get(_CLEANUP, "false")
        if self.clean:
            self.spark.conf.set(_CLEANUP, "true")
        try:
            frame.write.parquet(path)
        finally:
            if self.clean:
                self.spark.conf.set(_CLEANUP, before)
        return self.spark.read.schema(frame.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that no frame reads any more."""
        jvm = self.spark.sparkContext._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b`` long): root is the component's smallest node.

    Alternates the large-star and small-star steps on (higher, lower) pairs until
    they no longer change. Every step groups by node with sums in the map tasks
    first, and a node with very many neighbours meets them in a join that adaptive
    execution may split. Nothing but one checksum row reaches the driver.

    Self-links and repeated links do no harm; rows with a null end are no links; no
    links give no rows.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    pairs = edges.where("a <> b").select(low.alias("lo"), high.alias("hi")).distinct()
    turn, pairs = 0, scratch.keep(pairs, "links-0")
    before = _checksum(pairs)
    while before[0]:
        turn += 1
        # The small-star step reads its input more than once.
        stars = scratch.keep(_large_star(pairs), f"stars-{turn}")
        pairs = scratch.keep(_small_star(stars), f"links-{turn}")
        after = _checksum(pairs)
        scratch.drop(f"links-{turn - 1}", f"stars-{turn}")
        if after == before:
            break
        before = after
    members = pairs.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return members.unionAll(members.select(F.col("root").alias("node"), "root").distinct())


def with_least(members: DataFrame, node: str, value: str, least: str) -> DataFrame:
    """``members`` with the smallest ``value`` of each one's component as ``least``; nulls are never the smallest.

    ``root`` is what :func:`components` found for a ``node``, or null, which makes it a component of its own; it is the
    node itself after that. Members of a component are dealt to ``SHARES`` places by a hash of the node, and what
    the component has in common is sent to each, so that a large one does not meet in one task.
    """
    share = F.when(F.col("root").isNull(), 0).otherwise(F.pmod(F.xxhash64(node), F.lit(SHARES))).cast("int")
    last = F.when(F.col("root").isNull(), 0).otherwise(SHARES - 1)
    dealt = members.withColumn("share", share).withColumn("last", last).withColumn("root", F.coalesce("root", node))
    found = dealt.groupBy("root").agg(F.min(value).alias(least), F.max("last").alias("last"))
    places = found.select("root", least, F.explode(F.sequence(F.lit(0), "last")).alias("share"))
    return dealt.drop("last").join(places, ["root", "share"]).drop("share")


def _checksum(pairs: DataFrame) -> tuple:
    mixed = F.xxhash64("lo", "hi").cast("decimal(38,0)")
    return tuple(pairs.agg(F.count("*"), F.sum(mixed)).first())


def _large_star(pairs: DataFrame) -> DataFrame:
    """Join every higher neighbour of a node to the node's smallest neighbour, or itself."""
    both = pairs.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionAll(
        pairs.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.where("v > u").join(least, "u")
    return joined.select(F.col("m").alias("lo"), F.col("v").alias("hi")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """Join a node and its lower neighbours to the smallest of them."""
    least = pairs.groupBy("hi").agg(F.min("lo").alias("m"))
    lower = pairs.join(least, "hi").where("lo <> m").select(F.col("m").alias("lo"), F.col("lo").alias("hi"))
    return lower.unionAll(least.select(F.col("m").alias("lo"), "hi")).distinct()


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def numbered(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``docs``, written, as columns ``column_0`` and so on, with a number ``row`` of its own for every row."""
    inside = docs.toDF(*[f"column_{place}" for place in range(len(docs.columns))])
    return scratch.keep(inside.withColumn("row", F.monotonically_increasing_id()), "numbered")


def one_of_each(rows: DataFrame, candidates: DataFrame, group: list[str]) -> DataFrame:
    """The rows of a table of :func:`numbered` that are the first of ``candidates`` in their ``group``."""
    staying = candidates.groupBy(*group).agg(F.min("row").alias("row")).select("row")
    gone = rows.select("row").join(staying, "row", "left_anti")
    return rows.join(gone, "row", "left_anti").drop("row")


def map_rows(docs: DataFrame, mapped: Callable[[Iterator], Iterator]) -> DataFrame:
    """``docs`` with its Arrow batches mapped; names with dots, or that occur twice, do no harm."""
    inside = docs.toDF(*[f"column_{place}" for place in range(len(docs.columns))])
    return inside.mapInArrow(mapped, inside.schema).toDF(*docs.columns)
