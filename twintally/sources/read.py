"""Turn a source into a DataFrame."""

from __future__ import annotations

import re
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twintally.functions.template import is_dated, render
from twintally.functions.timing import windows_between
from twintally.sources.spec import FileSource, JdbcSource, Source

_WIDEST = T.DecimalType(38, 18)
_PARTITION = re.compile(r"(?P<key>[A-Za-z_]\w*)=(?P<value>.+)")
_CORRUPT = "_twintally_corrupt"
_PARALLEL_READ = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")


def read_source(spark: SparkSession, source: Source) -> DataFrame:
    """The source as a DataFrame; only options that are set reach the reader."""
    match source:
        case FileSource():
            return _read_file(spark, source)
        case JdbcSource():
            return spark.read.format("jdbc").options(**_jdbc_options(spark, source)).load()
    raise TypeError(f"not a source: {source!r}")


def _read_file(spark: SparkSession, source: FileSource) -> DataFrame:
    reader = spark.read.format(source.format).options(**source.options)
    if source.schema:
        reader = reader.schema(source.schema)
    return whole_rows(reader.load(source.path), source)


def whole_rows(table: DataFrame, source: FileSource) -> DataFrame:
    """The rows of a file source as a full read has them, whichever columns a query asks for."""
    if source.options.get("mode") in ("DROPMALFORMED", "FAILFAST"):
        # Spark parses only the columns a query asks for, so a plain count would
        # keep rows that a full read drops or fails on. The condition always holds
        # and makes every query parse every column.
        table = table.filter(F.length(F.concat_ws("", F.col("*"))) >= 0)
    return table


def read_range(
    spark: SparkSession, source: FileSource, first: datetime, last: datetime, granularity: str | None = None
) -> DataFrame:
    """What a dated path holds for all windows from that of ``first`` to that of ``last``, as one table.

    The dated end of the path must be folders named ``key=value``. It is read from the folder
    above them, as one scan that a filter on the folders' names cuts down to those
    of the windows before any file is opened. Windows without a folder have no rows. The columns are
    those of the files, as in a read of one folder; a ``schema`` must not have a folder's key among them.
    """
    parts = source.path.rstrip("/").split("/")
    dated = [place for place, part in enumerate(parts) if is_dated(part)]
    if not dated:
        raise ValueError(f"{source.path!r} does not depend on the time")
    folders = [_PARTITION.fullmatch(part) for part in parts[dated[0] :]]
    if not all(folders):
        raise ValueError(f"the dated folders of {source.path!r} must be named key=value")
    root = render("/".join(parts[: dated[0]]), first)
    keys = [folder["key"] for folder in folders]
    reader = spark.read.format(source.format).options(**source.options)
    given = reader.schema(source.schema).load(root) if source.schema else reader.load(root)
    # Names of folders are text: 07 is not 7.
    columns = [f for f in given.schema.fields if f.name not in keys]
    names = [T.StructField(key, T.StringType()) for key in keys]
    table = spark.read.format(source.format).options(**source.options).schema(T.StructType([*columns, *names])).load(root)
    windows = windows_between(first, last, granularity)
    wanted = sorted({"/".join(render(folder["value"], when) for folder in folders) for when in windows})
    named = F.concat_ws("/", *[F.col(_quoted(key)) for key in keys])
    return whole_rows(table.filter(named.isin(wanted)).drop(*keys), source)


def malformed_rows(spark: SparkSession, source: FileSource) -> DataFrame:
    """How many rows of a CSV source cannot be read as its schema says, whatever its mode.

    One row: ``mode, n_rows`` in the files, ``n_malformed`` among them, ``n_read`` that the source's mode lets through
    (malformed ones with NULLs in ``PERMISSIVE``, without them in ``DROPMALFORMED``; NULL where ``FAILFAST`` fails).
    """
    if source.format != "csv":
        raise ValueError(f"a {source.format} source has no malformed rows")
    mode = source.options.get("mode", "PERMISSIVE")
    schema = spark.read.schema(source.schema).csv(source.path).schema if source.schema else read_source(spark, source).schema
    name = source.options.get("columnNameOfCorruptRecord", _CORRUPT)
    if name not in schema.names:
        schema = T.StructType([*schema.fields, T.StructField(name, T.StringType())])
    options = {**source.options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": name}
    table = spark.read.format("csv").options(**options).schema(schema).load(source.path)
    # Spark parses only the columns a query asks for; asking for all finds all faults.
    others = F.length(F.concat_ws("", *[F.col(_quoted(f.name)) for f in schema.fields if f.name != name]))
    counted = table.select(others.alias("length"), F.col(_quoted(name)).isNotNull().alias("malformed"))
    numbers = counted.filter("length >= 0").agg(F.count("*").alias("n_rows"), F.count_if("malformed").alias("n_malformed"))
    read = {
        "PERMISSIVE": F.col("n_rows"),
        "DROPMALFORMED": F.col("n_rows") - F.col("n_malformed"),
        "FAILFAST": F.when(F.col("n_malformed") == 0, F.col("n_rows")),
    }[mode.upper()]
    return numbers.select(F.lit(mode).alias("mode"), "n_rows", "n_malformed", read.alias("n_read"))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _jdbc_options(spark: SparkSession, source: JdbcSource) -> dict[str, Any]:
    options = dict(source.options)
    column = options.get("partitionColumn")
    if not column:
        return options
    if options.get("query"):
        # Spark reads a query in parallel only when it is given as a derived table.
        options["dbtable"] = f"({options.pop('query')}) parallel_query"
    if "lowerBound" not in options or "upperBound" not in options:
        named = _quoted_column(spark, source, column)
        low, high = _ask(spark, source, f"min({named}) as low, max({named}) as high").first()
        if low is None:  # no rows, or no values to split by
            return {name: value for name, value in options.items() if name not in _PARALLEL_READ}
        options = {"lowerBound": str(low), "upperBound": str(high), **options}
    options.setdefault("numPartitions", spark.sparkContext.defaultParallelism)
    return options


def _quoted_column(spark: SparkSession, source: JdbcSource, column: str) -> str:
    """The column as the database's own quotes name it, found as Spark finds it: letter by letter first, then in any case."""
    dialect = spark.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(source.options["url"])
    options = {k: v for k, v in source.options.items() if k not in _PARALLEL_READ}
    names = spark.read.format("jdbc").options(**options).load().columns
    plain = column if column in names else column.strip('"`[]')
    found = [n for n in names if n == plain] or [n for n in names if n.lower() == plain.lower()]
    return dialect.quoteIdentifier(found[0]) if found else column


def _ask(spark: SparkSession, source: JdbcSource, totals: str) -> DataFrame:
    """One row of totals over a JDBC source, worked out by the database."""
    options = {k: v for k, v in source.options.items() if k not in (*_PARALLEL_READ, "dbtable", "query", "customSchema")}
    inner = f"({source.options['query']}) asked" if source.options.get("query") else source.options["dbtable"]
    return spark.read.format("jdbc").options(**options, query=f"select {totals} from {inner}").load()


def read_count(spark: SparkSession, source: JdbcSource) -> DataFrame:
    """The number of rows behind a JDBC source, counted by the database.

    One row, one bigint column ``n``. Spark does not push a count into a JDBC
    scan by itself: it would fetch an empty row for each row of the table.
    """
    return _ask(spark, source, "count(*) as n").toDF("n").select(F.col("n").cast("bigint"))


def conform(table: DataFrame, schema: T.StructType, *, trim_right: bool = True) -> tuple[DataFrame, DataFrame]:
    """``table`` cast column by column to the types of ``schema``, and the rows a cast would change.

    For sides that come from different systems: text dates against real ones,
    integers against doubles, ``CHAR`` columns padded with blanks. Columns are matched
    by position. Names stay as they are, so a check still sees a difference in them;
    so do columns beyond the schema.

    The first frame holds the rows whose values all keep what they say, cast; the second
    one the others, as they are: text that cannot be read, a fraction or a time
    of day that the type has no room for, a number out of range. The session's
    ANSI mode makes no difference. Only blanks on the right of text are given up.
    """
    inside = table.toDF(*[f"c{place}" for place in range(len(table.columns))])
    values, kept = [], F.lit(True)
    for place, given in enumerate(inside.schema.fields):
        value = F.col(given.name)
        if place < len(schema.fields):
            wanted = schema.fields[place].dataType
            cast = value.try_cast(wanted)
            if isinstance(given.dataType, T.StringType) and isinstance(wanted, T.IntegralType):
                cast = F.coalesce(cast, value.try_cast(_WIDEST).try_cast(wanted))  # "1.0" is a whole number, too
            kept = kept & _keeps(value, cast, given.dataType, wanted)
            value = F.rtrim(cast) if trim_right and isinstance(wanted, T.StringType) else cast
        values.append(value.alias(given.name))
    return inside.filter(kept).select(*values).toDF(*table.columns), inside.filter(~kept).toDF(*table.columns)


def _keeps(value: Column, cast: Column, given: T.DataType, wanted: T.DataType) -> Column:
    """Whether a cast value still says what the value said; never NULL."""
    if given == wanted:
        return F.lit(True)
    there = cast.isNotNull()
    if not isinstance(wanted, T.StringType):
        if not isinstance(given, T.StringType):
            if not isinstance(given, T.NullType):
                there = there & cast.try_cast(given).eqNullSafe(value)
        elif isinstance(wanted, T.DecimalType):
            # Text has no type to go back to: it is held against the widest type of its kind.
            widest = T.DecimalType(38, 38 - (wanted.precision - wanted.scale))
            there = there & cast.try_cast(widest).eqNullSafe(value.try_cast(widest))
        elif isinstance(wanted, T.IntegralType):
            there = there & cast.try_cast(_WIDEST).eqNullSafe(value.try_cast(_WIDEST))
        elif isinstance(wanted, T.DateType):
            there = there & cast.try_cast("timestamp_ntz").eqNullSafe(value.try_cast("timestamp_ntz"))
    return value.isNull() | there
