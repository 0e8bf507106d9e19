"""Scans: every format, option set and template a source may use."""

from __future__ import annotations

import os
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twintally.catalogue.registry import query
from twintally.catalogue.tables import SCHEMAS, parquet, table
from twintally.functions.timing import resolve_process_time
from twintally.sources import FileSource, JdbcSource, malformed_rows, read_count, read_range, read_source
from twintally.operators.counts import union_all
from twintally.storage import fresh_folder

_MONTH = "1995-06-17 13:45:10"
_DAY = "1995-6-17 3:45:10"
_UNUSED_CLOCK = datetime(2000, 1, 1)

_loaded: dict[tuple[str, str, str], str] = {}


def derby(spark: SparkSession, sf_dir: str, name: str) -> dict[str, str]:
    """Options that connect to a table, loaded into Derby's in-memory database.

    The database lives inside the JVM of a local session and is seen by no other
    process, so these queries run on a local master only. Spark's tasks load it,
    once per session and table.
    """
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):  # local-cluster has executors of its own, too
        raise RuntimeError("the JDBC queries use a database that only a local session's JVM can see")
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _loaded:
        spark._jvm.java.lang.System.setProperty("derby.stream.error.file", os.devnull)
        options = {
            "url": f"jdbc:derby:memory:{name}{len(_loaded)};create=true",
            "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver",
        }
        rows = table(spark, sf_dir, name)
        longest = rows.agg(*[F.max(F.char_length(c)).alias(c) for c, kind in rows.dtypes if kind == "string"]).first()
        kinds = {c: f"varchar({max(n or 1, 1)})" if (n or 1) <= 32_672 else "clob" for c, n in longest.asDict().items()}
        texts = ", ".join(f"{c} {kind}" for c, kind in kinds.items())
        rows.write.format("jdbc").options(**options, dbtable=name, createTableColumnTypes=texts).save()
        _loaded[key] = options["url"]
    return {"url": _loaded[key], "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


@query("scan_parquet", "select * from orders")
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_source(spark, parquet(sf_dir, "orders"))


@query("scan_parquet_options", "select * from events")
def scan_parquet_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = {"mergeSchema": "false", "datetimeRebaseMode": "CORRECTED", "int96RebaseMode": "CORRECTED"}
    return read_source(spark, FileSource("parquet", f"{sf_dir}/events.parquet", options))


@query("scan_csv", "select * from customer")
def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, path = table(spark, sf_dir, "customer"), fresh_folder(spark, "scan-csv")
    customer.write.csv(path, header=True)
    return read_source(spark, FileSource("csv", path, {"header": True}, schema=SCHEMAS["customer"]))


@query("scan_csv_options", "select * from orders")
def scan_csv_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, path = table(spark, sf_dir, "orders"), fresh_folder(spark, "scan-csv-options")
    shape = {"sep": "|", "quote": "'", "nullValue": "-", "encoding": "UTF-8", "lineSep": "\n"}
    layout = "dd/MM/yyyy HH:mm:ss"
    orders.write.options(**shape, timestampNTZFormat=layout, quoteAll=True).csv(path)
    options = {**shape, "timestampNTZFormat": layout, "mode": "FAILFAST", "header": "false", "maxColumns": "20"}
    return read_source(spark, FileSource("csv", path, options, schema=SCHEMAS["orders"]))


@query("scan_csv_multiline", "select * from documents")
def scan_csv_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, path = table(spark, sf_dir, "documents"), fresh_folder(spark, "scan-csv-multiline")
    # A file with line breaks inside values is read by one task: keep files small.
    documents.write.option("maxRecordsPerFile", 10_000).csv(path, header=True)
    options = {"header": True, "multiLine": True}
    return read_source(spark, FileSource("csv", path, options, schema=SCHEMAS["documents"]))


@query("scan_jdbc_table", "select * from supplier")
def scan_jdbc_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = {"partitionColumn": '"s_suppkey"'}
    return read_source(spark, JdbcSource({**derby(spark, sf_dir, "supplier"), "dbtable": "supplier", **split}))


@query("scan_jdbc_auto_bounds", "select * from orders where o_totalprice > 1000")
def scan_jdbc_auto_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = 'select * from orders where "o_totalprice" > 1000'
    split = {"partitionColumn": '"o_custkey"', "preferTimestampNTZ": True}
    return read_source(spark, JdbcSource({**derby(spark, sf_dir, "orders"), "query": wanted, **split}))


@query("scan_jdbc_query", "select c_custkey, c_acctbal from customer where c_mktsegment = 'BUILDING'")
def scan_jdbc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = """select "c_custkey", "c_acctbal" from customer where "c_mktsegment" = 'BUILDING'"""
    split = {"partitionColumn": '"c_custkey"'}
    return read_source(spark, JdbcSource({**derby(spark, sf_dir, "customer"), "query": wanted, **split}))


@query("scan_jdbc_partitioned", "select * from customer")
def scan_jdbc_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    low, high = table(spark, sf_dir, "customer").agg(F.min("c_custkey"), F.max("c_custkey")).first()
    split = {"partitionColumn": '"c_custkey"', "lowerBound": low, "upperBound": high}
    return read_source(spark, JdbcSource({**derby(spark, sf_dir, "customer"), "dbtable": "customer", **split}))


@query(
    "scan_jdbc_partitioned_query",
    "select c_custkey, c_mktsegment from customer where c_acctbal > 0",
)
def scan_jdbc_partitioned_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    low, high = table(spark, sf_dir, "customer").agg(F.min("c_custkey"), F.max("c_custkey")).first()
    wanted = """select "c_custkey", "c_mktsegment" from customer where "c_acctbal" > 0"""
    split = {"partitionColumn": '"c_custkey"', "lowerBound": low, "upperBound": high}
    return read_source(spark, JdbcSource({**derby(spark, sf_dir, "customer"), "query": wanted, **split}))


@query("scan_jdbc_count", "select cast(count(*) as bigint) as n from customer where c_nationkey < 10")
def scan_jdbc_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = 'select * from customer where "c_nationkey" < 10'
    return read_count(spark, JdbcSource({**derby(spark, sf_dir, "customer"), "query": wanted}))


@query(
    "scan_templated_path",
    """select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    from orders where date_trunc('month', o_orderdate) = date '1995-06-01'""",
)
def scan_templated_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, path = table(spark, sf_dir, "orders"), fresh_folder(spark, "scan-templated")
    by_month = orders.withColumn("month", F.date_format("o_orderdate", "yyyyMM"))
    # Rebalancing gives each folder few files and splits a month that is too big for one task.
    by_month.hint("rebalance", "month").write.partitionBy("month").parquet(path)
    when = resolve_process_time(_MONTH, _UNUSED_CLOCK, 0, "monthly")
    return read_source(spark, FileSource("parquet", f"{path}/month=%Y%m").at(when))


@query(
    "scan_templated_range",
    """select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    from orders where o_orderdate >= timestamp '1994-11-01' and o_orderdate < timestamp '1996-03-01'""",
)
def scan_templated_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, path = table(spark, sf_dir, "orders"), fresh_folder(spark, "scan-range")
    dated = orders.withColumns({"year": F.date_format("o_orderdate", "yyyy"), "month": F.date_format("o_orderdate", "MM")})
    dated.hint("rebalance", "year", "month").write.partitionBy("year", "month").parquet(path)
    source = FileSource("parquet", f"{path}/year=%Y/month=%m", schema=SCHEMAS["orders"])
    return read_range(spark, source, datetime(1994, 11, 30), datetime(1996, 2, 1), "monthly")


@query(
    "scan_csv_malformed",
    """with numbers as (
  select count(*) as n_rows, count(*) filter (where o_orderkey % 97 = 0 or o_orderkey % 89 = 0) as n_malformed from orders
)
select 'PERMISSIVE' as mode, n_rows, n_malformed, n_rows as n_read from numbers
union all select 'DROPMALFORMED', n_rows, n_malformed, n_rows - n_malformed from numbers
union all select 'FAILFAST', n_rows, n_malformed, case when n_malformed = 0 then n_rows end from numbers""",
)
def scan_csv_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, path = table(spark, sf_dir, "orders"), fresh_folder(spark, "scan-malformed")
    key, price = F.col("o_orderkey"), F.when(F.col("o_orderkey") % 97 == 0, "unknown").otherwise(F.col("o_totalprice").cast("string"))
    short = F.concat_ws(",", key, price)
    line = F.when(key % 89 == 0, short).otherwise(F.concat_ws(",", short, "o_orderpriority"))
    orders.select(line).write.text(path)
    schema = "o_orderkey bigint, o_totalprice double, o_orderpriority string"
    modes = ("PERMISSIVE", "DROPMALFORMED", "FAILFAST")
    return union_all([malformed_rows(spark, FileSource("csv", path, {"mode": mode}, schema)) for mode in modes])


@query(
    "scan_templated_query",
    """select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    from orders where cast(o_orderdate as date) = date '1995-06-17'""",
)
def scan_templated_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = """select * from orders where date("o_orderdate") = '%Y-%m-%d'"""
    split = {"partitionColumn": '"o_orderkey"', "preferTimestampNTZ": True}
    options = {**derby(spark, sf_dir, "orders"), "query": wanted, **split}
    when = resolve_process_time(_DAY, _UNUSED_CLOCK, 0, "daily")
    return read_source(spark, JdbcSource(options).at(when))
