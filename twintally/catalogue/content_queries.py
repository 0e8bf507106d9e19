"""Fingerprints and content reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from twintally.catalogue.registry import query
from twintally.catalogue.source_queries import derby
from twintally.catalogue.tables import (
    DOCUMENTS_TARGET_SQL,
    EMBEDDINGS_TARGET_SQL,
    LINEITEM_TARGET_SQL,
    ORDERS_TARGET_SQL,
    SCHEMAS,
    columns_of,
    documents_target,
    embeddings_target,
    lineitem_target,
    orders_target,
    parquet,
    row_text_sql,
    table,
)
from twintally.operators import (
    content_check,
    content_check_tree,
    distinct_fingerprints,
    row_fingerprint,
    rows_apart,
    rows_extra,
    rows_missing,
    schema_difference,
    stored_content_check,
)
from twintally.sources import FileSource, JdbcSource, read_source
from twintally.storage import fresh_folder


def _sides(name: str, target_sql: str, columns: tuple[str, ...] | None = None) -> str:
    text = row_text_sql(name, columns)
    return f"""with {target_sql},
s as (select {text} as "row" from {name}), t as (select {text} as "row" from tgt)"""


def _check_sql(name: str, target_sql: str, columns: tuple[str, ...] | None = None, except_all: bool = False) -> str:
    minus = "except all" if except_all else "except"
    return f"""{_sides(name, target_sql, columns)},
numbers as (
  select (select count(*) from s) as count_source, (select count(*) from t) as count_target,
         (select count(*) from (select "row" from s {minus} select "row" from t)) as missing,
         (select count(*) from (select "row" from t {minus} select "row" from s)) as extra
)
select true as schema_match, count_source, count_target, missing as source_not_in_target,
       extra as target_not_in_source, missing = 0 and extra = 0 as is_passed
from numbers"""


def _pair(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, DataFrame]:
    make_target = {"orders": orders_target, "lineitem": lineitem_target, "documents": documents_target}[name]
    rows = table(spark, sf_dir, name)
    return rows, make_target(rows)


# Fingerprints


@query("row_fingerprint", f'select {row_text_sql("labels")} as "row" from labels')
def fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_fingerprint(table(spark, sf_dir, "labels"))


@query("row_fingerprint_documents", f'select {row_text_sql("documents")} as "row" from documents')
def fingerprint_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_fingerprint(table(spark, sf_dir, "documents"))


@query(
    "distinct_fingerprints",
    f"""select distinct {row_text_sql("lineitem", ("l_returnflag", "l_linestatus"))} as "row" from lineitem""",
)
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_fingerprints(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"])


# Rows on one side only


@query(
    "content_missing_in_target",
    f'{_sides("orders", ORDERS_TARGET_SQL)} select "row" from s except select "row" from t',
)
def missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_missing(*_pair(spark, sf_dir, "orders"))


@query(
    "content_extra_in_target",
    f'{_sides("orders", ORDERS_TARGET_SQL)} select "row" from t except select "row" from s',
)
def extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_extra(*_pair(spark, sf_dir, "orders"))


@query(
    "content_missing_typed",
    f"with {LINEITEM_TARGET_SQL} select * from lineitem except select * from tgt",
)
def missing_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_missing(*_pair(spark, sf_dir, "lineitem"), mode="typed")


@query(
    "content_extra_typed",
    f"with {LINEITEM_TARGET_SQL} select * from tgt except select * from lineitem",
)
def extra_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_extra(*_pair(spark, sf_dir, "lineitem"), mode="typed")


@query(
    "content_missing_narrowed",
    f'{_sides("lineitem", LINEITEM_TARGET_SQL)} select "row" from s except select "row" from t',
)
def missing_narrowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_missing(*_pair(spark, sf_dir, "lineitem"), buckets=1 << 16)


@query(
    "content_extra_typed_narrowed",
    f"with {LINEITEM_TARGET_SQL} select * from tgt except select * from lineitem",
)
def extra_typed_narrowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_extra(*_pair(spark, sf_dir, "lineitem"), mode="typed", buckets=1 << 16)


@query(
    "content_extra_multiset",
    f"""{_sides("orders", ORDERS_TARGET_SQL)}
select "row", count(*) as copies from (select "row" from t except all select "row" from s) group by 1""",
)
def extra_multiset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_extra(*_pair(spark, sf_dir, "orders"), multiset=True)


# Verdicts


@query("content_check", _check_sql("orders", ORDERS_TARGET_SQL))
def check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_check(*_pair(spark, sf_dir, "orders"))


@query("content_check_full_key", _check_sql("orders", ORDERS_TARGET_SQL))
def check_full_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_check(*_pair(spark, sf_dir, "orders"), key="full")


@query("content_check_typed", _check_sql("orders", ORDERS_TARGET_SQL))
def check_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_check(*_pair(spark, sf_dir, "orders"), mode="typed")


@query("content_check_multiset", _check_sql("orders", ORDERS_TARGET_SQL, except_all=True))
def check_multiset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_check(*_pair(spark, sf_dir, "orders"), multiset=True)


@query(
    "content_check_columns",
    _check_sql("orders", ORDERS_TARGET_SQL, ("o_custkey", "o_orderstatus", "o_orderpriority")),
)
def check_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_check(*_pair(spark, sf_dir, "orders"), columns=["o_custkey", "o_orderstatus", "o_orderpriority"])


@query("content_check_lineitem", _check_sql("lineitem", LINEITEM_TARGET_SQL))
def check_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_check(*_pair(spark, sf_dir, "lineitem"))


@query("content_check_lineitem_typed", _check_sql("lineitem", LINEITEM_TARGET_SQL))
def check_lineitem_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_check(*_pair(spark, sf_dir, "lineitem"), mode="typed")


@query("content_check_narrowed", _check_sql("lineitem", LINEITEM_TARGET_SQL))
def check_narrowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_check(*_pair(spark, sf_dir, "lineitem"), buckets=1 << 16)


@query("content_check_tree", _check_sql("lineitem", LINEITEM_TARGET_SQL))
def check_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_check_tree(*_pair(spark, sf_dir, "lineitem"))


@query("content_check_tree_typed", _check_sql("lineitem", LINEITEM_TARGET_SQL, except_all=True))
def check_tree_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_check_tree(*_pair(spark, sf_dir, "lineitem"), mode="typed", multiset=True)


@query("content_check_tree_documents", _check_sql("documents", DOCUMENTS_TARGET_SQL))
def check_tree_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_check_tree(*_pair(spark, sf_dir, "documents"))


@query(
    "schema_difference",
    """select * from (values (1, 'o_custkey', 'bigint', 'o_custkey', 'string'), (5, 'o_orderpriority', 'string', null, null))
       as d(position, source_name, source_type, target_name, target_type)""",
)
def schemas_apart(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    other = orders.withColumn("o_custkey", F.col("o_custkey").cast("string")).drop("o_orderpriority")
    return schema_difference(orders, other, mode="typed")


@query("content_check_documents", _check_sql("documents", DOCUMENTS_TARGET_SQL))
def check_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_check(*_pair(spark, sf_dir, "documents"))


@query("content_check_documents_typed", _check_sql("documents", DOCUMENTS_TARGET_SQL))
def check_documents_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_check(*_pair(spark, sf_dir, "documents"), mode="typed")


@query(
    "content_check_nested",
    f"""with {EMBEDDINGS_TARGET_SQL},
numbers as (
  select (select count(*) from embeddings) as count_source, (select count(*) from tgt) as count_target,
         (select count(*) from (select * from embeddings except select * from tgt)) as missing,
         (select count(*) from (select * from tgt except select * from embeddings)) as extra
)
select true as schema_match, count_source, count_target, missing as source_not_in_target,
       extra as target_not_in_source, missing = 0 and extra = 0 as is_passed
from numbers""",
)
def check_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    return content_check(embeddings, embeddings_target(embeddings), mode="typed")


@query(
    "content_check_nested_narrowed",
    f"""with {EMBEDDINGS_TARGET_SQL},
numbers as (
  select (select count(*) from embeddings) as count_source, (select count(*) from tgt) as count_target,
         (select count(*) from (select * from embeddings except select * from tgt)) as missing,
         (select count(*) from (select * from tgt except select * from embeddings)) as extra
)
select true as schema_match, count_source, count_target, missing as source_not_in_target,
       extra as target_not_in_source, missing = 0 and extra = 0 as is_passed
from numbers""",
)
def check_nested_narrowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    return content_check(embeddings, embeddings_target(embeddings), mode="typed", buckets=1 << 16)


@query(
    "content_rows_with_counts",
    f"""{_sides("orders", ORDERS_TARGET_SQL)},
missing as (select "row" from s except select "row" from t), extra as (select "row" from t except select "row" from s)
select side, "row", (select count(*) from s) as count_source, (select count(*) from t) as count_target,
       (select count(*) from missing) as source_not_in_target, (select count(*) from extra) as target_not_in_source
from (select 'source' as side, "row" from missing union all select 'target', "row" from extra)""",
)
def rows_with_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts, path = Observation(), fresh_folder(spark, "rows-apart")
    rows_apart(*_pair(spark, sf_dir, "orders"), observation=counts).write.parquet(path)
    return spark.read.parquet(path).select("*", *[F.lit(n).cast("bigint").alias(name) for name, n in counts.get.items()])


@query("content_check_same_table", _check_sql("lineitem", "tgt as (select * from lineitem)"))
def check_same_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_check(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "lineitem"))


@query(
    "content_check_schema_mismatch",
    """select false as schema_match, count(*) as count_source, count(*) as count_target,
       cast(null as bigint) as source_not_in_target, cast(null as bigint) as target_not_in_source,
       false as is_passed
from orders""",
)
def check_schema_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return content_check(orders, orders.select(*reversed(columns_of("orders"))))


@query("content_check_conformed", _check_sql("orders", ORDERS_TARGET_SQL))
def check_conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, target = _pair(spark, sf_dir, "orders")
    path = fresh_folder(spark, "check-conformed")
    target.write.csv(path, header=True)
    # Without a schema every column of the file is text, and timestamps differ in layout.
    written = read_source(spark, FileSource("csv", path, {"header": True}))
    return content_check(orders, written, conform=True)


def _lossy(orders: DataFrame) -> DataFrame:
    """Orders as another system might hold them: wider types, with values that the types of ``orders`` have no room for."""
    key = F.col("o_orderkey")
    changed = {
        "o_orderkey": F.when(key % 97 == 0, key + 0.9).otherwise(key.cast("double")),
        "o_custkey": F.when(key % 83 == 0, F.lit("unknown")).otherwise(F.col("o_custkey").cast("string")),
        "o_totalprice": F.col("o_totalprice").cast("string"),
        "o_orderstatus": F.rpad("o_orderstatus", 8, " "),
    }
    return orders.withColumns(changed)


_LOSSY_SQL = """
with tgt as (
  select case when o_orderkey % 97 = 0 then o_orderkey + 0.9 else cast(o_orderkey as double) end as k,
         case when o_orderkey % 83 = 0 then 'unknown' else cast(o_custkey as varchar) end as c, o_orderkey
  from orders
), changed as (
  select * from tgt where try_cast(c as bigint) is null or cast(try_cast(k as bigint) as double) <> k
)
select true as schema_match, (select count(*) from orders) as count_source, (select count(*) from tgt) as count_target,
       (select count(*) from changed) as source_not_in_target, (select count(*) from changed) as target_not_in_source,
       (select count(*) from changed) = 0 as is_passed"""


@query("content_check_conformed_lossy", _LOSSY_SQL)
def check_conformed_lossy(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return content_check(orders, _lossy(orders), conform=True)


@query("content_check_conformed_unparsable", _LOSSY_SQL)
def check_conformed_unparsable(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    # All text, as from a file without a schema.
    texts = _lossy(orders).select(*[F.col(c).cast("string").alias(c) for c in orders.columns])
    return content_check(orders, texts, mode="typed", conform=True)


@query(
    "content_check_columns_case",
    """select false as schema_match, count(*) as count_source, count(*) as count_target,
       cast(null as bigint) as source_not_in_target, cast(null as bigint) as target_not_in_source,
       false as is_passed
from orders""",
)
def check_columns_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return content_check(orders, orders.withColumnRenamed("o_orderkey", "O_ORDERKEY"), columns=["o_custkey", "O_ORDERKEY"])


@query("content_check_jdbc", _check_sql("customer", "tgt as (select * from customer where c_mktsegment <> 'BUILDING')"))
def check_jdbc(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = """select * from customer where "c_mktsegment" <> 'BUILDING'"""
    split = {"partitionColumn": '"c_custkey"'}
    target = read_source(spark, JdbcSource({**derby(spark, sf_dir, "customer"), "query": wanted, **split}))
    return content_check(table(spark, sf_dir, "customer"), target)


def _stored_target(spark: SparkSession, sf_dir: str, label: str) -> tuple[DataFrame, FileSource, str]:
    """A target whose checksums were kept when it lacked the orders of one priority."""
    folder = fresh_folder(spark, label)
    target, late = orders_target(table(spark, sf_dir, "orders")), F.coalesce(F.col("o_orderpriority") == "1-URGENT", F.lit(False))
    written = FileSource("parquet", f"{folder}/target", schema=SCHEMAS["orders"])
    target.filter(~late).write.parquet(written.path)
    return target.filter(late), written, f"{folder}/checksums"


@query("content_check_stored", _check_sql("orders", ORDERS_TARGET_SQL))
def check_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    late, target, store = _stored_target(spark, sf_dir, "stored")
    stored_content_check(parquet(sf_dir, "orders"), target, store)
    late.write.mode("append").parquet(target.path)
    return stored_content_check(parquet(sf_dir, "orders"), target, store)


@query("content_check_stored_typed", _check_sql("orders", ORDERS_TARGET_SQL, except_all=True))
def check_stored_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    late, target, store = _stored_target(spark, sf_dir, "stored-typed")
    stored_content_check(parquet(sf_dir, "orders"), target, store, mode="typed", multiset=True)
    late.write.mode("append").parquet(target.path)
    return stored_content_check(parquet(sf_dir, "orders"), target, store, mode="typed", multiset=True, buckets=1 << 10)
