"""Input tables of the registered queries, and the targets they are checked against.

A check needs a target that is nearly, but not quite, its source. These targets
are made from the whole source table: some rows missing, some changed, some
doubled. The source side is always the table as given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twintally.sources import FileSource, read_source

# The schemas of the input tables. Stating them spares each read a job
# that opens a file to infer them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
        " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
        " l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

TABLES = tuple(SCHEMAS)


def parquet(sf_dir: str, name: str) -> FileSource:
    return FileSource("parquet", f"{sf_dir}/{name}.parquet", schema=SCHEMAS[name])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_source(spark, parquet(sf_dir, name))


def orders_target(orders: DataFrame) -> DataFrame:
    """Orders with rows dropped (key % 97), changed (key % 89) and doubled (key % 83)."""
    key = F.col("o_orderkey")
    changed = key % 89 == 0
    copies = F.when((key % 83 == 0) & ~changed, 2).otherwise(1)
    price = F.when(changed, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    kept = orders.filter(key % 97 != 0)
    doubled = kept.select("*", F.explode(F.array_repeat(F.lit(1), copies)).alias("copy"))
    return doubled.select(*[price.alias(c) if c == "o_totalprice" else F.col(c) for c in orders.columns])


ORDERS_TARGET_SQL = """
tgt as (
  select o_orderkey, o_custkey, o_orderstatus,
         case when o_orderkey % 89 = 0 then o_totalprice + 1 else o_totalprice end as o_totalprice,
         o_orderdate, o_orderpriority
  from orders where o_orderkey % 97 <> 0
  union all
  select * from orders
  where o_orderkey % 83 = 0 and o_orderkey % 97 <> 0 and o_orderkey % 89 <> 0
)"""


def lineitem_target(lineitem: DataFrame) -> DataFrame:
    """Line items with rows dropped (order key % 97) and changed (order key % 89)."""
    key = F.col("l_orderkey")
    tax = F.when(key % 89 == 0, F.col("l_tax") + 1).otherwise(F.col("l_tax"))
    kept = lineitem.filter(key % 97 != 0)
    return kept.select(*[tax.alias(c) if c == "l_tax" else F.col(c) for c in lineitem.columns])


LINEITEM_TARGET_SQL = """
tgt as (
  select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
         case when l_orderkey % 89 = 0 then l_tax + 1 else l_tax end as l_tax,
         l_returnflag, l_linestatus, l_shipdate
  from lineitem where l_orderkey % 97 <> 0
)"""


def documents_target(documents: DataFrame) -> DataFrame:
    """Documents with short texts missing and the texts of one language changed."""
    text = F.when(F.col("lang") == "de", F.concat("text", F.lit("."))).otherwise(F.col("text"))
    kept = documents.filter(F.col("n_chars") >= 100)
    return kept.select(*[text.alias(c) if c == "text" else F.col(c) for c in documents.columns])


DOCUMENTS_TARGET_SQL = """
tgt as (
  select doc_id, case when lang = 'de' then text || '.' else text end as text, lang, source, n_chars
  from documents where n_chars >= 100
)"""


def embeddings_target(embeddings: DataFrame) -> DataFrame:
    """Embeddings with one label missing and the vectors of another reversed."""
    vector = F.when(F.col("label") == 1, F.reverse("embedding")).otherwise(F.col("embedding"))
    return embeddings.filter(F.col("label") != 0).select("vec_id", vector.alias("embedding"), "label")


EMBEDDINGS_TARGET_SQL = """
tgt as (
  select vec_id, case when label = 1 then list_reverse(embedding) else embedding end as embedding, label
  from embeddings where label <> 0
)"""


def columns_of(name: str) -> list[str]:
    return [column.split()[0] for column in SCHEMAS[name].split(", ")]


def row_text_sql(name: str, columns: tuple[str, ...] | None = None) -> str:
    casts = ", ".join(f"cast({c} as varchar)" for c in columns or columns_of(name))
    return f"concat_ws('||', {casts})"
