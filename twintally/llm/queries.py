"""The operators applied to the tables, with production settings, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twintally.llm.bpe import digest_documents
from twintally.llm.chat import format_chats, formatted, read_learnt, read_turns, text_parts
from twintally.llm.embeddings import near_vectors
from twintally.llm.exact_dedup import exact_groups
from twintally.llm.language import fit_language, identify_languages
from twintally.llm.licenses import TEMPLATES, THRESHOLD, needed, scan_licenses
from twintally.llm.lines import line_report
from twintally.llm.mixing import score_texts
from twintally.llm.packing import pack_documents
from twintally.llm.repair import repair_report
from twintally.llm.simhash import simhash_groups
from twintally.llm.spelling import spelling_variants
from twintally.llm.toxicity import fit_toxicity, fold, score_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql:
            ORACLE_SQL[name] = sql.strip()
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "op1_chat_formatting",
    """
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), written as (
  select *, '<|turn|>' || role || chr(10)
    || replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;') || '<|end|>' as written
  from turns
)
select conv_id,
       count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       cast(sum(length(written)) as bigint) as formatted_chars
from written group by conv_id
""",
)
def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = "conv_id long, turn long, role string, text string"
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], columns)
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    chats = format_chats(turns, text_parts(F.col("text")))
    turn = F.transform(read_turns(F.col("blocks")), lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    read = chats.select("conv_id", F.size(turn).cast("long").alias("n_turns"), F.array_join(turn, "").alias("turns"), read_learnt(F.col("blocks")).alias("learnt"), formatted(F.col("blocks")).alias("formatted"))
    return read.select(
        "conv_id",
        "n_turns",
        F.sha2("turns", 256).alias("turns_sha256"),
        F.char_length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


@query("op2_packing")
def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def _license_sql() -> str:
    rows = ", ".join(
        "({}, '{}', '{}', {}, {})".format(n, label, text, *needed(text.encode().split(), THRESHOLD))
        for n, (label, text) in enumerate(TEMPLATES)
    )
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return rf"""
with lowered as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
  from documents
), worded as (
  select doc_id, text, regexp_extract_all(text, '{word}') as w from lowered
), places as (
  select doc_id, i - 1 as start, label from (
    select doc_id, i, case when w[i] = 'mit' and w[i + 1] = 'license' then 'mit'
                           when w[i] = 'apache' and w[i + 1] = 'license' then 'apache'
                           when w[i] = 'general' and w[i + 1] = 'public' and w[i + 2] = 'license' then 'gpl' end as label
    from (select doc_id, w, unnest(range(1, len(w) + 1)) as i from worded)
  ) where label is not null
), base as (
  select doc_id, count(*) as n_base, min(start) as first_word, max(start) as last_word,
         list(distinct label) as labels from places group by doc_id
), templates(t, label, words, least, size) as (
  select t, label, list_distinct(string_split(words, ' ')), least, size from (values {rows}) as v(t, label, words, least, size)
), hits as (
  select doc_id, t, label, least, size, len(words) as n_words, i, word
  from (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as i from worded)
  join (select *, unnest(words) as word from templates) using (word)
), windows as (
  select doc_id, label, least, n_words,
         count(distinct word) over (partition by doc_id, t order by i range between current row and size - 1 following) as n
  from hits
), matched as (
  select doc_id, label, n / n_words as share from windows where n >= least
), added as (
  select doc_id, list(distinct label) as labels, max(share) as share from matched group by doc_id
)
select w.doc_id, cast(len(w.w) as bigint) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
       array_to_string(list_sort(coalesce(base.labels, [])), ',') as base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(added.labels, [])))), ',') as labels,
       cast(case when n_base > 0 then 1 else coalesce(share, 0) end as double) as score
from worded w left join base on w.doc_id = base.doc_id left join added on w.doc_id = added.doc_id
"""


@query("op3_license_scan", _license_sql())
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).drop("blocks")


@query("op4_toxicity")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 5) != 0)
    scored = score_toxicity(docs, fit_toxicity(docs, labels))
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


@query(
    "op5_exact_dedup",
    """
with hashed as (select doc_id, sha256(coalesce(text, '')) as text_sha256 from documents)
select doc_id,
       max(doc_id) over (partition by text_sha256) as keep_id,
       count(*) over (partition by text_sha256) as group_size,
       doc_id = max(doc_id) over (partition by text_sha256) as kept,
       text_sha256
from hashed
""",
)
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"), keep="largest")


@query("op6_simhash_dedup")
def simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"), shingle_words=4, most_distance=4)


@query("op7_line_dedup")
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = line_report(table(spark, sf_dir, "documents"))
    return report.withColumn("dropped", F.array_join("dropped", ","))


@query(
    "op8_embedding_dedup",
    """
with recursive bad as (
  select distinct vec_id from (select vec_id, unnest(embedding) as x from embeddings) where x is null or not isfinite(x)
), usable as (
  select vec_id, cast(embedding as double[]) as v from embeddings
  where len(embedding) > 0 and list_aggregate(embedding, 'max') is not null and vec_id not in (select vec_id from bad)
    and (list_aggregate(embedding, 'max') <> 0 or list_aggregate(embedding, 'min') <> 0)
), links as (
  select a.vec_id as a, b.vec_id as b from usable a join usable b on len(a.v) = len(b.v) and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.v, b.v) >= 0.9
), reached(vec_id, other) as (
  select vec_id, vec_id from embeddings union select vec_id, b from reached join links on other = a
), counted as (select a, count(*) as n from links group by a),
roots as (select vec_id, min(other) as component_id from reached group by vec_id)
select e.vec_id, coalesce(n, 0) as n_links, component_id, e.vec_id = component_id as kept
from embeddings e join roots using (vec_id) left join counted on a = e.vec_id
""",
)
def embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), slack="worst")


@query("op9_bpe")
def bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op10_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_language(docs.where(fold(F.col("doc_id"), 3) != 1))
    found = identify_languages(docs, model)
    return found.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")


@query("op11_spelling_variants")
def spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling_variants(table(spark, sf_dir, "documents"), misspell_one_in=199)
    return found.select("word", "form", "root", "n", "n_near", "form_n")


@query("op12_lm_scoring")
def lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"), fold(F.col("doc_id"), 7) != 2)


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults made by a checksum of conversation and turn; what is null counts as one space."""
    space = F.lit(" ")
    conv, turn = (F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn"))
    key = F.concat(conv, F.lit(":"), turn)
    kind = F.crc32(key) % 20
    rows = turns.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), kind.alias("kind"))
    return rows.where("kind <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


@query("op13_conversation_repair")
def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return repair_report(damaged(turns), every=turns)
