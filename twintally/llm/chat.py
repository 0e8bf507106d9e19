"""Chat formatting: typed content parts, one template, and a way back.

A turn's content is an ordered list of typed parts. A visitor walks the parts and
writes text as text (escaped) and every image, audio clip or document as a
placeholder, and records what the placeholder stands for: which attachment, where,
and how many tokens a model will expand it to.

The template marks turns with ``<|turn|>role`` + newline and ``<|end|>``. In texts
and roles every ``&``, ``<`` and ``[`` is written as an entity, so neither the
template's own marks nor those of the common chat templates (``<s>``, ``[INST]``, ...)
can appear inside a text, and reading the entities back gives the text exactly.

Built-in functions only. A conversation is put together in two steps, blocks of turns
first, so that the last step of a very long conversation meets its blocks, not its
turns. The formatted conversation itself is one value and so must fit in a row (2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twintally.llm.scratch import quoted

TURN, END = "<|turn|>", "<|end|>"

# The escapes. ``&`` is written first and read back last.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lsqb;"))

PARTS_TYPE = "array<struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"

TURNS_PER_BLOCK = 64


def escape(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for plain, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def text_parts(text: Column) -> Column:
    """A plain text as a list of one text part; null counts as empty."""
    part = F.struct(
        F.lit("text").alias("kind"),
        F.coalesce(text.cast("string"), F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("int").alias("width"),
        F.lit(None).cast("int").alias("height"),
        F.lit(None).cast("double").alias("seconds"),
        F.lit(None).cast("int").alias("pages"),
    )
    return F.array(part)


def _expanded_tokens(part: Column, patch: int, audio_rate: int, page_tokens: int) -> Column:
    """Tokens that a model puts in the place of a part's placeholder; unknown sizes count as one unit."""

    def units(value: Column, per: int) -> Column:
        return F.greatest(F.ceil(F.coalesce(value, F.lit(1)) / per), F.lit(1)).cast("long")

    return (
        F.when(part.kind == "image", units(part.width, patch) * units(part.height, patch))
        .when(part.kind == "audio", F.greatest(F.ceil(F.coalesce(part.seconds, F.lit(1.0)) * audio_rate), F.lit(1)))
        .when(part.kind == "document", units(part.pages, 1) * page_tokens)
        .otherwise(F.lit(0))
        .cast("long")
    )


def visit_parts(parts: Column, patch: int = 14, audio_rate: int = 25, page_tokens: int = 256) -> Column:
    """An array of visited parts, in order: what is written, and what it refers to.

    Each is ``struct(written, kind, ref, tokens)``. Text has the kind ``text`` and no
    ref; image, audio and document parts are written as ``<|kind|>``; a part of
    another or a null kind is written as its text. Null parts and null lists are
    skipped.
    """

    def visited(part: Column) -> Column:
        attached = F.coalesce(part.kind.isin("image", "audio", "document"), F.lit(False))
        return F.struct(
            F.when(attached, F.concat(F.lit("<|"), part.kind, F.lit("|>")))
            .otherwise(escape(F.coalesce(part.text, F.lit(""))))
            .alias("written"),
            F.when(attached, part.kind).otherwise(F.lit("text")).alias("kind"),
            F.when(attached, F.coalesce(part.ref, F.lit(""))).alias("ref"),
            F.when(attached, _expanded_tokens(part, patch, audio_rate, page_tokens))
            .otherwise(F.lit(0).cast("long"))
            .alias("tokens"),
        )

    present = F.coalesce(parts, F.array().cast(PARTS_TYPE))
    return F.transform(F.filter(present, lambda part: part.isNotNull()), visited)


def format_chats(
    turns: DataFrame,
    parts: Column,
    conv_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    learn_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: its formatted text, loss mask and attachments.

    Columns: ``conv_id``; ``n_turns``; ``blocks``, an array in order of
    ``struct(text, spans)``, where spans are ``struct(start, length)`` in code points of the
    block's text and cover what is learnt, the contents of ``learn_role``'s turns;
    ``attachments``, an array of ``struct(turn, kind, ref, tokens)`` in order; and
    ``expanded_tokens``, their sum. The formatted conversation is the blocks' texts one
    after another (:func:`formatted`).

    Turns come in the order of their number; null is before all others, and rows that
    share a number come in the order of role and text. A null role is the empty role. Rows
    of a null conversation are one conversation. No rows give no conversations.
    """
    visited = visit_parts(parts)
    rows = turns.select(
        quoted(conv_column).alias("conv_id"),
        quoted(turn_column).cast("long").alias("turn"),
        F.coalesce(quoted(role_column).cast("string"), F.lit("")).alias("role"),
        visited.alias("visited"),
    ).select(
        "conv_id",
        "turn",
        "role",
        F.concat_ws("", F.col("visited.written")).alias("body"),
        F.filter("visited", lambda part: part.ref.isNotNull()).alias("attached"),
    )
    head = F.concat(F.lit(TURN), F.replace(escape(F.col("role")), F.lit("\n"), F.lit("&#10;")), F.lit("\n"))
    rows = rows.select(
        "conv_id",
        F.floor(F.col("turn") / TURNS_PER_BLOCK).alias("block"),
        F.struct(
            "turn",
            "role",
            F.concat(head, "body", F.lit(END)).alias("written"),
            F.char_length(head).cast("long").alias("before"),
            F.when(F.col("role") == learn_role, F.char_length("body")).cast("long").alias("learnt"),
            F.transform(
                "attached",
                lambda part: F.struct(F.col("turn").alias("turn"), part.kind.alias("kind"), part.ref.alias("ref"), part.tokens.alias("tokens")),
            ).alias("attached"),
        ).alias("row"),
    )
    blocks = rows.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    blocks = blocks.select(
        "conv_id",
        F.struct(
            "block",
            F.array_join("rows.written", "").alias("text"),
            _spans(F.col("rows")).alias("spans"),
            F.flatten("rows.attached").alias("attached"),
            F.size("rows").cast("long").alias("n_turns"),
        ).alias("part"),
    )
    chats = blocks.groupBy("conv_id").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    attachments = F.flatten("parts.attached")
    return chats.select(
        "conv_id",
        _total(F.col("parts.n_turns")).alias("n_turns"),
        F.transform("parts", lambda part: F.struct(part.text.alias("text"), part.spans.alias("spans"))).alias("blocks"),
        attachments.alias("attachments"),
        _total(F.transform(attachments, lambda part: part.tokens)).alias("expanded_tokens"),
    )


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda so_far, n: so_far + n)


def _spans(rows: Column) -> Column:
    """Where the learnt texts of a block stand in it."""
    nothing = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def add(so_far: Column, row: Column) -> Column:
        span = F.struct((so_far.at + row.before).alias("start"), row.learnt.alias("length"))
        return F.struct(
            (so_far.at + F.char_length(row.written)).alias("at"),
            F.when(row.learnt.isNotNull(), F.concat(so_far.spans, F.array(span))).otherwise(so_far.spans).alias("spans"),
        )

    return F.aggregate(rows, nothing, add, lambda done: done.spans)


def formatted(blocks: Column) -> Column:
    """The formatted conversation as one text."""
    return F.array_join(F.transform(blocks, lambda block: block.text), "")


def read_turns(blocks: Column) -> Column:
    """``struct(role, text)`` of each turn, read back from the formatted text.

    Placeholders stand in the text as they were written.
    """

    def turn(written: Column) -> Column:
        return F.struct(
            unescape(F.replace(F.substring_index(written, "\n", 1), F.lit("&#10;"), F.lit("\n"))).alias("role"),
            unescape(F.regexp_replace(F.substring_index(written, END, 1), r"\A[^\n]*\n", "")).alias("text"),
        )

    def turns(block: Column) -> Column:
        return F.transform(F.slice(F.split(block.text, r"<\|turn\|>"), 2, 1 << 30), turn)

    return F.flatten(F.transform(blocks, turns))


def read_learnt(blocks: Column) -> Column:
    """All text under the loss mask, in order, escapes read back."""

    def learnt(block: Column) -> Column:
        return F.array_join(
            F.transform(block.spans, lambda span: F.substring(block.text, (span.start + 1).cast("int"), span.length.cast("int"))),
            "",
        )

    return unescape(F.array_join(F.transform(blocks, learnt), ""))
