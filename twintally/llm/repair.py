"""Repair of a conversation's structure at least cost, by Four-Russians block tables.

A conversation's roles should read ``(s?(ua)+)?`` by their initials: an optional system turn, then
user and assistant in turn. Rows may be kept (0), given the role user or assistant (1),
deleted (2) or preceded by an inserted empty turn (5). Blank and repeated rows must be deleted; a
row that breaks off costs 5 more if it stays.

What is left to pay from a row on is a vector of four costs, one for each state of that pattern.
Less its smallest cost there are few such vectors, so

- the transition of every vector over every block of ``BLOCK`` row classes is worked out once;
- a conversation is processed from its end, one table lookup per block;
- its edits are traced from its start: each block is expanded again, backward from the vector that
  was stored at its end, and of the cheapest edits the first in ASCII order is taken. The costs that are
  left are exact, so that gives the ASCII-least of all cheapest sequences of edits.

A row is one byte there. Rows are dealt to tasks by ranges of conversation and turn and cut to
pieces of at most ``PIECE`` rows, so that a conversation of any length is read by many tasks; one row then
holds its bytes, as it holds its edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twintally.llm.scratch import Scratch, quoted

BLOCK = 4
PIECE = 1 << 16
SPACES = " \t\n\x0b\x0c\r"

RENAME, DELETE, INSERT, BROKEN = 1, 2, 5, 5  # costs

_INITIALS = "sua"  # others count as one more
_NONE, _BLANK, _DUPLICATE, _TRUNCATED = range(4)

# States: nothing yet, after s, after u, after a. What each initial leads to, and what a new turn is there.
_NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_NEW = ("u", "u", "a", "u")
_ROLE = {"u": "user", "a": "assistant"}
_NEVER = 1 << 20

# Classes of rows: 0 must go; else one more than initial * 2 + whether it breaks off.
_CLASSES = 1 + 2 * (len(_INITIALS) + 1)


def _row_class(symbol: int) -> int:
    initial, fault = divmod(symbol, 4)
    return 0 if fault in (_BLANK, _DUPLICATE) else 1 + 2 * initial + (fault == _TRUNCATED)


_CLASS_OF = np.array([_row_class(symbol) for symbol in range(4 * (len(_INITIALS) + 1))], np.uint8)


def _options(state: int, row: int) -> list[tuple[str, int, int]]:
    """What may be done with a row: edit, cost, next state."""
    options = [("D", DELETE, state)]
    if row:
        initial, broken = divmod(row - 1, 2)
        kept = _NEXT[state].get(_INITIALS[initial : initial + 1])
        if kept is not None:
            options.append(("K", BROKEN * broken, kept))
        options.append(("R", RENAME + BROKEN * broken, _NEXT[state][_NEW[state]]))
    return options


def _with_inserts(costs: list[int]) -> tuple[int, ...]:
    """The costs when any number of turns may be inserted first."""
    two, three = min(costs[2], INSERT + costs[3]), min(costs[3], INSERT + costs[2])
    return min(costs[0], INSERT + two), min(costs[1], INSERT + two), two, three


def _before(after: tuple[int, ...], row: int) -> tuple[int, ...]:
    """Costs before a row from those after it."""
    return _with_inserts([min(cost + after[to] for _, cost, to in _options(state, row)) for state in range(4)])


_AT_END = _with_inserts([0, _NEVER, _NEVER, 0])


@cache
def block_tables() -> tuple[list[tuple[int, ...]], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Normalised vectors, and over one row and over one block of rows: the vector before, and what it costs more.

    A block is a number whose digits to the base of the classes are its rows, the first row highest.
    """
    vectors, place, one, more = [_AT_END], {_AT_END: 0}, [], []
    for vector in vectors:  # grows
        found = [_before(vector, row) for row in range(_CLASSES)]
        least = [min(v) for v in found]
        normal = [tuple(c - low for c in v) for v, low in zip(found, least)]
        for v in normal:
            if v not in place:
                place[v] = len(vectors)
                vectors.append(v)
        one.append([place[v] for v in normal])
        more.append(least)
    step, added = np.array(one, np.int32), np.array(more, np.int64)
    to, cost = step, added  # the last row of the block first
    for _ in range(BLOCK - 1):
        wide = (len(vectors), -1)
        to, cost = (
            np.swapaxes(step[to], 1, 2).reshape(wide),
            np.swapaxes(added[to] + cost[:, :, None], 1, 2).reshape(wide),
        )
    return vectors, step, added, to, cost


def cheapest_edits(symbols: bytes) -> tuple[int, str]:
    """Cost and edits of a conversation; a symbol is ``initial * 4 + fault``."""
    vectors, step, added, block_step, block_added = block_tables()
    rows = _CLASS_OF[np.frombuffer(symbols, np.uint8)]
    single = len(rows) % BLOCK  # these come before the blocks
    weights = _CLASSES ** np.arange(BLOCK - 1, -1, -1)
    blocks = (rows[single:].reshape(-1, BLOCK) @ weights).tolist()
    rows = rows.tolist()

    at, total = 0, 0
    ends = []  # the vector after each block, the last block first
    for block in reversed(blocks):
        ends.append(at)
        total += int(block_added[at, block])
        at = int(block_step[at, block])
    cuts = [(single + BLOCK * n, single + BLOCK * (n + 1), end) for n, end in enumerate(reversed(ends))]
    if single:
        cuts.insert(0, (0, single, at))
        for row in reversed(rows[:single]):
            total += int(added[at, row])
            at = int(step[at, row])
    total += vectors[at][0]

    edits, state = [], 0
    for start, stop, end in cuts:
        left = [vectors[end]]  # costs before each row of the block, the block's end first
        for row in reversed(rows[start:stop]):
            left.append(_before(left[-1], row))
        for n, row in enumerate(rows[start:stop]):
            here, after = left[stop - start - n], left[stop - start - n - 1]
            done = False
            while not done:
                choices = [(edit, to, True) for edit, cost, to in _options(state, row) if cost + after[to] == here[state]]
                new = _NEXT[state][_NEW[state]]
                if INSERT + here[new] == here[state]:
                    choices.append(("I", new, False))
                edit, state, done = min(choices)
                edits.append(edit)
    while state in (1, 2):
        edits.append("I")
        state = _NEXT[state][_NEW[state]]
    return total, "".join(edits)


def with_faults(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, n, symbol`` of rows ``conv_id, turn, role, text``; equal rows are one with their number.

    A conversation's rows are in order of turn (nulls first), role and text. A row's fault is the first of
    blank, duplicate (role and text occur earlier) and truncated; of equal rows, all but the first are
    duplicates unless blank. ``symbol`` is that of the first.
    """
    both = [F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit("again"), "text", "role").alias("h2")]
    rows = turns.select("conv_id", "turn", "role", "text", *both)
    rows = rows.groupBy("conv_id", "turn", "h1", "h2").agg(
        F.count("*").alias("n"), F.first("role").alias("role"), F.first("text").alias("text")
    )
    # Nulls come first, and a minimum would pass over them.
    place = F.struct(F.col("turn").isNotNull().alias("numbered"), F.col("turn"))
    firsts = rows.groupBy(*[F.col(c).alias(f"{c}_") for c in ("conv_id", "h1", "h2")]).agg(F.min(place).alias("first"))
    same = F.col("conv_id").eqNullSafe(F.col("conv_id_")) & (F.col("h1") == F.col("h1_")) & (F.col("h2") == F.col("h2_"))
    rows = rows.join(firsts, same)
    said = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = (
        F.when(said == "", _BLANK)
        .when(place != F.col("first"), _DUPLICATE)
        .when(~F.right(said, F.lit(1)).isin(".", "!", "?"), _TRUNCATED)
        .otherwise(_NONE)
    )
    initial = F.instr(F.lit(_INITIALS), F.substring("role", 1, 1))
    initial = F.when((initial == 0) | (F.col("role") == ""), len(_INITIALS)).otherwise(initial - 1)
    return rows.select("conv_id", "turn", "role", "text", "n", (initial * 4 + fault).cast("int").alias("symbol"))


def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    return rows.sortWithinPartitions("conv_id", *first, F.col("turn").asc_nulls_first(), "role", "text")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a conversation as one row of bytes."""
    place, now, found = 0, None, bytearray()

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([now[0]], pa.int64()), pa.array([now[1]], pa.int64()), pa.array([place], pa.int64()), pa.array([bytes(found)])],
            ["conv_id", "turn", "place", "symbols"],
        )

    for batch in batches:
        for conv, turn, n, symbol in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "n", "symbol"))):
            if now is None or now[0] != conv or len(found) >= PIECE:
                if now is not None:
                    yield piece()
                now, found, place = (conv, turn), bytearray(), place + 1
            again = symbol if symbol % 4 == _BLANK else symbol - symbol % 4 + _DUPLICATE
            found.append(symbol)
            while n > PIECE:
                found += bytes([again]) * PIECE
                yield piece()
                found, place, n = bytearray(), place + 1, n - PIECE
            found += bytes([again]) * (n - 1)
    if now is not None:
        yield piece()


_AUDIT = "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for conv, symbols in zip(batch.column("conv_id").to_pylist(), batch.column("symbols").to_pylist()):
            every = np.frombuffer(symbols, np.uint8)
            fault, initial = every % 4, every // 4
            s, u, a = (initial == n for n in range(3))
            legal = (s[:-1] & u[1:]) | (u[:-1] & a[1:]) | (a[:-1] & u[1:])
            counts = [int((fault == kind).sum()) for kind in (_BLANK, _DUPLICATE, _TRUNCATED)]
            rows.append((conv, *counts, int((~legal).sum()), *cheapest_edits(symbols)))
        kinds = [pa.int64()] * 6 + [pa.string()]
        names = [c.split()[0] for c in _AUDIT.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows) if rows else [()] * 7, kinds)], names)


def audit_conversations(rows: DataFrame) -> DataFrame:
    """``conv_id, blank, duplicate, truncated, illegal, cost, audit`` for each conversation of :func:`with_faults`.

    ``illegal`` counts neighbours whose role initials are not su, ua or au; ``audit`` has the initials of the edits.
    """
    dealt = rows.select("conv_id", "turn", "role", "text", "n", "symbol").repartitionByRange("conv_id", "turn")
    pieces = _in_order(dealt).select("conv_id", "turn", "n", "symbol").mapInArrow(
        _pieces, "conv_id long, turn long, place long, symbols binary"
    )
    # Tasks hold ranges, so turn and then place within a task put the pieces in order.
    order = F.struct(F.col("turn").isNotNull().alias("numbered"), "turn", "place", "symbols")
    joined = pieces.groupBy("conv_id").agg(F.array_sort(F.collect_list(order)).alias("pieces"))
    # Bytes are below 128, so they are also text.
    text = F.array_join(F.transform("pieces", lambda p: p.symbols.cast("string")), "")
    return joined.select("conv_id", text.cast("binary").alias("symbols")).mapInArrow(_audits, _AUDIT)


def _applied(edits: str, rows: Iterator[tuple[str, str, int]]) -> Iterator[tuple[str, str, str]]:
    """Edit, role and text of the turns that stay; rows are consumed as they come."""
    state, copies = 0, iter(())
    for edit in edits:
        if edit == "I":
            role = _ROLE[_NEW[state]]
            text = ""
        else:
            row = next(copies, None)
            if row is None:
                role, text, n = next(rows)
                copies = repeat((role, text), n - 1)
            else:
                role, text = row
            if edit == "D":
                continue
            if edit == "R":
                role = _ROLE[_NEW[state]]
        state = _NEXT[state][role[0]]
        yield edit, role, text


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str, Iterator[tuple[str, str, int]]]]:
    """Each conversation's edits and its rows as they come; sorted, the edits before the rows."""

    def every():
        names = ("conv_id", "audit", "role", "text", "n")
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in names))

    stream, held = every(), []

    def rows():
        for conv, audit, role, text, n in stream:
            if audit is not None:
                held.append((conv, audit))
                return
            yield role, text, n

    first = next(stream, None)
    if first is not None:
        held.append(first[:2])
    while held:
        conv, audit = held.pop()
        mine = rows()
        yield conv, audit, mine
        for _ in mine:  # rows that were not asked for
            pass


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    schema = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    for conv, audit, mine in _conversations(batches):
        for position, (edit, role, text) in enumerate(_applied(audit, mine)):
            rows.append((conv, position, role, text, edit))
            size += len(text)
            if len(rows) >= 4096 or size >= 1 << 22:
                yield batch()
                rows, size = [], 0
    if rows:
        yield batch()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for conv, audit, mine in _conversations(batches):
        digest, sep = hashlib.sha256(), b""
        for _, role, text in _applied(audit, mine):
            digest.update(sep + role.encode() + b":" + text.encode())
            sep = b"\n"
        yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([digest.hexdigest()])], ["conv_id", "repaired_sha256"])


def _with_edits(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """Each conversation's edits and then its rows, in the order in which they are read."""
    none = F.lit(None)
    edits = audits.select("conv_id", "audit", *[none.cast(k).alias(c) for c, k in (("turn", "long"), ("role", "string"), ("text", "string"), ("n", "long"))])
    every = rows.select("conv_id", none.cast("string").alias("audit"), "turn", "role", "text", "n").unionAll(edits)
    dealt = every.withColumn("later", F.col("audit").isNull()).repartition("conv_id")
    return _in_order(dealt, "later").select("conv_id", "audit", "role", "text", "n")


def repaired_turns(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """``conv_id, position, role, text, edit`` of what the conversations are repaired to."""
    return _with_edits(rows, audits).mapInArrow(_turns, "conv_id long, position long, role string, text string, edit string")


def repaired_digests(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256``: the repaired ``role:text``, newline-joined. Texts are hashed as they stream by."""
    return _with_edits(rows, audits).mapInArrow(_digests, "conv_id long, repaired_sha256 string")


def _audited(turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    kinds = {"conv_id": "long", "turn": "long", "role": "string", "text": "string"}
    typed = turns.select(*[quoted(c).cast(kind).alias(c) for c, kind in kinds.items()])
    typed = typed.withColumns({c: F.coalesce(c, F.lit(" ")) for c in ("role", "text")})
    scratch = Scratch(turns.sparkSession, "repair")
    rows = scratch.keep(with_faults(typed), "rows")
    return typed, rows, scratch.keep(audit_conversations(rows), "audits")


def repair_conversations(turns: DataFrame) -> DataFrame:
    """The repaired turns of ``turns`` (``conv_id, turn, role, text``; other columns are not read).

    A null role or text is one space; null turns come first, rows that tie in turn go by role and text; a null
    conversation is one like any other. Texts may be of any length. No rows give no rows.
    """
    _, rows, audits = _audited(turns)
    return repaired_turns(rows, audits)


def repair_report(turns: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """One row per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    ``gaps`` counts the numbers that are missing between a conversation's turns. ``every`` may name in ``conv_id``
    more conversations; those without rows have zeros, no edits and the digest of the empty text.
    What :func:`repair_conversations` says of nulls and ties holds here too.
    """
    typed, rows, audits = _audited(turns)
    gaps = rows.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps")
    )
    conversations = typed.select("conv_id") if every is None else every.select(quoted("conv_id").cast("long").alias("conv_id"))
    found = conversations.distinct()
    for part in (gaps, audits, repaired_digests(rows, audits)):
        found = found.join(part.withColumnRenamed("conv_id", "other"), F.col("conv_id").eqNullSafe(F.col("other")), "left").drop("other")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    nothing = hashlib.sha256().hexdigest()
    return found.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast(T.LongType()).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
