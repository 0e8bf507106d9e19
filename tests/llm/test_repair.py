"""Conversation repair against a search over all edits."""

import hashlib
import zlib
from functools import cache

import numpy as np
import pytest

from twintally.llm import repair
from twintally.llm.queries import QUERIES
from twintally.llm.repair import cheapest_edits, repair_conversations, repair_report


@cache
def search(rows, state=0):
    """Least cost and, of its audits, the ASCII-least; rows are (initial, fault). A turn is only inserted once at a place."""
    after = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    options = []
    if not rows and state in (0, 3):
        options.append((0, ""))
    if rows:
        (initial, fault), rest = rows[0], rows[1:]
        options.append(join(2, "D", search(rest, state)))
        if fault not in (1, 2):
            extra = 5 * (fault == 3)
            if (state, initial) in after:
                options.append(join(extra, "K", search(rest, after[state, initial])))
            for role in "ua":
                if (state, role) in after:
                    options.append(join(1 + extra, "R", search(rest, after[state, role])))
    for role in "ua":
        if (state, role) in after:
            options += [join(5, "I", o) for o in inserted(rows, after[state, role], 3)]
    return min(options)


def inserted(rows, state, most):
    """Up to ``most`` more turns inserted, then something else."""
    after = {(0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    found = [search_without_insert(rows, state)]
    if most:
        for role in "ua":
            if (state, role) in after:
                found += [join(5, "I", o) for o in inserted(rows, after[state, role], most - 1)]
    return [f for f in found if f is not None]


@cache
def search_without_insert(rows, state):
    after = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    if not rows:
        return (0, "") if state in (0, 3) else None
    (initial, fault), rest = rows[0], rows[1:]
    options = [join(2, "D", search(rest, state))]
    if fault not in (1, 2):
        extra = 5 * (fault == 3)
        if (state, initial) in after:
            options.append(join(extra, "K", search(rest, after[state, initial])))
        for role in "ua":
            if (state, role) in after:
                options.append(join(1 + extra, "R", search(rest, after[state, role])))
    return min(options)


def join(cost, edit, found):
    return cost + found[0], edit + found[1]


def symbols(rows):
    return bytes(("sua".find(i) if i and i in "sua" else 3) * 4 + f for i, f in rows)


def test_edits_of_random_conversations():
    rng = np.random.default_rng(5)
    for _ in range(3000):
        rows = tuple((str(rng.choice(["s", "u", "a", "t"], p=[0.1, 0.4, 0.4, 0.1])), int(rng.choice(4, p=[0.6, 0.1, 0.1, 0.2]))) for _ in range(rng.integers(0, 10)))
        assert cheapest_edits(symbols(rows)) == search(rows), rows


def test_few_vectors_make_the_tables():
    vectors, step, _, to, cost = repair.block_tables()
    assert len(vectors) < 200 and to.shape == cost.shape == (len(vectors), repair._CLASSES**repair.BLOCK)
    rng = np.random.default_rng(6)
    for _ in range(200):
        rows = rng.integers(0, repair._CLASSES, repair.BLOCK)
        vector = int(rng.integers(len(vectors)))
        plain = vectors[vector]
        for row in reversed(rows.tolist()):
            plain = repair._before(plain, row)
        block = int(sum(r * repair._CLASSES ** (repair.BLOCK - 1 - n) for n, r in enumerate(rows.tolist())))
        assert tuple(c + cost[vector, block] for c in vectors[to[vector, block]]) == plain


SPACES = " \t\n\x0b\x0c\r"


def damage(rows):
    """Rows of one conversation after damage, in order."""
    found = []
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = {1: "", 2: "".join(c for c in text if c not in ".!?")}.get(kind, text)
        role = "user" if kind == 4 else role
        found += [(turn, role, text)] * (2 if kind == 3 else 1)
    return sorted(found, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def slow_report(conv, rows):
    seen, faults = set(), []
    for _, role, text in rows:
        said = text.rstrip(SPACES)
        faults.append(1 if not said else 2 if (role, text) in seen else 3 if said[-1] not in ".!?" else 0)
        seen.add((role, text))
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit = search(tuple(zip(initials, faults)))
    out, state, at = [], 0, iter(rows)
    new, after = {0: "user", 1: "user", 2: "assistant", 3: "user"}, {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    for edit in audit:
        if edit == "I":
            role, text = new[state], ""
        else:
            _, role, text = next(at)
            if edit == "D":
                continue
            role = new[state] if edit == "R" else role
        state = after[state, role[0]]
        out.append(f"{role}:{text}")
    turns = {r[0] for r in rows} - {None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
    return (conv, gaps, faults.count(1), faults.count(2), faults.count(3), illegal, cost, audit, digest)


def by_conversation(rows):
    found = {}
    for row in rows:
        found.setdefault(row[0], []).append(row)
    return found


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    wanted = {slow_report(conv, damage(own)) for conv, own in by_conversation(rows).items()}
    assert {tuple(r) for r in QUERIES["op13_conversation_repair"](spark, sf_dir).collect()} == wanted


@pytest.fixture(scope="module")
def odd_turns(spark):
    rng = np.random.default_rng(7)
    texts = ["Yes.", "No!", "", " \t", "cut", "a ? \n", None, "　", "long " * 5000 + "."]
    roles = ["user", "assistant", "system", "tool", "", None, "ask", "User"]
    rows = [
        (int(rng.integers(40)) if rng.random() > 0.03 else None, None if rng.random() < 0.1 else int(rng.integers(-3, 12)), roles[rng.integers(8)] if rng.random() < 0.4 else roles[rng.integers(2)], texts[rng.integers(len(texts))] if rng.random() < 0.5 else f"Text {rng.integers(9)}.", 1)
        for _ in range(300)
    ]
    rows += rows[:20] + [(99, None, None, None, 1), (98, 5, "user", None, 1)]
    return rows, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, symbol int").repartition(5)


def given(rows):
    cleaned = [(t, r if r is not None else " ", x if x is not None else " ") for _, t, r, x, *_ in rows]
    return sorted(cleaned, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def test_odd_turns(spark, odd_turns):
    rows, frame = odd_turns
    wanted = {slow_report(conv, given(own)) for conv, own in by_conversation(rows).items()}
    assert {tuple(r) for r in repair_report(frame).collect()} == wanted
    turns = by_conversation(sorted((tuple(r) for r in repair_conversations(frame).collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1])))
    for conv, *_, audit, digest in wanted:
        out = turns.get(conv, [])
        assert hashlib.sha256("\n".join(f"{r[2]}:{r[3]}" for r in out).encode()).hexdigest() == digest
        assert [r[1] for r in out] == list(range(len(out))) and "".join(r[4] for r in out) == audit.replace("D", "")


def test_a_conversation_of_many_pieces(spark, monkeypatch):
    rows = [(1, n, "user" if n % 3 else "assistant", f"t{n}." if n % 7 else "cut") for n in range(500)] + [(2, 0, "user", "Same.")] * 90
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    wanted = {}
    for conv, own in by_conversation(rows).items():
        wanted[conv] = slow_symbols(given([(*r, 0) for r in own]))
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    found = {r.conv_id: (r.cost, r.audit) for r in repair_report(frame).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert found == wanted


def slow_symbols(rows):
    seen, faults = set(), []
    for _, role, text in rows:
        said = text.rstrip(SPACES)
        faults.append(1 if not said else 2 if (role, text) in seen else 3 if said[-1] not in ".!?" else 0)
        seen.add((role, text))
    return cheapest_edits(symbols(list(zip([r[1][:1] for r in rows], faults))))


def test_pieces_are_cut(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(repair, "PIECE", 4)
    batch = pa.RecordBatch.from_pydict({"conv_id": [1, 1, 2], "turn": [0, 1, 0], "n": [11, 2, 1], "symbol": [4, 8, 4]})
    pieces = [r for b in repair._pieces(iter([batch])) for r in b.to_pylist()]
    assert b"".join(r["symbols"] for r in pieces if r["conv_id"] == 1) == bytes([4] + [6] * 10 + [8, 10])
    assert max(len(r["symbols"]) for r in pieces) <= 9 and [r["place"] for r in pieces] == sorted(r["place"] for r in pieces)


def test_nothing(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair_report(empty).collect() == [] and repair_conversations(empty).collect() == []
    one = spark.createDataFrame([(7,), (None,)], "conv_id long")
    assert {tuple(r) for r in repair_report(empty, every=one).collect()} == {
        (c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) for c in (7, None)
    }
