"""SimHash near-dedup with Golay-code fuzzy hashing.

A fingerprint's 64 bits are cut into three segments (22, 21 and 21 bits). If two
fingerprints differ in at most 4 bits, then by the pigeonhole principle either

- some segment has no error, and one of the other two has at most 2; or
- every segment has at least one error, and so none has more than 2.

Segments with at most 2 errors share one of their up to six Golay codeword indices
(:mod:`twintally.llm.golay`). So the keys "segment i as it is, an index of segment j"
(all ordered pairs) and "an index of each segment" bring every such pair together, and
comparing the fingerprints that share a key finds every link. A key holds 33 to 36 bits.

Equal fingerprints are one row before keys are made, so a text with very many copies costs
nothing more. Rows that share a key are compared in key order as a stream: first all with
the first of the key (a link is 4 bits or fewer), then what is left by a breadth-first
walk that stops at members already reached. That gives the links that connect a key's
members, not all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twintally.llm import golay
from twintally.llm.scratch import Scratch, components, numbered, one_of_each, quoted, with_least

SEED = 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and bits of each segment
MOST_DISTANCE = 4

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str | None, shingle_words: int) -> int:
    """SimHash of a text's word shingles, unsigned.

    Words are what white space of ASCII separates, A-Z lower-cased; a bit is 1 if it is
    set in over half of the shingles' XXH64 digests. Fewer words than a shingle are one
    shingle; no words give 0.
    """
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    span = min(shingle_words, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - span].tolist(), ends[span:].tolist())),
        np.uint64,
        len(words) - span,
    )
    octets = hashes.view(np.uint8).reshape(-1, 8)
    counts = np.concatenate([np.bincount(octets[:, k], minlength=256) @ _BITS for k in range(8)])
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(
    docs: DataFrame, id_column: str, text_column: str, shingle_words: int, row_column: str | None = None
) -> DataFrame:
    """``doc_id, fp`` for every row, and its number ``row`` if it has one; fp is the fingerprint as a signed long."""
    names = ["doc_id"] if row_column is None else ["doc_id", "row"]

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *keys, texts = batch.columns
            found = np.array([fingerprint(t, shingle_words) for t in texts.to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*keys, pa.array(found.view(np.int64))], [*names, "fp"])

    keys = [quoted(c).cast("long").alias(name) for c, name in zip([id_column, row_column], names)]
    rows = docs.select(*keys, quoted(text_column).cast("string").alias("text"))
    return rows.mapInArrow(compute, ", ".join(f"{name} long" for name in [*names, "fp"]))


def fuzzy_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All keys of unsigned fingerprints: an array of keys, and the row that each belongs to."""
    parts = [(prints >> np.uint64(at)) & np.uint64((1 << n) - 1) for at, n in SEGMENTS]
    near = [golay.near_codewords(part) for part in parts]
    index = [n[0].astype(np.int64) for n in near]
    valid = [np.arange(golay.MOST_KEYS) < n[1][:, None] for n in near]
    keys, rows = [], []
    kind = 0
    for i in range(3):
        for j in range(3):
            if i != j:
                key = (kind << 36) | (parts[i].astype(np.int64)[:, None] << 12) | index[j]
                keys.append(key[valid[j]])
                rows.append(np.nonzero(valid[j])[0])
                kind += 1
    every = (index[0][:, :, None, None] << 24) | (index[1][:, None, :, None] << 12) | index[2][:, None, None, :]
    held = valid[0][:, :, None, None] & valid[1][:, None, :, None] & valid[2][:, None, None, :]
    keys.append((kind << 36) | every[held])
    rows.append(np.nonzero(held)[0])
    return np.concatenate(keys), np.concatenate(rows)


def _emit_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column(0).to_numpy()
        for at in range(0, len(prints), 1000):
            some = prints[at : at + 1000]
            keys, rows = fuzzy_keys(some.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(some[rows])], ["key", "fp"])


def _near(one: np.ndarray, other: np.ndarray, most: int) -> np.ndarray:
    # Counts bits of unsigned numbers: of negative ones NumPy would count the absolute value's.
    return np.bitwise_count(np.bitwise_xor(one, other).view(np.uint64)) <= most


def _walk(prints: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Links that connect everything connected among ``prints``, by breadth-first walks."""
    links, left = [], prints
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            at = front.pop()
            hit = _near(left, at, most)
            if hit.any():
                found = left[hit]
                links += [(at, x) for x in found]
                front += list(found)
                left = left[~hit]
    return links


def _link_runs(keys: np.ndarray, prints: np.ndarray, most: int) -> np.ndarray:
    """Connecting links of every run of equal keys, as rows of two signed fingerprints."""
    new = np.concatenate(([True], keys[1:] != keys[:-1]))
    run = np.cumsum(new) - 1
    firsts = np.nonzero(new)[0]
    first = prints[firsts][run]
    near = _near(prints, first, most)
    linked = near & ~new
    links = [np.stack([first[linked], prints[linked]], 1)]
    length = np.diff(np.append(firsts, len(keys)))
    missed = np.bincount(run[~near], minlength=len(firsts))
    for r in np.nonzero((missed > 0) & (length > 2))[0]:
        links.append(_walk_run(prints[firsts[r] : firsts[r] + length[r]], most))
    return np.unique(np.concatenate(links), axis=0)


def _walk_run(prints: np.ndarray, most: int) -> np.ndarray:
    found = _walk(np.unique(prints), most)
    return np.array(found, np.int64).reshape(-1, 2)


def _link(most: int):
    """Streams rows sorted by key; holds one run of equal keys at most over a batch's end."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def linked(keys: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
            if len(keys) > 1:
                found = _link_runs(keys, prints, most)
                if len(found):
                    yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

        for batch in batches:
            keys, prints = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(keys):
                continue
            held.append((keys, prints))
            if keys[-1] == held[0][0][0]:  # one run so far
                continue
            keys, prints = (np.concatenate(column) for column in zip(*held))
            last = np.searchsorted(keys, keys[-1])
            held = [(keys[last:], prints[last:])]
            yield from linked(keys[:last], prints[:last])
        if held:
            yield from linked(*(np.concatenate(column) for column in zip(*held)))

    return links


def near_links(prints: DataFrame, most_distance: int = MOST_DISTANCE) -> DataFrame:
    """``a, b``: links that connect every pair of distinct ``fp`` at ``most_distance`` bits or fewer.

    Every link given is verified; of a connected group, enough are given to connect it.
    """
    if not 0 <= most_distance <= MOST_DISTANCE:
        raise ValueError(f"the keys find distances of 0 to {MOST_DISTANCE} bits")
    keys = prints.select("fp").mapInArrow(_emit_keys, "key long, fp long")
    dealt = keys.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(_link(most_distance), "a long, b long").distinct()


def simhash_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = 4,
    most_distance: int = MOST_DISTANCE,
) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint, component_id``.

    Documents whose fingerprints differ in ``most_distance`` bits or fewer are linked;
    ``component_id`` is the smallest ``doc_id`` that links reach, the row's own included.
    Other columns are not read.

    - A null text is an empty text; texts without words have the fingerprint 0 and are
      linked like any other.
    - Null identifiers are never the smallest; a component of nothing else has a null one.
    - Rows that repeat an identifier are rows of their own in the result.
    - An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    prints = scratch.keep(fingerprints(docs, id_column, text_column, shingle_words), "fingerprints")
    return prints.join(_groups(prints, scratch, most_distance), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _groups(prints: DataFrame, scratch: Scratch, most_distance: int) -> DataFrame:
    """``fp, root, component_id`` of every fingerprint; root is a fingerprint that stands for the component."""
    distinct = scratch.keep(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    links = scratch.keep(near_links(distinct, most_distance), "links")
    roots = components(links, scratch)
    scratch.drop("links")
    members = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "first", "root")
    groups = with_least(members, "fp", "first", "component_id").select("fp", "root", "component_id")
    groups = scratch.keep(groups, "groups")
    scratch.drop("distinct")
    return groups


def drop_near_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = 4,
    most_distance: int = MOST_DISTANCE,
) -> DataFrame:
    """``docs`` with one row of each component: the one whose identifier is the smallest.

    Of rows that repeat that identifier in the component, or of a component without
    identifiers, the first in the written table stays. Rows go by their number there, so what
    goes takes no row of another component with it. Settings are those of :func:`simhash_groups`.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = numbered(docs, scratch)
    id_name, text_name = (f"column_{docs.columns.index(c)}" for c in (id_column, text_column))
    prints = scratch.keep(fingerprints(rows, id_name, text_name, shingle_words, "row"), "fingerprints")
    groups = _groups(prints, scratch, most_distance)
    candidates = prints.join(groups, "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    return one_of_each(rows, candidates, ["root"]).toDF(*docs.columns)
