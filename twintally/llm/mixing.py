"""Language-model scoring by online logistic context mixing.

A text is a sequence of binary decisions, each predicted by several hashed contexts. Every context has counted over
the whole training corpus how often the decision was 1 and 0. Their log odds are mixed with weights chosen by a gate,
the mixture is the probability of the decision, and the weights are refined after it was seen.

- *Was the word said in this text before?* Contexts: the word before, the two words before, how the last
  decisions went, how many different words the text has. Weights start equal in every text and are refined as it goes
  on, so the score learns nothing of other texts but the counts. A repeated word then costs its share of the text so far.
- *Bits of a word's bytes*, for words that are new to the text: contexts are the bytes before it in
  the word, up to ``ORDERS``. The counts are of the different training words, as new words are words that occur once
  more. Weights start with those refined over words that occur once, as if these had not been counted, in shards of a
  fixed size by hash, and averaged. From there they are refined in every text as it goes on, so a word is spelt anew in
  each text that says it.
- *Kinds of text* are the gate of whole words. Short words are clustered by the texts that they share, and what
  short words were said so far tells the kind. Counts of whole words take part by absolute discounting, those
  of the kind first: ``(c - D + (D * V + 1) * next) / (N + 1)``, where ``next`` is the same of all kinds and
  after that the spelling. What is taken from every counted word goes on, so the probabilities of all words sum to 1.
  Words that a text has said leave the sum with what they had when they were said.

Counts of words are exact, in a written table that grows with the corpus. Probabilities by count of the at most ``MOST_HEAD`` most
frequent words are broadcast; all other words are joined to it by a shuffle. The hashed contexts have tables of a fixed
size, ``2 ** TABLE_BITS`` entries per context; where contexts share an entry, its odds blur.

Base score: add-one probabilities of single words.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twintally.llm.scratch import Scratch, quoted

MOST_HEAD = 1 << 18
LONGEST_HEAD = 64  # bytes of a word that is broadcast
TABLE_BITS = 18
ORDERS = 5
SHARD = 20_000  # words
KINDS = 8
SHORT = 3  # bytes of a word that tells a text's kind

END = b"\n"

_MIX = np.uint64(0x9E3779B97F4A7C15)
_SLOTS = 1 << TABLE_BITS
_SPELLING_RATE, _TEXT_RATE = 0.2, 0.02
_REFINED = 256  # words between refinements
_BLOCK = 32  # decisions of a text between refinements
_PRIOR = 256  # bits that hold each of a text's gates to the weights it started with
_SPELT = 64  # new words of a text between refinements of the weights of bits
_PIECE = 8192  # bytes of words whose bits are mixed at a time
_RECENT = 8  # decisions that are looked back upon
_LENGTHS = 24  # buckets of positions, by their logarithm
_GATES = 4
_MARKS = 512  # entries of short words
_MOST_HELD = 250_000
_MOST_BYTES = 1 << 20  # of texts or words that are worked on at a time


def tokens(text: str | None) -> list[bytes]:
    """Words between white space of ASCII, A-Z lower-cased, and the end."""
    words = (text or "").encode().lower().split()
    words.append(END)
    return words


# Kinds of text


class _Marks(dict):
    """Marks of short words; there are few."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > _MOST_HELD:
            self.clear()
        self[word] = mark = xxhash.xxh64_intdigest(word) % _MARKS
        return mark


def _count_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts two marks meet, the lower one first."""
    found, marks = np.zeros((_MARKS, _MARKS), np.int64), _Marks()
    for batch in batches:
        for start in range(0, batch.num_rows, 2000):
            some = batch.column("text").slice(start, 2000).to_pylist()
            held = np.zeros((len(some), _MARKS), np.float32)
            for row, text in enumerate(some):
                held[row, [marks[w] for w in set(tokens(text)) if len(w) <= SHORT]] = 1
            found += (held.T @ held).astype(np.int64)
    flat = np.triu(found).ravel()
    at = np.nonzero(flat)[0]
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[at])], ["entry", "n"])


@dataclass(frozen=True)
class Kinds:
    """Log probabilities of kinds, and of each kind's marks: whole numbers of 1/256, so that sums are exact."""

    prior: np.ndarray
    marks: np.ndarray


def _clusters(together: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kinds' shares, and their shares of marks: the mixture that tells best which two marks meet, by expectation-maximisation."""
    pairs = together.astype(float)
    np.fill_diagonal(pairs, 0)
    pairs /= max(pairs.sum(), 1)
    marks = pairs.sum(axis=1) + 1e-9
    of = marks[:, None] * np.random.default_rng(0).uniform(0.5, 1.5, (_MARKS, KINDS))
    of /= of.sum(axis=0)
    shares = np.full(KINDS, 1 / KINDS)
    for _ in range(200):
        ratio = pairs / ((of * shares) @ of.T)
        joint = of * (ratio @ of) * shares + 1e-12
        shares = joint.sum(axis=0) / joint.sum()
        of = joint / joint.sum(axis=0)
    return shares, of


def fit_kinds(texts: DataFrame) -> Kinds:
    """Kinds of the rows of ``text``. What is collected are at most ``_MARKS ** 2`` numbers."""
    rows = texts.select("text").mapInArrow(_count_marks, "entry long, n long").groupBy("entry").agg(F.sum("n").alias("n")).toArrow()
    half = np.zeros(_MARKS**2, np.int64)
    half[rows["entry"].to_numpy()] = rows["n"].to_numpy()
    half = half.reshape(_MARKS, _MARKS)
    shares, of = _clusters(half + np.triu(half, 1).T)
    return Kinds(*(np.round(256 * np.log(x)).astype(np.int64) for x in (shares, of + 1e-5)))


# Counts of words


_COUNTED = ["token", *[f"k{k}" for k in range(KINDS)], "entry", "n0", "n1"]
_COUNTED_KINDS = "token binary, " + ", ".join(f"{c} long" for c in _COUNTED[1:])


def _count_batches(kinds):
    def words(held: dict[bytes, int], n: np.ndarray) -> pa.RecordBatch:
        none = pa.nulls(len(held), pa.int64())
        by_kind = [pa.array(column) for column in n.reshape(-1, KINDS + 1)[: len(held), :KINDS].T]
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), *by_kind, none, none, none], _COUNTED)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = defaultdict(count().__next__)
        n = np.zeros(0, np.int64)  # by word and kind, and one more for texts that are not learnt from
        entries = np.zeros(2 * N_ENTRIES, np.int64)
        for batch in batches:
            for some in _some_texts(batch):
                texts = Texts(some.column("text"), kinds.value)
                learn = some.column("learn").to_numpy(zero_copy_only=False)[texts.lane]
                number = np.fromiter(map(held.__getitem__, texts.words), np.int64, len(texts.words))
                n = np.append(n, np.zeros((KINDS + 1) * len(held) - len(n), np.int64))
                n += np.bincount(number[texts.own] * (KINDS + 1) + np.where(learn, texts.kind, KINDS), minlength=len(n))
                if len(held) > _MOST_HELD:
                    yield words(held, n)
                    held, n = defaultdict(count().__next__), np.zeros(0, np.int64)
                later = learn & (texts.place > 0)
                entries += np.bincount((texts.entries[:, later] * 2 + texts.hit[later]).ravel(), minlength=2 * N_ENTRIES)
        if held:
            yield words(held, n)
        for at, n0, n1 in _nonzero(entries):
            none = pa.nulls(len(at), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.nulls(len(at), pa.binary()), *[none] * KINDS, pa.array(at), pa.array(n0), pa.array(n1)], _COUNTED)

    return counted


def count_texts(texts: DataFrame, kinds, scratch: Scratch) -> tuple[DataFrame, np.ndarray]:
    """Tokens, and log odds of the contexts of a text's decisions.

    The tokens of all rows of ``text``: ``token, c, k0`` and so on; ``c`` counts those in rows that are to ``learn`` from, and
    ``k0`` those of the first kind of text.
    """
    rows = texts.select("text", "learn").mapInArrow(_count_batches(kinds), _COUNTED_KINDS)
    # Rows of entries have no token; they go by entry.
    summed = rows.groupBy("token", "entry").agg(*[F.sum(c).alias(c) for c in _COUNTED if c not in ("token", "entry")])
    summed = scratch.keep(summed, "counts")
    found = _as_array(summed.where("token is null").select("entry", "n0", "n1"), N_ENTRIES)
    by_kind = [F.col(f"k{k}") for k in range(KINDS)]
    words = summed.where("token is not null").select("token", sum(by_kind[1:], by_kind[0]).alias("c"), *by_kind)
    return words, _odds(found[:, 0], found[:, 1])


@dataclass(frozen=True)
class Totals:
    """Over training tokens: their number, how many different, and what is discounted from each count."""

    n: int
    v: int
    discount: float


def _totals(counts: DataFrame) -> list[Totals]:
    """Of each kind, and last of all."""
    of = [F.col(c) for c in (*[f"k{k}" for k in range(KINDS)], "c")]
    sums = [f for c in of for f in (F.sum(c), F.count_if(c > 0), F.count_if(c == 1), F.count_if(c == 2))]
    row = [value or 0 for value in counts.agg(*[f.alias(f"s{n}") for n, f in enumerate(sums)]).first()]
    return [Totals(n, v, once / (once + 2 * twice) if once else 0.5) for n, v, once, twice in zip(*[iter(row)] * 4)]


# Spelling


def _in_parts(words: list[bytes]) -> Iterator[list[bytes]]:
    """Consecutive words that hold about ``_MOST_BYTES`` together, or one longer word."""
    ends = np.cumsum([len(w) + 1 for w in words])
    start = 0
    while start < len(words):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + _MOST_BYTES, "right")))
        yield words[start:stop]
        start = stop


def spelling_windows(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of the words, each with the space after it: the byte with the ``ORDERS`` before it in its word, and where words start.

    A window is a number, the byte itself lowest; before the word are zeros.
    """
    data = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(data)) - np.repeat(starts, lengths)
    windows = data.astype(np.uint64)
    for back in range(1, ORDERS + 1):
        before = np.zeros(len(data), np.uint64)
        before[back:] = data[:-back]
        windows |= np.where(place >= back, before, 0).astype(np.uint64) << np.uint64(8 * back)
    return windows, starts


def window_bits(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries (contexts by bit) and bits of windows, eight for each."""
    ways = np.arange(8)
    byte = (windows & np.uint64(255)).astype(np.int64)
    nodes = ((1 << ways) | (byte[:, None] >> (8 - ways))).astype(np.uint64)
    bits = ((byte[:, None] >> (7 - ways)) & 1).astype(np.uint8)
    entries = np.empty((ORDERS, len(windows) * 8), np.int32)
    for order in range(1, ORDERS + 1):
        context = (windows >> np.uint64(8)) & np.uint64((1 << 8 * order) - 1)
        mixed = ((context[:, None] << np.uint64(8)) | nodes) * _MIX
        mixed ^= mixed >> np.uint64(32)
        entries[order - 1] = ((mixed * _MIX) >> np.uint64(64 - TABLE_BITS)).ravel()
    return entries, bits.ravel()


def _count_spelling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = np.zeros((ORDERS, 2 * _SLOTS))
    for batch in batches:
        for words in _in_parts(batch.column(0).to_pylist()):
            windows, times = np.unique(spelling_windows(words)[0], return_counts=True)
            entries, bits = window_bits(windows)
            times = np.repeat(times, 8)
            for order in range(ORDERS):
                found[order] += np.bincount(entries[order] * 2 + bits, times, 2 * _SLOTS)
    for columns in _nonzero(found.ravel().astype(np.int64)):
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["entry", "n0", "n1"])


def _nonzero(found: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Entries, with their counts of 0 and 1 that are not both zero."""
    pairs = found.reshape(-1, 2)
    at = np.nonzero(pairs.any(axis=1))[0]
    for start in range(0, len(at), 1 << 16):
        some = at[start : start + (1 << 16)]
        yield some, pairs[some, 0], pairs[some, 1]


def _as_array(rows: DataFrame, size: int) -> np.ndarray:
    """Rows of ``entry, n0, n1`` as an array of two columns; there are ``size`` entries at most."""
    rows = rows.toArrow()
    found = np.zeros((size, 2), np.int64)
    at = rows["entry"].to_numpy()
    found[at, 0], found[at, 1] = rows["n0"].to_numpy(), rows["n1"].to_numpy()
    return found


def _odds(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return np.log((n1 + 0.4) / (n0 + 0.4)).astype(np.float32)


def _likelihood(logit: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of each bit."""
    return -np.logaddexp(0, np.where(bits, -logit, logit))


def _weights_of_shard(counts: np.ndarray, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Weights by gate, refined over words that are left out of the counts, and how many bits passed each gate."""
    weights = np.full((ORDERS + 1, ORDERS), 0.3)
    passed = np.zeros(ORDERS + 1)
    for at in range(0, len(words), _REFINED):
        entries, bits = window_bits(spelling_windows(words[at : at + _REFINED])[0])
        odds = np.empty((ORDERS, len(bits)), np.float32)
        gate = np.zeros(len(bits), np.int64)
        for order in range(ORDERS):
            n0, n1 = counts[order, :, 0][entries[order]], counts[order, :, 1][entries[order]]
            n0, n1 = np.maximum(n0 - (1 - bits), 0), np.maximum(n1 - bits, 0)
            odds[order] = _odds(n0, n1)
            gate += n0 + n1 > 1
        logit = np.zeros(len(bits))
        for order in range(ORDERS):
            logit += odds[order] * weights[:, order][gate]
        error = bits - 1 / (1 + np.exp(-logit))
        seen = np.bincount(gate, minlength=ORDERS + 1)
        steps = np.stack([np.bincount(gate, error * o, ORDERS + 1) for o in odds], 1)
        weights += _SPELLING_RATE * steps / np.maximum(seen, 1)[:, None]
        passed += seen
    return weights, passed


def _refine(counts):
    def refined(key: tuple, table: pa.Table) -> pa.Table:
        weights, passed = _weights_of_shard(counts.value, sorted(table["token"].to_pylist()))
        gate, order = np.indices(weights.shape)
        columns = [gate.ravel(), order.ravel(), (weights * passed[:, None]).ravel(), np.repeat(passed, ORDERS)]
        return pa.Table.from_arrays([pa.array(c) for c in columns], ["gate", "k", "weight", "passed"])

    return refined


@dataclass(frozen=True)
class Spelling:
    """Log odds by context and entry, which of them were seen more than once, and weights by gate and context."""

    odds: np.ndarray
    known: np.ndarray
    weights: np.ndarray

    def score(self, words: list[bytes]) -> np.ndarray:
        """Natural logarithm of the probability of each word's bytes and the space after them, by the weights as they are."""
        parts = [np.empty(0)]
        for some in _in_parts(words):
            every, starts = spelling_windows(some)
            windows, at = np.unique(every, return_inverse=True)
            entries, bits = window_bits(windows)
            gate = np.zeros(len(bits), np.int8)
            for order in range(ORDERS):
                gate += self.known[order][entries[order]]
            logit = np.zeros(len(bits))
            for order in range(ORDERS):
                logit += self.odds[order][entries[order]] * self.weights[gate, order]
            by_window = _likelihood(logit, bits).reshape(-1, 8).sum(axis=1)
            parts.append(np.add.reduceat(by_window[at], starts))
        return np.concatenate(parts)


def spelling_of(counts: np.ndarray, weights: np.ndarray) -> Spelling:
    """From counts of 0 and 1 by context and entry."""
    return Spelling(_odds(counts[:, :, 0], counts[:, :, 1]), counts.sum(axis=2) > 1, weights)


def fit_spelling(counts: DataFrame, v: int) -> Spelling:
    """The spelling of the tokens of :func:`count_tokens` that occur in training texts; there are ``v``."""
    session = counts.sparkSession
    learnt = counts.where("c > 0").select("token").mapInArrow(_count_spelling, "entry long, n0 long, n1 long")
    summed = learnt.groupBy("entry").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    found = _as_array(summed, ORDERS * _SLOTS).reshape(ORDERS, _SLOTS, 2)
    shared = session.sparkContext.broadcast(found.astype(np.float32))
    shard = F.pmod(F.xxhash64("token"), F.lit(max(1, v // SHARD)))
    dealt = counts.where("c = 1").groupBy(shard.alias("shard"))
    rows = dealt.applyInArrow(_refine(shared), "gate long, k long, weight double, passed double")
    weights = np.full((ORDERS + 1, ORDERS), 0.3)
    for gate, k, weight, passed in rows.groupBy("gate", "k").agg(F.sum("weight"), F.sum("passed")).collect():
        if passed:
            weights[gate, k] = round(weight / passed, 6)  # sums may come in any order
    return spelling_of(found, weights)


def _discounted(c: np.ndarray, of: Totals, further: np.ndarray | float = 0) -> np.ndarray:
    """A probability by counts, where ``further`` is that of what the discounts go to."""
    return (np.maximum(c - of.discount, 0) + (of.discount * of.v + 1) * further) / (of.n + 1)


def _spelt_shares(totals: list[Totals]) -> np.ndarray:
    """By kind, what the discounts leave to a word's spelling."""
    *kinds, every = totals
    return np.array([_discounted(0, of, _discounted(0, every, 1)) for of in kinds])


def _score_tokens(totals: list[Totals]):
    """Base scores, and probabilities by kind without what the spelling adds, which each text tells for itself."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *kinds, every = totals
        for batch in batches:
            c = batch.column("c").to_numpy()
            by_kind = [batch.column(f"k{k}").to_numpy() for k in range(KINDS)]
            counted = _discounted(c, every)
            found = np.stack([_discounted(by_kind[k], of, counted) for k, of in enumerate(kinds)], 1)
            base = np.log10((c + 1) / (every.n + every.v + 1))
            offsets = pa.array(np.arange(0, found.size + 1, KINDS), pa.int32())
            listed = pa.ListArray.from_arrays(offsets, pa.array(found.ravel().astype(np.float32)))
            yield pa.RecordBatch.from_arrays([batch.column("token"), batch.column("c"), pa.array(base), listed], ["token", "c", "base", "counted"])

    return scored


# Texts


@dataclass(frozen=True)
class Head:
    """The most frequent tokens: their numbers, and by number base score (log10) and, by kind, probability by counts, with a last row for others."""

    number: dict[bytes, int]
    base: np.ndarray
    counted: np.ndarray


def _head(table: DataFrame) -> Head:
    """The tokens from the count on that at most ``MOST_HEAD`` have; buckets of counts are so few that they may be collected."""
    bucket = F.floor(F.log2("c") * 8)
    short = table.where((F.col("c") > 0) & (F.octet_length("token") <= LONGEST_HEAD)).withColumn("bucket", bucket)
    least, held = None, 0
    for at, n in sorted(short.groupBy("bucket").agg(F.count("*")).collect(), reverse=True):
        if held + n > MOST_HEAD:
            break
        least, held = at, held + n
    if least is None:
        return Head({}, np.zeros(1), np.zeros((1, KINDS), np.float32))
    rows = short.where(F.col("bucket") >= least).select("token", "base", "counted").toArrow().sort_by("token")
    counted = rows["counted"].combine_chunks().flatten().to_numpy().reshape(-1, KINDS)
    return Head({w: n for n, w in enumerate(rows["token"].to_pylist())}, np.append(rows["base"].to_numpy(), 0), np.append(counted, np.zeros((1, KINDS), np.float32), 0))


def _numbered_tokens(texts: pa.Array) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """:func:`tokens` of all texts in a row, as numbers in the order in which they are first met, what they number, and each text's length."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = parts.flatten()
    lane = np.repeat(np.arange(len(texts)), pc.list_value_length(parts).to_numpy())
    full = pc.binary_length(flat).to_numpy() > 0  # beside white space at the ends are empty parts
    coded = flat.filter(pa.array(full)).dictionary_encode()
    number, lane = coded.indices.to_numpy().astype(np.int64), lane[full]
    lengths = np.bincount(lane, minlength=len(texts)) + 1
    # Words hold no white space: joined and cut they become objects faster than one by one.
    words = pc.binary_join(pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary), " ")[0].as_buffer().to_pybytes().split()
    # The end is met first after the first text.
    end = int(number[: lengths[0] - 1].max(initial=-1)) + 1 if len(texts) else 0
    words.insert(end, END)
    own = np.full(lengths.sum(), end)
    at_end = np.zeros(len(own), bool)
    at_end[np.cumsum(lengths) - 1] = True
    own[~at_end] = number + (number >= end)
    return own, words, lengths


class Texts:
    """Some texts' tokens in a row, with what the decisions on them are predicted from."""

    def __init__(self, texts: list[str | None] | pa.Array, kinds: Kinds):
        own, self.words, self.lengths = _numbered_tokens(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        starts = np.cumsum(self.lengths) - self.lengths
        self.lane = np.repeat(np.arange(len(texts)), self.lengths)
        self.place = np.arange(len(own)) - starts[self.lane]
        self.own = own

        # How often the token occurred before in its text.
        key = self.lane * len(self.words) + own
        order = np.argsort(key, kind="stable")
        new = np.append(True, np.diff(key[order]) != 0)
        runs = np.nonzero(new)[0]
        self.before = np.empty(len(own), np.int64)
        self.before[order] = np.arange(len(own)) - np.repeat(runs, np.diff(np.append(runs, len(own))))
        self.hit = self.before > 0

        # The kind that the different short words before a token tell.
        short = np.nonzero(np.fromiter(map(len, self.words), np.int64, len(self.words)) <= SHORT)[0]
        mark = np.full(len(self.words), _MARKS)
        mark[short] = [xxhash.xxh64_intdigest(self.words[w]) % _MARKS for w in short.tolist()]
        told = np.nonzero((mark[own] < _MARKS) & ~self.hit)[0]
        sums = np.append(np.zeros((1, KINDS), np.int64), np.cumsum(kinds.marks[mark[own[told]]], axis=0), 0)
        begun = np.searchsorted(told, starts)
        after = np.argmax(sums[1:] - sums[begun][self.lane[told]] + kinds.prior, axis=1)
        after = np.append(np.argmax(kinds.prior), after)
        so_far = np.searchsorted(told, np.arange(len(own)))
        self.kind = np.where(so_far > begun[self.lane], after[so_far], after[0])

        # Decisions start at the second token.
        recent = np.zeros(len(own), np.uint8)
        for back in range(1, _RECENT + 1):
            recent[back:] |= (self.hit[:-back] & (self.place[back:] >= back)).view(np.uint8) << (back - 1)
        self.gate = np.minimum(np.bitwise_count(recent) * _GATES // (_RECENT + 1), _GATES - 1)
        recent = recent.astype(np.int64)
        named = np.fromiter(map(zlib.crc32, self.words), np.uint64, len(self.words))[own]
        one, two = np.roll(named, 1), np.where(self.place > 1, np.roll(named, 2), 0).astype(np.uint64)
        different = np.cumsum(~self.hit) - ~self.hit
        different -= different[starts][self.lane]
        length = np.minimum(np.log2(np.maximum(self.place, 1)) * 2, _LENGTHS - 1).astype(np.int64)
        share = (31 * different) // np.maximum(self.place, 1)
        slots = [x >> np.uint64(64 - TABLE_BITS) for x in (one * _MIX, (one * _MIX + two) * _MIX)]
        self.entries = np.stack([
            slots[0].astype(np.int64),
            _SLOTS + slots[1].astype(np.int64),
            2 * _SLOTS + recent * _LENGTHS + length,
            2 * _SLOTS + (_LENGTHS << _RECENT) + share * _LENGTHS + length,
        ])


N_ENTRIES = 2 * _SLOTS + (_LENGTHS << _RECENT) + 32 * _LENGTHS


def _some_texts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows that hold about ``_MOST_BYTES`` of text together, or one longer text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy().astype(np.int64) + 1)
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + _MOST_BYTES, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def decisions(texts: Texts, odds: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of each decision, 0 where there is none; weights are refined in each text."""
    weights = np.full((len(texts.lengths) * _GATES, len(texts.entries)), 0.4)
    found = np.zeros(len(texts.place))
    block = (texts.place - 1) // _BLOCK
    order = np.argsort(block, kind="stable")
    cuts = np.searchsorted(block[order], np.arange(block.max() + 2))
    inputs = odds[texts.entries.T]
    for start, stop in zip(cuts, cuts[1:]):
        at = order[start:stop]
        slot = texts.lane[at] * _GATES + texts.gate[at]
        given, hit = inputs[at], texts.hit[at]
        logit = np.einsum("nk,nk->n", given, weights[slot])
        found[at] = _likelihood(logit, hit)
        error = _TEXT_RATE * (hit - 1 / (1 + np.exp(-logit)))
        np.add.at(weights, slot, error[:, None] * given)
    return found


def _bits_of(windows: np.ndarray, spelling: Spelling) -> tuple[np.ndarray, np.ndarray]:
    """Of each window's eight bits: by context log odds of what the bit is not, and how many contexts are known."""
    odds = np.empty((ORDERS, len(windows), 8), np.float32)
    known = np.zeros((len(windows), 8), np.uint8)
    for start in range(0, len(windows), 1024):
        some = slice(start, start + 1024)
        entries, bits = window_bits(windows[some])
        sign = 1 - bits.astype(np.float32) * 2
        for order in range(ORDERS):
            odds[order, some] = (spelling.odds[order].take(entries[order]) * sign).reshape(-1, 8)
            known[some] += spelling.known[order].take(entries[order]).reshape(-1, 8)
    return odds, known


class _BitMixer:
    """Mixes the bits of some bytes of words. Its arrays are used again and again, as new ones cost more than the sums."""

    def __init__(self, weights: np.ndarray, n_texts: int):
        self.weights = np.tile(weights.astype(np.float32), (n_texts, 1, 1))
        self.given = np.empty((ORDERS, _PIECE * 8), np.float32)
        self.arrays = np.empty((3, _PIECE * 8), np.float32)
        self.known = np.empty((_PIECE, 8), np.uint8)
        self.begin(0)

    def begin(self, n_texts: int) -> None:
        """Ahead of a step of the first texts."""
        self.steps, self.seen = np.zeros((n_texts, ORDERS + 1, ORDERS)), np.zeros((n_texts, ORDERS + 1))

    def end(self) -> None:
        self.weights[: len(self.seen)] -= _SPELLING_RATE * self.steps / (self.seen + _PRIOR)[:, :, None]

    def mix(self, odds: np.ndarray, known: np.ndarray, number: np.ndarray, runs: list[tuple[int, int, int]]) -> np.ndarray:
        """Natural logarithm of the probability of at most ``_PIECE`` bytes, given by the numbers of their windows.

        A run is a text, and where its bytes start and stop. Most bits have only known contexts and are mixed by run,
        with the weights of the last gate; what that gives for the others is replaced by what their own gates give.
        """
        n = len(number) * 8
        given, (against, one, two) = self.given[:, :n], self.arrays[:, :n]
        for order in range(ORDERS):
            odds[order].take(number, axis=0, out=given[order].reshape(-1, 8), mode="clip")
        for text, start, stop in runs:
            np.matmul(self.weights[text, ORDERS], given[:, 8 * start : 8 * stop], out=against[8 * start : 8 * stop])
        gate = known.take(number, axis=0, out=self.known[: len(number)], mode="clip").ravel()
        other = np.nonzero(gate != ORDERS)[0]
        of = np.repeat([r[0] for r in runs], [r[2] - r[1] for r in runs])[other >> 3]
        few = given[:, other]
        slot = of, gate[other]
        against[other] = np.einsum("kn,nk->n", few, self.weights[slot])
        # A bit is as likely as 1 / (1 + exp(against)).
        np.minimum(against, 80, out=against)
        np.exp(against, out=one)
        np.log1p(one, out=two)
        likely = two.reshape(-1, 8) @ np.full(8, -1, np.float32)
        np.add(one, 1, out=two)
        np.divide(one, two, out=one)
        np.add.at(self.steps, slot, (few * one[other]).T)
        np.add.at(self.seen, slot, 1)
        one[other] = 0
        for text, start, stop in runs:
            self.steps[text, ORDERS] += given[:, 8 * start : 8 * stop] @ one[8 * start : 8 * stop]
            self.seen[text, ORDERS] += 8 * (stop - start)
        np.subtract.at(self.seen[:, ORDERS], of, 1)
        return likely


def _in_pieces(cuts: list[int]) -> Iterator[list[tuple[int, int, int]]]:
    """Runs, and where they start and stop, that hold at most ``_PIECE`` together; longer ones are cut by themselves."""
    some: list[tuple[int, int, int]] = []
    for run, (start, stop) in enumerate(zip(cuts, cuts[1:])):
        if some and stop - some[0][1] > _PIECE:
            yield some
            some = []
        while stop - start > _PIECE:
            yield [(run, start, start + _PIECE)]
            start += _PIECE
        some.append((run, start, stop))
    if some:
        yield some


def spell(texts: Texts, spelling: Spelling) -> np.ndarray:
    """Natural logarithm of the probability of the bytes, and the space after them, of each word that is new to its text.

    Words as :class:`Texts` has them. A text's weights are refined after each ``_SPELT`` of its new words.
    """
    new = np.nonzero(~texts.hit)[0]
    n_new = np.bincount(texts.lane[new], minlength=len(texts.lengths))
    # Texts with the most new words first: those that go on to a further step are the first ones.
    rank = np.empty(len(n_new), np.int64)
    rank[np.argsort(-n_new, kind="stable")] = np.arange(len(n_new))
    step = (np.arange(len(new)) - np.repeat(np.cumsum(n_new) - n_new, n_new)) // _SPELT
    run = step * len(n_new) + np.repeat(rank, n_new)
    order = np.argsort(run, kind="stable")
    run, word = run[order], texts.own[new][order]

    every, starts = spelling_windows(texts.words)
    sizes = np.diff(np.append(starts, len(every)))[word]
    ends = np.cumsum(sizes)
    mixer = _BitMixer(spelling.weights, len(n_new))
    found = np.empty(len(new))
    # Each run is a text's words of one step. Parts of about ``_MOST_BYTES``, or one longer run, have their windows numbered together.
    firsts = np.append(np.nonzero(np.diff(run, prepend=-1))[0], len(run))
    text_of, step_of = run[firsts[:-1]] % len(n_new), run[firsts[:-1]] // len(n_new)
    edges = np.append(ends - sizes, ends[-1:])[firsts] if len(run) else firsts
    part = 0
    while part < len(text_of):
        beyond = max(part + 1, int(np.searchsorted(edges[1:], edges[part] + _MOST_BYTES, "right")))
        words, begin = slice(firsts[part], firsts[beyond]), edges[part]
        place = np.repeat(starts[word[words]] - (ends - sizes)[words], sizes[words]) + np.arange(begin, edges[beyond])
        coded = pa.array(every[place]).dictionary_encode()
        number = coded.indices.to_numpy().astype(np.int64)
        odds, known = _bits_of(coded.dictionary.to_numpy(), spelling)
        likely = np.empty(len(number))
        while part < beyond:
            # Of a step that is cut by the end of the part, the other texts come in the next one.
            upto = min(beyond, int(np.searchsorted(step_of, step_of[part], "right")))
            mixer.begin(int(text_of[upto - 1]) + 1)
            for some in _in_pieces((edges[part : upto + 1] - begin).tolist()):
                start, stop = some[0][1], some[-1][2]
                runs = [(int(text_of[part + r]), x - start, y - start) for r, x, y in some]
                likely[start:stop] = mixer.mix(odds, known, number[start:stop], runs)
            mixer.end()
            part = upto
        found[words] = np.add.reduceat(likely, (ends - sizes)[words] - begin)
    result = np.empty(len(new))
    result[order] = found
    return result


_SCORED = "row long, doc_id long, held_out boolean, n_tokens long, n_bytes long, n_known long, base double, score double, tail array<binary>, times array<int>, kinds array<int>, spelt array<double>"


def _score_texts(kinds, head, odds, spelling, spelt_shares):
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, log_odds = head.value, odds.value
        outside = len(own.number)
        for batch in batches:
            for some in _some_texts(batch):
                texts = Texts(some.column("text"), kinds.value)
                n = len(texts.lengths)
                number = np.fromiter(map(own.number.get, texts.words, repeat(outside)), np.int64, len(texts.words))[texts.own]
                first, later = ~texts.hit, texts.place > 0
                score = decisions(texts, log_odds) / np.log(10)
                again = np.nonzero(texts.hit)[0]
                score[again] += np.log10(texts.before[again] / texts.place[again])
                # What is left when the words that were said before are out of question.
                new = np.nonzero(first)[0]
                spelt = spell(texts, spelling.value)
                shares = own.counted[number[new]] + np.where(number[new] < outside, np.exp(spelt), 0)[:, None] * spelt_shares
                said = np.cumsum(shares, axis=0, dtype=np.float64) - shares
                starts = np.searchsorted(new, np.cumsum(texts.lengths) - texts.lengths)
                at = texts.lane[new], texts.kind[new]
                said = said[np.arange(len(new)), at[1]] - said[starts][at]
                score[new] -= np.log10(np.maximum(1 - said, 1e-9))
                spelt /= np.log(10)
                spelt_at = np.zeros(len(first))
                spelt_at[new] = spelt
                with np.errstate(divide="ignore"):
                    likely = np.logaddexp2(np.log2(own.counted[number[new], at[1]]), (spelt + np.log10(spelt_shares[at[1]])) * np.log2(10)) * np.log10(2)
                score[new] += np.where(number[new] < outside, likely, 0)

                other = np.nonzero((number == outside) & first)[0]
                key = texts.lane * len(texts.words) + texts.own
                times = np.bincount(np.searchsorted(np.sort(key[other]), key[number == outside]), minlength=len(other))
                by_key = other[np.argsort(key[other])]
                offsets = np.append(0, np.cumsum(np.bincount(texts.lane[by_key], minlength=n))).astype(np.int32)
                tail = pa.array([texts.words[w] for w in texts.own[by_key].tolist()], pa.binary())
                told = [tail, pa.array(times.astype(np.int32)), pa.array(texts.kind[by_key].astype(np.int32)), pa.array(spelt_at[by_key])]

                def per_text(values: np.ndarray) -> np.ndarray:
                    return np.bincount(texts.lane, values, n)

                columns = [
                    *(some.column(c) for c in ("row", "doc_id", "held_out")),
                    pa.array(texts.lengths),
                    pc.cast(pc.fill_null(pc.binary_length(some.column("text")), 0), pa.int64()),
                    pa.array(per_text(number != outside).astype(np.int64)),
                    pa.array(per_text(own.base[number])),
                    pa.array(per_text(score)),
                    *(pa.ListArray.from_arrays(offsets, values) for values in told),
                ]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _SCORED.split(", ")])

    return scored


def score_texts(docs: DataFrame, learn: Column, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte``.

    Counts are taken from the rows where ``learn`` is true; null counts as false, and ``held_out`` is the contrary. Scores are
    log10 probabilities of the whole text with its end; ``bits_per_byte`` is that of ``score`` per byte of text and the end.

    - A null text is an empty text, which is its end alone.
    - Rows that repeat an identifier, or have none, are rows of their own.
    - Without rows to learn from, words are spelt with even odds and all base scores are 0.
    - An empty table gives no rows. Other columns are not read, but by ``learn``.
    """
    session = docs.sparkSession
    scratch = Scratch(session, "mixing")
    learning = F.coalesce(learn, F.lit(False)).alias("learn")
    rows = docs.select(quoted(id_column).cast("long").alias("doc_id"), quoted(text_column).cast("string").alias("text"), learning)
    share = session.sparkContext.broadcast
    kinds = share(fit_kinds(rows.where("learn")))
    counts, log_odds = count_texts(rows, kinds, scratch)
    totals = _totals(counts)
    spelling = share(fit_spelling(counts, totals[-1].v))
    table = counts.mapInArrow(_score_tokens(totals), "token binary, c long, base double, counted array<float>")
    table = scratch.keep(table, "tokens")
    scratch.drop("counts")

    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", (~F.col("learn")).alias("held_out"), "text")
    spelt_shares = _spelt_shares(totals)
    scored = numbered.mapInArrow(_score_texts(kinds, share(_head(table)), share(log_odds), spelling, spelt_shares), _SCORED)
    scored = scratch.keep(scored, "scored")
    tail = scored.select("row", F.explode(F.arrays_zip("tail", "times", "kinds", "spelt")).alias("at")).select("row", "at.*")
    joined = tail.join(table, F.col("tail") == F.col("token"))
    by_count, spelt_share = F.get("counted", F.col("kinds")).cast("double"), F.get(F.array(*map(F.lit, spelt_shares.tolist())), F.col("kinds"))
    rest = joined.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times"))).alias("more_known"),
        F.sum(F.col("base") * F.col("times")).alias("more_base"),
        F.sum(F.when(by_count > 0, F.log10(by_count + spelt_share * F.pow(F.lit(10.0), "spelt"))).otherwise(F.log10(spelt_share) + F.col("spelt"))).alias("more_score"),
    )
    every = scored.drop("tail", "times", "kinds", "spelt").join(rest, "row", "left")
    score = F.col("score") + F.coalesce("more_score", F.lit(0.0))
    return every.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(totals[-1].n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        score.alias("score"),
        (-score / F.lit(float(np.log10(2))) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
