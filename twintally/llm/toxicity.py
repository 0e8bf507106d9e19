"""Toxicity by two Kneser-Ney word models, one of toxic and one of ordinary text.

A class's model is made of Kneser-Ney's continuation counts: before how many different
words a word was seen in the class. Counting contexts and not occurrences keeps
passages that are copied many times from counting many times. The counts are
discounted, and what that frees goes to backoff counts that both classes share, of how many
documents of the whole corpus hold a word. So a rare or unseen word counts the same for both
classes, and only what was seen in more contexts of one class speaks for it.

A text is compared by the difference of its words' log-likelihoods. Its subject and its
language move all its words alike, so the differences are taken from their median, and a word
counts with what it has beyond ``DEAD_ZONE``. The mean over all words of the text is put
on a scale from 0 to 1 by a logistic curve that is fitted on labelled texts which the
models have not seen.

Shared counts are exact. A word that neither class's model knows counts the same for both whatever its
number, so only the known words' numbers of documents are gathered, over all documents. The class models
are fitted on at most ``most_per_class`` labelled documents of each class, chosen by a hash of their
identifier. That bounds the known words, and with them what every task holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twintally.llm.scratch import Scratch, map_rows, quoted
from twintally.llm.words import word_hashes

MOST_PER_CLASS = 4000
DISCOUNT = 0.9
LEAST_CONTEXTS = 2  # words with fewer are left to the shared counts
DEAD_ZONE = 3.0  # natural logarithm: a word that is 20 times as likely

_START = 0  # stands before the first word


def _hashed(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The words of some texts one after another, and how many each text has."""
    found = [word_hashes(t or "") for t in texts]
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    return np.concatenate(found) if found else np.empty(0, np.uint64), lengths


def shared_counts(docs: DataFrame, known: np.ndarray, text_column: str = "text") -> tuple[np.ndarray, int]:
    """In how many documents each of the ``known`` words (sorted hashes) occurs, and how many words all documents have, each counted once.

    Tasks count first and send a row per known word at most.
    """
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = len(shared.value) + 1  # the last one counts all words
        total = np.zeros(places, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                words, lengths = _hashed(batch.column(0).slice(at, 256).to_pylist())
                if not len(words):
                    continue
                different, number = np.unique(words, return_inverse=True)
                owner = np.repeat(np.arange(len(lengths)), lengths)
                seen = np.unique(owner * len(different) + number) % len(different)
                times = np.bincount(seen, minlength=len(different))
                place, there = _places(shared.value, different)
                total[place[there]] += times[there]
                total[-1] += len(seen)
        held = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["place", "n"])

    counted = docs.select(quoted(text_column).cast("string").alias("text")).mapInArrow(count, "place long, n long")
    rows = counted.groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(len(known) + 1, np.int64)
    counts[rows["place"].to_numpy()] = rows["n"].to_numpy()
    return counts[:-1], int(counts[-1])


def _places(known: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words stand among sorted ones, and whether they do."""
    if not len(known):
        return np.zeros(len(words), np.int64), np.zeros(len(words), bool)
    place = np.minimum(np.searchsorted(known, words), len(known) - 1)
    return place, known[place] == words


def _discounted(known: np.ndarray, words: np.ndarray, contexts: np.ndarray, total: int) -> tuple[np.ndarray, float]:
    """A class's discounted continuation probabilities of the known words, and what is left to the shared counts.

    From its own words' numbers of contexts, and the number of all its (word, context) pairs.
    """
    share = np.zeros(len(known))
    share[np.searchsorted(known, words)] = (contexts - DISCOUNT) / max(total, 1)
    return share, float(1 - share.sum())


@dataclass
class ToxicityModel:
    words: np.ndarray  # sorted hashes of the words that a class's model knows
    ratio: np.ndarray  # how much likelier in toxic text each is, as a natural logarithm
    other: float  # the same of all other words
    slope: float = 1.0
    offset: float = 0.0
    trained: bool = True  # on texts of both classes

    def difference(self, texts: list[str | None]) -> np.ndarray:
        """How much likelier toxic per word, on a root scale with its sign; 0 for a text without words."""
        words, lengths = _hashed(texts)
        found = np.zeros(len(lengths))
        if not len(words):
            return found
        place, there = _places(self.words, words)
        ratio = np.where(there, self.ratio[place], self.other) if len(self.words) else np.full(len(words), self.other)
        end = 0
        for row, length in enumerate(lengths):
            if length:
                own = ratio[end : end + length]
                own = own - np.median(own)
                found[row] = (np.sign(own) * np.maximum(np.abs(own) - DEAD_ZONE, 0)).sum() / length
                end += length
        return np.sign(found) * np.sqrt(np.abs(found))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """From 0 to 1; the larger, the likelier toxic. Without training on both classes all are below 0.5."""
        if not self.trained:
            return np.full(len(texts), 0.25)
        raw = np.clip(self.slope * self.difference(texts) + self.offset, -500, 500)
        return 1 / (1 + np.exp(-raw))


def fold(id_column: Column, parts: int) -> Column:
    """The fold of a row: CRC-32 of its identifier as text, modulo ``parts``; null is fold 0."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % parts, F.lit(0))


def labelled_sample(labels: DataFrame, label_column: str, most_per_class: int) -> DataFrame:
    """``doc_id, toxic, part, weight``: at most ``most_per_class`` labelled identifiers of each class.

    Chosen by hash, so the choice does not depend on the order of rows. ``part`` is 0 for three
    quarters (to count) and 1 for one quarter (to set the scale). ``weight`` is how many labelled
    identifiers of its class a row stands for. Of labels that disagree on an identifier the larger counts.
    """
    rows = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max(label_column).cast("int").alias("toxic"))
    rows = rows.where("toxic in (0, 1)").withColumn("pick", F.xxhash64(F.lit("sample"), "doc_id"))
    sizes = {toxic: n for toxic, n in rows.groupBy("toxic").count().collect()}
    chosen = None
    for toxic, n in sorted(sizes.items()):
        # With room to spare, so that a sort of few rows cuts to the exact number.
        share = min(1.0, 1.2 * most_per_class / n + 200 / n)
        below = min(int((2 * share - 1) * 2**63), 2**63 - 1)
        some = rows.where((F.col("toxic") == toxic) & (F.col("pick") <= below))
        some = some.orderBy("pick", "doc_id").limit(most_per_class).withColumn("weight", F.lit(n / min(n, most_per_class)))
        chosen = some if chosen is None else chosen.unionAll(some)
    if chosen is None:
        chosen = rows.withColumn("weight", F.lit(1.0))
    part = (F.pmod(F.col("pick"), F.lit(4)) == 0).cast("int").alias("part")
    return chosen.select("doc_id", "toxic", part, "weight")


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    most_per_class: int = MOST_PER_CLASS,
) -> ToxicityModel:
    """A model from the labels given (``doc_id`` and a 0/1 column) and all documents' texts."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    rows = docs.select(quoted(id_column).cast("long").alias("doc_id"), quoted(text_column).cast("string").alias("text"))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), quoted(label_column).alias("label"))
    chosen = labelled_sample(known, "label", most_per_class)
    # At most two classes of most_per_class identifiers.
    sample = scratch.keep(rows.join(F.broadcast(chosen), "doc_id"), "sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                words, lengths = _hashed(part.column(1).to_pylist())
                if not len(words):
                    continue
                before = np.concatenate(([_START], words[:-1].view(np.int64)))
                before[(np.cumsum(lengths) - lengths)[lengths > 0]] = _START
                toxic = np.repeat(np.array(part.column(0).to_pylist(), np.int32), lengths)
                columns = [toxic, before, words.view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["toxic", "v", "w"])

    seen = sample.where("part = 0").select("toxic", "text").mapInArrow(count, "toxic int, v long, w long")
    contexts = scratch.keep(seen.distinct().groupBy("toxic", "w").agg(F.count("*").alias("n")), "contexts")
    totals = {toxic: n for toxic, n in contexts.groupBy("toxic").agg(F.sum("n")).collect()}
    known_words = contexts.where(F.col("n") >= LEAST_CONTEXTS).toArrow()
    known = np.unique(known_words["w"].to_numpy().view(np.uint64))
    counts, words = shared_counts(docs, known, text_column)
    shared = counts / max(words, 1)  # a known word occurs in a document of the sample

    def likelihood(toxic: int) -> tuple[np.ndarray, float]:
        one = known_words.filter(pc.equal(known_words["toxic"], toxic))
        share, rest = _discounted(known, one["w"].to_numpy().view(np.uint64), one["n"].to_numpy(), totals.get(toxic, 0))
        return np.log(np.maximum(share + rest * shared, 1e-300)), rest

    (toxic, toxic_rest), (ordinary, ordinary_rest) = likelihood(1), likelihood(0)
    fitted = ToxicityModel(known, toxic - ordinary, float(np.log(max(toxic_rest, 1e-9) / max(ordinary_rest, 1e-9))))
    fitted.trained = len(totals) == 2
    held = _differences(sample.where("part = 1").select("toxic", "text", "weight"), fitted).toArrow()
    fitted.slope, fitted.offset = _logistic(*(held[c].to_numpy() for c in ("difference", "toxic", "weight")))
    scratch.drop("sample", "contexts")
    return fitted


def _differences(rows: DataFrame, model: ToxicityModel) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(at, 256) for at in range(0, batch.num_rows, 256)):
                found = shared.value.difference(part.column(1).to_pylist())
                columns = [part.column(0), pa.array(found), part.column(2)]
                yield pa.RecordBatch.from_arrays(columns, ["toxic", "difference", "weight"])

    return rows.mapInArrow(compute, "toxic int, difference double, weight double")


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve; Newton's method with a small ridge.

    A text weighs as many labelled texts as it stands for, so that where classes overlap the more common
    one, ordinary text, is kept, however few of it are in the sample.
    """
    if not len(x) or y.min() == y.max():
        return 1.0, 0.0
    weight = weight / weight.sum()
    scale = np.sqrt(weight @ (x - weight @ x) ** 2) or 1.0
    a = np.stack([x / scale, np.ones(len(x))], 1)
    b = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        gradient = a.T @ (weight * (y - p)) - 1e-4 * b * [1, 0]
        hessian = (a * (weight * p * (1 - p))[:, None]).T @ a + np.diag([1e-4, 1e-9])
        step = np.linalg.solve(hessian, gradient)
        b += np.clip(step, -5, 5)
        if abs(step).max() < 1e-9:
            break
    return max(float(b[0] / scale), 0.0), float(b[1])


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, score, predicted`` for every row, by its whole text; predicted is 1 from a score of 0.5.

    - A null text is empty; a text without words has a difference of 0 and the score that goes with it.
    - Repeated rows and null identifiers are kept as they are; an empty table gives no rows.
    - Without labelled texts of both classes nothing is predicted toxic: all scores are 0.25.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(at, 256) for at in range(0, batch.num_rows, 256)):
                scores = shared.value.scores(part.column(1).to_pylist())
                columns = [part.column(0), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "predicted"])

    rows = docs.select(quoted(id_column).cast("long").alias("doc_id"), quoted(text_column).cast("string").alias("text"))
    return rows.mapInArrow(compute, "doc_id long, score double, predicted int")


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is below 0.5, as they are; no row is shuffled.

    Null and empty texts have the score of a text without words, repeated rows go or stay together. A model that
    has not learnt both classes drops nothing. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_column)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(at, 256) for at in range(0, batch.num_rows, 256)):
                yield part.filter(pa.array(shared.value.scores(part.column(place).to_pylist()) < 0.5))

    return map_rows(docs, clean)
