"""Language identification with a string kernel, Nystroem landmarks and ridge regression.

The blended-spectrum presence kernel of two texts counts the distinct character n-grams,
of one to ``MOST_N`` characters, that both hold, divided by the root of the product of
their own counts. A few labelled texts are landmarks, and the n-grams are those that occur
in landmarks. A text is described by its kernel values with the landmarks, turned by the
inverse root of the landmarks' own kernel matrix (Nystroem), and one ridge regression per
language is fitted on these features of a labelled sample. Texts are scored in batches: a
presence matrix times the landmarks' presence matrix gives the kernel values, and that times the
regression weights gives the scores.

Labelled texts are a sample of at most ``most_per_language`` documents of each language,
chosen by a hash of the identifier. Every text is described and scored whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twintally.llm.scratch import Scratch, map_rows, quoted

MOST_N = 3
LANDMARKS = 128
MOST_PER_LANGUAGE = 300
RIDGE = 1e-3
UNKNOWN = "und"

_MOST_DIRECT = 1 << 22  # codes below are looked up in a table
_LETTER = re.compile(r"[^\W\d_]")  # and a few numerals


def _has_letter(text: str | None) -> bool:
    return any(found.group().isalpha() for found in _LETTER.finditer(text or ""))


@dataclass
class Numbers:
    """Sorted codes, numbered from 1; 0 stands for all others."""

    codes: np.ndarray
    table: np.ndarray | None = None  # by code, if the codes are small

    @classmethod
    def of(cls, codes: np.ndarray) -> Numbers:
        if not len(codes) or codes[-1] >= _MOST_DIRECT:
            return cls(codes)
        table = np.zeros(codes[-1] + 1, np.int32)
        table[codes] = np.arange(1, len(codes) + 1)
        return cls(codes, table)

    def look_up(self, codes: np.ndarray) -> np.ndarray:
        if not len(self.codes):
            return np.zeros(len(codes), np.int64)
        if self.table is not None:
            return np.where(codes < len(self.table), self.table[np.minimum(codes, len(self.table) - 1)], 0).astype(np.int64)
        place = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[place] == codes, place + 1, 0)


def ngram_codes(text: str, known: list[Numbers]) -> Iterator[np.ndarray]:
    """A text's n-grams of one character, of two and so on, one code each: where each character begins one, or -1.

    The code of an n-gram is the number of the n-gram without its last character, and the last one's number. Those that ``known``
    lacks are not gone on with. ``known`` may grow between the steps.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    yield points
    letters = number = known[0].look_up(points)
    size = len(known[0].codes) + 1
    for n in range(2, MOST_N + 1):
        number, last = number[: max(len(points) - n + 1, 0)], letters[n - 1 :]
        codes = np.where((number > 0) & (last > 0), number * size + last, -1)
        yield codes
        if n < MOST_N:
            number = np.where(codes >= 0, known[n - 1].look_up(np.maximum(codes, 0)), 0)


def ngrams(text: str, known: list[Numbers]) -> Iterator[np.ndarray]:
    """Numbers of a text's n-grams of one character, of two and so on; 0 for those that are not ``known``."""
    for codes, numbers in zip(ngram_codes(text, known), known):
        yield np.where(codes >= 0, numbers.look_up(np.maximum(codes, 0)), 0)


@dataclass
class LanguageModel:
    languages: list[str]
    grams: list[Numbers]  # of one character, of two and so on: those that occur in landmarks
    landmarks: np.ndarray  # presence of each n-gram in each landmark, divided by the root of its count
    weights: np.ndarray  # regression weights by landmark (and one offset) and language

    def kernel(self, texts: list[str]) -> np.ndarray:
        """Kernel values of each text with each landmark."""
        present = np.zeros((len(texts), self.landmarks.shape[1]), np.float32)
        for row, text in enumerate(texts):
            start = 0
            for numbers, grams in zip(ngrams(text, self.grams), self.grams):
                present[row, start + numbers[numbers > 0] - 1] = 1
                start += len(grams.codes)
        own = np.sqrt(np.maximum(present.sum(axis=1, keepdims=True), 1))
        return (present @ self.landmarks.T) / own

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The language of each text and how sure that is, from 0 to 1."""
        names = [UNKNOWN] * len(texts)
        scores = np.zeros(len(texts))
        rows = [row for row, t in enumerate(texts) if _has_letter(t)] if self.languages else []
        if rows:
            values = self.kernel([texts[row] for row in rows]).astype(float)
            found = np.column_stack([values, np.ones(len(rows))]) @ self.weights
            best = found.argmax(axis=1)
            scores[rows] = np.clip((1 + found[np.arange(len(rows)), best]) / 2, 0, 1)
            for row, language in zip(rows, best):
                names[row] = self.languages[language]
        return names, scores


def _landmark_tables(texts: list[str]) -> tuple[list[Numbers], np.ndarray]:
    """All n-grams of the landmarks, and the presence matrix of the landmarks."""
    known: list[Numbers] = []
    steps = [ngram_codes(text, known) for text in texts]
    for _ in range(MOST_N):
        codes = [next(step) for step in steps]
        found = np.unique(np.concatenate(codes)) if codes else np.empty(0, np.int64)
        known.append(Numbers.of(found[found >= 0]))
    present = np.zeros((len(texts), sum(len(n.codes) for n in known)), np.float32)
    for row, text in enumerate(texts):
        start = 0
        for numbers, grams in zip(ngrams(text, known), known):
            present[row, start + numbers[numbers > 0] - 1] = 1
            start += len(grams.codes)
        present[row] /= np.sqrt(max(present[row].sum(), 1))
    return known, present


def _labelled_sample(rows: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows of each language, chosen by the identifiers' hash."""
    rows = rows.withColumn("pick", F.xxhash64(F.lit("sample"), "doc_id"))
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"))
    share = F.least(F.lit(1.0), 1.2 * most / F.col("n") + 100 / F.col("n"))
    # One row per language: the classes of the model, which the driver holds as well.
    some = rows.join(F.broadcast(sizes), "lang").where(F.col("pick") / float(2**64) + 0.5 <= share)
    # What is left is a little more than ``most`` rows per language.
    place = F.row_number().over(Window.partitionBy("lang").orderBy("pick", "doc_id", F.xxhash64("text")))
    return some.withColumn("place", place).where(F.col("place") <= most).select("lang", "place", "text")


def fit_language(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    most_per_language: int = MOST_PER_LANGUAGE,
    landmarks: int = LANDMARKS,
) -> LanguageModel:
    """A model from the rows that have a language and a text with a letter.

    The driver holds the landmarks' texts, and of the other sampled documents their kernel
    values with the landmarks.
    """
    rows = docs.select(
        quoted(id_column).cast("long").alias("doc_id"),
        quoted(text_column).cast("string").alias("text"),
        quoted(lang_column).cast("string").alias("lang"),
    ).where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sample = Scratch(docs.sparkSession, "language").keep(_labelled_sample(rows, most_per_language), "sample")
    languages = sorted(row[0] for row in sample.select("lang").distinct().collect())
    each = max(1, landmarks // max(1, len(languages)))
    marks = [row[0] for row in sample.where(F.col("place") <= each).orderBy("lang", "place").select("text").collect()]
    known, present = _landmark_tables(marks)
    bare = LanguageModel([], known, present, np.empty(0))
    if not languages:
        return bare
    found = _kernel_values(sample, bare).toArrow()
    values = np.array(found["values"].to_pylist(), float)
    place = {language: n for n, language in enumerate(languages)}
    wanted = np.full((len(values), len(languages)), -1.0)
    wanted[np.arange(len(values)), [place[x] for x in found["lang"].to_pylist()]] = 1
    return LanguageModel(languages, known, present, _ridge(values, present.astype(float), wanted))


def _ridge(values: np.ndarray, present: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """One-versus-rest ridge regression on Nystroem features, as weights of kernel values.

    Every language weighs the same, however many rows it has.
    """
    eigenvalues, vectors = np.linalg.eigh(present @ present.T)
    kept = eigenvalues > 1e-8 * max(eigenvalues.max(), 1e-30)
    turn = vectors[:, kept] / np.sqrt(eigenvalues[kept])
    features = np.column_stack([values @ turn, np.ones(len(values))])
    weights = np.empty((features.shape[1], wanted.shape[1]))
    for n in range(wanted.shape[1]):
        y = wanted[:, n]
        share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1))
        penalty = np.append(np.full(features.shape[1] - 1, RIDGE), 1e-9)
        left = (features * share[:, None]).T @ features + np.diag(penalty)
        weights[:, n] = np.linalg.solve(left, features.T @ (share * y))
    return np.vstack([turn @ weights[:-1], weights[-1:]])


def _kernel_values(sample: DataFrame, model: LanguageModel) -> DataFrame:
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(at, 64) for at in range(0, batch.num_rows, 64)):
                values = shared.value.kernel(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(list(values), pa.list_(pa.float32()))], ["lang", "values"]
                )

    return sample.select("lang", "text").mapInArrow(compute, "lang string, values array<float>")


def identify_languages(
    docs: DataFrame, model: LanguageModel, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row, by its whole text.

    - A null text, a text without a letter, and every text of a model that learnt no language
      have the language ``und`` and the score 0.
    - Repeated rows and null identifiers are kept as they are; an empty table gives no rows.
    - Of languages with equal scores the first by name is given.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(at, 64) for at in range(0, batch.num_rows, 64)):
                names, scores = shared.value.predict(part.column(1).to_pylist())
                columns = [part.column(0), pa.array(names, pa.string()), pa.array(scores)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score"])

    rows = docs.select(quoted(id_column).cast("long").alias("doc_id"), quoted(text_column).cast("string").alias("text"))
    return rows.mapInArrow(compute, "doc_id long, lang_pred string, score double")


def drop_unknown(docs: DataFrame, model: LanguageModel, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text has a letter, and so a language, as they are; no row is shuffled.

    Null and empty texts go, also when no language could be learnt; repeated rows go or stay together. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_column)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(at, 64) for at in range(0, batch.num_rows, 64)):
                texts = part.column(place).to_pylist()
                names, _ = shared.value.predict(texts)
                if not shared.value.languages:
                    names = ["any" if _has_letter(text) else UNKNOWN for text in texts]
                yield part.filter(pa.array([name != UNKNOWN for name in names], pa.bool_()))

    return map_rows(docs, known)
