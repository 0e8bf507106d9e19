"""Spelling variants: words one edit apart, found by asymmetric chunks, and the form that each varies.

Of two words the shorter one contributes two disjoint chunks that cover it, the other one its grams
with their positions. One edit leaves one of the two chunks whole, and moves it by at most one
position, so joining chunks with grams of the same text within a shift of one finds every pair. Grams
elsewhere join nothing and are not made.

A common chunk, such as an ending, would bring all its words together. So the join goes one
step further: if a chunk is whole, the edit lies in the rest, which is cut into two chunks again, and
the pair agrees in one of these as well. What is left open is a quarter of the word, so
no key holds many words whatever they have in common. Pairs are verified by edit distance.

Words are counted in the tasks that read them, so a very frequent word is one row per batch of texts.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twintally.llm.scratch import Scratch, quoted

LEAST_LENGTH = 6
LEAST_COUNT = 5
TIMES_AS_MANY = 5

# Latin-1: a-z and what stands from U+00C0 are letters, A-Z become a-z, the rest separates. Characters beyond it become "?".
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0xC0 else 0x20 for b in range(256))
_MOST_HELD = 200_000


def letter_runs(text: str) -> list[bytes]:
    """Maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased, in Latin-1: one byte per code point."""
    return text.encode("latin-1", "replace").translate(_FOLD).split()


def _misspelt(run: bytes, document: int, one_in: int) -> bytes:
    """The run, without one of its letters if the checksum of document and run says so; ``document`` is its checksum."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), document)
    if h % one_in:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _counting(least_length: int, one_in: int | None):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def counted() -> pa.RecordBatch:
            words = [w.decode("latin-1") for w in held]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                own = Counter(letter_runs(text or ""))
                if one_in is not None:
                    document = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                    changed = [(run, new) for run in own if (new := _misspelt(run, document, one_in)) != run]
                    gone = [(new, own.pop(run)) for run, new in changed]
                    for new, n in gone:
                        own[new] += n
                for word, n in own.items():
                    if len(word) >= least_length:
                        held[word] += n
                if len(held) > _MOST_HELD:
                    yield counted()
                    held.clear()
        if held:
            yield counted()

    return count


def count_words(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    misspell_one_in: int | None = None,
) -> DataFrame:
    """``word, n``: the runs of letters of at least ``least_length`` code points, with at least ``least_count`` occurrences.

    Null and empty texts hold none. ``misspell_one_in`` deletes a letter from about one in so many different runs of each
    document before they are counted, by a checksum of identifier (null: empty) and run, to have something to find.
    """
    rows = docs.select(quoted(id_column).cast("long").alias("doc_id"), quoted(text_column).cast("string").alias("text"))
    counted = rows.mapInArrow(_counting(least_length, misspell_one_in), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _key(length: Column, kind: int, chunk: Column, inner: Column) -> Column:
    return F.xxhash64(length, F.lit(kind), chunk, inner)


def chunk_keys(word: Column) -> Column:
    """The keys of a word that is not the longer one: each of its two chunks, with each chunk of the rest."""
    length = F.char_length(word)
    half = F.floor(length / 2).cast("int")
    head, tail = F.substring(word, F.lit(1), half), F.substring(word, half + 1, length)
    keys = []
    for kind, (chunk, rest) in enumerate(((head, tail), (tail, head))):
        inner = F.floor(F.char_length(rest) / 2).cast("int")
        keys.append(_key(length, 2 * kind, chunk, F.substring(rest, F.lit(1), inner)))
        keys.append(_key(length, 2 * kind + 1, chunk, F.substring(rest, inner + 1, length)))
    return F.array(*keys)


def gram_keys(word: Column, shift: int) -> Column:
    """The keys under which a word ``shift`` (0 or 1) longer than the other finds that one's chunks.

    A chunk from the start stands where it was, one up to the end ``shift`` positions further.
    """
    length = F.char_length(word) - shift
    half = F.floor(length / 2).cast("int")
    keys = []
    for kind in range(2):
        if kind == 0:
            gram, rest, size = F.substring(word, F.lit(1), half), F.substring(word, half + 1, length + 1), length - half
        else:
            gram, rest, size = F.substring(word, half + shift + 1, length), F.substring(word, F.lit(1), half + shift), half
        inner = F.floor(size / 2).cast("int")
        keys.append(_key(length, 2 * kind, gram, F.substring(rest, F.lit(1), inner)))
        keys.append(_key(length, 2 * kind + 1, gram, F.substring(rest, inner + shift + 1, length + 1)))
    return F.array(*keys)


def near_words(words: DataFrame) -> DataFrame:
    """``a, a_n, b, b_n``: every pair of ``word, n`` that one inserted, deleted or replaced code point parts, once."""
    short = words.select(F.explode(chunk_keys(F.col("word"))).alias("key"), F.col("word").alias("a"), F.col("n").alias("a_n"))
    keys = F.concat(
        F.transform(gram_keys(F.col("word"), 0), lambda key: F.struct(key.alias("key"), F.lit(0).alias("shift"))),
        F.transform(gram_keys(F.col("word"), 1), lambda key: F.struct(key.alias("key"), F.lit(1).alias("shift"))),
    )
    long = words.select(F.explode(keys).alias("at"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    long = long.select(F.col("at.key").alias("other"), "at.shift", "b", "b_n")
    met = (F.col("key") == F.col("other")) & ((F.col("shift") == 1) | (F.col("a") < F.col("b")))
    met &= F.call_function("levenshtein", F.col("a"), F.col("b"), F.lit(1)) == 1
    return short.join(long, met).select("a", "a_n", "b", "b_n").distinct()


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``word, root`` of words with a form (``word, form``): where the forms lead in the end, by doubling the steps.

    A form occurs several times as often as its word, so there are no circles and few rounds.
    """
    turn = 0
    roots = scratch.keep(forms.select("word", F.col("form").alias("root")), "roots-0")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if roots.join(further, "root", "left_semi").isEmpty():
            return roots
        turn += 1
        moved = roots.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
        roots = scratch.keep(moved, f"roots-{turn}")
        scratch.drop(f"roots-{turn - 1}")


def group_variants(words: DataFrame, times_as_many: int = TIMES_AS_MANY) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of words with their numbers (``word, n``), which must be distinct.

    ``n_near`` counts the words one edit away. A word's ``form`` is the most frequent of them (ties: the smallest in
    code-point order) if it occurs ``times_as_many`` times as often as the word or more, else null. ``root`` is
    where the forms lead, the word itself without one. No words give no rows. Words need two code points at least
    of which to cut chunks, null words are left out.
    """
    scratch = Scratch(words.sparkSession, "spelling")
    words = scratch.keep(words.where("word is not null").select("word", F.col("n").cast("long").alias("n")), "words")
    pairs = scratch.keep(near_words(words), "pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).unionAll(
        pairs.select("b", "a", "a_n")
    )
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("least"), "near")).alias("best")
    )
    told = words.join(best, "word", "left").withColumn("often", -F.col("best.least") >= times_as_many * F.col("n"))
    told = scratch.keep(
        told.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(F.col("often"), F.col("best.near")).alias("form"),
            F.when(F.col("often"), -F.col("best.least")).alias("form_n"),
        ),
        "told",
    )
    scratch.drop("words", "pairs")
    roots = _roots(told.where("form is not null").select("word", "form"), scratch)
    return told.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", misspell_one_in: int | None = None
) -> DataFrame:
    """:func:`group_variants` of the words that :func:`count_words` finds; an empty table gives no rows, other columns are not read."""
    return group_variants(count_words(docs, id_column, text_column, misspell_one_in=misspell_one_in))
