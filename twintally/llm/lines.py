"""Fuzzy line dedup: SimHash of lines, a join on pigeonhole blocks, and edit similarity.

A line is the text between newlines, normalised by lower-casing, trimming and one kind of blank; lines without
anything else take no part. Equal lines are one, however short. Lines are also linked if
their SimHashes differ in at most ``MOST_DISTANCE`` bits and their edit similarity (one minus the
edit distance over the longer length) is at least ``SIMILARITY``; of the occurrences of a
connected group of lines only the first stays, by document and then by place.

- *SimHash.* Features are a line's different words without punctuation, so that a mark which stands between
  any two cells of a table does not make all its lines alike. A line of fewer than ``LEAST_WORDS`` words, as of a script
  without spaces, has its character trigrams in their place; if it has fewer than ``LEAST_CHARACTERS``, it has no
  SimHash. Features are counted by bit in long integers that hold
  several counters side by side, inside the tasks that read them; a line is one row after that.
- *Blocks.* The 64 bits are cut into five blocks; lines at 3 bits or fewer agree in two of them, so
  the ten pairs of blocks, of 25 or 26 bits, are the keys of the join. Equal lines are one row before that.
- *Links.* Within a key every line is compared with the key's first line. Lines that are not linked
  with it are compared with all of the key. So what is connected stays connected, and as
  many pairs arise as there are lines, times one more for each line that is unlike the first.

Built-in functions only: no row passes through Python.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twintally.llm.scratch import Scratch, components, quoted, with_least

LEAST_WORDS = 5
LEAST_CHARACTERS = 16
MOST_DISTANCE = 3
SIMILARITY = 0.8

# First bit and number of bits of each block; any two of five are a key.
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))

# What counts as a space, and what is no part of a word.
BLANKS = "\t\r\x0b\x0c\u00a0\u3000"
PUNCTUATION = ".,;:!?\"'()[]{}"

# What ids of lines a task may be sent whole; more are joined by a shuffle.
MOST_BROADCAST = 500_000

_LAST_DOC = (1 << 63) - 1
_LONG = 1 << 14
# The first code unit of UTF-16 that is no character.
_MARKS = 0xD800


def _replaced(text: Column, characters: str, other: str) -> Column:
    """``text`` with ``other`` in place of each of the characters, as ``translate`` gives it; that looks up every character of the text."""
    return F.regexp_replace(text, "[" + "".join(f"\\{c}" for c in characters) + "]", other)


def split_lines(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``doc_id, line, h1, h2, norm``: every line that is not blank, with two independent hashes of what it is normalised to."""
    # Once for the whole text: what is made of a line is made anew for each use of it.
    text = F.lower(_replaced(F.coalesce(quoted(text_column).cast("string"), F.lit("")), BLANKS, " "))
    rows = docs.select(quoted(id_column).cast("long").alias("doc_id"), F.posexplode(F.split(text, "\n")).alias("line", "raw"))
    rows = rows.select("doc_id", "line", F.trim("raw").alias("norm")).where("norm <> ''")
    return rows.select("doc_id", "line", F.xxhash64("norm").alias("h1"), F.xxhash64(F.lit("again"), "norm").alias("h2"), "norm")


def line_place() -> Column:
    """Where a line stands, document first, as one number that a sum can take the smallest of."""
    document = F.coalesce("doc_id", F.lit(_LAST_DOC)).cast("decimal(20,0)")
    return document * F.lit(1 << 32).cast("decimal(11,0)") + F.col("line").cast("decimal(11,0)")


def _document(place: Column) -> Column:
    """The document of a :func:`line_place`; ``_LAST_DOC`` is none."""
    lines = F.lit(1 << 32).cast("decimal(11,0)")
    return F.call_function("div", (place - F.pmod(place, lines)).cast("decimal(33,0)"), lines)


def _words(norm: Column) -> Column:
    """Hashes of a line's different words without punctuation."""
    plain = _replaced(norm, PUNCTUATION, "")
    return F.array_distinct(F.transform(F.array_remove(F.split(plain, " "), ""), lambda word: F.xxhash64(word)))


def _trigrams(norm: Column) -> Column:
    """Hashes of a line's different character trigrams."""
    letters = F.split(norm, "")
    pairs = F.zip_with(letters, F.slice(letters, 2, F.char_length(norm)), lambda a, b: F.concat(a, b))
    trigrams = F.zip_with(pairs, F.slice(letters, 3, F.char_length(norm)), lambda a, b: F.xxhash64(F.concat(a, b)))
    return F.array_distinct(F.filter(F.slice(trigrams, 1, F.char_length(norm) - 2), lambda x: x.isNotNull()))


def _counters(word_hash: Column, bits: int) -> list[Column]:
    """Sums over words that hold counters of ``bits`` bits side by side: one counter for each bit of the hash."""
    ones = sum(1 << at for at in range(0, 64, bits))
    return [F.sum(F.shiftrightunsigned(word_hash, s).bitwiseAND(F.lit(ones))).alias(f"c{s}") for s in range(bits)]


def _majority(bits: int, n_words: Column) -> tuple[Column, Column]:
    """``lift`` and, with it, the SimHash: each bit that is set in over half of the words.

    All counters of a sum are compared at once: the number is added that lifts those which
    reach the majority, and no others, to the counter's second highest bit.
    """
    ones = F.lit(sum(1 << at for at in range(0, 64, bits)))
    lift = (F.lit(1 << (bits - 2)) - F.floor(n_words / 2) - 1) * ones
    parts = [
        F.shiftleft(F.shiftrightunsigned(F.col(f"c{s}") + F.col("lift"), bits - 2).bitwiseAND(ones), s) for s in range(bits)
    ]
    while len(parts) > 1:
        parts = [a.bitwiseOR(b) for a, b in zip(parts[::2], parts[1::2])]
    return lift, parts[0]


def line_hashes(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``doc_id, line, h1, h2, simhash`` of all lines; the last is null for lines without features.

    The counters of 16 bits hold lines below 16,384 characters, which cannot have more features; longer lines are counted with 32 bits.
    """

    def hashed(some: DataFrame, bits: int) -> DataFrame:
        # In steps of their own, so that the words are taken once.
        worded = some.select("doc_id", "line", "h1", "h2", "norm", _words(F.col("norm")).alias("words"))
        enough = F.char_length("norm") >= LEAST_CHARACTERS
        features = F.when(F.size("words") >= LEAST_WORDS, F.col("words")).when(enough, _trigrams(F.col("norm")))
        found = worded.select("doc_id", "line", "h1", "h2", features.alias("features"))
        each = found.select("doc_id", "line", "h1", "h2", F.explode_outer("features").alias("w"))
        # Sums of what is never null are quicker.
        counters = _counters(F.coalesce("w", F.lit(0)), bits)
        counted = each.groupBy("doc_id", "line", "h1", "h2").agg(F.count("w").alias("n"), *counters)
        lift, simhash = _majority(bits, F.col("n"))
        return counted.withColumn("lift", lift).select("doc_id", "line", "h1", "h2", F.when(F.col("n") > 0, simhash).alias("simhash"))

    # A line has at most twice its characters in lower case.
    text = quoted(text_column).cast("string")
    has_long = F.exists(F.split(text, "\n"), lambda line: F.char_length(line) >= _LONG // 2)
    long_texts = docs.where(F.char_length(text) >= _LONG // 2).where(has_long)
    usual = split_lines(docs, id_column, text_column).where(F.char_length("norm") < _LONG)
    long = split_lines(long_texts, id_column, text_column).where(F.char_length("norm") >= _LONG)
    return hashed(usual, 16).unionAll(hashed(long, 32))


def block_keys(simhash: Column) -> Column:
    """The ten keys of a line: two blocks as they are, and which two."""
    keys = []
    for kind, pair in enumerate(combinations(BLOCKS, 2)):
        blocks = [F.shiftrightunsigned(simhash, at).bitwiseAND(F.lit((1 << n) - 1)) for at, n in pair]
        keys.append(F.lit(kind << 32).bitwiseOR(F.shiftleft(blocks[0], 16)).bitwiseOR(blocks[1]))
    return F.array(*keys)


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _core(words: Column) -> Column:
    """The words, each with the space after it."""
    return F.array_join(F.transform(words, lambda word: F.concat(word, F.lit(" "))), "")


def _alike(a: Column, b: Column) -> Column:
    """How many words two lists begin with in common."""
    # Where one list ends the other's word is no null.
    same = F.array_append(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), F.lit(False))
    return F.array_position(same, False).cast("int") - 1


def _marks(words: Column, different: Column) -> Column:
    """A text of one character for each word: its place in ``different``, which has fewer than ``_MARKS`` words."""
    marks = F.transform(words, lambda word: F.lpad(F.hex(F.array_position(different, word)), 4, "0"))
    return F.decode(F.unhex(F.array_join(marks, "")), "UTF-16BE")


def with_similarity(pairs: DataFrame) -> DataFrame:
    """``a_norm`` and ``b_norm`` with ``similar``: whether the texts have the edit similarity.

    Four shortcuts spare most of the quadratic work and change no answer. Texts with the same
    number of words need no more edits than their words one by one, so if that is few
    enough, it is settled. What texts begin or end with in common needs no edits, so
    only what lies between is compared, and no further than the similarity allows. There, whole words are
    put in, taken out or replaced first: so many of them cost no more than the longest words of both, each with its
    space, and if that is few enough, characters are not compared. Else it is
    looked at first whether half of the edits will do, which takes half of the time.
    """
    words = pairs.withColumns({"a_words": F.split("a_norm", " "), "b_words": F.split("b_norm", " ")})
    longest = F.greatest(F.char_length("a_norm"), F.char_length("b_norm"))
    words = words.withColumn("most", F.floor(longest * F.lit(f"{1 - SIMILARITY:.6f}").cast("decimal(7,6)")).cast("int"))
    a, b = F.col("a_words"), F.col("b_words")
    each = F.zip_with(a, b, lambda x, y: F.when(x == y, 0).otherwise(F.levenshtein(x, y)))
    words = words.withColumn("by_word", F.when(F.size(a) == F.size(b), F.aggregate(each, F.lit(0), lambda n, x: n + x)))
    words = words.withColumn("settled", F.coalesce(F.col("by_word") <= F.col("most"), F.lit(False)))
    # Columns of their own: each is used more than once.
    start, end = F.col("start"), F.col("end")
    words = words.withColumn("start", F.when(~F.col("settled"), _alike(a, b)))
    rest = [F.reverse(F.slice(some, start + 1, F.size(some))) for some in (a, b)]
    words = words.withColumn("end", F.when(~F.col("settled"), _alike(*rest)))
    words = words.withColumns({f"{x}_inner": F.slice(some, start + 1, F.size(some) - start - end) for x, some in (("a", a), ("b", b))})
    words = words.withColumn("different", F.array_union("a_inner", "b_inner"))
    marks = [F.when(F.size("different") < _MARKS, _marks(F.col(f"{x}_inner"), F.col("different"))) for x in "ab"]
    # More of them seldom cost few enough characters.
    words = words.withColumn("changed", F.call_function("levenshtein", *marks, F.floor(F.col("most") / 8).cast("int")))
    lengths = F.transform(F.concat("a_inner", "b_inner"), lambda word: F.char_length(word) + 1)
    dearest = F.when(F.col("changed") >= 0, F.slice(F.sort_array(lengths, asc=False), 1, F.col("changed")))
    words = words.withColumn("by_place", F.coalesce(F.aggregate(dearest, F.lit(0), lambda n, x: n + x) <= F.col("most"), F.lit(False)))
    words = words.withColumns({f"{x}_core": F.when(~F.col("by_place"), _core(F.col(f"{x}_inner"))) for x in "ab"})
    limits = F.array(F.floor(F.col("most") / 2).cast("int"), F.col("most"))
    within = F.exists(limits, lambda most: F.call_function("levenshtein", "a_core", "b_core", most) >= 0)
    return words.withColumn("similar", F.when(F.col("settled") | F.col("by_place"), True).otherwise(within))


def _members(distinct: DataFrame, most: int) -> DataFrame:
    """The lines of each key that has two or more, but for its first line, which they have beside them.

    Unlike lines meet in a key mostly two by two: where a key's only two lines are too far apart, it has none.
    """
    keyed = distinct.where("simhash is not null").select(F.explode(block_keys(F.col("simhash"))).alias("key"), "id", "simhash").repartition("key")
    groups = keyed.groupBy("key").agg(
        F.count("*").alias("n"), F.min("id").alias("first"), F.min_by("simhash", "id").alias("first_hash"), F.bit_xor("simhash").alias("both")
    )
    groups = groups.where((F.col("n") > 2) | (F.col("n") == 2) & (F.bit_count("both") <= most)).drop("both")
    # One row of a key is few bytes, so that no rows need be sorted.
    return keyed.join(groups.hint("shuffle_hash"), "key").where("id <> first")


def _first_kind(a: Column, b: Column) -> Column:
    """The first of the kinds of keys that two hashes have in common."""
    other = a.bitwiseXOR(b)
    same = [F.shiftrightunsigned(other, at).bitwiseAND(F.lit((1 << n) - 1)) == 0 for at, n in BLOCKS]
    chosen = F.lit(-1)
    for kind, (i, j) in reversed(list(enumerate(combinations(range(len(BLOCKS)), 2)))):
        chosen = F.when(same[i] & same[j], kind).otherwise(chosen)
    return chosen


def _pairs_with_all(some: DataFrame, members: DataFrame, most: int) -> DataFrame:
    """Pairs near enough of the lines of ``some`` with all lines of their keys.

    A pair that has several keys in common is made in the first of them: if neither line is in
    ``some`` there, both are linked with that key's first line. ``some`` says of its rows whether
    they are ``apart`` from the first line by their hash; two such lines of a key are one pair.
    """
    left = some.select("key", F.col("id").alias("x"), F.col("simhash").alias("x_hash"), F.col("apart").alias("x_apart"))
    right = members.select(F.col("key").alias("other"), F.col("id").alias("y"), F.col("simhash").alias("y_hash"), F.col("apart").alias("y_apart"))
    near = (F.col("key") == F.col("other")) & (F.col("x") != F.col("y")) & (_distance(F.col("x_hash"), F.col("y_hash")) <= most)
    near &= F.shiftright("key", 32) == _first_kind(F.col("x_hash"), F.col("y_hash"))
    near &= ~(F.col("x_apart") & F.col("y_apart")) | (F.col("x") < F.col("y"))
    joined = left.join(right, near)
    return joined.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _texts(docs: DataFrame, distinct: DataFrame, pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """``id, norm`` of the lines of ``docs`` (``doc_id, text``) that stand in pairs."""
    ids = pairs.select(F.col("a").alias("id")).unionAll(pairs.select("b")).distinct()
    wanted = scratch.keep(distinct.join(ids, "id", "left_semi").select("id", "h1", "h2", "place"), "wanted")
    if wanted.count() <= MOST_BROADCAST:
        # Texts that hold none of them are not cut into lines.
        holding = wanted.select(_document(F.col("place")).alias("holding")).distinct()
        docs = docs.join(F.broadcast(holding), F.coalesce("doc_id", F.lit(_LAST_DOC)) == F.col("holding"), "left_semi")
        wanted = F.broadcast(wanted)
    # Only the first occurrence of a line is wanted, so a line with many copies is fetched once.
    found = split_lines(docs, "doc_id", "text").withColumn("place", line_place()).join(wanted, ["h1", "h2", "place"])
    return found.select("id", "norm").dropDuplicates(["id"])


def _verified(pairs: DataFrame, texts: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The pairs whose texts are similar. Written before they are chosen: a condition would be made of the steps again, each for every use of it."""
    a = texts.select(F.col("id").alias("a"), F.col("norm").alias("a_norm"))
    b = texts.select(F.col("id").alias("b"), F.col("norm").alias("b_norm"))
    told = scratch.keep(with_similarity(pairs.join(a, "a").join(b, "b")).select("a", "b", "similar"), name)
    return told.where("similar").select("a", "b")


def line_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", most_distance: int = MOST_DISTANCE) -> DataFrame:
    """``doc_id, line, keep_doc, keep_line, kept`` for every line that is not blank.

    ``keep_doc`` and ``keep_line`` (from 0) are the first occurrence of the line's connected group.

    - A null text is an empty text, which is one blank line.
    - A null identifier comes after all others; rows that repeat an identifier count as one document, so
      that equal lines at the same place of both stay or go together.
    - An empty table gives no rows. Other columns are not read.
    """
    if not 0 <= most_distance <= MOST_DISTANCE:
        raise ValueError(f"the keys find distances of 0 to {MOST_DISTANCE} bits")
    scratch = Scratch(docs.sparkSession, "lines")
    hashed = scratch.keep(line_hashes(docs, id_column, text_column), "hashed")
    place = line_place()
    distinct = hashed.groupBy("h1", "h2").agg(F.max("simhash").alias("simhash"), F.min(place).alias("place"))
    distinct = scratch.keep(distinct.withColumn("id", F.monotonically_increasing_id()), "distinct")

    apart = _distance(F.col("simhash"), F.col("first_hash")) > most_distance
    members = scratch.keep(_members(distinct, most_distance).withColumn("apart", apart), "members")
    beside = members.where("not apart")
    apart = members.where("apart and n > 2")
    with_first = beside.select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
    pairs = scratch.keep(with_first.unionAll(_pairs_with_all(apart, members, most_distance)).distinct(), "pairs")
    read = docs.select(quoted(id_column).cast("long").alias("doc_id"), quoted(text_column).alias("text"))
    texts = scratch.keep(_texts(read, distinct, pairs, scratch), "texts")
    links = _verified(pairs, texts, scratch, "verified")

    # Lines near the first line by their hash that are unlike it by their text.
    unlike = beside.where("n > 2").join(links, (F.col("first") == F.col("a")) & (F.col("id") == F.col("b")), "left_anti")
    more = _pairs_with_all(unlike, members, most_distance).join(pairs, ["a", "b"], "left_anti")
    links = links.unionAll(_verified(more, texts, scratch, "verified-more"))

    roots = components(links, scratch)
    scratch.drop("members", "pairs", "wanted", "texts", "verified", "verified-more")
    linked = distinct.select("id", "place").join(roots, F.col("id") == F.col("node"))
    linked = with_least(linked, "id", "place", "keep").select(F.col("id").alias("linked"), "keep")
    kept = distinct.join(linked, F.col("id") == F.col("linked"), "left")
    kept = scratch.keep(kept.select("h1", "h2", F.coalesce("keep", "place").alias("keep")), "kept")
    scratch.drop("distinct")
    found = hashed.withColumn("place", place).join(kept, ["h1", "h2"])
    return found.select(
        "doc_id",
        "line",
        F.nullif(_document(F.col("keep")), F.lit(_LAST_DOC)).alias("keep_doc"),
        F.pmod("keep", F.lit(1 << 32).cast("decimal(11,0)")).cast("int").alias("keep_line"),
        (F.col("place") == F.col("keep")).alias("kept"),
    )


def line_report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per identifier: ``doc_id, n_lines`` (that are not blank), ``n_kept``, ``dropped`` (line numbers in order)."""
    groups = line_groups(docs, id_column, text_column)
    told = groups.groupBy("doc_id").agg(
        F.count("*").alias("n_lines"),
        F.count_if("kept").alias("n_kept"),
        F.array_sort(F.collect_set(F.when(~F.col("kept"), F.col("line")))).alias("dropped"),
    )
    every = docs.select(quoted(id_column).cast("long").alias("every")).distinct()
    joined = every.join(told, F.col("every").eqNullSafe(F.col("doc_id")), "left")
    return joined.select(
        F.col("every").alias("doc_id"),
        F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
        F.coalesce("n_kept", F.lit(0)).alias("n_kept"),
        F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"),
    )


def drop_repeated_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with the text of every row without the lines that do not stay.

    A null text stays null and blank lines stay; an empty table gives no rows. What :func:`line_groups` says of
    rows without an identifier, or that repeat one, holds here too.
    """
    dropped = line_report(docs, id_column, text_column).where(F.size("dropped") > 0)
    names = {c: f"column_{n}" for n, c in enumerate(docs.columns)}
    inside = docs.toDF(*names.values())
    id_name, text_name = names[id_column], names[text_column]
    joined = inside.join(dropped, F.col(id_name).cast("long").eqNullSafe(F.col("doc_id")), "left")
    lines = F.split(text_name, "\n")
    numbered = F.arrays_zip(lines.alias("text"), F.sequence(F.lit(0), F.size(lines) - 1).alias("number"))
    staying = F.filter(numbered, lambda line: ~F.array_contains(F.col("dropped"), line.number))
    shortened = F.array_join(F.transform(staying, lambda line: line.text), "\n")
    text = F.when(F.col("dropped").isNull(), F.col(text_name)).otherwise(shortened)
    return joined.select(*[(text if inner == text_name else F.col(inner)).alias(c) for c, inner in names.items()])
