"""Content reconciliation: which distinct rows are on one side only?

Both sides are unioned, each row tagged with its side, and grouped by the row's
key. One scan per side and one shuffle answer everything: both row counts, both
one-sided counts, and with ``multiset`` the surplus copies. Equal rows are added
up in each task before the shuffle, so a row that makes up a third of a table
still reaches the shuffle once per task.

Keys of ``mode="concat"`` are the row's text (see
:func:`twintally.functions.rowkey.row_text`); counting groups by its SHA-256
in place of the text. ``mode="typed"`` groups by the row itself,
when counting with a digest for each long string: NULL and nesting matter, and
both sides must have the same column types.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import zip_longest

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from twintally.functions.rowkey import is_collated, row_digest, row_hashes, row_struct, row_struct_digest, row_text, text_hashes
from twintally.operators.counts import count_rows, tally, union_all
from twintally.sources.read import conform as conformed

MODES = ("concat", "typed")
KEYS = ("digest", "full")

BUCKET = "_twintally_bucket"


class SchemaMismatch(ValueError):
    """The two sides do not have the same columns."""


def row_fingerprint(table: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One ``row`` string for each row of ``table``."""
    return _only(table, table, columns)[0].select(row_text().alias("row"))


def distinct_fingerprints(table: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The distinct ``row`` strings of ``table``."""
    return row_fingerprint(table, columns).distinct()


def schemas_match(source: DataFrame, target: DataFrame, mode: str = "concat") -> bool:
    """Same column names in the same order, case included; in typed mode, same types too."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}, not {mode!r}")
    if mode == "typed":
        return source.dtypes == target.dtypes
    return source.columns == target.columns


def schema_difference(
    source: DataFrame, target: DataFrame, mode: str = "concat", columns: Sequence[str] | None = None
) -> DataFrame:
    """The columns for which the two sides do not match, one row for each position (from 0).

    ``position, source_name, source_type, target_name, target_type``; a side without a
    column at the position has NULL. In concat mode types do not count, but are told.
    """
    source, target = _only(source, target, columns)
    pairs = enumerate(zip_longest(source.dtypes, target.dtypes, fillvalue=(None, None)))
    kept = slice(0, 2) if mode == "typed" else slice(0, 1)
    rows = [(position, *left, *right) for position, (left, right) in pairs if left[kept] != right[kept]]
    names = "position int, source_name string, source_type string, target_name string, target_type string"
    return source.sparkSession.createDataFrame(rows, names)


def content_check(
    source: DataFrame,
    target: DataFrame,
    *,
    mode: str = "concat",
    columns: Sequence[str] | None = None,
    multiset: bool = False,
    key: str = "digest",
    buckets: int | None = None,
    conform: bool = False,
) -> DataFrame:
    """Are the two sides the same set of rows?

    One row: ``schema_match, count_source, count_target, source_not_in_target,
    target_not_in_source, is_passed``. When the schemas do not match the two
    one-sided counts are NULL and the check fails; the row counts are still given.

    ``columns`` compares a subset of the columns; a name that only one side has, letter
    by letter, is a schema that does not match. ``multiset`` counts surplus copies of a
    row as differences. ``key="full"`` groups by the whole row text or row, not by
    digests. ``buckets``, a power of two, is for tables expected to be nearly equal: it
    sets aside the hash buckets whose checksums agree before rows are shuffled, at the
    price of a second scan; the answer is the same. (Tables with text of a collation are
    compared as if ``buckets`` and the digest had not been asked for.)

    ``conform`` casts the target to the source's types first (see
    :func:`twintally.sources.conform`). A target row that a cast would change is on the
    target's side only, as it is.
    """
    source, target = _only(source, target, columns)
    if key not in KEYS:
        raise ValueError(f"key must be one of {', '.join(KEYS)}, not {key!r}")
    if not schemas_match(source, target, "concat" if conform else mode):
        unknown = F.lit(None).cast("bigint")
        counts = count_rows(source, target)
        return _verdict(counts, F.lit(False), unknown, unknown)
    apart = []
    if conform:
        schema = source.schema
        source = conformed(source, schema)[0]
        target, changed = conformed(target, schema)
        # Rows that no cast can bring over are on one side only, so they need no comparing.
        alone = _grouped(changed.limit(0), changed, "typed", key, None)
        apart = [difference_numbers(alone, multiset)]
    return _compared(*_grouped_apart(source, target, mode, key, buckets), multiset, apart)


def check_with_sums(
    source: DataFrame, target: DataFrame, sums: DataFrame, *, mode: str, multiset: bool, key: str, buckets: int
) -> DataFrame:
    """:func:`content_check` with ``buckets`` whose checksums are known: columns of :func:`net_sums`."""
    return _compared(*_grouped_apart(source, target, mode, key, buckets, sums), multiset)


def _compared(grouped: DataFrame, equal: DataFrame | None, multiset: bool, more: Sequence[DataFrame] = ()) -> DataFrame:
    """The verdict on grouped rows, counts of rows that are known to agree, and further numbers."""
    parts = [difference_numbers(grouped, multiset), *more]
    if equal is not None:
        none = F.lit(0).cast("bigint")
        parts.append(equal.select(F.col("s").alias("count_source"), F.col("t").alias("count_target"), none.alias("missing"), none.alias("extra")))
    numbers = parts[0]
    if len(parts) > 1:
        numbers = union_all(parts).agg(*[F.sum(c).alias(c) for c in numbers.columns])
    return _verdict(numbers, F.lit(True), F.col("missing"), F.col("extra"))


def rows_missing(
    source: DataFrame,
    target: DataFrame,
    *,
    mode: str = "concat",
    columns: Sequence[str] | None = None,
    multiset: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """The distinct rows of ``source`` that ``target`` does not have.

    Column ``row`` (the text) in concat mode, the table's own columns in typed
    mode. ``multiset`` gives rows the source has more copies of, with the surplus
    in a last column ``copies``. ``buckets`` is that of :func:`content_check`.
    Raises :class:`SchemaMismatch` on unlike schemas.
    """
    source, target = _only(source, target, columns)
    if not schemas_match(source, target, mode):
        raise SchemaMismatch(f"cannot compare {source.dtypes} with {target.dtypes}")
    grouped = _grouped(source, target, mode, "full", buckets)
    rows = ["row"] if mode == "concat" else ["row.*"]
    if multiset:
        return grouped.filter("s > t").select(*rows, (F.col("s") - F.col("t")).alias("copies"))
    return grouped.filter("s > 0 and t = 0").select(*rows)


def rows_apart(
    source: DataFrame,
    target: DataFrame,
    *,
    mode: str = "concat",
    columns: Sequence[str] | None = None,
    multiset: bool = False,
    observation: Observation | None = None,
) -> DataFrame:
    """:func:`rows_missing` and :func:`rows_extra` in one pass: ``side`` (``source`` or ``target``) and then the rows.

    An ``observation`` has the numbers of :func:`content_check` once the rows were written or otherwise gone
    through as a whole: ``count_source, count_target, source_not_in_target, target_not_in_source``.
    Raises :class:`SchemaMismatch` on unlike schemas.
    """
    source, target = _only(source, target, columns)
    if not schemas_match(source, target, mode):
        raise SchemaMismatch(f"cannot compare {source.dtypes} with {target.dtypes}")
    grouped = _grouped(source, target, mode, "full", None)
    if observation is not None:
        numbers = zip(("count_source", "count_target", "source_not_in_target", "target_not_in_source"), _numbers(multiset).values())
        zero = F.lit(0).cast("bigint")
        grouped = grouped.observe(observation, *[F.coalesce(number, zero).alias(name) for name, number in numbers])
    side = F.when(F.expr("s > t"), "source").otherwise("target").alias("side")
    rows = ["row"] if mode == "concat" else ["row.*"]
    if multiset:
        return grouped.filter("s <> t").select(side, *rows, F.abs(F.col("s") - F.col("t")).alias("copies"))
    return grouped.filter("(s > 0 and t = 0) or (t > 0 and s = 0)").select(side, *rows)


def rows_extra(source: DataFrame, target: DataFrame, **how: object) -> DataFrame:
    """The distinct rows of ``target`` that ``source`` does not have; see :func:`rows_missing`."""
    return rows_missing(target, source, **how)


def check_buckets(buckets: int | None) -> int | None:
    """A power of two, or nothing."""
    if buckets is not None and (buckets < 1 or buckets & (buckets - 1)):
        raise ValueError(f"buckets must be a power of two, not {buckets}")
    return buckets


WORDS = tuple(f"word{n}" for n in range(4))


def bucket_words(hashes: Sequence[Column], buckets: int) -> list[Column]:
    """The bucket of a row with these two 64-bit hashes, and both cut into four numbers of 32 bits."""
    half = F.lit((1 << 32) - 1)
    parts = [part for h in hashes for part in (h.bitwiseAND(half), F.shiftrightunsigned(h, 32))]
    return [hashes[0].bitwiseAND(F.lit(buckets - 1)).alias(BUCKET), *[p.alias(w) for p, w in zip(parts, WORDS)]]


def net_sums(marked: DataFrame) -> DataFrame:
    """For each bucket the counts ``s`` and ``t`` of both sides, and the words' sums on the source less those on the target.

    A sum that overflows is NULL, which is not equal to 0: such a bucket counts as differing.
    """
    net = F.col("s") - F.col("t")
    words = [F.try_sum(F.col(w) * net).alias(w) for w in WORDS]
    return marked.groupBy(BUCKET).agg(F.sum("s").alias("s"), F.sum("t").alias("t"), *words)


def agree() -> Column:
    """Whether a row of :func:`net_sums` is of a bucket with the same rows on both sides."""
    equal = F.col("s") == F.col("t")
    for word in WORDS:
        equal = equal & F.col(word).eqNullSafe(0)
    return equal


def _narrowed(
    source: DataFrame,
    target: DataFrame,
    hashes: Callable[[DataFrame], list[Column]],
    buckets: int,
    sums: DataFrame | None = None,
) -> tuple[tuple[DataFrame, DataFrame], DataFrame]:
    """Both sides without the buckets whose checksums agree, and the counts of those; equal rows have equal ``hashes``.

    Rows fall into ``buckets`` by the first of two 64-bit hashes. Each task adds up both, as four
    numbers of 32 bits, by bucket, so at most ``buckets`` rows per task are shuffled.
    A bucket whose four sums and whose counts agree on both sides is taken to hold
    the same rows on both. What is left, every row of every other bucket, has the
    differences of the whole tables, for one more scan of each side but without
    shuffling the rows that agree. The buckets that differ are joined as adaptive
    execution sees fit: few are broadcast. ``sums`` that are known already spare the first pass.
    """
    check_buckets(buckets)

    def marked(side: DataFrame, of_source: bool) -> DataFrame:
        hashed = side.select(*[h.alias(f"hash{n}") for n, h in enumerate(hashes(side))])
        return tally(hashed, of_source=of_source, by=bucket_words([F.col("hash0"), F.col("hash1")], buckets))

    if sums is None:
        sums = net_sums(marked(source, True).unionAll(marked(target, False)))
    differing = sums.filter(~agree()).select(BUCKET)
    zero = F.lit(0).cast("bigint")
    agreeing = sums.filter(agree()).agg(*[F.coalesce(F.sum(n), zero).alias(n) for n in ("s", "t")])

    def narrowed(side: DataFrame) -> DataFrame:
        bucket = hashes(side)[0].bitwiseAND(F.lit(buckets - 1)).alias(BUCKET)
        return side.select("*", bucket).join(differing, BUCKET, "left_semi").drop(BUCKET)

    return (narrowed(source), narrowed(target)), agreeing


def _only(
    source: DataFrame, target: DataFrame, columns: Sequence[str] | None
) -> tuple[DataFrame, DataFrame]:
    """Both sides with the chosen columns only; names are taken letter by letter.

    A column that one side does not have is left out there, so that the schemas differ.
    """
    if columns is None:
        return source, target
    unknown = [c for c in columns if c not in source.columns and c not in target.columns]
    if unknown:
        raise ValueError(f"neither side has the column(s) {', '.join(unknown)}")

    def chosen(side: DataFrame) -> DataFrame:
        # By position, so that dots, quotes and names that differ in case only do no harm.
        places = [side.columns.index(c) for c in columns if c in side.columns]
        numbered = side.toDF(*[f"c{place}" for place in range(len(side.columns))])
        return numbered.select(*[f"c{place}" for place in places]).toDF(*[side.columns[place] for place in places])

    return chosen(source), chosen(target)


def _grouped(source: DataFrame, target: DataFrame, mode: str, key: str, buckets: int | None) -> DataFrame:
    return _grouped_apart(source, target, mode, key, buckets)[0]


def _grouped_apart(
    source: DataFrame, target: DataFrame, mode: str, key: str, buckets: int | None, sums: DataFrame | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """One line per distinct row: ``row`` (its key) and its copies ``s`` and ``t``.

    With ``buckets``, rows of buckets that agree are left out, and their counts ``s``
    and ``t`` are given apart.
    """
    sides, agreeing = (source, target), None
    if any(is_collated(side.schema) for side in sides):
        key, buckets = "full", None
    if mode == "typed":
        if buckets is not None:
            sides, agreeing = _narrowed(*sides, row_hashes, buckets, sums)
        keyed = [row_struct_digest(s) if key == "digest" else s.select(row_struct().alias("row")) for s in sides]
    else:
        keyed = [s.select(row_text().alias("row")) for s in sides]
        if buckets is not None:
            keyed, agreeing = _narrowed(*keyed, lambda side: text_hashes(F.col("row")), buckets, sums)
        if key == "digest":
            keyed = [s.select(row_digest(F.col("row")).alias("row")) for s in keyed]
    by = [F.col("row")]
    both = tally(keyed[0], of_source=True, by=by).unionAll(tally(keyed[1], of_source=False, by=by))
    return both.groupBy("row").agg(F.sum("s").alias("s"), F.sum("t").alias("t")), agreeing


def _numbers(multiset: bool) -> dict[str, Column]:
    """Both row counts and both one-sided counts of grouped rows; NULL without rows."""
    if multiset:
        zero = F.lit(0).cast("bigint")
        missing = F.sum(F.greatest(F.expr("s - t"), zero))
        extra = F.sum(F.greatest(F.expr("t - s"), zero))
    else:
        missing = F.count_if(F.expr("s > 0 and t = 0"))
        extra = F.count_if(F.expr("t > 0 and s = 0"))
    return {"count_source": F.sum("s"), "count_target": F.sum("t"), "missing": missing, "extra": extra}


def difference_numbers(grouped: DataFrame, multiset: bool) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    return grouped.agg(*[F.coalesce(number, zero).alias(name) for name, number in _numbers(multiset).items()])


def _verdict(numbers: DataFrame, schema_match: Column, missing: Column, extra: Column) -> DataFrame:
    return numbers.select(
        schema_match.alias("schema_match"),
        "count_source",
        "count_target",
        missing.alias("source_not_in_target"),
        extra.alias("target_not_in_source"),
        (schema_match & F.coalesce((missing == 0) & (extra == 0), F.lit(False))).alias("is_passed"),
    )
