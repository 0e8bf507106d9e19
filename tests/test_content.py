"""Content checks on tiny hand-made frames."""

import pytest
from pyspark.sql import functions as F

from twintally import SchemaMismatch, content_check, rows_extra, rows_missing, schema_difference
from twintally.operators import distinct_fingerprints, row_fingerprint


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def outcome(source, target, **how):
    row = content_check(source, target, **how).first()
    return row.schema_match, row.source_not_in_target, row.target_not_in_source, row.is_passed


EQUAL = (True, 0, 0, True)
DIFFER = (True, 1, 1, False)
MISMATCH = (False, None, None, False)

# case: source SQL, target SQL, verdict in concat mode, verdict in typed mode
CASES = {
    "null is skipped": (
        "select 'a' x, cast(null as string) y, 'b' z", "select 'a' x, 'b' y, cast(null as string) z", EQUAL, DIFFER,
    ),
    "separator in text": ("select 'a||b' x, 'c' y", "select 'a' x, 'b||c' y", EQUAL, DIFFER),
    "type-blind": ("select 1 x", "select '1' x", EQUAL, MISMATCH),
    "double against int": ("select 1d x", "select 1 x", DIFFER, MISMATCH),
    "decimal scale": (
        "select cast(1.5 as decimal(10,3)) x", "select cast(1.5 as decimal(10,2)) x", DIFFER, MISMATCH,
    ),
    "column case": ("select 1 A", "select 1 a", MISMATCH, MISMATCH),
    "column order": ("select 1 a, 2 b", "select 2 b, 1 a", MISMATCH, MISMATCH),
    "column missing": ("select 1 a, 2 b", "select 1 a", MISMATCH, MISMATCH),
    "all null": ("select cast(null as int) x", "select '' x", EQUAL, MISMATCH),
    "both null": ("select cast(null as int) x", "select cast(null as int) x", EQUAL, EQUAL),
    "array flattened": ("select array('a', 'b') x, 'c' y", "select array('a') x, 'b||c' y", EQUAL, DIFFER),
    "nan": ("select double('NaN') x", "select double('NaN') x", EQUAL, EQUAL),
    "binary": ("select X'4142' x", "select X'4142' x", EQUAL, EQUAL),
    "column named like a tally": ("select 1 s, 2 t, 3 row", "select 1 s, 2 t, 4 row", DIFFER, DIFFER),
    "null against empty": ("select 1 x, '' y", "select 1 x, cast(null as string) y", DIFFER, DIFFER),
    "same names twice": ("select 1 x, 'b' x", "select 1 x, 'c' x", DIFFER, DIFFER),
    "signed zero": ("select 0d x", "select -0d x", DIFFER, EQUAL),
    "column name with a dot": ("select 1 as `a.b`", "select 1 as `a.b`", EQUAL, EQUAL),
}


@pytest.mark.parametrize("case", CASES)
def test_modes(spark, case):
    source, target, concat, typed = CASES[case]
    source, target = spark.sql(source), spark.sql(target)
    assert outcome(source, target) == concat
    assert outcome(source, target, key="full") == concat
    assert outcome(source, target, buckets=8) == concat
    assert outcome(source, target, mode="typed") == typed
    assert outcome(source, target, mode="typed", key="full") == typed
    if case not in ("array flattened", "same names twice"):
        assert outcome(source, target, mode="typed", buckets=8) == typed


@pytest.mark.parametrize(
    "value", ["named_struct('p', 1, 'q', null)", "map('k', 1, 'l', 2)", "array(array(1), array(2, null))"]
)
def test_nested_types_compare_in_typed_mode(spark, value):
    side = spark.sql(f"select 1 id, {value} v")
    assert outcome(side, side, mode="typed") == EQUAL
    other = spark.sql(f"select 2 id, {value} v")
    assert outcome(side, other, mode="typed") == DIFFER
    assert rows_missing(side, other, mode="typed").columns == ["id", "v"]


def test_rendered_text(spark):
    table = spark.sql(
        "select 1 i, true b, date'2024-01-02' d, cast(1.5 as decimal(10,3)) m, 1d f, 1.0e10 g,"
        " timestamp_ntz'2024-01-02 03:04:05.120' t, array('x', null, 'y') a, cast(null as int) n, X'4142' y"
    )
    text = "1||true||2024-01-02||1.500||1.0||1.0E10||2024-01-02 03:04:05.12||x||y||AB"
    assert row_fingerprint(table).first().row == text


def test_long_and_short_texts_get_their_own_digest(spark):
    texts = ["", "a", "a" * 18, "a" * 20, "a" * 22, "a" * 5000, "é" * 9, "é" * 11]
    source = frame(spark, [(t,) for t in texts], "x string")
    target = frame(spark, [(t + "!",) for t in texts], "x string")
    for how in ({}, {"mode": "typed"}):
        assert outcome(source, source, **how) == EQUAL
        assert outcome(source, target, **how) == (True, 8, 8, False)
    binary = [side.select(F.col("x").cast("binary"), F.lit(None).cast("string")) for side in (source, target)]
    assert outcome(*binary, mode="typed") == (True, 8, 8, False)


def test_duplicates(spark):
    source, target = frame(spark, [(1,), (1,), (2,)], "x int"), frame(spark, [(1,), (2,), (2,), (2,)], "x int")
    found = content_check(source, target).first()
    assert (found.count_source, found.count_target, found.is_passed) == (3, 4, True)
    assert outcome(source, target, multiset=True) == (True, 1, 2, False)
    assert outcome(source, target, multiset=True, buckets=16) == (True, 1, 2, False)
    assert outcome(source, target, multiset=True, mode="typed") == (True, 1, 2, False)
    assert rows_missing(source, target).count() == 0
    assert [tuple(r) for r in rows_missing(source, target, multiset=True).collect()] == [("1", 1)]
    assert [tuple(r) for r in rows_extra(source, target, multiset=True, mode="typed").collect()] == [(2, 2)]


@pytest.mark.parametrize("how", [{}, {"mode": "typed"}, {"multiset": True}, {"buckets": 4}])
def test_empty_sides(spark, how):
    empty, one = frame(spark, [], "x int"), frame(spark, [(1,)], "x int")
    assert outcome(empty, empty, **how) == EQUAL
    assert outcome(empty, one, **how) == (True, 0, 1, False)
    assert outcome(one, empty, **how) == (True, 1, 0, False)


def test_columns_compare_a_subset(spark):
    source, target = spark.sql("select 1 a, 2 b, 3 c"), spark.sql("select 3 c, 1 a, 9 b")
    assert outcome(source, target) == MISMATCH
    assert outcome(source, target, columns=["a", "c"]) == EQUAL
    assert outcome(source, target, columns=["a", "b"]) == DIFFER
    assert distinct_fingerprints(source, ["c"]).first().row == "3"


def test_rows_of_unlike_schemas_are_refused(spark):
    with pytest.raises(SchemaMismatch):
        rows_missing(spark.sql("select 1 a"), spark.sql("select 1 b"))


def test_mismatch_still_counts(spark):
    found = content_check(spark.range(5), spark.range(7).toDF("other")).first()
    assert (found.schema_match, found.count_source, found.count_target) == (False, 5, 7)


def test_bad_settings(spark):
    side = spark.range(1)
    for how in ({"mode": "json"}, {"key": "crc"}, {"buckets": 0}, {"buckets": 12}, {"columns": ["nowhere"]}):
        with pytest.raises(ValueError):
            content_check(side, side, **how)


def test_equal_to_the_plain_set_form(spark, sf_dir):
    """The fused check against distinct, subtract and count on each side."""
    from twintally.catalogue.tables import lineitem_target, table

    source = table(spark, sf_dir, "lineitem")
    target = lineitem_target(source)
    left, right = (s.select(F.concat_ws("||", "*").alias("row")).distinct() for s in (source, target))
    plain = (source.count(), target.count(), left.subtract(right).count(), right.subtract(left).count())
    for how in ({}, {"key": "full"}, {"mode": "typed"}, {"buckets": 1 << 10}, {"mode": "typed", "buckets": 1 << 16}):
        found = content_check(source, target, **how).first()
        numbers = (found.count_source, found.count_target, found.source_not_in_target, found.target_not_in_source)
        assert numbers == plain, how


def test_expected_numbers(spark, sf_dir):
    from twintally.catalogue.tables import orders_target, table

    orders = table(spark, sf_dir, "orders")
    found = content_check(orders, orders_target(orders)).first()
    assert tuple(found) == (True, 15000, 15022, 322, 167, False)
    found = content_check(orders, orders_target(orders), multiset=True).first()
    assert tuple(found) == (True, 15000, 15022, 322, 344, False)


def test_a_row_that_is_a_third_of_the_table(spark):
    """Copies of one row do not change the answer, however many there are."""
    hot = spark.range(300_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("x"))
    target = hot.filter("x <> -1 and x <> 1").union(spark.range(1_000_000, 1_000_007).toDF("x"))
    for how in ({}, {"mode": "typed"}, {"buckets": 1 << 12}, {"mode": "typed", "buckets": 1 << 12}):
        assert outcome(hot, target, **how) == (True, 2, 7, False)
    assert outcome(hot, target, multiset=True) == (True, 100_001, 7, False)
    assert sorted(r.row for r in rows_missing(hot, target).collect()) == ["-1", "1"]


# Values that are easily taken for one another, one column of each type.
LOOKALIKES = {
    "string": ["'a'", "'a,'", "''", "null", "'1:a'", "'a,1:a'"],
    "binary": ["X'61'", "X''", "null", "X'FF'", "X'EFBFBD'"],
    "double": ["0d", "-0d", "double('NaN')", "double('Infinity')", "1e300", "1.0000000000000002d", "1d", "null"],
    "float": ["cast(0 as float)", "cast(-0d as float)", "float('NaN')", "cast(0.1 as float)", "null"],
    "timestamp": ["timestamp'2024-11-03 05:30:00Z'", "timestamp'2024-11-03 06:30:00Z'", "null"],
    "timestamp_ntz": ["timestamp_ntz'2024-11-03 01:30:00'", "timestamp_ntz'2024-11-03 01:30:00.000001'", "null"],
    "decimal(5,2)": ["1.10", "1.01", "null"],
    "boolean": ["true", "false", "null"],
    "date": ["date'2024-01-02'", "date'2024-02-01'", "null"],
    "bigint": ["1", "-1", "null"],
}


@pytest.mark.parametrize("kind", LOOKALIKES)
def test_buckets_keep_typed_equality(spark, kind):
    """Narrowing by exact texts finds the rows that grouping whole rows finds."""
    values = [f"(cast({v} as {kind}))" for v in LOOKALIKES[kind]]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # an hour that comes twice
    try:
        one = spark.sql(f"select * from values {', '.join(values)} as t(x)").coalesce(1)
        pairs = one.toDF("x").join(one.toDF("y"), F.lit(True)).coalesce(1)
        target = pairs.filter("x <=> y or x is null")
        swapped = pairs.filter("x is not null").select(F.col("y").alias("x"), F.col("x").alias("y"))
        for left, right in ((pairs, target), (target, swapped)):
            full = content_check(left, right, mode="typed", key="full", multiset=True).first()
            assert content_check(left, right, mode="typed", multiset=True).first() == full
            assert content_check(left, right, mode="typed", buckets=4, multiset=True).first() == full
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


WAYS = [
    {"mode": mode, "key": key, "buckets": buckets} for mode in ("concat", "typed") for key in ("digest", "full") for buckets in (None, 4)
]


@pytest.mark.parametrize("kind", ["string", "string collate UTF8_LCASE", "binary"])
@pytest.mark.parametrize("how", WAYS, ids=str)
def test_every_way_has_the_same_answer(spark, kind, how):
    texts = ["A", "b", "C" * 19, "D" * 20, "e" * 21, "F" * 4000, "", None]
    source = frame(spark, [(t,) for t in texts], "x string").select(F.col("x").cast(kind).alias("x"))
    lower = frame(spark, [(t and t.lower(),) for t in texts], "x string").select(F.col("x").cast(kind).alias("x"))
    alike = "LCASE" in kind
    assert outcome(source, lower, **how) == (EQUAL if alike else (True, 4, 4, False))
    assert outcome(source, source, **how) == EQUAL
    missing = rows_missing(source, lower, mode=how["mode"], buckets=how["buckets"])
    assert missing.count() == (0 if alike else 4)


def test_columns_are_named_letter_by_letter(spark):
    one, other = frame(spark, [(1, 2)], "A int, `x.y` int"), frame(spark, [(1, 2)], "a int, `x.y` int")
    assert outcome(one, other, columns=["x.y"]) == EQUAL
    assert outcome(one, other, columns=["A"]) == outcome(one, other, columns=["a"]) == (False, None, None, False)
    twice = spark.sql("select 1 as k, 2 as v, 3 as v")
    assert outcome(twice, twice, columns=["k"]) == EQUAL


def test_what_differs_in_schemas(spark):
    one, other = spark.sql("select 1 as a, 2L as b, 3 as c"), spark.sql("select 1 as A, 2 as b")
    found = schema_difference(one, other)
    assert [tuple(r) for r in found.collect()] == [(0, "a", "int", "A", "int"), (2, "c", "int", None, None)]
    typed = schema_difference(one, other, mode="typed", columns=["b"])
    assert [tuple(r) for r in typed.collect()] == [(0, "b", "bigint", "b", "int")]
    assert schema_difference(one, one).collect() == []


NESTED = "id int, s struct<a:int,b:string,c:array<string>>, l array<struct<x:double,y:map<string,int>>>, m map<int,array<string>>"
NESTED_ROWS = [
    (1, (1, "a,b", ["x", None]), [(0.0, {"k": 1, "j": None})], {1: ["a"], 2: None}),
    (2, None, None, None),
    (3, (None, None, None), [], {}),
    (4, (None, "", [""]), [None], {7: []}),
    (5, (None, "", [None]), [(None, None)], {7: [None]}),
    (6, (1, "2:ab,", ["", ""]), [(float("nan"), {})], {1: ["", ""]}),
    (6, (1, "2:ab", [",", ""]), [(float("nan"), {})], {1: [",", ""]}),
]


@pytest.mark.parametrize("how", [{}, {"buckets": 4}, {"buckets": 1 << 12, "multiset": True}])
def test_nested_columns_are_compared_exactly(spark, how):
    rows = spark.createDataFrame(NESTED_ROWS, NESTED)
    assert rows.select("id").count() == 7
    same = spark.createDataFrame(list(reversed(NESTED_ROWS)), NESTED).repartition(3)
    found = content_check(rows, same, mode="typed", **how).first()
    assert (found.count_source, found.source_not_in_target, found.target_not_in_source, found.is_passed) == (7, 0, 0, True)
    for n, row in enumerate(NESTED_ROWS):  # no two of them are alike, whatever their number
        others = spark.createDataFrame([(row[0], *r[1:]) for i, r in enumerate(NESTED_ROWS) if i != n], NESTED)
        found = content_check(rows.limit(0).unionAll(spark.createDataFrame([row], NESTED)), others, mode="typed", **how).first()
        assert (found.source_not_in_target, found.target_not_in_source) == (1, 6)


def test_maps_are_equal_whatever_the_order_of_their_entries(spark):
    left = spark.sql("select map('a', 1, 'b', -0.0D) m, array(named_struct('k', map(2, 'y', 1, 'x'))) l")
    right = spark.sql("select map('b', 0.0D, 'a', 1) m, array(named_struct('k', map(1, 'x', 2, 'y'))) l")
    for how in ({}, {"buckets": 2}):
        assert content_check(left, right, mode="typed", **how).first().is_passed


def test_nulls_keep_their_place_in_hashes(spark):
    left = spark.createDataFrame([(1, None, "a"), (None, 1, "b")], "a int, b int, c string")
    right = spark.createDataFrame([(None, 1, "a"), (1, None, "b")], "a int, b int, c string")
    found = content_check(left, right, mode="typed", buckets=1).first()
    assert (found.source_not_in_target, found.target_not_in_source) == (2, 2)


@pytest.mark.parametrize("mode", ["concat", "typed"])
@pytest.mark.parametrize("multiset", [False, True])
def test_rows_and_counts_in_one_pass(spark, mode, multiset):
    from pyspark.sql import Observation

    from twintally import rows_apart

    source = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, None)], "k int, v string")
    target = spark.createDataFrame([(1, "a"), (4, "d"), (4, "d")], "k int, v string")
    seen = Observation()
    rows = rows_apart(source, target, mode=mode, multiset=multiset, observation=seen).collect()
    plain = content_check(source, target, mode=mode, multiset=multiset).first()
    assert seen.get == {c: plain[c] for c in ("count_source", "count_target", "source_not_in_target", "target_not_in_source")}
    for side, function in (("source", rows_missing), ("target", rows_extra)):
        wanted = function(source, target, mode=mode, multiset=multiset).collect()
        assert sorted(tuple(r)[1:] for r in rows if r.side == side) == sorted(tuple(r) for r in wanted)
    with pytest.raises(SchemaMismatch):
        rows_apart(source, target.drop("v"))
    nothing = Observation()
    assert rows_apart(source.limit(0), target.limit(0), observation=nothing).collect() == [] and nothing.get["count_source"] == 0
