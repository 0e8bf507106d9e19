"""Row fingerprints: one value that stands for a whole row.

All of them are built-in JVM expressions over ``*``, so they stay inside
whole-stage code generation and read exactly the columns of the frame they are
applied to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEPARATOR = "||"


def row_text() -> Column:
    """The row as one string: columns joined by ``||``, NULLs skipped.

    Skipping NULLs and not escaping the separator are part of the meaning:
    ``('a', NULL, 'b')`` and ``('a', 'b', NULL)`` have the same text. Use
    :func:`row_struct` where that is not wanted.
    """
    return F.concat_ws(SEPARATOR, F.col("*"))


def row_digest(text: Column) -> Column:
    """The SHA-256 of ``text`` (a string or binary column), 32 bytes; NULL stays NULL.

    Shuffling this in place of the text bounds the key's width whatever the width of
    the table. It stands for the text's bytes, so not for text of a collation that
    takes different bytes for equal.
    """
    return F.unhex(F.sha2(text, 256))


def is_collated(kind: T.DataType) -> bool:
    """Whether equality of this type takes more than its bytes: text of a collation, however deep."""
    return " collate " in kind.simpleString()


def row_struct() -> Column:
    """The row as a struct: null-safe and type-exact, nested types included."""
    return F.struct(F.col("*"))


def row_struct_digest(table: DataFrame) -> DataFrame:
    """One ``row`` struct for each row: :func:`row_struct` with wide values cut down.

    Strings, binary and nested columns go into one :func:`row_digest` of their exact text
    together, so rows are equal here when they are equal as structs, maps included; text of a
    collation and all other columns stay as they are.
    """
    numbered = table.toDF(*[f"c{i}" for i in range(len(table.columns))])
    wide = [f for f in numbered.schema.fields if _is_wide(f.dataType) and has_exact_text(f.dataType)]
    values = [F.col(f.name) for f in numbered.schema.fields if f not in wide]
    if wide:
        texts = F.concat_ws(",", *[_exact(F.col(f.name), f.dataType) for f in wide])
        values.append(row_digest(texts).alias("wide"))
    return numbered.select(F.struct(*values).alias("row"))


def _is_wide(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StringType, T.BinaryType)) or _is_nested(kind)


def _is_nested(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StructType, T.ArrayType, T.MapType))


def row_hashes(table: DataFrame) -> list[Column]:
    """Two 64-bit hashes that are the same for two rows that are equal as structs, and independent of one another.

    Values are hashed as they are, without a text, but for nested ones: a hash passes over what is null inside.
    """
    values = []
    for field in table.schema.fields:
        value = F.col(_quoted(field.name))
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            value = value + F.lit(0).cast(field.dataType)  # -0.0 equals 0.0
        elif not isinstance(field.dataType, (T.StringType, T.BinaryType, T.AtomicType)) and has_exact_text(field.dataType):
            value = _exact(value, field.dataType)
        values += [value, value.isNull()]
    return [F.xxhash64(*values), F.xxhash64(F.lit("again"), *values)]


def text_hashes(text: Column) -> list[Column]:
    """The same of rows that are equal when their texts are."""
    return [F.xxhash64(text), F.xxhash64(F.lit("again"), text)]


def row_exact_text(table: DataFrame) -> Column:
    """A text that is the same for two rows exactly if they are equal as structs.

    NULL is empty. Strings and nested values carry their length, and everything else has a
    text without a comma, so no two different rows run together. A map's entries are in order of
    their keys' texts, so maps with the same entries have the same text.
    """
    return F.concat_ws(",", *[_exact(F.col(_quoted(f.name)), f.dataType) for f in table.schema.fields])


def has_exact_text(kind: T.DataType) -> bool:
    """Whether :func:`row_exact_text` takes columns of this type; text of a collation is not equal by its bytes."""
    if is_collated(kind):
        return False
    match kind:
        case T.StructType():
            return all(has_exact_text(f.dataType) for f in kind.fields)
        case T.ArrayType():
            return has_exact_text(kind.elementType)
        case T.MapType():
            return has_exact_text(kind.keyType) and has_exact_text(kind.valueType)
    flat = (
        T.StringType, T.BinaryType, T.FloatType, T.DoubleType, T.TimestampType, T.IntegralType, T.DecimalType, T.BooleanType,
        T.DateType, T.TimestampNTZType, T.NullType,
    )
    return isinstance(kind, flat)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _with_length(text: Column) -> Column:
    return F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)


def _exact(value: Column, kind: T.DataType) -> Column:
    match kind:
        case T.StructType():
            parts = [_exact(value.getField(f.name), f.dataType) for f in kind.fields]
            text = F.when(value.isNotNull(), _with_length(F.concat_ws(",", F.lit("s"), *parts)))
        case T.ArrayType():
            parts = F.transform(value, lambda item: _exact(item, kind.elementType))
            text = _with_length(F.concat_ws(",", F.size(value).cast("string"), F.array_join(parts, ",")))
            text = F.when(value.isNotNull(), text)
        case T.MapType():
            entry = lambda e: F.concat(_exact(e.key, kind.keyType), F.lit("="), _exact(e.value, kind.valueType))
            parts = F.array_sort(F.transform(F.map_entries(value), entry))
            text = _with_length(F.concat_ws(",", F.size(value).cast("string"), F.array_join(parts, ",")))
            text = F.when(value.isNotNull(), text)
        case T.NullType():
            text = F.lit(None).cast("string")
        case T.StringType() | T.BinaryType():
            text = _with_length(value.cast("string"))
        case T.FloatType() | T.DoubleType():
            text = (value + F.lit(0).cast(kind)).cast("string")  # -0.0 equals 0.0
        case T.TimestampType():
            text = F.unix_micros(value).cast("string")  # clock text repeats an hour in autumn
        case T.IntegralType() | T.DecimalType() | T.BooleanType() | T.DateType() | T.TimestampNTZType():
            text = value.cast("string")
        case _:
            raise ValueError(f"no exact text for type {kind.simpleString()}")
    return F.coalesce(text, F.lit(""))
