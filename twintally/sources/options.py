"""Reader options a source may set, and the check that guards them."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

# Option names of Spark's own readers with the kind of value each
# takes. A tuple lists the values allowed.
_REBASE_MODES = ("EXCEPTION", "CORRECTED", "LEGACY")

CSV_OPTIONS: dict[str, Any] = {
    "sep": str,
    "encoding": str,
    "quote": str,
    "escape": str,
    "comment": str,
    "header": bool,
    "inferSchema": bool,
    "preferDate": bool,
    "enforceSchema": bool,
    "ignoreLeadingWhiteSpace": bool,
    "ignoreTrailingWhiteSpace": bool,
    "nullValue": str,
    "nanValue": str,
    "positiveInf": str,
    "negativeInf": str,
    "dateFormat": str,
    "timestampFormat": str,
    "timestampNTZFormat": str,
    "enableDateTimeParsingFallback": bool,
    "maxColumns": int,
    "maxCharsPerColumn": int,
    "mode": ("PERMISSIVE", "DROPMALFORMED", "FAILFAST"),
    "columnNameOfCorruptRecord": str,
    "multiLine": bool,
    "charToEscapeQuoteEscaping": str,
    "samplingRatio": float,
    "emptyValue": str,
    "locale": str,
    "lineSep": str,
    "unescapedQuoteHandling": (
        "STOP_AT_CLOSING_QUOTE",
        "BACK_TO_DELIMITER",
        "STOP_AT_DELIMITER",
        "SKIP_VALUE",
        "RAISE_ERROR",
    ),
}

PARQUET_OPTIONS: dict[str, Any] = {
    "datetimeRebaseMode": _REBASE_MODES,
    "int96RebaseMode": _REBASE_MODES,
    "mergeSchema": bool,
    "compression": str,
}

JDBC_OPTIONS: dict[str, Any] = {
    "url": str,
    "user": str,
    "password": str,
    "dbtable": str,
    "query": str,
    "prepareQuery": str,
    "driver": str,
    "partitionColumn": str,
    "lowerBound": "bound",
    "upperBound": "bound",
    "numPartitions": int,
    "queryTimeout": int,
    "fetchsize": int,
    "sessionInitStatement": str,
    "customSchema": str,
    "pushDownPredicate": bool,
    "pushDownAggregate": bool,
    "pushDownLimit": bool,
    "pushDownTableSample": bool,
    "keytab": str,
    "principal": str,
    "refreshKrb5Config": bool,
    "connectionProvider": str,
    "preferTimestampNTZ": bool,
}

# Texts read as a truth value in a text configuration.
_TRUE = ("true", "t", "yes", "y", "on", "1")
_FALSE = ("false", "f", "no", "n", "off", "0")


def as_bool(name: str, value: Any) -> bool:
    text = str(value).strip().lower()
    if text in _TRUE:
        return True
    if text in _FALSE:
        return False
    raise ValueError(f"{name} must be a truth value, not {value!r}")


def as_int(name: str, value: Any) -> int:
    if isinstance(value, bool) or isinstance(value, float) and not value.is_integer():
        raise ValueError(f"{name} must be an integer, not {value!r}")
    try:
        return int(value)
    except (TypeError, ValueError):
        raise ValueError(f"{name} must be an integer, not {value!r}") from None


def _checked(name: str, value: Any, kind: Any) -> Any:
    if isinstance(kind, tuple):
        if value not in kind:
            raise ValueError(f"{name} must be one of {', '.join(kind)}, not {value!r}")
        return value
    if kind is bool:
        return as_bool(name, value)
    if kind is int:
        return as_int(name, value)
    if kind is float:
        try:
            return float(value)
        except (TypeError, ValueError):
            raise ValueError(f"{name} must be a number, not {value!r}") from None
    if kind == "bound":
        # Numbers, or the text of a date or timestamp; Spark parses it by column type.
        return value if isinstance(value, str) else as_int(name, value)
    if not isinstance(value, str):
        raise ValueError(f"{name} must be text, not {value!r}")
    return value


def check_options(given: Mapping[str, Any] | None, allowed: Mapping[str, Any]) -> dict[str, Any]:
    """The options that are set, each of its kind; an unknown name is an error."""
    given = given or {}
    unknown = sorted(set(given) - set(allowed))
    if unknown:
        raise ValueError(f"unknown option(s): {', '.join(unknown)}")
    return {name: _checked(name, value, allowed[name]) for name, value in given.items() if value is not None}
