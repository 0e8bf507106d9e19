"""Time templates: ``strftime`` text with directives filled from a process time.

``render`` fills a path or an SQL text on the driver; ``render_column`` does the
same for every row of a table with built-in expressions only. ``%`` is special
everywhere in a template, SQL ``LIKE`` patterns included: write ``%%`` for a
literal percent sign. A directive that is not listed here is an error.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIRECTIVE = re.compile(r"%(.?)", re.DOTALL)

# Directives that stand for several others (C locale). A naive time
# has no zone, so the two zone directives are empty.
_SHORTHANDS = {
    "c": "%a %b %e %H:%M:%S %Y",
    "x": "%m/%d/%y",
    "X": "%H:%M:%S",
    "D": "%m/%d/%y",
    "F": "%Y-%m-%d",
    "R": "%H:%M",
    "T": "%H:%M:%S",
    "h": "%b",
    "z": "",
    "Z": "",
}


def _padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def _name(when: Column, pattern: str) -> Column:
    return F.date_format(when.cast("date"), pattern)


def _weekday(when: Column) -> Column:
    """Monday is 0."""
    return F.weekday(when)


def _week(when: Column, days_into_week: Column) -> Column:
    """Weeks of the year counted from the first day whose ``days_into_week`` is 0."""
    return _padded(F.floor((F.dayofyear(when) + 6 - days_into_week) / 7), 2)


def _micros(when: Column) -> Column:
    seconds = F.extract(F.lit("SECOND"), when)
    return _padded(((seconds - F.floor(seconds)) * 1_000_000).cast("int"), 6)


# What each directive renders to, for a ``timestamp_ntz`` column. Numbers come
# from field extraction, which is zone-free; only names use a date pattern.
_COLUMN_FORM = {
    "Y": lambda t: F.year(t).cast("string"),
    "y": lambda t: _padded(F.year(t) % 100, 2),
    "m": lambda t: _padded(F.month(t), 2),
    "d": lambda t: _padded(F.dayofmonth(t), 2),
    "e": lambda t: F.lpad(F.dayofmonth(t).cast("string"), 2, " "),
    "H": lambda t: _padded(F.hour(t), 2),
    "M": lambda t: _padded(F.minute(t), 2),
    "S": lambda t: _padded(F.second(t), 2),
    "f": _micros,
    "j": lambda t: _padded(F.dayofyear(t), 3),
    "I": lambda t: _padded((F.hour(t) + 11) % 12 + 1, 2),
    "p": lambda t: F.when(F.hour(t) < 12, "AM").otherwise("PM"),
    "b": lambda t: _name(t, "MMM"),
    "B": lambda t: _name(t, "MMMM"),
    "a": lambda t: _name(t, "EEE"),
    "A": lambda t: _name(t, "EEEE"),
    "w": lambda t: (F.dayofweek(t) - 1).cast("string"),
    "u": lambda t: (_weekday(t) + 1).cast("string"),
    "U": lambda t: _week(t, F.dayofweek(t) - 1),
    "W": lambda t: _week(t, _weekday(t)),
    "V": lambda t: _padded(F.weekofyear(t), 2),
    "G": lambda t: F.extract(F.lit("YEAROFWEEK"), t).cast("string"),
    "%": lambda t: F.lit("%"),
}

DIRECTIVES = frozenset(_COLUMN_FORM) | frozenset(_SHORTHANDS)


def _pieces(template: str) -> Iterator[tuple[str, str | None]]:
    """Literal text and the directive after it, if any, in order."""
    start = 0
    for match in _DIRECTIVE.finditer(template):
        letter = match[1]
        if letter not in DIRECTIVES:
            raise ValueError(f"unknown directive {match[0]!r} in template {template!r}; write %% for a percent sign")
        if letter in _SHORTHANDS:
            yield template[start : match.start()], None
            yield from _pieces(_SHORTHANDS[letter])
        else:
            yield template[start : match.start()], letter
        start = match.end()
    yield template[start:], None


def is_dated(template: str) -> bool:
    """Whether any directive of the template depends on the time."""
    return any(letter not in (None, "%") for _, letter in _pieces(template))


def render(template: str, when: datetime) -> str:
    """The template filled from one process time."""
    filled = (text + (when.strftime("%" + letter) if letter else "") for text, letter in _pieces(template))
    return "".join(filled)


def render_column(when: Column, template: str) -> Column:
    """The template filled from the time in each row."""
    naive = when.cast("timestamp_ntz")
    parts: list[Column] = []
    for text, letter in _pieces(template):
        if text:
            parts.append(F.lit(text))
        if letter:
            parts.append(_COLUMN_FORM[letter](naive))
    return F.concat(*parts) if parts else F.lit("")
