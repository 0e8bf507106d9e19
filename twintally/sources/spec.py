"""Where a side of a check comes from."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from datetime import datetime
from typing import Any

from twintally.functions.template import render
from twintally.sources.options import CSV_OPTIONS, JDBC_OPTIONS, PARQUET_OPTIONS, check_options

_FILE_OPTIONS = {"csv": CSV_OPTIONS, "parquet": PARQUET_OPTIONS}
# Names that CSV writers know and readers do not; taken without effect.
_WRITER_ONLY = {"csv": ("quoteAll", "escapeQuotes")}
_URL_SECRET = re.compile(r"(?i)(password|pwd)=[^;&]*")


@dataclass(frozen=True)
class FileSource:
    """A CSV or Parquet path; the path may be a time template.

    ``schema`` (DDL text) spares a CSV read the extra pass of ``inferSchema``.
    """

    format: str
    path: str
    options: Mapping[str, Any] = field(default_factory=dict)
    schema: str | None = None

    kind = "hdfs"

    def __post_init__(self) -> None:
        if self.format not in _FILE_OPTIONS:
            raise ValueError(f"file format must be one of {', '.join(_FILE_OPTIONS)}, not {self.format!r}")
        if not self.path:
            raise ValueError("a file source needs a path")
        given = {k: v for k, v in (self.options or {}).items() if k not in _WRITER_ONLY.get(self.format, ())}
        object.__setattr__(self, "options", check_options(given, _FILE_OPTIONS[self.format]))

    def at(self, when: datetime) -> FileSource:
        return replace(self, path=render(self.path, when))


@dataclass(frozen=True)
class JdbcSource:
    """A database table (``dbtable``) or query (``query``) read over JDBC.

    Only ``query`` may be a time template. Without ``partitionColumn`` one task
    reads everything, so set it for tables of any size; the database is asked for
    its bounds if they are not given, and ``numPartitions`` is the session's
    parallelism if it is not.
    """

    options: Mapping[str, Any]

    kind = "jdbc"

    def __post_init__(self) -> None:
        options = check_options(self.options, JDBC_OPTIONS)
        if not options.get("url"):
            raise ValueError("a JDBC source needs a url")
        if bool(options.get("dbtable")) == bool(options.get("query")):
            raise ValueError("a JDBC source needs exactly one of dbtable and query")
        object.__setattr__(self, "options", options)

    def at(self, when: datetime) -> JdbcSource:
        if not self.options.get("query"):
            return self
        return replace(self, options={**self.options, "query": render(self.options["query"], when)})

    def __repr__(self) -> str:
        shown = {k: "***" if k == "password" else v for k, v in self.options.items()}
        shown["url"] = _URL_SECRET.sub(r"\1=***", shown["url"])
        return f"JdbcSource({shown})"


Source = FileSource | JdbcSource


def source_from_mapping(config: Mapping[str, Any]) -> Source:
    """A source from a nested text configuration (``type`` and its ``*_config``)."""
    kind = config.get("type")
    if kind not in ("file", "database"):
        raise ValueError(f"source type must be file or database, not {kind!r}")
    body = config.get(f"{kind}_config")
    if not body:
        raise ValueError(f"{kind}_config is needed for a source of type {kind!r}")
    options = body.get("options") or {}
    if isinstance(options, str) and not options.strip():
        options = {}
    if kind == "file":
        return FileSource(body.get("format"), body.get("path"), options, body.get("schema"))
    if body.get("format") != "jdbc":
        raise ValueError(f"database format must be jdbc, not {body.get('format')!r}")
    return JdbcSource(options)
