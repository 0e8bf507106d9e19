from twintally.sources.read import conform, malformed_rows, read_count, read_range, read_source
from twintally.sources.spec import FileSource, JdbcSource, Source, source_from_mapping

__all__ = ["FileSource", "JdbcSource", "Source", "conform", "malformed_rows", "read_count", "read_range", "read_source", "source_from_mapping"]
