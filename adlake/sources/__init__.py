"""Readers and table storage."""

from adlake.sources.records import coerce, explode_records, landed_files, parse_records, select_or_null, typed_catalog
from adlake.sources.scan import literal_rows, scan
from adlake.sources.tables import (
    TableStore,
    align_to_schema,
    batch_stamp,
    ensure_schemas,
    missing_tables,
    retire_tables,
)

__all__ = [
    "TableStore",
    "align_to_schema",
    "batch_stamp",
    "coerce",
    "ensure_schemas",
    "explode_records",
    "landed_files",
    "literal_rows",
    "missing_tables",
    "parse_records",
    "retire_tables",
    "scan",
    "select_or_null",
    "typed_catalog",
]
