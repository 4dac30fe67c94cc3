"""Scans: JSON landing, Parquet, union-by-name, catalog, plus the fixtures."""

from cairn.sources.files import (
    read_json_records,
    read_or_empty,
    scan_union_by_name,
    union_by_name,
)

__all__ = [
    "read_json_records",
    "read_or_empty",
    "scan_union_by_name",
    "union_by_name",
]
