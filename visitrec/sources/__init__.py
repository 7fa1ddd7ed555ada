"""Readers. Everything arrives as text and is cast by name later; nothing is inferred."""

from visitrec.sources.csv_files import read_csv, read_push_list, read_registry
from visitrec.sources.landing import freshness, landing_files, newest_file
from visitrec.sources.records import read_records, records_from_text, text_schema

__all__ = [
    "freshness",
    "landing_files",
    "newest_file",
    "read_csv",
    "read_push_list",
    "read_records",
    "read_registry",
    "records_from_text",
    "text_schema",
]
