"""Writers: CSV, conditional CSV and text records, published together in a dated folder."""

from visitrec.sinks.batch import Batch, read_manifest, write_csv_if_any
from visitrec.sinks.csv_files import CSV_OPTIONS, push_folder, write_csv
from visitrec.sinks.text_records import text_records, write_text_records

__all__ = [
    "Batch",
    "CSV_OPTIONS",
    "push_folder",
    "read_manifest",
    "text_records",
    "write_csv",
    "write_csv_if_any",
    "write_text_records",
]
