"""Column expressions: cleaning, dates, codes. Built-in functions only."""

from visitrec.functions.codes import first_ticked, is_code, is_not_code, matches
from visitrec.functions.dates import (
    date_from_parts,
    date_in_zone,
    default_run_date,
    iso_date,
    run_date_text,
)
from visitrec.functions.names import column
from visitrec.functions.text import blank_to_null, clean_cell, to_integer, whole_number

__all__ = [
    "blank_to_null",
    "clean_cell",
    "column",
    "date_from_parts",
    "date_in_zone",
    "default_run_date",
    "first_ticked",
    "is_code",
    "is_not_code",
    "iso_date",
    "matches",
    "run_date_text",
    "to_integer",
    "whole_number",
]
