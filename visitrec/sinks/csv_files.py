"""CSV output. Each output is a folder of part files, every one with the header."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from visitrec.functions import run_date_text

# Fixed values of the output format: header, null as nothing, quotes doubled, blanks kept.
CSV_OPTIONS = {
    "header": "true",
    "nullValue": "",
    "emptyValue": "",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "dateFormat": "yyyy-MM-dd",
}


def push_folder(root: str, run_date: dt.date | str) -> str:
    """Folder of one run; the writers create it."""
    return f"{root.rstrip('/')}/push_{run_date_text(run_date)}"


def write_csv(df: DataFrame, path: str) -> str:
    """Write, also when there are no rows: the header is then written alone."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    return path

