"""All outputs of one run date, published together.

Files are written to a draft folder beside the dated one, and rows are counted while they are written. At the end a
manifest names the files and their rows, and one rename puts the folder in its place. A run that dies leaves what stood
there before; a rerun replaces the whole date. Between moving the older folder aside and the rename nothing stands
there; if the rename fails, the older folder goes back.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from visitrec.functions import run_date_text
from visitrec.sinks.csv_files import CSV_OPTIONS, push_folder
from visitrec.sinks.text_records import text_records
from visitrec.storage import file_system, read_text, write_text

MANIFEST = "_manifest.json"


class Batch:
    """Use it in a ``with`` block: it publishes at the end, and discards the draft on an error."""

    def __init__(self, spark: SparkSession, root: str, run_date: dt.date | str) -> None:
        self.spark = spark
        self.day = run_date_text(run_date)
        self.folder = push_folder(root, self.day)
        self.draft = f"{root.rstrip('/')}/_draft-{self.day}-{uuid.uuid4().hex}"
        #: Rows of each file written so far, by its name.
        self.rows: dict[str, int] = {}

    def __enter__(self) -> Batch:
        return self

    def __exit__(self, kind: type | None, *_: object) -> None:
        if kind is None:
            self.publish()
        else:
            self.discard()

    def csv(self, df: DataFrame, name: str) -> str:
        """Write a CSV folder; the path it has once the batch is published."""
        self.rows[name] = _counted_write(df, f"{self.draft}/{name}", "csv")
        return f"{self.folder}/{name}"

    def csv_if_any(self, df: DataFrame, name: str) -> str | None:
        """Write a CSV folder if there are rows, in one pass over them."""
        path = self.csv(df, name)
        if self.rows[name]:
            return path
        del self.rows[name]
        _delete(self.spark, f"{self.draft}/{name}")
        return None

    def text(self, df: DataFrame, layout: Sequence[tuple[str, int, str]], name: str) -> str:
        """Write fixed-width text records."""
        self.rows[name] = _counted_write(text_records(df, layout), f"{self.draft}/{name}", "text")
        return f"{self.folder}/{name}"

    def publish(self) -> str:
        """Put the draft in the place of the dated folder."""
        files = [{"name": name, "rows": rows} for name, rows in sorted(self.rows.items())]
        manifest = {"run_date": self.day, "files": files}
        write_text(self.spark, f"{self.draft}/{MANIFEST}", json.dumps(manifest, indent=1) + "\n")
        older = f"{self.draft}-replaced"
        system, path = file_system(self.spark, self.folder)
        replaces = system.exists(path(self.folder))
        if replaces and not system.rename(path(self.folder), path(older)):
            raise OSError(f"cannot replace {self.folder}")
        if not system.rename(path(self.draft), path(self.folder)):
            if replaces:
                system.rename(path(older), path(self.folder))
            raise OSError(f"cannot publish {self.folder}")
        if replaces:
            system.delete(path(older), True)
        return self.folder

    def discard(self) -> None:
        _delete(self.spark, self.draft)


def write_csv_if_any(df: DataFrame, path: str) -> str | None:
    """Write only if there are rows, in one pass: into a draft beside the path, which then takes its place."""
    spark = df.sparkSession
    parent, _, name = path.rstrip("/").rpartition("/")
    draft = f"{parent}/_draft-{uuid.uuid4().hex}-{name}"
    try:
        if not _counted_write(df, draft, "csv"):
            return None
        system, at = file_system(spark, path)
        system.delete(at(path), True)
        if not system.rename(at(draft), at(path)):
            raise OSError(f"cannot write {path}")
        return path
    finally:
        _delete(spark, draft)


def _counted_write(df: DataFrame, path: str, kind: str) -> int:
    seen = Observation(f"rows-{uuid.uuid4().hex}")
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write
    if kind == "csv":
        writer.options(**CSV_OPTIONS).csv(path)
    else:
        writer.text(path)
    return seen.get.get("rows", 0)


def read_manifest(spark: SparkSession, folder: str) -> dict:
    """What a published folder holds; a folder without a manifest was not published."""
    return json.loads(read_text(spark, f"{folder}/{MANIFEST}"))


def _delete(spark: SparkSession, path: str) -> None:
    system, at = file_system(spark, path)
    system.delete(at(path), True)
