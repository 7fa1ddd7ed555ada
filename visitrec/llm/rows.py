"""Rows that pass through a look at their texts and keep their other columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from visitrec.llm import arrays as A


def through_texts(
    documents: DataFrame, change: Callable[[pa.RecordBatch, int], pa.RecordBatch]
) -> DataFrame:
    """What ``change`` makes of the rows, a block of texts at a time; it gets them and the place of the text column.

    A user function would hold the rows of a whole batch until all its results are there.
    """
    names = documents.columns
    place = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.parts(batch, place):
                yield pa.RecordBatch.from_arrays(change(part, place).columns, names=names)
            A.give_back()

    # by number, as a name may hold a dot
    return documents.toDF(*(f"column_{i}" for i in range(len(names)))).mapInArrow(run, documents.schema)
