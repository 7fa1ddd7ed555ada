"""Benchmark decontamination by winnowing.

Every text is reduced to fingerprints: of each ``spread`` neighbouring hashes of ``gram`` words the least
is kept. A stretch of ``span = gram + spread - 1`` words that two texts share holds a full window, whose
least hash is kept on both sides, so no shared stretch of that length is missed. Where a fingerprint of
a document is one of a benchmark item, the windows of ``span`` words around it are compared word for
word, in a join.

The fingerprints of the benchmark meet those of the documents in a bitmap of fixed size; only windows
around its hits are shuffled, and the join with the benchmark's windows decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from visitrec.llm import arrays as A
from visitrec.llm.bitmap import bitmap_of, may_be_in, may_hold
from visitrec.storage import Scratch

SPAN, GRAM = 10, 5

_WINDOWS = "row long, at int, length int, words string, n_words long"
_ITEMS = "row long, length int, words string, marks array<long>"


def _kept(hashes: np.ndarray, spread: int) -> np.ndarray:
    """Which hashes are the least of any full window of ``spread`` neighbours; equal ones all are."""
    if len(hashes) < spread:
        return np.zeros(len(hashes), dtype=bool)
    least = A.sliding_min(hashes, spread)
    edge = np.zeros(spread - 1, dtype=np.uint64)
    return A.sliding_max(np.concatenate([edge, least, edge]), spread) == hashes


def _scan(block: A.Block) -> tuple[A.Words, np.ndarray]:
    words = A.words_of(block, A.ALNUM_BYTES)
    return words, A.Rolling(block.data, A.FOLDED_CODES).of(words.starts, words.ends)


def _text(block: A.Block, words: A.Words, at: int, length: int) -> str:
    cut = [
        block.data[s:e].tobytes()
        for s, e in zip(words.starts[at : at + length], words.ends[at : at + length])
    ]
    return b" ".join(cut).lower().decode()


def _item_windows(span: int, gram: int):
    spread = span - gram + 1

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in A.blocks(batch.column("text")):
                words, hashes = _scan(block)
                row = batch.column("row").to_pylist()[block.first : block.last]
                out = []
                for k, (a, b) in enumerate(zip(words.first, words.first[1:])):
                    if b - a >= span:
                        marks = A.run_hashes(hashes[a:b], gram)
                        marks = marks[_kept(marks, spread)]
                        for i in range(a, b - span + 1):
                            own = marks if i == a else marks[:0]
                            out.append((row[k], span, _text(block, words, i, span), own))
                    elif b > a:  # a short item is one window, and its own fingerprint
                        mark = A.run_hashes(hashes[a:b], int(b - a))
                        out.append((row[k], int(b - a), _text(block, words, a, int(b - a)), mark))
                columns = list(zip(*out)) or [(), (), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(columns[0], pa.int64()),
                        pa.array(columns[1], pa.int32()),
                        pa.array(columns[2], pa.string()),
                        pa.array([m.view(np.int64) for m in columns[3]], pa.list_(pa.int64())),
                    ],
                    names=["row", "length", "words", "marks"],
                )

    return scan


def _document_windows(span: int, gram: int, short: list[int], marks):
    """One row for each document (``at`` is -1), and one for each window around a fingerprint met."""
    spread = span - gram + 1

    def starts_of(words: A.Words, hashes: np.ndarray, table: np.ndarray) -> list:
        found = []
        runs = A.run_hashes(hashes, gram)
        hit = np.flatnonzero(_kept(runs, spread))
        hit = hit[may_hold(table, runs[hit])]
        if len(hit):
            near = (hit[:, None] - np.arange(spread)[None, :]).ravel()
            found.append((span, near))
        for length in short:
            runs = A.run_hashes(hashes, length)
            found.append((length, np.flatnonzero(may_hold(table, runs))))
        out = []
        for length, at in found:
            at = np.unique(at[at >= 0])
            owner = np.searchsorted(words.first, at, side="right") - 1
            fits = at + length <= words.first[np.minimum(owner + 1, len(words.first) - 1)]
            out += [(length, int(i), int(k)) for i, k in zip(at[fits], owner[fits])]
        return out

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = marks.value
        for batch in batches:
            rows = batch.column("row").to_numpy()
            for block in A.blocks(batch.column("text")):
                words, hashes = _scan(block)
                row, counts = rows[block.first : block.last], words.counts
                hits = starts_of(words, hashes, table)
                n, m = len(block), len(hits)
                owner = np.array([k for _, _, k in hits], dtype=np.int64)
                at = np.array([i for _, i, _ in hits], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([row, row[owner]])),
                        pa.array(
                            np.concatenate([np.full(n, -1), at - words.first[owner]]).astype(np.int32)
                        ),
                        pa.array(
                            np.concatenate([np.zeros(n), [h[0] for h in hits]]).astype(np.int32)
                        ),
                        pa.array([None] * n + [_text(block, words, i, k) for k, i, _ in hits], pa.string()),
                        pa.array(np.concatenate([counts, np.zeros(m)]).astype(np.int64)),
                    ],
                    names=["row", "at", "length", "words", "n_words"],
                )
            A.give_back()

    return scan


def benchmark_hits(
    documents: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM
) -> DataFrame:
    """Which words of ``documents`` (doc_id, text) lie in a stretch that ``benchmark`` (item_id, text) has.

    A window is ``span`` words of an item, or the whole item if it has fewer words but not none. Words
    are lower-cased runs of ASCII digits, ASCII letters and characters beyond ASCII.

    Returns for each row of ``documents``: doc_id, n_words, n_hit (words inside any occurrence of a
    window), items (sorted ids, as text, of the items with occurring windows), n_items, contaminated.
    A null or empty text has no words and no hits; a null or empty item has no windows. Rows that repeat
    a doc_id, and rows without one, are judged one by one; items that repeat an id count once, and an
    item without an id marks words but is not listed. Other columns are ignored.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "winnow")
    items = scratch.keep(
        benchmark.select(F.monotonically_increasing_id().alias("row"), "item_id", "text"), "items"
    )
    windows = scratch.keep(
        items.select("row", "text")
        .mapInArrow(_item_windows(span, gram), _ITEMS)
        .join(items.select("row", F.col("item_id").cast("string").alias("item")), "row"),
        "windows",
    )
    marks = bitmap_of(windows.select(F.explode("marks").alias("mark")), F.col("mark"))
    short = [r.length for r in windows.filter(F.col("length") < span).select("length").distinct().collect()]

    rows = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    scanned = scratch.keep(
        rows.select("row", "text", "doc_id").mapInArrow(
            _with_ids(_document_windows(span, gram, sorted(short), marks)),
            T.StructType([documents.schema["doc_id"], *T.StructType.fromDDL(_WINDOWS).fields]),
        ),
        "scanned",
    )
    owners = windows.groupBy("words").agg(F.collect_set("item").alias("items"))
    met = (
        scanned.filter("at >= 0")
        .select("row", "at", "length", "words")
        .join(owners, "words")
        .select("row", "at", (F.col("at") + F.col("length")).alias("until"), "items")
    )
    before = Window.partitionBy("row").orderBy("at", "until").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.greatest(F.col("until") - F.greatest("at", F.coalesce(F.max("until").over(before), F.lit(0))), F.lit(0))
    per_row = (
        met.withColumn("covered", covered)
        .groupBy("row")
        .agg(
            F.sum("covered").alias("n_hit"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
    )
    return (
        scanned.filter("at < 0")
        .select("row", "doc_id", "n_words")
        .join(per_row, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("contaminated", F.col("n_hit") > 0)
    )


def _with_ids(scan):
    """Carry doc_id along: the scan's output rows name their input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ids = batch.column("row").to_numpy(), batch.column("doc_id")
            for out in scan([batch]):
                at = np.searchsorted(rows, out.column("row").to_numpy())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(at)), *out.columns], names=["doc_id", *out.schema.names]
                )

    return run


def decontaminated(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``documents`` without any stretch of the benchmark, with all their columns.

    Rows are matched by doc_id: if one of several rows with an id is hit, all go. Rows without an id stay
    only if none of them is hit. A map of the ids that are hit, of fixed size, tells which rows the exact join needs;
    the others stay where they are.
    """
    hits = benchmark_hits(documents, benchmark, **options).filter("contaminated").select("doc_id").distinct()
    hits = Scratch(documents.sparkSession, "decontaminated").keep(hits, "hits")
    doubtful = may_be_in(bitmap_of(hits, F.xxhash64("doc_id")), F.xxhash64("doc_id"))
    few = documents.filter(doubtful)
    kept = few.join(hits, few["doc_id"].eqNullSafe(hits["doc_id"]), "left_anti")
    return documents.filter(~doubtful).union(kept)
