"""Quality rules: plain limits on each text, then robust multivariate outliers.

Every text becomes a vector of transformed statistics. For each language and source the minimum-covariance-
determinant estimate is sought over all its texts: centre and covariance of those ``core`` of the vectors
that lie closest. Concentration steps go from three starts: medians with quartile ranges, medians with the
floors, and plain moments. After two steps the start with the least determinant goes on alone, until its
determinant falls no more. A text farther from its group's centre than the cutoff, by Mahalanobis distance,
is rejected.

A concentration step is two aggregations by group with partial sums, so a group's rows never meet in one
task. The table of estimates has one row for each group and start and is joined by Spark's own choice.
Quantiles are off by at most one rank in ``ACCURACY`` of a group's rows, so they are exact up to that many.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitrec.llm import arrays as A
from visitrec.storage import Scratch

REPEAT = 8
#: Least standard deviation that a statistic counts with, so that one which hardly varies rejects nothing.
FLOORS = {
    "word_length": 0.08,
    "line_words": 0.35,
    "symbols": 0.08,
    "dup_lines": 0.15,
    "repeats": 0.10,
    "upper": 0.08,
}
STATISTICS = tuple(FLOORS)
CORE = 0.75
#: Concentration steps of every start; of the best one, at most; a logarithm of a determinant that falls by less is at rest.
FIRST_STEPS, STEPS, REST = 2, 30, 1e-3
ACCURACY = 10_000
#: With 6 statistics, the chance of a normal vector beyond it is 5e-8; texts are not quite normal.
CUTOFF = 45.0

_SYMBOLS = A.byte_table(b"#*$%&|<>")
_CHARS = A.WORD_BYTES & ~A.byte_table(bytes(range(0x80, 0xC0)))
_UPPER = A.byte_table(bytes(range(ord("A"), ord("Z") + 1)))
_COUNTS = "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper"


def _sum_by_text(block: A.Block, table: np.ndarray) -> np.ndarray:
    return np.add.reduceat(table[block.data], block.starts, dtype=np.int64)


def _repeated(owner: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which (owner, hash) pairs occur twice or more."""
    keys = A.mix(hashes + owner.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    out = np.zeros(len(keys), dtype=bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _lines(block: A.Block, words: A.Words) -> tuple[np.ndarray, np.ndarray]:
    """For each text: lines with a word that equal an earlier line, and lines with a word."""
    breaks = np.flatnonzero(block.data == 10)
    starts = np.union1d(block.starts, breaks + 1)
    owner = np.searchsorted(block.starts, starts, side="right") - 1
    ends = np.minimum(np.append(starts[1:], len(block.data)) - 1, block.ends[owner])
    full = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends, owner = starts[full], ends[full], owner[full]
    keys = A.mix(A.span_hashes(block.data, starts, ends) + owner.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    order = np.argsort(keys, kind="stable")
    later = order[1:][keys[order][1:] == keys[order][:-1]]
    return np.bincount(owner[later], minlength=len(block)), np.bincount(owner, minlength=len(block))


def _repeat_words(words: A.Words, hashes: np.ndarray, n: int) -> np.ndarray:
    """For each text: words inside an n-word run that the text has twice or more."""
    runs = A.run_hashes(hashes, n)
    at = np.flatnonzero(A.runs_inside(words, n))
    owner = words.owner()
    twice = at[_repeated(owner[at], runs[at])]
    edges = np.zeros(len(hashes) + 1, dtype=np.int64)
    np.add.at(edges, twice, 1)
    np.add.at(edges, twice + n, -1)
    covered = np.cumsum(edges[:-1]) > 0
    return np.bincount(owner[covered], minlength=len(words.first) - 1)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = batch.drop_columns(["text"])
        for block in A.blocks(batch.column("text")):
            words = A.words_of(block)
            hashes = A.span_hashes(block.data, words.starts, words.ends)
            dup_lines, lines = _lines(block, words)
            counts = (
                words.counts,
                _sum_by_text(block, _CHARS),
                _sum_by_text(block, _SYMBOLS),
                dup_lines,
                _repeat_words(words, hashes, REPEAT),
                lines,
                _sum_by_text(block, _UPPER),
            )
            kept = keys.slice(block.first, len(block))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, *(pa.array(c.astype(np.int64)) for c in counts)],
                names=[*kept.schema.names, *_COUNTS],
            )


def _statistics() -> dict[str, Column]:
    """Ratios on scales on which ordinary texts are spread evenly about the middle."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    lines = F.greatest(F.col("n_lines"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    return {
        "word_length": F.log(chars / words),
        "line_words": F.log(words / lines),
        "symbols": F.sqrt(F.col("n_symbols") / chars),
        "dup_lines": F.sqrt(F.col("n_dup_lines") / lines),
        "repeats": F.sqrt(F.col("n_repeat_words") / words),
        "upper": F.sqrt(F.col("n_upper") / chars),
    }


def _moments() -> list[Column]:
    pairs = [(a, b) for i, a in enumerate(STATISTICS) for b in STATISTICS[i:]]
    return [
        F.count(F.lit(1)).alias("n"),
        *(F.avg(a).alias(f"m_{a}") for a in STATISTICS),
        *(F.covar_pop(a, b).alias(f"c_{a}_{b}") for a, b in pairs),
    ]


def _estimates(groups: DataFrame, keys: list[str]) -> DataFrame:
    """Centre, inverse covariance and logarithm of its determinant for each group, from its moments."""

    def invert(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = len(STATISTICS)
        for frame in frames:
            cov = np.zeros((len(frame), p, p))
            for i, a in enumerate(STATISTICS):
                for j, b in enumerate(STATISTICS[i:], start=i):
                    cov[:, i, j] = cov[:, j, i] = frame[f"c_{a}_{b}"].fillna(0)
            floor = np.array([FLOORS[a] ** 2 for a in STATISTICS])
            lack = np.maximum(floor - np.diagonal(cov, axis1=1, axis2=2), 0)
            cov += lack[:, :, None] * np.eye(p) + 1e-9 * np.eye(p)
            out = frame[[*keys, *(f"m_{a}" for a in STATISTICS)]].copy()
            out["precision"] = list(np.linalg.inv(cov).reshape(len(frame), p * p)) if len(frame) else []
            out["spread"] = np.linalg.slogdet(cov)[1]
            yield out

    fields = [groups.schema[k] for k in [*keys, *(f"m_{a}" for a in STATISTICS)]]
    added = T.StructType.fromDDL("precision array<double>, spread double").fields
    return groups.mapInPandas(invert, T.StructType([*fields, *added]))


def _starts(passed: DataFrame, keys: list[str]) -> DataFrame:
    """First centres and covariances of each group, one row for each start."""
    pairs = [(a, b) for i, a in enumerate(STATISTICS) for b in STATISTICS[i:]]
    whole = passed.groupBy(*keys).agg(
        *(F.percentile_approx(a, [0.25, 0.5, 0.75], ACCURACY).alias(f"q_{a}") for a in STATISTICS),
        *_moments(),
    )

    def start(name: str, centre: Callable[[str], Column], covariance: Callable[[str, str], Column]) -> Column:
        return F.struct(
            F.lit(name).alias("start"),
            *(centre(a).alias(f"m_{a}") for a in STATISTICS),
            *(covariance(a, b).cast("double").alias(f"c_{a}_{b}") for a, b in pairs),
        )

    def middle(a: str) -> Column:
        return F.col(f"q_{a}")[1]

    def quartiles(a: str, b: str) -> Column:
        reach = F.col(f"q_{a}")[2] - F.col(f"q_{a}")[0]
        return F.pow(reach / 1.349, 2) if a == b else F.lit(0.0)

    starts = F.array(
        start("quartiles", middle, quartiles),
        start("floors", middle, lambda a, b: F.lit(FLOORS[a] ** 2 if a == b else 0.0)),
        start("moments", lambda a: F.col(f"m_{a}"), lambda a, b: F.col(f"c_{a}_{b}")),
    )
    return whole.select(*keys, F.explode(starts).alias("one")).select(*keys, "one.*")


def _step(scratch: Scratch, passed: DataFrame, estimates: DataFrame, keys: list[str], core: float, name: str) -> DataFrame:
    """A concentration step: the estimates of the nearest ``core`` of each group's vectors."""
    group = [*keys, "start"]
    reach = (
        _measured(passed, estimates, keys, "inner")
        .groupBy(*group)
        .agg(F.percentile_approx("distance", core, ACCURACY).alias("reach"))
    )
    reach = scratch.keep(estimates.join(reach, group), f"reach-{name}")
    near = _measured(passed, reach, keys, "inner").filter(F.col("distance") <= F.col("reach"))
    return scratch.keep(_estimates(near.groupBy(*group).agg(*_moments()), group), f"estimates-{name}")


def minimum_determinant(
    scratch: Scratch, passed: DataFrame, keys: list[str], core: float = CORE, steps: int = STEPS
) -> DataFrame:
    """For each group of ``passed`` (keys and statistics): centre, precision and spread of least determinant found.

    The first steps take all starts, the later ones each group's best start, as long as its determinant falls.
    """
    estimates = _estimates(_starts(passed, keys), [*keys, "start"])
    estimates = scratch.keep(estimates, "estimates-start")
    for step in range(FIRST_STEPS):
        estimates = _step(scratch, passed, estimates, keys, core, f"first{step}")
    columns = [c for c in estimates.columns if c not in keys]
    best = F.min_by(F.struct(*columns), F.struct("spread", "start")).alias("one")
    estimates = scratch.keep(estimates.groupBy(*keys).agg(best).select(*keys, "one.*"), "best")
    done, live = [], estimates
    for step in range(steps):
        after = _step(scratch, passed, live, keys, core, f"step{step}")
        before = live.select(*keys, F.col("spread").alias("_before"))
        judged = scratch.keep(
            after.join(before, keys).withColumn("_falls", F.col("spread") < F.col("_before") - REST), f"judged{step}"
        )
        live = judged.filter("_falls").drop("_before", "_falls")
        # where it fell no more, what it rested at
        done.append(estimates.join(judged.filter("NOT _falls"), keys, "left_semi"))
        estimates = live
        if live.isEmpty():
            return reduce(DataFrame.union, done).drop("start")
    return reduce(DataFrame.union, [*done, live]).drop("start")


def _distance() -> Column:
    """Squared Mahalanobis distance to the group's estimate on the same row."""
    gap = [F.col(a) - F.col(f"m_{a}") for a in STATISTICS]
    p = len(gap)
    return reduce(
        add, (gap[i] * gap[j] * F.col("precision")[i * p + j] for i in range(p) for j in range(p))
    )


def _measured(rows: DataFrame, estimates: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    return rows.join(estimates, keys, how).withColumn("distance", _distance())


def quality_rules(
    documents: DataFrame,
    core: float = CORE,
    steps: int = STEPS,
    cutoff: float = CUTOFF,
) -> DataFrame:
    """Judge every row of ``documents`` (doc_id, text, lang, source).

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, distance
    (squared, null where base_failed) and kept. The estimates use the texts that pass the plain limits.
    A null or empty text has no words and fails. A null language or source is a group like any other. A
    group with few texts, or texts all alike, has a covariance of at least the floors. Rows that repeat a
    doc_id are judged one by one; other columns are ignored.
    """
    scratch = Scratch(documents.sparkSession, "quality")
    keys = ["lang_key", "source_key"]
    rows = documents.select(
        "doc_id",
        *(F.to_json(F.array(F.col(c).cast("string"))).alias(f"{c}_key") for c in ("lang", "source")),
        "text",
    )
    fields = [f for f in rows.schema.fields if f.name != "text"]
    counted = rows.mapInArrow(
        _counts, T.StructType([*fields, *(T.StructField(c, T.LongType()) for c in _COUNTS)])
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    counted = scratch.keep(
        counted.withColumn("base_failed", failed).withColumns(_statistics()), "counts"
    )
    passed = counted.filter(~F.col("base_failed")).select(*keys, *STATISTICS)

    estimates = scratch.keep(minimum_determinant(scratch, passed, keys, core, steps), "estimates")
    distance = F.when(~F.col("base_failed"), F.col("distance") / _widening(core, len(STATISTICS)))
    return (
        _measured(counted, estimates, keys)
        .withColumn("distance", distance)
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(False)))
        .select("doc_id", *_COUNTS[:5], "base_failed", "distance", "kept")
    )


def _widening(core: float, p: int) -> float:
    """How much the covariance of the nearest ``core`` of normal vectors falls short of that of all."""

    def chance(x: float, k: int) -> float:  # of a chi-squared variable with k (even or odd) degrees
        term = total = 1.0 / math.gamma(k / 2 + 1)
        half, i = x / 2, 1
        while term > 1e-12 * total:
            term *= half / (k / 2 + i)
            total += term
            i += 1
        return min(1.0, total * half ** (k / 2) * math.exp(-half))

    low, high = 0.0, 1000.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if chance(middle, p) < core else (low, middle)
    return core / chance(high, p + 2)
