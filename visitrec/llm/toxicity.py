"""Severity of toxic language by cumulative-link ordinal regression.

For grades 0 to K - 1, P(grade <= k) = sigmoid(threshold[k] - w . x): one weight vector serves all the ordered
thresholds. Features are sparse and binary: which words a text has, and which word beginnings, hashed. The
model is fitted on a bounded sample of labelled rows; every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitrec.llm import arrays as A
from visitrec.llm.rows import through_texts

FEATURE_BITS = 20
#: Bytes of a word's beginnings that are features of their own.
STEM_BYTES = 4, 5
#: Labelled rows of each class that a model is fitted on, at most.
SAMPLE = 2000
#: A sampled feature counts if so many texts have it.
LEAST_TEXTS = 5
GRADES = 4
#: Expected severity from which a text is toxic.
CUT = 0.5


@dataclass(frozen=True)
class OrdinalModel:
    """``features`` are sorted; feature i weighs ``weights[i]``. Thresholds rise."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def chances(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 to K - 1."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -50, 50)))


@dataclass(frozen=True)
class Sample:
    toxic: bool
    features: np.ndarray


def _features(block: A.Block) -> tuple[np.ndarray, np.ndarray]:
    """Text number and feature of every word and every word's beginning, with repeats."""
    words = A.words_of(block, A.ALNUM_BYTES)
    roll = A.Rolling(block.data, A.FOLDED_CODES)
    hashes = [roll.of(words.starts, words.ends)]
    for size in STEM_BYTES:
        stems = np.minimum(words.starts + size, words.ends)
        hashes.append(A.mix(roll.of(words.starts, stems) ^ np.uint64(size)))
    features = (np.concatenate(hashes) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)
    return np.tile(words.owner(), len(hashes)), features


def _distinct(owner: np.ndarray, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.unique((owner << FEATURE_BITS) | features)
    return keys >> FEATURE_BITS, keys & ((1 << FEATURE_BITS) - 1)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in A.blocks(batch.column("text")):
            owner, features = _distinct(*_features(block))
            bounds = np.searchsorted(owner, np.arange(len(block) + 1))
            lists = pa.ListArray.from_arrays(
                pa.array(bounds, pa.int32()), pa.array(features, pa.int32())
            )
            toxic = batch.column("toxic").slice(block.first, len(block))
            yield pa.RecordBatch.from_arrays([toxic, lists], names=["toxic", "features"])


def sample_features(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list:
    """The distinct features of ``sample`` labelled texts of each class at most, chosen by a hash of doc_id.

    Conflicting labels of one doc_id count as toxic; rows without a label or an id are not used.
    """
    known = (
        labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg((F.max(F.col("toxic").cast("int")) > 0).alias("toxic"))
    )
    rank = F.xxhash64("doc_id")
    chosen = known.filter("toxic").orderBy(rank, "doc_id").limit(sample)
    chosen = chosen.union(known.filter("NOT toxic").orderBy(rank, "doc_id").limit(sample))
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # 2 * sample ids
    rows = (
        texts.select("toxic", "text")
        .mapInArrow(_sampled, "toxic boolean, features array<int>")
        .limit(4 * sample)  # rows that repeat an id don't unbound the sample
        .toArrow()
    )
    out = []
    for batch in rows.to_batches():
        lists = batch.column("features")
        values, bounds = lists.values.to_numpy(), lists.offsets.to_numpy()
        for toxic, a, b in zip(batch.column("toxic").to_pylist(), bounds, bounds[1:]):
            out.append(Sample(toxic, values[a:b]))
    return out


def severity_grades(rows: list, grades: int = GRADES) -> np.ndarray:
    """Grades for rows labelled toxic or not: 0 for clean ones; the toxic ones in equal parts from 1 up.

    They are ranked by how many of their features set toxic texts apart: those that at least ``LEAST_TEXTS``
    toxic texts have and that are 20 times as frequent there as in clean ones.
    """
    toxic = np.array([r.toxic for r in rows], dtype=bool)
    counts = np.zeros((2, 1 << FEATURE_BITS))
    for r in rows:
        counts[int(r.toxic), r.features] += 1
    share = counts / np.maximum([[np.sum(~toxic)], [np.sum(toxic)]], 1)
    marks = (counts[1] >= LEAST_TEXTS) & (share[1] > 20 * share[0])
    found = np.array([marks[r.features].sum() for r in rows], dtype=float)
    out = np.zeros(len(rows), dtype=np.int64)
    if toxic.any():
        cuts = np.quantile(found[toxic], np.arange(1, grades - 1) / (grades - 1))
        out[toxic] = 1 + np.searchsorted(cuts, found[toxic], side="left")
    return out


def fit_ordinal(
    features: list,
    grades: np.ndarray,
    n_grades: int = GRADES,
    penalties: tuple[float, ...] = (8e-3, 1e-3),
    rounds: int = 200,
) -> OrdinalModel:
    """Fit by accelerated proximal gradient descent; an absolute penalty leaves most weights at zero.

    Each further penalty fits anew with the features that the one before left. Sizes of the grades are balanced between clean and other rows. Without rows of both kinds there is
    nothing to tell apart, and the model scores every text as clean.
    """
    sizes = np.array([len(f) for f in features], dtype=np.int64)
    if not len(grades) or grades.min() == grades.max():
        return OrdinalModel(np.zeros(0, np.int64), np.zeros(0), np.full(n_grades - 1, 30.0))
    flat = np.concatenate([np.asarray(f, dtype=np.int32) for f in features])
    seen = np.bincount(flat, minlength=1 << FEATURE_BITS)
    kept = np.flatnonzero(seen >= LEAST_TEXTS)
    use = seen[flat] >= LEAST_TEXTS
    col = np.searchsorted(kept, flat[use])
    row = np.repeat(np.arange(len(features), dtype=np.int32), sizes)[use]
    del flat, use
    n, m = len(features), len(kept)
    clean = grades == 0
    share = np.where(clean, 0.5 / clean.sum(), 0.5 / (~clean).sum())
    step = 4.0 / max(1.0, _largest(row, col, share, n, m))

    weights, momentum = np.zeros(m), np.zeros(m)
    thresholds = np.linspace(0.5, 2.5, n_grades - 1)
    moved, t = thresholds.copy(), 1.0
    level = np.arange(n_grades - 1)[None, :]
    left = np.ones(m, dtype=bool)
    for k in range(rounds * len(penalties)):
        if k % rounds == 0:
            left, penalty = left & ((weights != 0) | (k == 0)), penalties[k // rounds]
            momentum, moved, t = weights.copy(), thresholds.copy(), 1.0
        scores = np.bincount(row, momentum[col], n)
        below = 1 / (1 + np.exp(np.clip(scores[:, None] - moved[None, :], -50, 50)))  # P(grade <= k)
        wide = np.concatenate([np.zeros((n, 1)), below, np.ones((n, 1))], axis=1)
        chance = np.maximum(wide[np.arange(n), grades + 1] - wide[np.arange(n), grades], 1e-12)
        slope = below * (1 - below)
        upper = np.where(level == grades[:, None], slope, 0)
        lower = np.where(level == grades[:, None] - 1, slope, 0)
        pull = share[:, None] * (lower - upper) / chance[:, None]  # of the loss, along each threshold
        by_threshold, by_score = pull.sum(axis=0), -pull.sum(axis=1)
        stepped = momentum - step * np.bincount(col, by_score[row], m)
        new = left * np.sign(stepped) * np.maximum(np.abs(stepped) - step * penalty, 0)
        placed = np.maximum.accumulate(moved - by_threshold + 1e-3 * np.arange(n_grades - 1))
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        momentum = new + (t - 1) / t_next * (new - weights)
        moved = np.maximum.accumulate(placed + (t - 1) / t_next * (placed - thresholds))
        weights, thresholds, t = new, placed, t_next
    return OrdinalModel(kept[weights != 0], weights[weights != 0], thresholds)


def _largest(row: np.ndarray, col: np.ndarray, share: np.ndarray, n: int, m: int) -> float:
    """The largest eigenvalue of the weighted Gram matrix of the features, by power iteration."""
    v, value = np.ones(m) / max(1.0, np.sqrt(m)), 1.0
    for _ in range(20):
        u = np.bincount(col, (share * np.bincount(row, v[col], n))[row], m)
        value = float(np.linalg.norm(u)) or 1.0
        v = u / value
    return value


def fit_severity(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> OrdinalModel:
    rows = sample_features(documents, labels, sample)
    return fit_ordinal([r.features for r in rows], severity_grades(rows))


def _scores(block: A.Block, model: OrdinalModel) -> np.ndarray:
    table = np.zeros(1 << FEATURE_BITS, dtype=bool)
    table[model.features] = True
    owner, features = _features(block)
    used = table[features]
    owner, features = _distinct(owner[used], features[used])
    return np.bincount(owner, model.weights[np.searchsorted(model.features, features)], len(block))


def severity(documents: DataFrame, model: OrdinalModel, cut: float = CUT) -> DataFrame:
    """Grade every row of ``documents`` (doc_id, text).

    Returns doc_id, expected_severity (the mean grade), grade (the likeliest) and toxic (mean of at least
    ``cut``). A null or empty text scores as one without any known word. Rows that repeat a doc_id are graded
    one by one; other columns are ignored.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in A.blocks(batch.column("text")):
                above = shared.value.chances(_scores(block, shared.value))
                edge = np.ones((len(block), 1))
                each = np.concatenate([edge, above], axis=1) - np.concatenate([above, 0 * edge], axis=1)
                mean = above.sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(block.first, len(block)),
                        pa.array(mean),
                        pa.array(each.argmax(axis=1).astype(np.int32)),
                        pa.array(mean >= cut),
                    ],
                    names=["doc_id", "expected_severity", "grade", "toxic"],
                )

    fields = T.StructType.fromDDL("expected_severity double, grade int, toxic boolean").fields
    return documents.select("doc_id", "text").mapInArrow(
        score, T.StructType([documents.schema["doc_id"], *fields])
    )


def without_toxic(documents: DataFrame, model: OrdinalModel, cut: float = CUT) -> DataFrame:
    """The rows whose text is not toxic, with all their columns; no shuffle."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def clean(rows: pa.RecordBatch, place: int) -> pa.RecordBatch:
        means = [
            shared.value.chances(_scores(block, shared.value)).sum(axis=1) for block in A.blocks(rows.column(place))
        ]
        return rows.filter(pa.array(np.concatenate(means) < cut))

    return through_texts(documents, clean)
