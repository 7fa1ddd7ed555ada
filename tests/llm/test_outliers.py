"""The minimum-determinant estimate against a plain search over all subsets and over many starts."""

import itertools

import numpy as np
import pytest

from visitrec.llm import outliers
from visitrec.llm.outliers import FLOORS, STATISTICS, minimum_determinant
from visitrec.storage import Scratch

FLOOR = np.array([FLOORS[a] ** 2 for a in STATISTICS])


def floored(values):
    cov = np.cov(values, rowvar=False, bias=True)
    return cov + np.diag(np.maximum(FLOOR - np.diag(cov), 0)) + 1e-9 * np.eye(len(FLOOR))


def spread(values):
    return np.linalg.slogdet(floored(values))[1]


def vectors(rows, outliers, seed):
    rng = np.random.default_rng(seed)
    good = rng.normal(size=(rows - outliers, len(STATISTICS))) * 3
    return np.vstack([good, rng.normal(size=(outliers, len(STATISTICS))) * 0.5 + 25])


def estimates(spark, groups):
    rows = [(str(g), "s", *map(float, v)) for g, values in enumerate(groups) for v in values]
    passed = spark.createDataFrame(rows, ["lang_key", "source_key", *STATISTICS])
    scratch = Scratch(spark, "mcd")
    found = minimum_determinant(scratch, passed, ["lang_key", "source_key"]).collect()
    assert len(found) == len(groups)
    return {int(r.lang_key): r for r in found}


def test_least_determinant(spark):
    small = [vectors(12, 2, seed) for seed in range(3)]
    large = [vectors(400, 80, seed) for seed in range(3)]
    found = estimates(spark, small + large)
    for g, values in enumerate(small):
        # steps rest at the estimate of a subset, which needn't be the least of all in so small a group
        subsets = [spread(values[list(chosen)]) for chosen in itertools.combinations(range(12), 9)]
        assert np.abs(np.array(subsets) - found[g].spread).min() < 1e-6
        assert found[g].spread < np.quantile(subsets, 0.1)
    rng = np.random.default_rng(7)
    for g, values in enumerate(large, start=len(small)):
        least = np.inf
        for _ in range(60):
            chosen = rng.choice(len(values), 12, replace=False)
            for _ in range(20):
                gap = values - values[chosen].mean(axis=0)
                far = np.einsum("ij,jk,ik->i", gap, np.linalg.inv(floored(values[chosen])), gap)
                chosen = np.argsort(far, kind="stable")[:300]
            least = min(least, spread(values[chosen]))
        assert found[g].spread == pytest.approx(least, abs=0.05)
        # the crowd of outliers is outside
        centre = np.array([found[g][f"m_{a}"] for a in STATISTICS])
        assert np.abs(centre).max() < 1.5


def test_one_vector_and_equal_ones(spark):
    one = np.ones((1, len(STATISTICS)))
    found = estimates(spark, [one, np.repeat(one, 50, axis=0)])
    for r in found.values():
        assert [r[f"m_{a}"] for a in STATISTICS] == [1.0] * len(STATISTICS)
        assert r.spread == pytest.approx(np.log(FLOOR + 1e-9).sum())


def test_steps_end(spark, monkeypatch):
    values = vectors(300, 60, 1)
    rested = estimates(spark, [values])[0].spread
    monkeypatch.setattr(outliers, "REST", -1e9)  # never at rest
    rows = [("0", "s", *map(float, v)) for v in values]
    passed = spark.createDataFrame(rows, ["lang_key", "source_key", *STATISTICS])
    stopped = minimum_determinant(Scratch(spark, "mcd"), passed, ["lang_key", "source_key"], steps=3).collect()
    assert len(stopped) == 1 and stopped[0].spread <= rested + 0.05
