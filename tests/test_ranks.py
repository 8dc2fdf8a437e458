"""Exact percentiles on both paths, against numpy."""

import numpy as np
import pytest

from cellstride.plans import ranks
from cellstride.plans.ranks import percentiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


def sample(kind, n, rng):
    if kind == "smooth":
        return rng.normal(size=n)
    if kind == "ties":
        return np.where(rng.random(n) < 0.4, 3.0, rng.integers(0, 2000, n)).astype(float)
    return rng.pareto(0.5, n)


@pytest.mark.parametrize("kind", ["smooth", "ties", "heavy tail"])
@pytest.mark.parametrize("limit, margin", [(None, ranks.MARGIN), (1, ranks.MARGIN), (1, 0.3)])
def test_against_numpy(spark, kind, limit, margin, monkeypatch):
    monkeypatch.setattr(ranks, "MARGIN", margin)     # a wide margin leaves work for the narrowing
    rng = np.random.default_rng(3)
    groups = {"big": sample(kind, 60_000, rng), "small": sample(kind, 11, rng)}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("big", None)]
    df = spark.createDataFrame(rows, "District string, v double").repartition(7)
    got = {r["District"]: r for r in percentiles(df, ["v"], PROBS, "District", max_group=limit).collect()}
    for key, values in groups.items():
        assert got[key]["n"] == len(values)
        np.testing.assert_allclose(got[key]["q"], np.percentile(values, np.array(PROBS) * 100), rtol=1e-12)


def test_whole_frame_and_several_columns(spark):
    rng = np.random.default_rng(4)
    data = rng.normal(size=(6_000, 2))
    df = spark.createDataFrame(data.tolist(), "a double, b double")
    for limit in (None, 1):
        got = {r["feature"]: r["q"] for r in percentiles(df, ["a", "b"], [0.1, 0.9], max_group=limit).collect()}
        np.testing.assert_allclose(got["a"], np.percentile(data[:, 0], [10, 90]))
        np.testing.assert_allclose(got["b"], np.percentile(data[:, 1], [10, 90]))


def test_approximate_is_close(spark):
    df = spark.range(10_001).selectExpr("cast(id as double) v")
    low, high = percentiles(df, ["v"], [0.1, 0.9], approximate=True).first()["q"]
    assert abs(low - 1000) < 20 and abs(high - 9000) < 20
