"""Multivariate statistics against brute force."""

import os
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellstride.operators import dcor, multivar
from cellstride.plans import jobs
from cellstride.sources import staging
from helpers import series_table


def brute_dcor(x, y):
    a, b = (np.abs(v[:, None] - v[None, :]) for v in (x, y))
    a, b = (m - m.mean(0) - m.mean(1)[:, None] + m.mean() for m in (a, b))
    spread = np.sqrt((a * a).mean() * (b * b).mean())
    return np.sqrt((a * b).mean() / spread) if spread else 0.0


def table(n=700, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=n)
    data = {"x": x, "twice": 2 * x + 1, "square": x * x, "noise": rng.gamma(1, 3, n),
            "hot": np.where(rng.random(n) < 0.4, 5.0, np.round(rng.normal(size=n), 1)),
            "coin": rng.integers(0, 2, n).astype(float)}
    return data


@pytest.fixture(scope="module")
def wide(spark):
    data = table()
    return data, spark.createDataFrame([tuple(map(float, r)) for r in zip(*data.values())], list(data)).repartition(5)


@pytest.mark.parametrize("block_rows, own_block, cells", [(None, 4_096, 1 << 22), (60, 4_096, 1 << 22), (60, 5, 40), (7, 20, 300), (1, 700, 2)])
def test_distance_correlation_matches_brute_force(wide, block_rows, own_block, cells):
    """Few and many ranges, frequent values alone or not, grids in one task or strip by strip."""
    data, df = wide
    got = dcor.pair_distance_correlation(df, list(combinations(data, 2)), block_rows, own_block, cells).collect()
    assert len(got) == 15
    for r in got:
        expected = brute_dcor(data[r["feature_x"]], data[r["feature_y"]])
        assert r["dcor"] == pytest.approx(expected, abs=1e-7), (r["feature_x"], r["feature_y"])


def test_dominance_sums():
    rng = np.random.default_rng(4)
    for n in (1, 2, 9, 60):
        order, y = rng.integers(0, 9, n), rng.integers(0, 7, n) / 2
        w, x, z = rng.random((3, n))
        below = (order[:, None] < order) & (y[:, None] < y)
        expected = (below * w[:, None] * w * (x - x[:, None]) * (z - z[:, None])).sum()
        assert dcor.dominance(order, y, np.stack([w, w * x, w * z, w * x * z])) == pytest.approx(expected)


def test_rows_travel_once_per_column_of_many_values(wide, monkeypatch):
    data, df = wide
    moved, whole = [], dcor._moved
    monkeypatch.setattr(dcor, "_moved", lambda rows, c, *rest: moved.append(c) or whole(rows, c, *rest))
    multivar.distance_correlation(df, ["coin", "noise", "x"]).collect()
    assert moved == [1, 2]


def test_equal_rows_travel_as_one_point(wide, monkeypatch):
    data, df = wide
    copies = df.select("x", "noise", "square").withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("x") > 0, 9).otherwise(2))))
    told, whole = [], dcor._moved
    monkeypatch.setattr(dcor, "_moved", lambda rows, c, *rest: told.append(rows.count()) or whole(rows, c, *rest))
    got = dcor.pair_distance_correlation(copies, [("x", "noise"), ("noise", "square")], 60).collect()
    assert told == [df.select("x", "noise", "square").distinct().count()] * 3
    often = np.where(data["x"] > 0, 9, 2)
    for r in got:
        expected = brute_dcor(*[np.repeat(data[r[c]], often) for c in ("feature_x", "feature_y")])
        assert r["dcor"] == pytest.approx(expected, abs=1e-7)


def test_distance_correlation_of_constants_and_order(wide):
    _, df = wide
    flat = df.withColumn("flat", F.lit(3.0))
    pairs = [("x", "flat"), ("x", "square"), ("square", "x"), ("x", "twice")]
    got = {(r[0], r[1]): r[2] for r in multivar.pair_distance_correlation(flat, pairs).collect()}
    assert got["x", "flat"] == 0 and got["x", "twice"] == pytest.approx(1.0)
    assert got["x", "square"] == pytest.approx(got["square", "x"])


def test_density(wide):
    data, df = wide
    got = multivar.density(df, ["noise"]).orderBy("point").collect()
    x = data["noise"]
    h = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min() - 3 * h, x.max() + 3 * h, 200)
    expected = np.exp(-0.5 * ((grid[:, None] - x) / h) ** 2).sum(1) / (len(x) * h * np.sqrt(2 * np.pi))
    np.testing.assert_allclose([r["x"] for r in got], grid)
    np.testing.assert_allclose([r["density"] for r in got], expected, atol=1e-14)
    assert sum(r["density"] for r in got) * (grid[1] - grid[0]) == pytest.approx(1, abs=0.01)


def test_density_with_unreached_grid_points(spark):
    values = [0.0] * 2000 + [1000.0] * 2000 + [1e6]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = multivar.density(df).orderBy("point").collect()
    assert len(got) == 200
    x, v = np.array([r["x"] for r in got]), np.array(values)
    h = v.std(ddof=1) * len(v) ** -0.2
    whole = np.exp(-0.5 * ((x[:, None] - v) / h) ** 2).sum(1) / (len(v) * h * np.sqrt(2 * np.pi))
    np.testing.assert_allclose([r["density"] for r in got], whole, rtol=1e-9, atol=1e-300)
    assert np.count_nonzero(whole) == np.count_nonzero([r["density"] for r in got]) > 40


def test_components(wide):
    data, df = wide
    columns = ["x", "square", "noise", "coin"]
    m = np.stack([data[c] for c in columns], 1)
    z = (m - m.mean(0)) / m.std(0)
    values, vectors = np.linalg.eigh(np.cov(z.T))
    order = np.argsort(values)[::-1]
    fitted = multivar.Components(df, columns)
    np.testing.assert_allclose(fitted.ratios, values[order] / values.sum(), atol=1e-9)
    ratios = np.cumsum(values[order] / values.sum())
    assert fitted.count_for(0.7) == int(np.argmax(ratios >= 0.7)) + 1
    got = fitted.project(df, 4).collect()
    raw = np.array([[r[c] for c in columns] for r in got])
    scores = (raw - m.mean(0)) / m.std(0) @ vectors[:, order]
    np.testing.assert_allclose(np.abs([[r[f"PC_{i}"] for i in range(1, 5)] for r in got]), np.abs(scores), atol=1e-8)
    together = multivar.component_correlation(df, columns, 0.7).collect()
    assert len(together) == 4 * fitted.count_for(0.7)
    pc = {f"PC_{i + 1}": np.array([r[f"PC_{i + 1}"] for r in got]) for i in range(4)}
    for r in together:
        x = raw[:, columns.index(r["feature_x"])]
        assert r["dcor"] == pytest.approx(brute_dcor(x, pc[r["feature_y"]]), abs=1e-7)


def test_scatter_bins_count_every_row(wide):
    data, df = wide
    got = multivar.scatter_bins(df, ["x", "hot"], bins=10)
    assert got.agg(F.sum("n")).first()[0] == 700
    assert got.agg(F.max("bin_x"), F.min("bin_x")).first()[:] == (9, 0)


def test_scatter_bins_of_a_missing_column(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    assert multivar.scatter_bins(df).collect() == []
    partly = spark.createDataFrame([(0.0, 1.0), (10.0, 2.0), (1e6, None)], "a double, b double")
    assert sorted(r["bin_x"] for r in multivar.scatter_bins(partly, bins=10).collect()) == [0, 9]


def test_profile_has_every_table(spark):
    df = series_table(spark, {"a": 80, "b": 30})
    tables = jobs.profile_tables(df, max_lag=3)
    assert all(t.count() > 0 for t in tables.values())
    assert set(tables) >= {"quality", "statistics", "pacf", "distance_correlation", "density", "components"}


def test_correlation_with_components_stores_rows_once(wide, monkeypatch):
    """Components are neither stored nor moved, one column's mean distances are kept, and nothing is left behind."""
    _, df = wide
    columns = ["x", "square", "noise", "coin"]
    told, paths, whole = [], set(), staging.Scratch.stage

    def stage(self, rows, name):
        told.append((name, rows.columns))
        out = whole(self, rows, name)
        paths.add(self.paths[id(out)][1])
        assert os.path.exists(self.paths[id(out)][1])
        return out
    monkeypatch.setattr(staging.Scratch, "stage", stage)
    assert len(multivar.component_correlation(df, columns, 0.95).collect()) == 16
    stored = {name: [c for c in names if c not in dcor.SUMS] for name, names in told}
    assert stored["points"] == [*columns, "__w"]
    assert all(not c.startswith(("PC_", "__v")) for _, names in told for c in names)
    assert sum(c.startswith("__m") for c in max((names for _, names in told), key=len)) <= 3
    assert len(paths) == len(told) and not any(os.path.exists(p) for p in paths)


def test_shuffles_of_a_scratch_table_go_with_its_write(spark, tmp_path):
    name = staging.Scratch.CLEANUP
    was = spark.conf.get(name)
    with staging.Scratch(spark) as scratch:
        kept = scratch.stage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
        assert kept.count() == 7 and os.listdir(scratch.paths[id(kept)][1])
        path = scratch.paths[id(kept)][1]
    assert not os.path.exists(path) and spark.conf.get(name) == was
