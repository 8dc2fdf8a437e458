"""Losses, penalties and patience of the forecasters against numpy."""

import uuid

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler

from cellstride.operators.forecast import ForecastConfig, fit_forecaster, load_forecaster, stopping_round
from cellstride.operators.linear import fit_linear, fit_linear_each
from helpers import series_table

RNG = np.random.default_rng(8)


@pytest.fixture(scope="module")
def points(spark):
    x = RNG.normal(size=(400, 3)) * [1, 10, 0.1] + [5, 100, 0]
    y = x @ [2.0, -0.3, 4.0] + 7 + RNG.standard_t(2, 400)
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, y double")
    return x, y, VectorAssembler(inputCols=["a", "b", "c"], outputCol="__x").transform(df).repartition(3)


def slow(x, y, loss, norm1, norm2, e, rounds=400_000):
    """Proximal gradient steps on scaled columns, one small step at a time: slow and plain."""
    s = x.std(0)
    z = np.column_stack([(x - x.mean(0)) / s, np.ones(len(x))])
    curve = float(np.linalg.norm(z, 2) ** 2 / len(z)) * (2 if loss == "mse" else 1 / e)
    w = np.append(np.zeros(x.shape[1]), np.median(y))
    ahead, t = w, 1.0
    for _ in range(rounds):
        r = z @ ahead - y
        g = z.T @ (2 * r if loss == "mse" else r / np.sqrt(r * r + e * e)) / len(z)
        new = ahead - g / curve
        if norm1:
            new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - norm1 / s / curve, 0)
        if (ahead - new) @ (new - w) > 0:
            t = 1.0
        grown = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, moved = new + (t - 1) / grown * (new - w), np.abs(new - w).max()
        w, t = new, grown
        if moved < 1e-15:
            break
    return w[:-1] / s, w[-1] - (w[:-1] / s) @ x.mean(0)


@pytest.mark.parametrize("loss, norm1", [("mse", 0.0), ("mse", 0.2), ("l1", 0.0), ("l1", 0.05)])
def test_linear_losses(points, loss, norm1):
    x, y, df = points
    w, b = fit_linear(df, "y", loss, norm1)
    base, at = fit_linear(df, "y", "mse", norm1) if loss == "l1" else (w, b)
    e = 1e-3 * np.sqrt(np.mean((y - x @ base - at) ** 2))
    expected, intercept = slow(x, y, loss, norm1, 0.0, e)
    np.testing.assert_allclose(w, expected, atol=1e-6)
    assert b == pytest.approx(intercept, abs=1e-5)
    if loss == "l1" and not norm1:  # near the exact least absolute deviation too: half the residuals on either side
        assert abs(np.mean(np.sign(y - x @ w - b))) < 0.02


def test_rows_are_computed_once_for_all_passes(points, tmp_path):
    x, y, df = points

    def seen(batches):
        (tmp_path / uuid.uuid4().hex).touch()
        yield from batches
    rows = df.select("a", "b", "c", "y").mapInArrow(seen, "a double, b double, c double, y double")
    w, b = fit_linear(VectorAssembler(inputCols=["a", "b", "c"], outputCol="__x").transform(rows), "y", "l1", 0.05)
    assert len(list(tmp_path.iterdir())) == df.rdd.getNumPartitions()
    expected, intercept = fit_linear(df, "y", "l1", 0.05)
    np.testing.assert_allclose(w, expected, atol=1e-9)


def test_targets_are_fitted_together(points):
    x, y, df = points
    both = df.withColumn("z", 3 - 2 * df.y)
    found = fit_linear_each(both, ["y", "z"], "l1", 0.01)
    for (w, b), target in zip(found, ["y", "z"]):
        alone, intercept = fit_linear(both, target, "l1", 0.01)
        np.testing.assert_allclose(w, alone, atol=1e-9)
        assert b == pytest.approx(intercept, abs=1e-7)


@pytest.mark.parametrize("loss", ["mse", "l1"])
def test_euclidean_norm_is_optimal(points, loss):
    """No nearby point has a lower cost, and a strong penalty leaves nothing."""
    x, y, df = points
    w, b = fit_linear(df, "y", loss, 0.01, 0.3)
    e = 1e-9 if loss == "mse" else None

    def cost(v, c):
        r = np.abs(y - x @ v - c)
        return (r * r if e else r).mean() + 0.01 * np.abs(v).sum() + 0.3 * np.linalg.norm(v)
    for _ in range(200):
        d = RNG.normal(size=4) * [1e-2, 1e-3, 1e-2, 1e-2]
        assert cost(w, b) <= cost(w + d[:3], b + d[3]) + 2e-4
    assert not fit_linear(df, "y", loss, 0.0, 1e5)[0].any()


def test_stopping_round():
    assert stopping_round([5, 4, 3, 3.5, 3.4, 2], 2) == (2, 4)
    assert stopping_round([5, 4, 3, 3.5, 3.4, 2], 3) == (5, 5)
    assert stopping_round([5, 4.9, 4.8, 4.7], 2, delta=0.5) == (0, 2)
    assert stopping_round([5, 5, 5], 9) == (2, 2)  # an equal loss counts as no worse
    assert stopping_round([1.0], 1) == (0, 0)


@pytest.mark.parametrize("loss", ["mse", "l1"])
def test_patience_keeps_the_best_prefix(spark, loss, tmp_path):
    df = series_table(spark, {"north": 300, "east": 90}, missing=0)
    config = ForecastConfig(targets=("down",), features=("down",), n_lags=2, kind="gbt", loss=loss, max_iter=6, patience=2)
    fitted = fit_forecaster(df, config)
    [(_, losses, best)] = fitted.history
    after = []
    for rounds in range(1, 7):  # each prefix fitted anew
        short = fit_forecaster(df, ForecastConfig(**{**config.__dict__, "max_iter": rounds, "patience": None, "early_stop": False}))
        rows = short.score_held_out(df).collect()
        error = np.array([r.y_true[0] - r.y_pred[0] for r in rows])
        after.append(float((np.abs(error) if loss == "l1" else error ** 2).mean()))
    np.testing.assert_allclose(losses, after[:len(losses)], rtol=1e-9)
    assert (best, len(losses) - 1) == stopping_round(after, 2)
    assert fitted.models.stages[1].getNumTrees == best + 1
    fitted.save(str(tmp_path / "model"))
    again = load_forecaster(spark, str(tmp_path / "model")).score_held_out(df).collect()
    assert [r.y_pred[0] for r in sorted(again, key=lambda r: (r.District, r.time))] == pytest.approx(
        [r.y_pred[0] for r in sorted(fitted.score_held_out(df).collect(), key=lambda r: (r.District, r.time))])
    assert [r.kept for r in fitted.rounds(spark).orderBy("round").collect()] == [i == best for i in range(len(losses))]
