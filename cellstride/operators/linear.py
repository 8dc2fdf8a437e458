"""Linear models by squared or absolute loss with plain-norm penalties; only sums of a task's rows travel."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame, functions as F

#: Step lengths that one pass over the rows tries, and the widths, beside the residuals' spread, at which |r| is rounded off.
STEPS = (1.0, 0.5, 0.2, 0.05, 0.01)
WIDTHS = (1.0, 0.1, 0.01, 0.001)
BLOCK_BYTES = 1 << 20  # rows that meet in a pass; their terms stay near the core
TASKS_PER_CORE = 3     # of a pass, which takes little longer than to start its tasks


def _packed(rows: DataFrame, targets: list[str], features: str) -> DataFrame:
    """The rows in blocks ``(width, data)``: a matrix of doubles with a row per feature, then one per target.

    A pass then takes a block at a time and no row by itself.
    """
    narrow = rows.select(vector_to_array(features).alias("x"), *[F.col(t).cast("double").alias(f"y{i}") for i, t in enumerate(targets)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                whole = np.vstack([x.T, *(y.to_numpy(zero_copy_only=False) for y in batch.columns[1:])])
                step = max(1, BLOCK_BYTES // (8 * len(whole)))
                for i in range(0, batch.num_rows, step):
                    yield pa.RecordBatch.from_arrays([pa.array([len(whole)], pa.int32()), pa.array([whole[:, i:i + step].tobytes()], pa.binary())],
                                                     ["width", "data"])

    return narrow.mapInArrow(run, "width int, data binary")


def _sums(blocks: DataFrame, targets: int, target: int, size: int, of) -> np.ndarray:
    """``size`` numbers: ``of(x with a row of ones, y)`` added over all blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for width, data in zip(batch.column(0), batch.column(1)):
                block = np.frombuffer(data.as_buffer()).reshape(width.as_py(), -1)
                d = len(block) - targets
                total += of(np.vstack([block[:d], np.ones(block.shape[1])]), block[d + target])
        yield pa.RecordBatch.from_arrays([pa.array([total])], ["v"])

    added = blocks.mapInArrow(run, "v array<double>").select(F.posexplode("v").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v"))
    out = np.zeros(size)
    for r in added.collect():
        out[r["i"]] = r["v"]
    return out


def _shrunk(w: np.ndarray, norm1: float, norm2: float) -> np.ndarray:
    """The proximal point of norm1·‖w‖₁ + norm2·‖w‖₂."""
    v = np.sign(w) * np.maximum(np.abs(w) - norm1, 0)
    length = float(np.linalg.norm(v))
    return v * max(0.0, 1 - norm2 / length) if length else v


def minimise_quadratic(h: np.ndarray, c: np.ndarray, norm1: float, norm2: float, start: np.ndarray, rounds: int = 50_000) -> np.ndarray:
    """argmin of w·h·w/2 − c·w + norm1·‖w‖₁ + norm2·‖w‖₂ over all but the intercept, which comes last and goes free.

    Without penalties it is one solve.  With them the intercept is eliminated, and accelerated proximal steps with restarts find
    the rest.
    """
    if not norm1 and not norm2:
        return np.linalg.lstsq(h, c, rcond=1e-14)[0]  # constant columns get nothing
    side, corner = h[:-1, -1], h[-1, -1]
    inner, goal = h[:-1, :-1] - np.outer(side, side) / corner, c[:-1] - side * c[-1] / corner
    step = 1 / max(float(np.linalg.norm(inner, 2)), 1e-300)
    w = ahead = start[:-1]
    t, still = 1.0, 0
    for _ in range(rounds):
        new = _shrunk(ahead - step * (inner @ ahead - goal), step * norm1, step * norm2)
        if float((ahead - new) @ (new - w)) > 0:
            t = 1.0
        grown = (1 + np.sqrt(1 + 4 * t * t)) / 2
        moved = float(np.abs(new - w).max())
        ahead, w, t = new + (t - 1) / grown * (new - w), new, grown
        still = still + 1 if moved <= 1e-15 * max(1e-3, float(np.abs(w).max())) else 0
        if still > 3:
            break
    return np.append(w, (c[-1] - side @ w) / corner)


def fit_linear(rows: DataFrame, target: str, loss: str = "mse", norm1: float = 0.0, norm2: float = 0.0, features: str = "__x",
               max_iter: int = 60) -> tuple[np.ndarray, float]:
    """Coefficients and intercept that minimise mean loss + norm1·‖w‖₁ + norm2·‖w‖₂ (plain norms, the intercept free).

    Squared loss needs one pass for the products of the columns.  Absolute loss is minimised as sqrt(r² + e²) − e with e falling to
    a thousandth of the residuals' spread, by Newton steps from the squared solution; a pass gives loss, gradient and
    curvature at several step lengths.  Rows are never gathered: they are computed once, kept by the executors in blocks, and a task
    returns sums of the size of the curvature matrix.
    """
    return fit_linear_each(rows, [target], loss, norm1, norm2, features, max_iter)[0]


def fit_linear_each(rows: DataFrame, targets: list[str], loss: str = "mse", norm1: float = 0.0, norm2: float = 0.0, features: str = "__x",
                    max_iter: int = 60) -> list[tuple[np.ndarray, float]]:
    """``fit_linear`` for several targets of the same rows."""
    blocks = _packed(rows, targets, features).persist()
    few = blocks.coalesce(TASKS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism)
    try:
        return [_fit(few, len(targets), i, loss, norm1, norm2, max_iter) for i in range(len(targets))]
    finally:
        blocks.unpersist()


def _fit(blocks: DataFrame, targets: int, target: int, loss: str, norm1: float, norm2: float, max_iter: int) -> tuple[np.ndarray, float]:
    first = blocks.first()
    if first is None:
        raise ValueError("no rows to fit")
    d = first["width"] - targets + 1

    def added(size: int, of) -> np.ndarray:
        return _sums(blocks, targets, target, size, of)

    means = added(d + 2, lambda x, y: np.concatenate([x.sum(1), [y.sum(), y @ y]]))
    n = means[d - 1]
    centre = np.append(means[:d - 1] / n, 0.0)

    def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = x - centre[:, None]
        return np.concatenate([(z @ z.T).ravel(), z @ y, [y @ y]])

    moments = added(d * d + d + 1, products) / n
    h, c = 2 * moments[:d * d].reshape(d, d), 2 * moments[d * d:-1]
    w = minimise_quadratic(h, c, norm1, norm2, np.zeros(d))
    if loss == "l1":
        spread = float(np.sqrt(max(moments[-1] + w @ h @ w / 2 - c @ w, 0.0)))
        for width in WIDTHS if spread else ():
            w = _newton(added, centre, n, w, width * spread, norm1, norm2, max_iter)
    elif loss != "mse":
        raise ValueError(f"unknown loss {loss}")
    return w[:-1], float(w[-1] - w[:-1] @ centre[:-1])


def _newton(added, centre: np.ndarray, n: float, w: np.ndarray, e: float, norm1: float, norm2: float, max_iter: int) -> np.ndarray:
    d, size = len(w), 1 + len(w) + len(w) ** 2

    def at(points: np.ndarray):
        def of(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            z, out = x - centre[:, None], []
            for p in points:
                r = p @ z - y
                root = np.sqrt(r * r + e * e)
                curve = e * e / (root * root * root)
                out.append(np.concatenate([[(root - e).sum()], z @ (r / root), ((z * curve) @ z.T).ravel()]))
            return np.concatenate(out)
        return (added(size * len(points), of) / n).reshape(len(points), size)

    def penalty(p: np.ndarray) -> float:
        return norm1 * float(np.abs(p[:-1]).sum()) + norm2 * float(np.linalg.norm(p[:-1]))

    here = at(w[None])[0]
    for _ in range(max_iter):
        h = here[1 + d:].reshape(d, d)
        h = h + 1e-9 * np.trace(h) / d * np.eye(d)
        goal = minimise_quadratic(h, h @ w - here[1:1 + d], norm1, norm2, w)
        if float(np.abs(goal - w).max()) <= 1e-10 * max(1.0, float(np.abs(w).max())):
            break
        points = w + np.array(STEPS)[:, None] * (goal - w)
        tried = at(points)
        costs = [t[0] + penalty(p) for t, p in zip(tried, points)]
        best = int(np.argmin(costs))
        if costs[best] >= here[0] + penalty(w):
            break
        w, here = points[best], tried[best]
    return w


def as_model(spark, coefficients: np.ndarray, intercept: float, features: str, prediction: str) -> LinearRegressionModel:
    """The coefficients as a model that pipelines transform with and save."""
    from pyspark.ml.common import _py2java
    made = spark._jvm.org.apache.spark.ml.regression.LinearRegressionModel(
        f"linear_{abs(hash((intercept, *coefficients))):x}", _py2java(spark.sparkContext, Vectors.dense(coefficients)), float(intercept))
    return LinearRegressionModel(made).setFeaturesCol(features).setPredictionCol(prediction)
