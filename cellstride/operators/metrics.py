"""Regression metrics over ``(key, time, dim, y_true, y_pred)`` rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..series import SeriesSpec

SPEC = SeriesSpec()


def long_predictions(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred",
                     spec: SeriesSpec = SPEC) -> DataFrame:
    """Array columns to one row per output dimension."""
    return df.select(*spec.keys, spec.time, F.posexplode(F.arrays_zip(
        F.col(y_true).alias("t"), F.col(y_pred).alias("p"))).alias("dim", "z")).select(
        *spec.keys, spec.time, "dim", F.col("z.t").alias("y_true"), F.col("z.p").alias("y_pred"))


def _guarded_r2(sse: Column, spread: Column) -> Column:
    """A constant truth scores 1 if it is met and 0 otherwise."""
    return (F.when(spread > 0, 1 - sse / F.when(spread > 0, spread))
            .when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0)))


def metrics_by_dim(predictions: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``(by…, dim, n, mse, rmse, mae, r2, nrmse)``; nrmse is NULL where the mean truth is 0."""
    error = F.col("y_true") - F.col("y_pred")
    sums = predictions.groupBy(*(by or []), "dim").agg(
        F.count(F.lit(1)).alias("n"), F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"), F.avg("y_true").alias("mean_true"),
        F.var_pop("y_true").alias("var_true"))
    return sums.select(*(by or []), "dim", "n", "mse", F.sqrt("mse").alias("rmse"), "mae",
                       _guarded_r2(F.col("mse"), F.col("var_true")).alias("r2"),
                       F.try_divide(F.sqrt("mse"), "mean_true").alias("nrmse"))


def metrics_overall(predictions: DataFrame, dims: list[int] | None = None,
                    by: list[str] | None = None) -> DataFrame:
    """``(by…, mse, rmse, mae, r2, nrmse)`` over all outputs.

    rmse is the root of the overall mse.  nrmse averages the chosen ``dims`` whose mean truth is
    not 0, and is 0 if none is left.
    """
    each = metrics_by_dim(predictions, by)
    chosen = F.col("nrmse") if dims is None else F.when(F.col("dim").isin(list(dims)), F.col("nrmse"))
    return each.groupBy(*(by or [])).agg(
        F.avg("mse").alias("mse"), F.sqrt(F.avg("mse")).alias("rmse"), F.avg("mae").alias("mae"),
        F.avg("r2").alias("r2"), F.coalesce(F.avg(chosen), F.lit(0.0)).alias("nrmse"))


def dim_and_overall(predictions: DataFrame) -> DataFrame:
    """Rows per dimension and one over all (dim NULL) by rollup."""
    error = F.col("y_true") - F.col("y_pred")
    return predictions.rollup("dim").agg(
        F.count(F.lit(1)).alias("n"), F.avg(error * error).alias("mse"),
        F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"))


def actual_vs_predicted(predictions: DataFrame, dim: int = 0, spec: SeriesSpec = SPEC) -> DataFrame:
    """The chart series of one output: truth, prediction and residual by time."""
    return (predictions.where(F.col("dim") == dim)
            .select(*spec.keys, spec.time, "y_true", "y_pred",
                    (F.col("y_true") - F.col("y_pred")).alias("residual")))
