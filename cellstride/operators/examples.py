"""Model-ready examples: lag tensors, target history, exogenous data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.moments import row_statistics
from ..functions.timefeat import FROM_ONE, PERIODS, calendar_part, cyclical
from ..plans.layout import Layout, over_rows, plan_layout
from ..series import US, SeriesSpec, numeric_columns
from .lags import lag_name, row_lags

SPEC = SeriesSpec()


def tensor(columns: list[str], n_lags: int) -> Column:
    """Lag columns as lags × features, oldest lag first, features in model input order."""
    return F.array(*[F.array(*[F.col(lag_name(c, n)) for c in reversed(columns)])
                     for n in range(n_lags, 0, -1)])


def sequences(df: DataFrame, n_lags: int = 10, columns: list[str] | None = None,
              spec: SeriesSpec = SPEC, layout: Layout | None = None) -> DataFrame:
    """``(key, time, x)`` with x an ARRAY<ARRAY<DOUBLE>> of shape lags × features."""
    columns = columns or numeric_columns(df, spec)
    lagged = row_lags(df, n_lags, columns, "lags", spec, layout)
    return lagged.select(*spec.keys, spec.time, tensor(columns, n_lags).alias("x"))


def examples(df: DataFrame, targets: list[str], n_lags: int = 10, features: list[str] | None = None,
             exogenous: tuple[str, ...] = ("hour", "minute"), spec: SeriesSpec = SPEC,
             layout: Layout | None = None) -> DataFrame:
    """One training example per row after the first ``n_lags`` of its series.

    ``x`` are the lags, ``exog`` the cyclical calendar parts, ``y`` the targets now, and
    ``y_hist`` the targets at t−L−1 … t−2, zero before the series starts.  All come from one
    sorted window, so their sizes agree by construction.
    """
    features = features or numeric_columns(df, spec)
    layout = layout or plan_layout(df, spec)
    pairs = [v for p in exogenous
             for v in cyclical(calendar_part(spec.time, p), PERIODS[p], 1 if p in FROM_ONE else 0)]

    def build(rows: DataFrame, w) -> DataFrame:
        extra = [c for c in rows.columns if c.startswith("__")]

        def back(c: str, n: int) -> Column:
            return F.coalesce(F.lag(F.col(c).cast("double"), n).over(w), F.lit(0.0))

        needed = sorted({(c, n) for c in features for n in range(1, n_lags + 1)}
                        | {(c, n) for c in targets for n in range(2, n_lags + 2)})
        lagged = rows.select("*", F.lag(US, n_lags).over(w).isNotNull().alias("__deep"),
                             *[back(c, n).alias(lag_name(c, n)) for c, n in needed])
        return lagged.where("__deep").select(
            *spec.keys, spec.time, tensor(features, n_lags).alias("x"),
            F.array(*pairs).cast("array<double>").alias("exog"),
            F.array(*[F.array(*[F.col(lag_name(c, n)) for c in targets])
                      for n in range(n_lags + 1, 1, -1)]).alias("y_hist"),
            F.array(*[F.col(c).cast("double") for c in targets]).alias("y"), *extra)

    return over_rows(df, layout, n_lags + 1, build)


def lag_statistics(df: DataFrame, targets: list[str], n_lags: int = 10,
                   stats: list[str] | None = ("mean", "median", "std", "variance", "kurtosis", "skew", "gmean"),
                   spec: SeriesSpec = SPEC, layout: Layout | None = None) -> DataFrame | None:
    """Statistics over the lags of each target as ``{stat}_{target}``; ``None`` asks for nothing."""
    if stats is None or not list(stats) or list(stats)[0] is None:
        return None
    lagged = row_lags(df, n_lags, list(targets), "lags", spec, layout)
    for c in targets:
        lagged = row_statistics(lagged, [lag_name(c, n) for n in range(1, n_lags + 1)], c, list(stats))
    return lagged.select(*spec.keys, spec.time, *[f"{s}_{c}" for c in targets for s in stats])
