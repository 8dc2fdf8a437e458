"""Profiles of a measurement table: quality, statistics, autocorrelation, chart series."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.moments import adjusted_kurtosis, adjusted_skewness, geometric_mean
from ..plans.layout import Layout, over_rows, plan_layout
from ..plans.params import attach, settle
from ..plans.ranks import MAX_GROUP, melt, percentiles
from ..series import SeriesSpec, numeric_columns
from .project import drop_any_missing

SPEC = SeriesSpec()


def quality_report(df: DataFrame) -> DataFrame:
    """Rows with a missing cell and missing cells, as counts and percentages; one row."""
    gap = F.lit(False)
    gaps = F.lit(0)
    for c in df.columns:
        gap = gap | F.col(c).isNull()
        gaps = gaps + F.col(c).isNull().cast("long")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(gap).alias("rows_with_missing"),
                  F.sum(gaps).alias("missing_cells")).select(
        "*", (F.col("rows_with_missing") / F.col("n_rows") * 100).alias("pct_rows_missing"),
        (F.col("missing_cells") / (F.col("n_rows") * len(df.columns)) * 100).alias("pct_cells_missing"))


def modes(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(feature, mode)``, the smallest of ties, by counting equal values before comparing."""
    counts = melt(df, [], columns).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("m"))
    top = F.max(F.struct(F.col("m"), (-F.col("value")).alias("neg")))
    return counts.groupBy("feature").agg((-top["neg"] + F.lit(0.0)).alias("mode"))


def statistics(df: DataFrame, columns: list[str] | None = None, spec: SeriesSpec = SPEC,
               max_group: int = MAX_GROUP) -> DataFrame:
    """One row per feature over the rows without missing features."""
    columns = columns or numeric_columns(df, spec)
    full = drop_any_missing(df, columns).select(*[F.col(c).cast("double").alias(c) for c in columns])
    moments = full.agg(*[F.struct(
        F.lit(c).alias("feature"), F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("stdev"),
        F.min(c).alias("min"), F.max(c).alias("max"), geometric_mean(c).alias("gmean"),
        F.var_samp(c).alias("variance"), adjusted_skewness(c).alias("skewness"),
        adjusted_kurtosis(c).alias("kurtosis")).alias(c) for c in columns])
    fitted = settle(moments.select(F.explode(F.array(*columns)).alias("s")).select("s.*"))
    table = fitted.df
    ranks = percentiles(full, columns, [0.1, 0.5, 0.9], max_group=max_group, largest=max(fitted.distinct("n"))).select(
        "feature", F.get("q", 1).alias("median"), F.get("q", 0).alias("p10"), F.get("q", 2).alias("p90"))
    return (table.join(ranks, "feature").join(modes(full, columns), "feature")
            .select("feature", "mean", "stdev", "median", "mode", "min", "max", "gmean", "variance",
                    "skewness", "kurtosis", "p10", "p90"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(column)


def series_keys(df: DataFrame, spec: SeriesSpec = SPEC) -> DataFrame:
    return df.select(spec.key).distinct()


def date_range(df: DataFrame, spec: SeriesSpec = SPEC) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(spec.key).alias("n_series"),
                  F.min(spec.time).alias("first_time"), F.max(spec.time).alias("last_time"))


def describe(df: DataFrame, columns: list[str] | None = None, spec: SeriesSpec = SPEC,
             max_group: int = MAX_GROUP) -> DataFrame:
    """``(feature, type, count, mean, stdev, min, p25, p50, p75, max)`` over non-missing values."""
    columns = columns or numeric_columns(df, spec)
    kinds = dict(df.dtypes)
    basic = df.agg(*[F.struct(
        F.lit(c).alias("feature"), F.lit(kinds[c]).alias("type"), F.count(c).alias("count"),
        F.avg(c).alias("mean"), F.stddev_samp(c).alias("stdev"), F.min(c).cast("double").alias("min"),
        F.max(c).cast("double").alias("max")).alias(c) for c in columns])
    fitted = settle(basic.select(F.explode(F.array(*columns)).alias("s")).select("s.*"))
    table = fitted.df
    ranks = percentiles(df, columns, [0.25, 0.5, 0.75], max_group=max_group, largest=max(fitted.distinct("count"))).select(
        "feature", F.get("q", 0).alias("p25"), F.get("q", 1).alias("p50"), F.get("q", 2).alias("p75"))
    return table.join(ranks, "feature")


def skew_profile(df: DataFrame, column: str, spec: SeriesSpec = SPEC,
                 max_group: int = MAX_GROUP) -> DataFrame:
    """How the series differ: rows, time span and quartiles of one feature."""
    spans = df.groupBy(spec.key).agg(F.count(F.lit(1)).alias("n_rows"), F.min(spec.time).alias("first_time"),
                                     F.max(spec.time).alias("last_time"))
    ranks = percentiles(df, [column], [0.25, 0.5, 0.75], spec.key, max_group).select(
        spec.key, F.get("q", 0).alias("p25"), F.get("q", 1).alias("p50"), F.get("q", 2).alias("p75"))
    return spans.join(ranks, spec.key, "left")


def autocorrelation(df: DataFrame, max_lag: int = 15, columns: list[str] | None = None,
                    spec: SeriesSpec = SPEC, layout: Layout | None = None) -> DataFrame:
    """``(key, feature, n, acf)`` with ``acf[k]`` for k = 0…max_lag, after listwise drop.

    Autocovariances divide by n.  The lag products are summed on the map side.
    """
    columns = columns or numeric_columns(df, spec)
    keys, ties = spec.keys, [t for t in spec.ties if t not in columns]
    full = drop_any_missing(df, columns).select(*dict.fromkeys([*keys, spec.time, *spec.ties, *columns]))
    layout = layout or plan_layout(full, spec)
    means = settle(full.groupBy(*keys).agg(*[F.avg(c).alias(f"__m_{c}") for c in columns]))
    if keys:
        centred = attach(full, means, keys, [spec.time])
        centred = centred.select(*keys, spec.time, *ties, *[(F.col(c) - F.col(f"__m_{c}")).alias(c) for c in columns])
    else:
        centred = full.select(spec.time, *ties, *[(F.col(c) - F.lit(means.one()[f"__m_{c}"])).alias(c)
                                                  for c in columns])

    def build(rows: DataFrame, w) -> DataFrame:
        extra = [c for c in rows.columns if c.startswith("__")]
        return rows.select(*keys, *[
            F.array(*[F.col(c) * (F.lag(c, k).over(w) if k else F.col(c)) for k in range(max_lag + 1)]).alias(c)
            for c in columns], *extra)

    products = over_rows(centred, layout, max_lag, build)
    # One wide row per series, melted after the sums.
    wide = products.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[
        F.sum(F.get(c, k)).alias(f"{c}__{k}") for c in columns for k in range(max_lag + 1)])
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), *[
        F.col(f"{c}__{k}").alias(f"s{k}") for k in range(max_lag + 1)]) for c in columns]))
    sums = wide.select(*keys, "n", cells.alias("cell")).select(*keys, "n", "cell.*").where("n > 0")
    acf = F.array(*[F.try_divide(F.coalesce(F.col(f"s{k}"), F.lit(0.0)), F.col("s0"))
                    for k in range(max_lag + 1)])
    return sums.select(*keys, "feature", "n", acf.alias("acf"))


def _durbin_levinson():
    """Partial autocorrelations from one short array of autocorrelations per series and feature."""
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def apply(acf: pd.Series) -> pd.Series:
        if not len(acf):
            return acf
        r = np.array(acf.tolist(), dtype=float)  # one row per series and feature; missing becomes NaN
        phi, out = np.zeros((len(r), 0)), [np.ones(len(r))]
        for k in range(1, r.shape[1]):
            gap = 1.0 - (phi * r[:, 1:k]).sum(1)
            gap[gap == 0] = np.nan
            last = (r[:, k] - (phi * r[:, k - 1:0:-1]).sum(1)) / gap
            phi = np.concatenate([phi - last[:, None] * phi[:, ::-1], last[:, None]], 1)
            out.append(last)
        known = ~np.isnan(r).any(1)
        return pd.Series([list(x) if ok else None for x, ok in zip(np.stack(out, 1), known)], index=acf.index, dtype=object)

    return apply


def partial_autocorrelation(df: DataFrame, max_lag: int = 15, columns: list[str] | None = None,
                            spec: SeriesSpec = SPEC, layout: Layout | None = None) -> DataFrame:
    """``(key, feature, lag, acf, pacf, band)``; the band is the 95 % limit of white noise."""
    table = autocorrelation(df, max_lag, columns, spec, layout).withColumn("pacf", _durbin_levinson()("acf"))
    zipped = F.posexplode(F.arrays_zip("acf", "pacf")).alias("lag", "z")
    return table.select(*spec.keys, "feature", "n", zipped).select(
        *spec.keys, "feature", "lag", F.col("z.acf").alias("acf"), F.col("z.pacf").alias("pacf"),
        (F.lit(1.96) / F.sqrt("n")).alias("band"))


def trends(df: DataFrame, columns: list[str] | None = None, every: str | None = None,
           spec: SeriesSpec = SPEC) -> DataFrame:
    """``(key, feature, time, value)`` to chart; ``every`` averages over windows of that length."""
    columns = columns or numeric_columns(df, spec)
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
                                for c in columns]))
    rows = df.select(*spec.keys, spec.time, cells.alias("cell")).select(*spec.keys, spec.time, "cell.*")
    if every is None:
        return rows.select(*spec.keys, "feature", spec.time, "value")
    return (rows.groupBy(*spec.keys, "feature", F.window(spec.time, every).alias("w"))
            .agg(F.avg("value").alias("value"))
            .select(*spec.keys, "feature", F.col("w.start").alias(spec.time), "value"))
