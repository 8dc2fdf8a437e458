"""Multivariate statistics: distance correlation, Pearson, density curves, PCA."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from math import pi, sqrt
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import DataFrame, functions as F

from ..series import SeriesSpec, numeric_columns
from .dcor import pair_distance_correlation
from .project import drop_any_missing
from .scale import fit_scaler

SPEC = SeriesSpec()
KDE_POINTS = 200       # fixed values: grid size and how many bandwidths it extends past the data
KDE_CUT = 3
KDE_BLOCK = 256        # values that meet the grid at once; their terms stay in a core's cache


def pearson(df: DataFrame, columns: list[str] | None = None, spec: SeriesSpec = SPEC) -> DataFrame:
    """``(feature_x, feature_y, corr)`` for every pair, in one aggregation."""
    columns = columns or numeric_columns(df, spec)
    full = drop_any_missing(df, columns)
    pairs = list(combinations(columns, 2))
    wide = full.agg(*[F.corr(a, b).alias(f"p{i}") for i, (a, b) in enumerate(pairs)])
    cells = F.array(*[F.struct(F.lit(a).alias("feature_x"), F.lit(b).alias("feature_y"),
                               F.col(f"p{i}").alias("corr")) for i, (a, b) in enumerate(pairs)])
    return wide.select(F.explode(cells).alias("cell")).select("cell.*")


def distance_correlation(df: DataFrame, columns: list[str] | None = None, spec: SeriesSpec = SPEC,
                         block_rows: int | None = None) -> DataFrame:
    """``(feature_x, feature_y, dcor)`` for every pair of columns, after listwise drop."""
    columns = columns or numeric_columns(df, spec)
    return pair_distance_correlation(drop_any_missing(df, columns), list(combinations(columns, 2)), block_rows)


def density(df: DataFrame, columns: list[str] | None = None, points: int = KDE_POINTS,
            spec: SeriesSpec = SPEC) -> DataFrame:
    """Gaussian kernel density ``(feature, point, x, density)`` with Scott's bandwidth.

    Every value adds to every grid point: a task multiplies blocks of its values with the grid and adds up, so only
    ``points`` sums per feature and task travel.
    """
    columns = columns or numeric_columns(df, spec)
    fitted = df.agg(*[F.struct(F.count(c).alias("n"), F.stddev_samp(c).alias("sd"),
                               F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi")
                               ).alias(c) for c in columns]).first()
    shape = {}
    for c in columns:
        if fitted[c]["n"] and fitted[c]["sd"]:
            h = fitted[c]["sd"] * fitted[c]["n"] ** -0.2
            start = fitted[c]["lo"] - KDE_CUT * h
            shape[c] = (h, start, (fitted[c]["hi"] + KDE_CUT * h - start) / (points - 1), fitted[c]["n"])
    if not shape:
        raise ValueError("no feature with two different values")

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {c: np.zeros(points) for c in shape}
        for batch in batches:
            for c, (h, start, step, _) in shape.items():
                values, m = np.unique(batch.column(c).drop_null().to_numpy(zero_copy_only=False), return_counts=True)
                grid = (start + step * np.arange(points)[:, None]) / h
                for i in range(0, len(values), KDE_BLOCK):
                    z = grid - values[i:i + KDE_BLOCK] / h
                    z *= z
                    z *= -0.5
                    sums[c] += np.exp(z, out=z) @ m[i:i + KDE_BLOCK].astype(float)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array(list(sums.values()))], ["feature", "sums"])

    def of(i: int):
        return F.element_at(F.create_map(*[x for c in shape for x in (F.lit(c), F.lit(float(shape[c][i])))]), F.col("feature"))

    # Files of one row group would keep one task busy: narrow rows are evened out first.
    narrow = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in shape]).hint("rebalance")
    parts = narrow.mapInArrow(add_up, "feature string, sums array<double>")
    sums = parts.select("feature", F.posexplode("sums").alias("point", "s")).groupBy("feature", "point").agg(F.sum("s").alias("s"))
    return sums.select(
        "feature", "point", (of(1) + F.col("point") * of(2)).alias("x"),
        (F.col("s") / (of(3) * of(0) * sqrt(2 * pi))).alias("density"))


def scatter_bins(df: DataFrame, columns: list[str] | None = None, bins: int = 50,
                 spec: SeriesSpec = SPEC) -> DataFrame:
    """Counts ``(feature_x, feature_y, bin_x, bin_y, n)`` for every pair, on equal-width bins."""
    columns = columns or numeric_columns(df, spec)
    full = drop_any_missing(df, columns)
    span = full.agg(*[F.struct(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi")).alias(c)
                    for c in columns]).first()

    def at(c: str):
        width = (span[c]["hi"] - span[c]["lo"]) / bins if span[c]["lo"] is not None else 0
        if not width:
            return F.when(F.col(c).isNotNull(), F.lit(0)).cast("long")
        return F.least(F.floor((F.col(c) - F.lit(span[c]["lo"])) / F.lit(width)), F.lit(bins - 1)).cast("long")

    cells = F.array(*[F.struct(F.lit(a).alias("feature_x"), F.lit(b).alias("feature_y"),
                               at(a).alias("bin_x"), at(b).alias("bin_y")) for a, b in combinations(columns, 2)])
    return (full.select(F.explode(cells).alias("c"))
            .groupBy("c.feature_x", "c.feature_y", "c.bin_x", "c.bin_y").agg(F.count(F.lit(1)).alias("n")))


def scatter_sample(df: DataFrame, fraction: float, seed: int = 0, columns: list[str] | None = None,
                   spec: SeriesSpec = SPEC) -> DataFrame:
    """A seeded sample of the rows to draw as points."""
    columns = columns or numeric_columns(df, spec)
    return df.select(*columns).sample(fraction, seed)


class Components:
    """Principal components of the standardised features."""

    def __init__(self, df: DataFrame, columns: list[str] | None = None, spec: SeriesSpec = SPEC):
        self.columns = columns or numeric_columns(df, spec)
        self.spec = spec
        full = drop_any_missing(df, self.columns)
        self.scaler = fit_scaler(full, "standard", self.columns)
        self._assembler = VectorAssembler(inputCols=self.columns, outputCol="__features")
        self.model = PCA(k=len(self.columns), inputCol="__features", outputCol="__pc").fit(
            self._assembler.transform(self.scaler.apply(full.select(self.columns))))
        self.ratios = [float(v) for v in self.model.explainedVariance]

    def variance(self, spark) -> DataFrame:
        """``(component, ratio, cumulative)``."""
        rows = [(i + 1, r, float(sum(self.ratios[:i + 1]))) for i, r in enumerate(self.ratios)]
        return spark.createDataFrame(rows, "component int, ratio double, cumulative double")

    def count_for(self, threshold: float = 0.95) -> int:
        """The first number of components whose cumulative ratio reaches the threshold."""
        reached = np.cumsum(self.ratios) >= threshold - 1e-12
        return int(np.argmax(reached)) + 1 if reached.any() else len(self.ratios)

    def project(self, df: DataFrame, k: int | None = None) -> DataFrame:
        """Append ``PC_1…PC_k``, sums of the standardised features by loadings; the largest loading of each component is made positive."""
        k = k or self.count_for()
        loadings = self.model.pc.toArray()
        signs = [1.0 if loadings[np.argmax(np.abs(loadings[:, i])), i] >= 0 else -1.0 for i in range(k)]
        full = drop_any_missing(df, self.columns)
        scaled = self.scaler.apply(full.select("*", *[F.col(c).alias(f"__raw_{c}") for c in self.columns]))
        scores = [reduce(add, [F.col(c) * F.lit(float(x)) for c, x in zip(self.columns, loadings[:, i] * signs[i])]) for i in range(k)]
        return scaled.select(
            *[F.col(f"__raw_{c}").alias(c) if c in self.columns else F.col(c) for c in df.columns],
            *[score.alias(f"PC_{i + 1}") for i, score in enumerate(scores)])


def component_correlation(df: DataFrame, columns: list[str] | None = None, threshold: float = 0.95,
                          spec: SeriesSpec = SPEC, block_rows: int | None = None) -> DataFrame:
    """Distance correlation of every feature with every kept component."""
    fitted = Components(df, columns, spec)
    k = fitted.count_for(threshold)
    # Equal rows have equal components: they are projected, and told apart from other rows, once.
    counted = (drop_any_missing(df, fitted.columns).groupBy(*fitted.columns).agg(F.count(F.lit(1)).alias("__rows")))
    return pair_distance_correlation(
        counted, [(c, f"PC_{i + 1}") for c in fitted.columns for i in range(k)], block_rows, weight="__rows",
        derive=lambda rows: fitted.project(rows, k))
