"""Scalers: fit to a parameter table, apply, invert.

Parameters are plain aggregates, so fitting combines on the map side.  A fitted scaler is the
table ``(key?, feature, center, scale)``; applying it is a projection after a parameter join and
works on streams too.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..plans.params import Settled, attach, settle
from ..plans.ranks import percentiles
from ..series import SeriesSpec, numeric_columns

SPEC = SeriesSpec()
ALIASES = {"StandardScaler": "standard", "MinMaxScaler": "minmax",
           "RobustScaler": "robust", "MaxAbsScaler": "maxabs"}


@dataclass(frozen=True)
class Scaler:
    kind: str
    features: tuple[str, ...]
    key: str | None
    wide: Settled                    # key?, then one struct(center, scale) per feature

    def table(self) -> DataFrame:
        """``(key?, feature, center, scale)``."""
        keys = [self.key] if self.key else []
        cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"__{c}.center").alias("center"),
                                   F.col(f"__{c}.scale").alias("scale")) for c in self.features])
        return self.wide.df.select(*keys, F.explode(cells).alias("cell")).select(*keys, "cell.*")

    def apply(self, df: DataFrame, spec: SeriesSpec = SPEC) -> DataFrame:
        return self._map(df, spec, lambda x, center, scale: (x - center) / scale)

    def invert(self, df: DataFrame, spec: SeriesSpec = SPEC) -> DataFrame:
        return self._map(df, spec, lambda x, center, scale: x * scale + center)

    def _map(self, df: DataFrame, spec: SeriesSpec, formula) -> DataFrame:
        if self.key is None:
            row = self.wide.one()
            bound = {c: (F.lit(row[f"__{c}"]["center"]), F.lit(row[f"__{c}"]["scale"]))
                     for c in self.features}
            source = df
        else:
            bound = {c: (F.col(f"__{c}.center"), F.col(f"__{c}.scale")) for c in self.features}
            source = attach(df, self.wide, [self.key], [spec.time])
        return source.select(*[formula(F.col(c), *bound[c]).alias(c) if c in bound else F.col(c)
                               for c in df.columns])


def fit_scaler(df: DataFrame, kind: str = "standard", features: list[str] | None = None,
               key: str | None = None, spec: SeriesSpec = SPEC, max_group: int | None = None) -> Scaler:
    """Fit on the non-missing values, per series when ``key`` is given.

    A feature of zero width is divided by 1.
    """
    kind = ALIASES.get(kind, kind)
    features = features or numeric_columns(df, spec)
    keys = [key] if key else []
    if kind == "robust":
        quartiles = percentiles(df, features, [0.25, 0.5, 0.75], key, max_group)
        cell = _cell(F.get("q", 1), F.get("q", 2) - F.get("q", 0))
        wide = (quartiles.withColumn("cell", cell).groupBy(*keys)
                .agg(*[F.max(F.when(F.col("feature") == c, F.col("cell"))).alias(f"__{c}")
                       for c in features]))
    else:
        formulas = {
            "standard": lambda c: _cell(F.avg(c), F.stddev_pop(c)),
            "minmax": lambda c: _cell(F.min(c), F.max(c) - F.min(c)),
            "maxabs": lambda c: _cell(F.lit(0.0), F.max(F.abs(c))),
        }
        if kind not in formulas:
            raise ValueError(f"not a supported scaler: {kind}")
        wide = df.groupBy(*keys).agg(*[formulas[kind](F.col(c)).alias(f"__{c}") for c in features])
    return Scaler(kind, tuple(features), key, settle(wide))


def _cell(center: Column, width: Column) -> Column:
    width = width.cast("double")
    return F.struct(center.cast("double").alias("center"),
                    F.when(width == 0, F.lit(1.0)).otherwise(width).alias("scale"))


def scale_frame(df: DataFrame, kind: str = "standard", spec: SeriesSpec = SPEC) -> DataFrame:
    """Fit and apply on one frame."""
    return fit_scaler(df, kind, spec=spec).apply(df, spec)


def scale_train_val(train: DataFrame, val: DataFrame | None = None, scaler: str | Scaler | None = "standard",
                    per_series: bool = False, features: list[str] | None = None,
                    spec: SeriesSpec = SPEC) -> tuple[DataFrame, DataFrame | None, Scaler | None]:
    """Fit on train, apply to both.  ``None`` or an unknown name leaves the data unscaled."""
    if isinstance(scaler, str):
        if ALIASES.get(scaler, scaler) not in set(ALIASES.values()):
            return train, val, None
        scaler = fit_scaler(train, scaler, features, spec.key if per_series else None, spec)
    if scaler is None:
        return train, val, None
    return scaler.apply(train, spec), None if val is None else scaler.apply(val, spec), scaler
