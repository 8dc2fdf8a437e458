"""Projections, filters, key checks and set operations."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, functions as F

from ..series import SeriesSpec, numeric_columns, select_numeric  # noqa: F401  (re-exported)

SPEC = SeriesSpec()


def only_series(df: DataFrame, value: str, spec: SeriesSpec = SPEC, keep_key: bool = True) -> DataFrame:
    """Rows of one series; on a layout partitioned by the key this prunes folders."""
    rows = df.where(F.col(spec.key) == value)
    return rows if keep_key else rows.drop(spec.key)


def cast_features(df: DataFrame, numeric_type: str = "double", spec: SeriesSpec = SPEC) -> DataFrame:
    """Every column but key and time as ``float`` or ``double``."""
    fixed = {spec.time, *spec.keys}
    return df.select(*[F.col(c) if c in fixed else F.col(c).cast(numeric_type).alias(c)
                       for c in df.columns])


def split_xy(df: DataFrame, targets: list[str], ignore: list[str] | None = None,
             spec: SeriesSpec = SPEC) -> DataFrame:
    """One row with struct columns ``X`` (all features but the ignored) and ``y`` (the targets).

    Targets stay in ``X`` unless ignored; the key is never ignored.
    """
    fixed = [*spec.keys, spec.time]
    dropped = set(ignore or ()) - set(spec.keys)
    features = [c for c in df.columns if c not in fixed and c not in dropped]
    return df.select(*fixed, F.struct(*features).alias("X"), F.struct(*targets).alias("y"))


def drop_key(df: DataFrame, spec: SeriesSpec = SPEC) -> DataFrame:
    if spec.key not in df.columns:
        raise KeyError(spec.key)
    return df.drop(spec.key)


def drop_any_missing(df: DataFrame, columns: list[str] | None = None,
                     spec: SeriesSpec = SPEC) -> DataFrame:
    return df.na.drop("any", subset=columns or numeric_columns(df, spec))


def drop_sparse_rows(df: DataFrame, threshold: float = 0.33, columns: list[str] | None = None,
                     spec: SeriesSpec = SPEC) -> DataFrame:
    """Keep rows with at least ``ceil(F * (1 - threshold))`` of their F features present."""
    features = columns or numeric_columns(df, spec)
    return df.na.drop(thresh=ceil(len(features) * (1 - threshold)), subset=features)


def drop_empty_columns(df: DataFrame, columns: list[str] | None = None,
                       spec: SeriesSpec = SPEC) -> DataFrame:
    """Drop features without a single value; one aggregate row decides."""
    features = columns or numeric_columns(df, spec)
    seen = df.agg(*[F.count(c).alias(c) for c in features]).first()
    return df.drop(*[c for c in features if seen[c] == 0])


def key_mismatch(left: DataFrame, right: DataFrame, spec: SeriesSpec = SPEC) -> DataFrame:
    """Series present on one side only: ``(key, missing_in)``."""
    a, b = left.select(spec.key).distinct(), right.select(spec.key).distinct()
    return (a.join(b, spec.key, "left_anti").withColumn("missing_in", F.lit("right"))
            .unionByName(b.join(a, spec.key, "left_anti").withColumn("missing_in", F.lit("left"))))


def require_same_keys(left: DataFrame, right: DataFrame, spec: SeriesSpec = SPEC) -> None:
    strays = key_mismatch(left, right, spec).limit(5).collect()
    if strays:
        raise ValueError(f"series differ between the tables: {[tuple(r) for r in strays]}")


def exogenous_by_series(train: DataFrame, val: DataFrame | None = None,
                        spec: SeriesSpec = SPEC) -> DataFrame:
    """Exogenous rows of train and, after a key check, validation, marked by ``split``.

    The key stays a column, since a folder per series (``partitionBy``) replaces the in-memory
    dictionary of frames; ``drop_key`` removes it after the write.
    """
    if val is None:
        return train.withColumn("split", F.lit("train"))
    require_same_keys(train, val, spec)
    return stack_splits(train, val)


def stack_splits(train: DataFrame, val: DataFrame) -> DataFrame:
    """UNION ALL of both parts with a ``split`` column."""
    return (train.withColumn("split", F.lit("train"))
            .unionByName(val.withColumn("split", F.lit("val"))))
