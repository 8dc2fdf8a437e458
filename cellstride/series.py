"""The measurement table: one row per (series key, time) with numeric features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

US = "__us"            # order coordinate of a row, BIGINT
SERIES = "__series"    # stands in for the key when the whole frame is one series
UTC_ZONES = {"UTC", "Etc/UTC", "GMT", "Z", "+00:00"}


@dataclass(frozen=True)
class SeriesSpec:
    """Names of the time and key columns.

    ``key=None`` treats the frame as one series.  ``ties`` orders rows of the same instant where
    an operator goes by rows; operators that go by time refuse such rows.
    """

    time: str = "time"
    key: str | None = "District"
    ties: tuple[str, ...] = ()

    @property
    def keys(self) -> list[str]:
        return [self.key] if self.key else []


def numeric_columns(df: DataFrame, spec: SeriesSpec = SeriesSpec()) -> list[str]:
    """Names of the numeric features, from the schema alone; key, time and tie columns are none."""
    return [f.name for f in df.schema
            if isinstance(f.dataType, T.NumericType) and f.name not in (*spec.keys, spec.time, *spec.ties)
            and not f.name.startswith("__")]


def select_numeric(df: DataFrame, spec: SeriesSpec = SeriesSpec()) -> DataFrame:
    """Key, time and the numeric features; key and time are kept so that order survives."""
    return df.select(*spec.keys, spec.time, *numeric_columns(df, spec))


def nan_to_null(df: DataFrame) -> DataFrame:
    """One spelling of "missing": Spark aggregates skip NULL but propagate NaN."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[
        F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns])


def epoch_us(df: DataFrame, column: str) -> Column:
    """Microseconds since 1970-01-01 of a time column, read as wall-clock for TIMESTAMP_NTZ.

    Wall-clock times pass through no zone: in one with summer time, two of them could meet.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, (T.LongType, T.IntegerType)):
        return F.col(column).cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long") * F.lit(86_400_000_000)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if df.sparkSession.conf.get("spark.sql.session.timeZone") in UTC_ZONES:
        return F.unix_micros(F.col(column).cast("timestamp"))
    since = f"`{column}` - TIMESTAMP_NTZ'1970-01-01 00:00:00'"
    return F.expr(f"cast(cast(cast({since} as interval second) as decimal(18, 6)) * 1000000 as bigint)")


def wall_clock(instant: Column) -> Column:
    """The TIMESTAMP_NTZ whose ``epoch_us`` equals that of an instant."""
    seconds = (F.unix_micros(instant).cast("decimal(20, 0)") / 1_000_000).cast("decimal(18, 6)")
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds)


def duplicate_instants(df: DataFrame, spec: SeriesSpec = SeriesSpec()) -> DataFrame:
    """(key, time) pairs held by more than one row; time lags refuse such input."""
    return (df.groupBy(*spec.keys, spec.time).agg(F.count(F.lit(1)).alias("n_rows"))
            .where("n_rows > 1"))


def require_unique_instants(df: DataFrame, spec: SeriesSpec = SeriesSpec()) -> None:
    if duplicate_instants(df, spec).limit(1).count():
        raise ValueError(f"duplicate rows for {spec.keys + [spec.time]}; downsample first")
