"""Tumbling-window downsampling, the same code for batch and stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..series import SeriesSpec, epoch_us, numeric_columns, wall_clock

SPEC = SeriesSpec()
ROWS = "__rows"     # rows that a written window has counted


def downsample(df: DataFrame, indicators: list[str] | None = None, every: str = "2 minutes",
               aggregates: dict[str, Column] | None = None, spec: SeriesSpec = SPEC) -> DataFrame:
    """One row per series and window: the mean of each indicator, or the given aggregates.

    Windows start at multiples of ``every``.  Aggregation is partial before the shuffle, and the
    shuffle key contains the window, so a busy series spreads over its windows.
    """
    if aggregates is None:
        aggregates = {c: F.avg(c) for c in indicators or numeric_columns(df, spec)}
    grouped = df.groupBy(*spec.keys, F.window(spec.time, every).alias("w"))
    return grouped.agg(*[a.alias(name) for name, a in aggregates.items()]).select(
        *spec.keys, F.col("w.start").alias(spec.time), *aggregates)


def normalised_variance(c: str) -> Column:
    """Population variance over the squared mean; NULL for a mean of 0."""
    return F.try_divide(F.var_pop(c), F.avg(c) * F.avg(c))


def throughput(bits: str, window_seconds: float) -> Column:
    """Transport-block bits of a window per second."""
    return F.sum(bits) / F.lit(float(window_seconds))


def user_count(user: str) -> Column:
    """Distinct users of a window, exactly; for streams see ``count_users_stream``."""
    return F.countDistinct(user)


def dropped_minutes(windows: DataFrame, columns: list[str] | None = None, window_minutes: float = 2,
                    spec: SeriesSpec = SPEC) -> DataFrame:
    """Minutes per series that the any-missing rule removes."""
    gap = F.lit(False)
    for c in columns or numeric_columns(windows, spec):
        gap = gap | F.col(c).isNull()
    return windows.groupBy(*spec.keys).agg(
        F.count(F.lit(1)).alias("n_windows"), F.count_if(gap).alias("n_dropped"),
        (F.count_if(gap) * F.lit(float(window_minutes))).alias("dropped_minutes"))


def downsample_stream(stream: DataFrame, out: str, checkpoint: str, every: str = "2 minutes",
                      lateness: str = "10 minutes", aggregates: dict[str, Column] | None = None,
                      spec: SeriesSpec = SPEC, available_now: bool = False) -> StreamingQuery:
    """Start the downsampling of a stream into a Parquet table.

    Every micro-batch writes the new versions of the windows it touched to a folder of its own, which a repeated
    batch replaces; ``read_windows`` gives the newest version of each, open windows included.  State is kept until
    the watermark (latest time seen minus ``lateness``) passes a window's end; rows that come after that (from the next
    micro-batch on) are left out, and ``late_by_window`` accounts for them.  Source offsets and state live in ``checkpoint``, so a restarted query continues without loss.
    """
    timed, naive = _instants(stream, spec)
    if aggregates is None:
        aggregates = {c: F.avg(c) for c in numeric_columns(stream, spec)}
    windows = downsample(timed.withWatermark(spec.time, lateness), every=every,
                         aggregates={**aggregates, ROWS: F.count(F.lit(1))}, spec=spec)
    if naive:
        windows = windows.withColumn(spec.time, wall_clock(F.col(spec.time)))

    return _started(windows.writeStream.outputMode("update"), out, checkpoint, available_now, lambda batch: batch)


def _instants(stream: DataFrame, spec: SeriesSpec) -> tuple[DataFrame, bool]:
    """The stream with instants, which a watermark needs; wall-clock times travel as if they were UTC."""
    naive = isinstance(stream.schema[spec.time].dataType, T.TimestampNTZType)
    return stream.withColumn(spec.time, F.timestamp_micros(epoch_us(stream, spec.time))) if naive else stream, naive


def _started(writer: DataStreamWriter, out: str, checkpoint: str, available_now: bool,
             shape: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    def write(batch: DataFrame, number: int) -> None:
        shape(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = writer.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def count_users_stream(stream: DataFrame, out: str, checkpoint: str, user: str, every: str = "2 minutes", lateness: str = "10 minutes",
                       name: str = "rnti_count", spec: SeriesSpec = SPEC, available_now: bool = False) -> StreamingQuery:
    """Start the exact count of a stream's distinct users per series and window; ``read_user_counts`` gives the result.

    Two stages: the state holds one small row per (series, window, user), spread over all tasks and dropped once the watermark
    passes the window, so no set of users is ever one value; each micro-batch then counts the users that are new to their
    window.  Counts of batches add up, and a repeated batch replaces its folder.  Set the state store to RocksDB where
    the users of all open windows exceed memory.
    """
    timed, naive = _instants(stream, spec)
    placed = timed.withWatermark(spec.time, lateness).select(*spec.keys, F.window(spec.time, every).alias("w"), F.col(user).alias("__user"))
    new = placed.where(F.col("__user").isNotNull()).dropDuplicates([*spec.keys, "w", "__user"])

    def count(batch: DataFrame) -> DataFrame:
        at = wall_clock(F.col("w.start")) if naive else F.col("w.start")
        return batch.groupBy(*spec.keys, at.alias(spec.time)).agg(F.count(F.lit(1)).alias(name))

    return _started(new.writeStream.outputMode("append"), out, checkpoint, available_now, count)


def read_user_counts(spark: SparkSession, out: str, name: str = "rnti_count", spec: SeriesSpec = SPEC) -> DataFrame:
    """Distinct users of every window that ``count_users_stream`` has seen, open windows included."""
    return spark.read.parquet(out).groupBy(*spec.keys, spec.time).agg(F.sum(name).alias(name))


def read_windows(spark: SparkSession, out: str, spec: SeriesSpec = SPEC) -> DataFrame:
    """The newest version of every window that ``downsample_stream`` has written."""
    return _newest(spark, out, spec).drop(ROWS)


def _newest(spark: SparkSession, out: str, spec: SeriesSpec) -> DataFrame:
    versions = spark.read.parquet(out)
    at = [*spec.keys, spec.time]
    values = [c for c in versions.columns if c not in (*at, "batch")]
    newest = versions.groupBy(*at).agg(F.max_by(F.struct(*values), "batch").alias("v"))
    return newest.select(*at, "v.*")


def compact_windows(spark: SparkSession, out: str, target: str, spec: SeriesSpec = SPEC) -> DataFrame:
    """Write the newest version of every window to ``target``, once each, as the table's batch −1.

    A later query over the same checkpoint may go on writing to ``target``: its versions win over the compacted ones.
    """
    _newest(spark, out, spec).write.mode("overwrite").parquet(f"{target}/batch=-1")
    return read_windows(spark, target, spec)


def late_by_window(rows: DataFrame, out: str, every: str = "2 minutes", spec: SeriesSpec = SPEC) -> DataFrame:
    """``(key, time, n_rows, n_counted, n_late)`` of every window of the rows a stream has read.

    A window's newest version says how many rows it counted; the rest came when it was closed.  The account follows from the
    two tables alone, so it is complete whatever restarts and however many batches there were.
    """
    at = [*spec.keys, spec.time]
    whole = downsample(rows, every=every, aggregates={"n_rows": F.count(F.lit(1))}, spec=spec)
    counted = _newest(rows.sparkSession, out, spec).select(*at, F.col(ROWS).alias("n_counted"))
    same = [F.col(f"w.{c}").eqNullSafe(F.col(f"c.{c}")) for c in at]
    joined = whole.alias("w").join(counted.alias("c"), same, "left")
    n = F.coalesce(F.col("n_counted"), F.lit(0))
    return joined.select(*[F.col(f"w.{c}").alias(c) for c in at], "n_rows", n.alias("n_counted"), (F.col("n_rows") - n).alias("n_late"))


def late_rows(query: StreamingQuery) -> int:
    """Rows that the query left out because their window was closed, as far as its progress reports go back."""
    return sum(int(s["numRowsDroppedByWatermark"]) for p in query.recentProgress for s in p["stateOperators"])
