"""Missing values and outliers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..plans.layout import Layout, neighbours, plan_layout
from ..plans.params import attach, settle
from ..plans.ranks import MAX_GROUP, melt, percentiles
from ..series import US, SeriesSpec, numeric_columns
from .project import drop_sparse_rows

SPEC = SeriesSpec()


def missing_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``(feature, n_missing)`` in one pass."""
    columns = columns or df.columns
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "feature", "n_missing")


def fill_constant(df: DataFrame, constant: float = 0.0, columns: list[str] | None = None,
                  spec: SeriesSpec = SPEC) -> DataFrame:
    return df.na.fill(float(constant), subset=columns or numeric_columns(df, spec))


def fill_mean(df: DataFrame, columns: list[str] | None = None, spec: SeriesSpec = SPEC) -> DataFrame:
    """Missing cells take the mean of their column."""
    columns = columns or numeric_columns(df, spec)
    return _filled(df, df.agg(*[F.avg(c).alias(c) for c in columns]).first().asDict())


def _filled(df: DataFrame, values: dict[str, float | None]) -> DataFrame:
    return df.select(*[F.coalesce(F.col(c), F.lit(values[c])).alias(c) if values.get(c) is not None
                       else F.col(c) for c in df.columns])


def clean_missing(df: DataFrame, threshold: float = 0.33, no_drop: bool = False,
                  spec: SeriesSpec = SPEC) -> DataFrame:
    """Sparse rows out, empty columns out, remaining gaps to the column mean."""
    kept = df if no_drop else drop_sparse_rows(df, threshold, spec=spec)
    columns = numeric_columns(kept, spec)
    # A column without values has no mean, so one pass answers both questions.
    means = kept.agg(*[F.avg(c).alias(c) for c in columns]).first().asDict()
    return _filled(kept.drop(*[c for c in columns if means[c] is None]), means)


def fill_by_time(df: DataFrame, columns: list[str] | None = None, spec: SeriesSpec = SPEC,
                 layout: Layout | None = None) -> DataFrame:
    """Missing cells from the nearest known values before and after, weighted by 1/distance.

    At the ends of a series the one known side is taken.
    """
    columns = columns or numeric_columns(df, spec)
    layout = layout or plan_layout(df, spec)
    found = neighbours(df, layout, columns)

    def filled(c: str) -> Column:
        before, after = F.col(f"__prev_{c}"), F.col(f"__next_{c}")
        to_before, to_after = F.col(US) - before["us"], after["us"] - F.col(US)
        between = (before["value"] * to_after + after["value"] * to_before) / (to_before + to_after)
        return F.coalesce(F.col(c), between, before["value"], after["value"])

    return layout.strip(found.select(
        *[filled(c).alias(c) if c in columns else F.col(c) for c in df.columns]))


def missing_runs(df: DataFrame, columns: list[str] | None = None, spec: SeriesSpec = SPEC,
                 layout: Layout | None = None) -> DataFrame:
    """Runs of consecutive missing cells: ``(key, feature, run_start, run_end, n_rows)``.

    All cells of a run share the known cell before them, so grouping by its time finds the runs
    with map-side counting, whatever their length.
    """
    columns = columns or numeric_columns(df, spec)
    layout = layout or plan_layout(df, spec)
    found = neighbours(df, layout, columns)
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).isNull().alias("missing"),
                               F.col(f"__prev_{c}.us").alias("since")) for c in columns])
    return (found.select(*spec.keys, spec.time, F.explode(cells).alias("cell"))
            .where("cell.missing")
            .groupBy(*spec.keys, F.col("cell.feature").alias("feature"),
                     F.col("cell.since").alias("__since"))
            .agg(F.min(spec.time).alias("run_start"), F.max(spec.time).alias("run_end"),
                 F.count(F.lit(1)).alias("n_rows"))
            .drop("__since"))


def load_rule(df: DataFrame, columns: list[str] | None = None,
              spec: SeriesSpec = SPEC) -> tuple[DataFrame, DataFrame]:
    """Drop rows with any missing indicator; also report what was dropped per series."""
    columns = columns or numeric_columns(df, spec)
    gap = F.lit(False)
    for c in columns:
        gap = gap | F.col(c).isNull()
    report = df.groupBy(*spec.keys).agg(F.count(F.lit(1)).alias("n_rows"),
                                        F.count_if(gap).alias("n_dropped"))
    return df.na.drop("any", subset=columns), report


def clip(value: Column, lo, hi) -> Column:
    """Value limited to [lo, hi]; missing stays missing, and a missing bound does not limit."""
    return F.when(value.isNotNull(), F.greatest(F.least(value, hi), lo))


def cap_bounds(df: DataFrame, columns: list[str], low: float = 10, high: float = 90,
               key: str | None = None, approximate: bool = False,
               max_group: int = MAX_GROUP) -> DataFrame:
    """``(key?, feature, lo, hi)`` percentile bounds over the non-missing values."""
    table = percentiles(df, columns, [low / 100, high / 100], key, max_group, approximate)
    return table.select(*([key] if key else []), "feature", F.get("q", 0).alias("lo"),
                        F.get("q", 1).alias("hi"))


def cap(df: DataFrame, columns: list[str], low: float = 10, high: float = 90,
        approximate: bool = False) -> DataFrame:
    """Floor and cap each column at its own percentiles over the whole frame."""
    bounds = {r["feature"]: r for r in cap_bounds(df, columns, low, high,
                                                  approximate=approximate).collect()}
    return df.select(*[clip(F.col(c), F.lit(bounds[c]["lo"]), F.lit(bounds[c]["hi"])).alias(c)
                       if c in bounds else F.col(c) for c in df.columns])


def cap_all_cells(df: DataFrame, columns: list[str] | None = None, low: float = 10,
                  high: float = 90, spec: SeriesSpec = SPEC) -> DataFrame:
    """Floor and cap at one pair of percentiles taken over all cells of all columns."""
    columns = columns or numeric_columns(df, spec)
    pair = percentiles(melt(df, [], columns), ["value"], [low / 100, high / 100]).first()["q"]
    return df.select(*[clip(F.col(c).cast("double"), F.lit(pair[0]), F.lit(pair[1])).alias(c)
                       if c in columns else F.col(c) for c in df.columns])


def cap_by_series(df: DataFrame, columns: list[str], pairs: dict[str, tuple[float, float]] | None = None,
                  exclude: list[str] | None = None, spec: SeriesSpec = SPEC, approximate: bool = False,
                  max_group: int = MAX_GROUP) -> DataFrame:
    """Floor and cap per series, each with its own percentile pair (default 10/90).

    With ``pairs`` every series of the data must have one; series in ``exclude`` pass unchanged.
    """
    wanted = sorted({p for pair in (pairs or {}).values() for p in pair} or {10, 90})
    spark, kind = df.sparkSession, df.schema[spec.key].dataType.simpleString()
    largest = _largest_of_known(df, columns, list(pairs), spec) if pairs else None
    table = percentiles(df, columns, [p / 100 for p in wanted], spec.key, max_group, approximate, largest)
    if pairs:
        ranks = spark.createDataFrame([(k, wanted.index(lo), wanted.index(hi)) for k, (lo, hi) in pairs.items()],
                                      f"`{spec.key}` {kind}, __lo int, __hi int")
        table = table.join(ranks, spec.key)
    else:
        table = table.select("*", F.lit(0).alias("__lo"), F.lit(1).alias("__hi"))
    bounds = table.select(spec.key, "feature", F.get("q", "__lo").alias("lo"), F.get("q", "__hi").alias("hi"))
    if exclude:
        bounds = bounds.join(spark.createDataFrame([(k,) for k in exclude], f"`{spec.key}` {kind}"), spec.key, "left_anti")
    wide = bounds.groupBy(spec.key).agg(
        *[F.max(F.when(F.col("feature") == c, F.struct("lo", "hi"))).alias(f"__{c}") for c in columns])
    joined = attach(df, settle(wide), [spec.key], [spec.time])
    return joined.select(*[
        F.coalesce(clip(F.col(c), F.col(f"__{c}.lo"), F.col(f"__{c}.hi")), F.col(c)).alias(c)
        if c in columns else F.col(c) for c in df.columns])


def unknown_series(df: DataFrame, known: DataFrame, spec: SeriesSpec = SPEC) -> DataFrame:
    """Series of the data without parameters."""
    return df.select(spec.key).distinct().join(known.select(spec.key), spec.key, "left_anti")


def _largest_of_known(df: DataFrame, columns: list[str], known: list[str], spec: SeriesSpec) -> int:
    """The most values a column has in one series, in one job that also refuses series that are not ``known``."""
    kind = df.schema[spec.key].dataType.simpleString()
    listed = df.sparkSession.createDataFrame([(k, True) for k in known], f"`{spec.key}` {kind}, __known boolean")
    counts = df.groupBy(spec.key).agg(F.greatest(*[F.count(c) for c in columns], F.lit(0)).alias("__n"))
    stray = F.when(F.col("__known").isNull(), F.coalesce(F.col(spec.key).cast("string"), F.lit("NULL")))
    told = counts.join(F.broadcast(listed), spec.key, "left").agg(F.max("__n").alias("n"), F.min(stray).alias("stray")).first()
    if told["stray"] is not None:
        raise ValueError(f"no parameters for series such as {told['stray']}")
    return told["n"] or 0
