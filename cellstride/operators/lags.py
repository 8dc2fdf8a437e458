"""Lag features, sampling regularity and the chronological split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..plans.layout import (Layout, halo, instants_at, over_rows, plan_layout, row_index, row_positions,
                            rows_before_slot, same_instant)
from ..plans.params import attach, settle
from ..series import US, SeriesSpec, numeric_columns
from ..sources.staging import stage

SPEC = SeriesSpec()
TOLERANCE_US = 10_000          # fixed value: steps this close to the modal period count as equal
HIGHLY_IRREGULAR_BELOW = 75.0  # fixed values: percent of steps that match the modal period
IRREGULAR_BELOW = 90.0
MAX_COPIES = 4                 # slots a row may be copied into before lags are joined instead


def lag_name(column: str, n: int) -> str:
    return f"{column}_lag_{n}"


def lag_columns(columns: list[str], n_lags: int) -> list[str]:
    """Model input order: oldest lag first, features reversed inside each lag."""
    return [lag_name(c, n) for n in range(n_lags, 0, -1) for c in reversed(columns)]


def row_lags(df: DataFrame, n_lags: int = 10, columns: list[str] | None = None, keep: str = "lags",
             spec: SeriesSpec = SPEC, layout: Layout | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """The value 1…``n_lags`` rows back, 0 where missing; the first ``n_lags`` rows of a series go.

    ``keep`` chooses the output next to key and time: ``lags`` (input order, see
    ``lag_columns``), ``values`` (the original features) or ``both``.  Columns in ``carry`` come along as they are.
    """
    columns = columns or numeric_columns(df, spec)
    layout = layout or plan_layout(df, spec)
    values = [*(columns if keep in ("values", "both") else []), *carry]
    names = lag_columns(columns, n_lags) if keep in ("lags", "both") else []
    if keep not in ("lags", "values", "both"):
        raise ValueError(keep)

    def build(rows: DataFrame, w) -> DataFrame:
        extra = [c for c in rows.columns if c.startswith("__")]
        lagged = [F.coalesce(F.lag(F.col(c).cast("double"), n).over(w), F.lit(0.0)).alias(lag_name(c, n))
                  for n in range(1, n_lags + 1) for c in columns] if names else []
        return (rows.select("*", F.lag(US, n_lags).over(w).isNotNull().alias("__deep"), *lagged)
                .where("__deep").select(*spec.keys, spec.time, *values, *names, *extra))

    return over_rows(df, layout, n_lags, build)


def time_lags(df: DataFrame, n_lags: int, step: int = 1, columns: list[str] | None = None,
              period_us: int | None = None, spec: SeriesSpec = SPEC, layout: Layout | None = None,
              method: str = "auto") -> DataFrame:
    """The value at exactly t − n·period, missing if the series has no such instant.

    n = step, 2·step, … step·n_lags.  The first ``n_lags`` rows of each series go.  Without
    ``period_us`` every series uses its modal period.  ``frame`` reads the lags from one sorted
    window; ``join`` matches on (key, time), which suits horizons much longer than a slot.
    """
    columns = columns or numeric_columns(df, spec)
    layout = layout or plan_layout(df, spec)
    steps = [step * i for i in range(1, n_lags + 1)]
    periods = None
    if period_us is None:
        periods = settle(modal_periods(df, spec, layout).select(*spec.keys, F.col("period_us").alias("__period")))
        common = periods.distinct("__period") if periods.bounded else []
        if len(common) == 1:
            period_us = common[0]
            if period_us is None:
                raise ValueError("fewer than two rows; no sampling period")
    if method == "auto":
        method = "frame" if period_us and _copies(layout, steps[-1] * period_us) <= MAX_COPIES else "join"
    if method == "frame" and period_us is None:
        raise ValueError("the series differ in period; use method='join'")
    if method == "frame":
        return _lags_by_frame(df, layout, steps, columns, period_us, n_lags)
    return _drop_first(_lags_by_join(df, layout, steps, columns, period_us, periods), df, layout, n_lags)


def _copies(layout: Layout, horizon_us: int) -> int:
    if not layout.sliced:
        return 1
    narrowest = layout.cuts.df.agg(F.min("__width").alias("w")).first()["w"]
    return horizon_us // narrowest + 1


def _lags_by_frame(df: DataFrame, layout: Layout, steps: list[int], columns: list[str],
                   period_us: int, skip: int) -> DataFrame:
    """Lags, the position that decides on the first rows, and the check for equal instants, all
    in the one sorted window."""
    placed = rows_before_slot(halo(df, layout, steps[-1] * period_us), df, layout, skip)
    w = layout.window

    def at(n: int):
        return w.rangeBetween(-n * period_us, -n * period_us)

    own = F.sum(F.when(F.col("__copy"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    lagged = placed.select("*", *[F.first(c).over(at(n)).alias(lag_name(c, n)) for n in steps for c in columns],
                           own.alias("__own"), F.lag(US).over(w).alias("__last"))
    deep = F.when(F.col("__last") == F.col(US), same_instant("boolean")).otherwise(F.col("__before") + F.col("__own") > skip)
    return layout.strip(lagged.where(~F.col("__copy") & deep))


def _lags_by_join(df: DataFrame, layout: Layout, steps: list[int], columns: list[str],
                  period_us: int | None, periods) -> DataFrame:
    """Send every row to the instants that look back at it, and gather per instant, in one shuffle for all lags.

    (key, time) is unique, so an instant receives one row of its own and at most one for each lag; an instant with two
    rows of its own is refused.
    """
    placed = layout.place(df)
    if period_us is not None:
        placed = placed.withColumn("__period", F.lit(period_us))
    else:
        placed = attach(placed, periods, layout.spec.keys, [US])
    own = [c for c in placed.columns if c != "__period"]
    sent = placed.select(
        F.col(layout.key).alias("__to"), F.struct(*own).alias("__row"), "__period", US, F.explode(F.array(*map(F.lit, [0, *steps]))).alias("__n"))
    is_own = F.col("__n") == 0
    sent = sent.select("__to", F.when(is_own, F.col(US)).otherwise(F.col(US) + F.col("__n") * F.col("__period")).alias("__at"), "__n",
                       F.when(is_own, F.col("__row")).alias("__own"), F.when(~is_own, F.struct(*[F.col("__row")[c].alias(c) for c in columns])).alias("__seen"))
    met = sent.groupBy("__to", "__at").agg(
        F.count("__own").alias("__owns"), F.first("__own", ignorenulls=True).alias("__own"),
        *[F.first(F.when(F.col("__n") == n, F.col("__seen")), ignorenulls=True).alias(f"__{n}") for n in steps])
    lone = F.when(F.col("__owns") > 1, same_instant("boolean")).otherwise(F.col("__owns") == 1)
    return met.where(lone).select("__own.*", *[F.col(f"__{n}")[c].alias(lag_name(c, n)) for n in steps for c in columns])


def _drop_first(lagged: DataFrame, df: DataFrame, layout: Layout, n: int) -> DataFrame:
    """Drop the first ``n`` rows of each series, found by their times."""
    first = first_instants(df, layout, n)
    cut = attach(lagged, first, layout.spec.keys, [US]) if layout.spec.key else \
        lagged.withColumn("__cut", F.lit(None if first.empty else first.one()["__cut"]).cast("long"))
    return layout.strip(cut.where(F.col(US) > F.col("__cut")))


def first_instants(df: DataFrame, layout: Layout, n: int):
    """Time coordinate of the n-th row per series; series with fewer rows are absent."""
    at = instants_at(df, layout, lambda total: F.when(total >= n, F.lit(n)).cast("long"))
    return settle(at.select(*layout.spec.keys, F.col("instant_us").alias("__cut")))


def time_differences(df: DataFrame, spec: SeriesSpec = SPEC, layout: Layout | None = None) -> DataFrame:
    """Microseconds since the previous row of the series, NULL on the first."""
    layout = layout or plan_layout(df, spec)

    def build(rows: DataFrame, w) -> DataFrame:
        extra = [c for c in rows.columns if c.startswith("__")]
        return rows.select(*spec.keys, spec.time, (F.col(US) - F.lag(US).over(w)).alias("diff_us"), *extra)

    return over_rows(df.select(*spec.keys, spec.time, *spec.ties), layout, 1, build)


def difference_counts(df: DataFrame, spec: SeriesSpec = SPEC, layout: Layout | None = None) -> DataFrame:
    """Value counts of the steps: ``(key, diff_us, n)``."""
    return (time_differences(df, spec, layout).where("diff_us is not null")
            .groupBy(*spec.keys, "diff_us").agg(F.count(F.lit(1)).alias("n")))


def modal_periods(df: DataFrame, spec: SeriesSpec = SPEC, layout: Layout | None = None) -> DataFrame:
    """``(key, period_us)``: the most common step, the smallest of ties."""
    return _modes(difference_counts(df, spec, layout), spec)


def _modes(counts: DataFrame, spec: SeriesSpec) -> DataFrame:
    top = F.max(F.struct(F.col("n"), (-F.col("diff_us")).alias("neg")))
    return counts.groupBy(*spec.keys).agg((-top["neg"]).alias("period_us"))


def sampling_report(df: DataFrame, spec: SeriesSpec = SPEC, layout: Layout | None = None) -> DataFrame:
    """``(key, period_us, n_rows, n_match, pct, verdict)``.

    The percentage refers to the number of rows, one more than the number of steps, because the
    bounds of the verdict do.  A series with fewer than two rows has no period.
    """
    steps = time_differences(df, spec, layout)
    # Written once: the modes and the matches both read it.
    counts = stage(steps.groupBy(*spec.keys, "diff_us").agg(F.count(F.lit(1)).alias("n")), "steps")
    modes = _modes(counts.where("diff_us is not null"), spec)
    if spec.key:
        judged = attach(counts, settle(modes), spec.keys, ["diff_us"])
    else:
        judged = counts.withColumn("period_us", F.lit(modes.first()["period_us"]).cast("long"))
    match = F.abs(F.col("diff_us") - F.col("period_us")) <= TOLERANCE_US
    pct = F.col("n_match") / F.col("n_rows") * 100
    return (judged.groupBy(*spec.keys)
            .agg(F.max("period_us").alias("period_us"), F.sum("n").alias("n_rows"),
                 F.coalesce(F.sum(F.when(match, F.col("n"))), F.lit(0)).alias("n_match"))
            .withColumn("pct", pct)
            .withColumn("verdict", F.when(F.col("period_us").isNull(), "too few rows")
                        .when(F.col("pct") < HIGHLY_IRREGULAR_BELOW, "highly irregular")
                        .when(F.col("pct") < IRREGULAR_BELOW, "irregular").otherwise("regular")))


def mark_split(df: DataFrame, train_size: float = 0.8, spec: SeriesSpec = SPEC,
               layout: Layout | None = None, skip: int = 0) -> DataFrame:
    """Add ``is_train``: the first ceil(train_size · n) rows of each series, by position.

    The first ``skip`` rows of a series do not count towards n and are on the training side.  Rows of one
    instant are told apart by ``spec.ties``; without ties they are refused.
    """
    placed = row_positions(df, layout or plan_layout(df, spec))
    n_train = F.ceil(F.lit(float(train_size)) * F.greatest(F.col("__total") - skip, F.lit(0)))
    return placed.select(*df.columns, (F.col("__position") < skip + n_train).alias("is_train"))


def split_train_val(df: DataFrame, train_size: float = 0.8, spec: SeriesSpec = SPEC,
                    layout: Layout | None = None) -> tuple[DataFrame, DataFrame]:
    marked = mark_split(df, train_size, spec, layout)
    return marked.where("is_train").drop("is_train"), marked.where("not is_train").drop("is_train")


def split_report(marked: DataFrame, spec: SeriesSpec = SPEC) -> DataFrame:
    """Rows in total, for training and for validation, per series and over all (key NULL)."""
    return marked.rollup(*spec.keys).agg(
        F.count(F.lit(1)).alias("n_total"), F.count_if(F.col("is_train")).alias("n_train"),
        F.count_if(~F.col("is_train")).alias("n_val"))


def skip_rows(df: DataFrame, n: int, spec: SeriesSpec = SPEC, layout: Layout | None = None) -> DataFrame:
    """Rows after the first ``n`` of each series, by position; see ``mark_split`` for equal instants."""
    if not n:
        return df
    return row_positions(df, layout or plan_layout(df, spec)).where(F.col("__position") >= n).select(*df.columns)


#: Half the width, in bits, of the numbers a shuffle permutes, and its rounds.
HALF_BITS = 24


def shuffle_keys(seed: int, rounds: int = 6) -> list[tuple[int, int]]:
    """Factor (odd) and summand of each round of ``permuted``."""
    state, out = seed, []
    for _ in range(rounds):
        state = (state * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append((state >> 34 | 1, state >> 16 & (1 << 30) - 1))
    return out


def permuted(position: Column, seed: int) -> Column:
    """A seeded permutation of the numbers below 2^48 (a Feistel network): different positions give different numbers.

    Plain integer arithmetic, so any SQL engine can repeat it.
    """
    mask = F.lit((1 << HALF_BITS) - 1).cast("long")
    left, right = F.shiftright(position, HALF_BITS), position.bitwiseAND(mask)
    for factor, summand in shuffle_keys(seed):
        mixed = F.shiftright(right * F.lit(factor) + F.lit(summand), 11).bitwiseAND(mask)
        left, right = right, left.bitwiseXOR(mixed)
    return F.shiftleft(left, HALF_BITS) + right


def batch_ids(df: DataFrame, batch_size: int, shuffle_seed: int | None = None,
              spec: SeriesSpec = SPEC, layout: Layout | None = None) -> DataFrame:
    """Add ``batch_id``: consecutive rows of a series, or a seeded shuffle of them.

    The shuffle orders a series by ``permuted`` row positions, so it depends on the order of the rows and the seed alone.
    """
    indexed = row_index(df, layout or plan_layout(df, spec), "batch_row")
    if shuffle_seed is not None:
        mixed = indexed.withColumn(US, permuted(F.col("batch_row"), shuffle_seed)).drop("batch_row")
        indexed = row_index(mixed, plan_layout(mixed, spec), "batch_row")
    return indexed.select(*df.columns, F.expr(f"batch_row div {batch_size}").alias("batch_id"))
