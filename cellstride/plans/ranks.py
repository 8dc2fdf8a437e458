"""Exact percentiles without holding a group in memory.

Spark's exact ``percentile`` keeps every distinct value of a group in one aggregation buffer.
That is fine for a group that was counted and is small.  For larger groups each wanted rank is
bracketed between two values of an approximate sketch; exact counts below and inside the bracket
narrow it until few distinct values remain, and only those are sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .params import Settled, attach, settle

MAX_GROUP = 1_000_000
ACCURACY = 10_000
MARGIN = 3 / ACCURACY
PROBES = 256


def percentiles(df: DataFrame, columns: list[str], probs: list[float], key: str | None = None,
                max_group: int | None = None, approximate: bool = False, largest: int | None = None) -> DataFrame:
    """Linearly interpolated percentiles of the non-missing values.

    Returns ``(key?, feature, n, q)`` with ``q`` in the order of ``probs``.  ``approximate``
    trades exactness for a single pass.  ``largest``, the largest group's count where known, saves counting.
    """
    keys = [key] if key else []
    limit = MAX_GROUP if max_group is None else max(max_group, 4 * PROBES)
    grid = F.array(*[F.lit(float(p)) for p in probs])
    if approximate:
        return _melted(df.groupBy(*keys).agg(*[
            F.struct(F.count(c).alias("n"),
                     F.transform(F.percentile_approx(c, grid, ACCURACY), lambda v: v.cast("double"))
                     .alias("q")).alias(c) for c in columns]), keys, columns)
    counts = df.groupBy(*keys).agg(*[F.count(c).alias(c) for c in columns])
    if largest is None:
        largest = counts.agg(F.greatest(*[F.max(c) for c in columns], F.lit(0)).alias("n")).first()["n"]
    if (largest or 0) <= limit:
        return _melted(df.groupBy(*keys).agg(*[
            F.struct(F.count(c).alias("n"),
                     F.percentile(F.col(c).cast("double"), grid).alias("q")).alias(c)
            for c in columns]), keys, columns)
    return _bracketed(df, columns, probs, keys, limit)


def _melted(wide: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`.n").alias("n"),
                               F.col(f"`{c}`.q").alias("q")) for c in columns])
    return wide.select(*keys, F.explode(cells).alias("cell")).select(*keys, "cell.*")


def melt(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``(key…, feature, value)`` rows of the non-missing cells."""
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
                      for c in columns])
    return (df.select(*keys, F.explode(cells).alias("cell")).select(*keys, "cell.*")
            .where("value is not null"))


def _bracketed(df: DataFrame, columns: list[str], probs: list[float], keys: list[str],
               limit: int) -> DataFrame:
    group = [*keys, "feature"]
    rows = melt(df, keys, columns)
    # One sketch per group brackets every target.  Its rank error is 1/ACCURACY of the group; the
    # bracket is three times as wide on either side, or the whole range where that is a few rows.
    sides = F.array(*[F.lit(min(1.0, max(0.0, p + s * MARGIN))) for p in probs for s in (-1, 1)])
    targets = F.array(*[F.struct(F.lit(i).alias("target"), F.lit(float(p)).alias("p"))
                        for i, p in enumerate(probs)])
    sketched = (rows.groupBy(*group)
                .agg(F.count("value").alias("n"), F.min("value").alias("min"), F.max("value").alias("max"),
                     F.percentile_approx("value", sides, ACCURACY).alias("q"))
                .withColumn("t", F.explode(targets)))
    p, few = F.col("t.p"), F.col("n") * MARGIN < 10
    state = settle(sketched.select(
        *group, "n", "min", "max", "t.target", (p * (F.col("n") - 1)).alias("pos"),
        F.when(few | (p <= MARGIN), F.col("min")).otherwise(F.get("q", F.col("t.target") * 2)).alias("lo"),
        F.when(few | (p >= 1 - MARGIN), F.col("max")).otherwise(F.get("q", F.col("t.target") * 2 + 1)).alias("hi")))
    while True:
        widest = state.df.agg(F.max(F.when(F.col("lo") < F.col("hi"), F.col("n")))).first()[0] or 0
        if widest * 4 * MARGIN > limit:
            state = _narrowed(rows, state, group, limit)
        picked = _picked(rows, state, group)
        if not picked.df.where("low or high").limit(1).count():
            break
        # The sketch missed a rank: look on the side where the counts say it is.
        state = settle(picked.df.select(
            *group, "n", "min", "max", "target", "pos",
            F.when(F.col("low"), F.col("min")).when(F.col("high"), F.col("hi")).otherwise(F.col("lo")).alias("lo"),
            F.when(F.col("low"), F.col("lo")).when(F.col("high"), F.col("max")).otherwise(F.col("hi")).alias("hi")))
    return (picked.df.groupBy(*group, "n")
            .agg(F.sort_array(F.collect_list(F.struct("target", "v"))).alias("s"))
            .select(*group, "n", F.transform("s", lambda s: s["v"]).alias("q")))


def _picked(rows: DataFrame, state: Settled, group: list[str]) -> Settled:
    """The value of each wanted rank, and whether the rank lies below or above its bracket."""
    # Rows below a bracket collapse to one key before the shuffle, so they travel as a count.
    spots = ["target", "n", "min", "max", "lo", "hi", "pos"]
    kept = (_with_state(rows, state, group).where(F.col("value") <= F.col("hi"))
            .withColumn("value", F.when(F.col("value") >= F.col("lo"), F.col("value"))))
    counts = kept.groupBy(*group, *spots, "value").agg(F.count(F.lit(1)).alias("m"))
    upto = F.sum("m").over(Window.partitionBy(*group, "target").orderBy("value")
                           .rowsBetween(Window.unboundedPreceding, 0))
    picked = (counts.withColumn("upto", upto).groupBy(*group, *spots)
              .agg(F.min(F.when(F.col("upto") > F.floor("pos"), F.col("value"))).alias("v0"),
                   F.min(F.when(F.col("upto") > F.ceil("pos"), F.col("value"))).alias("v1"),
                   F.coalesce(F.max(F.when(F.col("value").isNull(), F.col("m"))), F.lit(0)).alias("below")))
    value = F.col("v0") + (F.col("v1") - F.col("v0")) * (F.col("pos") - F.floor("pos"))
    low, high = F.col("below") > F.floor("pos"), F.col("v1").isNull()
    both = low & high  # the two neighbours of a rank on either side of the bracket: start from the whole range
    return settle(picked.select(
        *group, "n", "min", "max", "target", "pos", F.when(both, F.col("min")).otherwise(F.col("lo")).alias("lo"),
        F.when(both, F.col("max")).otherwise(F.col("hi")).alias("hi"), low.alias("low"), (high & ~low).alias("high"), value.alias("v")))


def _narrowed(rows: DataFrame, state: Settled, group: list[str], limit: int) -> Settled:
    """Brackets of at most about ``limit`` distinct values, by exact counts and sketches inside.

    Every round narrows each wide bracket or finds that it can get no narrower.
    """
    probes = F.array(*[F.lit(i / PROBES) for i in range(PROBES + 1)])
    while True:
        inside = F.col("value").between(F.col("lo"), F.col("hi"))
        measured = settle(
            _with_state(rows, state, group).groupBy(*group, "target")
            .agg(F.first("n").alias("n"), F.first("min").alias("min"), F.first("max").alias("max"), F.first("pos").alias("pos"), F.first("lo").alias("lo"),
                 F.first("hi").alias("hi"), F.count_if(F.col("value") < F.col("lo")).alias("below"),
                 F.count_if(inside).alias("inside"),
                 F.approx_count_distinct(F.when(inside, F.col("value"))).alias("distinct"),
                 F.percentile_approx(F.when(inside, F.col("value")), probes, ACCURACY).alias("q")))
        small = (F.col("distinct") <= limit) | (F.col("lo") >= F.col("hi"))
        if not measured.df.where(~small).limit(1).count():
            break
        at = F.floor((F.floor("pos") - F.col("below")) / F.col("inside") * PROBES).cast("int")
        inner = settle(measured.df.select(
            *group, "n", "min", "max", "target", "pos",
            F.when(small, F.col("lo")).otherwise(F.get("q", F.greatest(at - 2, F.lit(0)))).alias("lo"),
            F.when(small, F.col("hi")).otherwise(F.get("q", F.least(at + 3, F.lit(PROBES)))).alias("hi")))
        # (key, feature, target, lo, hi) as before: only single values are left to split
        if not inner.df.select(*group, "target", "lo", "hi").exceptAll(state.df.select(*group, "target", "lo", "hi")).limit(1).count():
            break
        state = inner
    return state


def _with_state(rows: DataFrame, state: Settled, group: list[str]) -> DataFrame:
    return attach(rows, state, group, ["value"], "inner")
