"""Ordered work on long series.

A window partitioned by the series key puts a whole series into one task.  With few series, or
one that holds a third of all rows, that task never ends.  A ``Layout`` cuts each long series
into time slots of about ``rows_per_slot`` rows, and the helpers below make the results
independent of the cut:

* ``over_rows``   expressions that look back a fixed number of rows,
* ``halo``        expressions that look back a fixed length of time,
* ``neighbours``  the nearest known value on either side, however far away,
* ``row_index``   the position of a row in its series.

Series that fit a slot stay whole, so short series cost one ordinary window.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, WindowSpec, functions as F

from ..series import SERIES, US, SeriesSpec, epoch_us
from ..sources.staging import stage
from .params import Settled, attach, settle

ROWS_PER_SLOT = 1_000_000
PARTS_PER_SLOT = 64        # the copied end of a slot is about this fraction of it
SLOT = "__slot"
CUT = ["__t0", "__t1", "__width"]


@dataclass(frozen=True)
class Layout:
    spec: SeriesSpec
    rows_per_slot: int
    cuts: Settled | None = None      # key, first and last instant, slot width of the cut series

    @property
    def key(self) -> str:
        return self.spec.key or SERIES

    @property
    def sliced(self) -> bool:
        return self.cuts is not None

    @property
    def parts(self) -> list[str]:
        return [self.key, SLOT] if self.sliced else [self.key]

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.parts).orderBy(US, *self.spec.ties)

    def place(self, df: DataFrame, keep_cut: bool = False) -> DataFrame:
        """Add the order coordinate and, for cut series, the slot of each row."""
        out = _coordinates(df, self.spec)
        if not self.sliced:
            return out
        if self.spec.key is None:
            cut = self.cuts.one()
            out = out.select("*", *[F.lit(cut[c]).alias(c) for c in CUT])
        else:
            out = attach(out, self.cuts, [self.key], [US])
        slot = F.coalesce(F.expr(f"({US} - __t0) div __width"), F.lit(0))
        placed = out.withColumn(SLOT, slot)
        return placed if keep_cut else placed.drop(*CUT)

    def slots(self, df: DataFrame) -> DataFrame:
        """Rows per slot, rows before it in the series, and rows of the series."""
        series = Window.partitionBy(self.key)
        counts = self.place(df).groupBy(*self.parts).agg(F.count(F.lit(1)).alias("n"))
        if not self.sliced:
            return counts.select("*", F.lit(0).cast("long").alias("offset"), F.col("n").alias("total"))
        before = series.orderBy(SLOT).rowsBetween(Window.unboundedPreceding, -1)
        return counts.select("*", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
                             F.sum("n").over(series).alias("total"))

    def strip(self, df: DataFrame) -> DataFrame:
        return df.drop(*[c for c in df.columns if c.startswith("__")])


def _coordinates(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    out = df if US in df.columns else df.withColumn(US, epoch_us(df, spec.time))
    return out if spec.key else out.withColumn(SERIES, F.lit(0))


def plan_layout(df: DataFrame, spec: SeriesSpec = SeriesSpec(),
                rows_per_slot: int | None = None) -> Layout:
    """Measure the series and cut the long ones.

    Slots start equally wide within a series.  While one of them is overfull because the
    measurements cluster in time, its series gets narrower slots; distinct instants guarantee
    that this ends.
    """
    per_slot = rows_per_slot or ROWS_PER_SLOT
    base = _coordinates(df, spec)
    key = spec.key or SERIES
    long_series = (
        base.groupBy(*spec.keys)
        .agg(F.count(F.lit(1)).alias("n"), F.min(US).alias("__t0"), F.max(US).alias("__t1"))
        .where(F.col("n") > per_slot)
        .select(*spec.keys, "__t0", "__t1", F.greatest(
            F.lit(1), F.ceil((F.col("__t1") - F.col("__t0") + 1) / F.col("n") * per_slot)
        ).cast("long").alias("__width")))
    cuts = settle(long_series)
    if cuts.empty:
        return Layout(spec, per_slot)
    narrow = F.greatest(F.lit(1), F.expr("__width div 8"))
    while True:
        layout = Layout(spec, per_slot, cuts)
        placed = layout.place(base)
        counts = placed.groupBy(key, SLOT).agg(F.count(F.lit(1)).alias("n"))
        if spec.key is None:
            worst = counts.agg(F.max("n").alias("n")).first()["n"]
            cut = cuts.one()
            if worst <= 4 * per_slot or cut["__width"] == 1:
                return layout
            narrower = cuts.df.withColumn("__width", narrow)
        else:
            crowded = settle(counts.where(F.col("n") > 4 * per_slot).select(key).distinct()
                             .withColumn("__crowded", F.lit(True)))
            if crowded.empty:
                return layout
            joined = cuts.df.join(crowded.df, key, "left")
            if not joined.where("__crowded and __width > 1").limit(1).count():
                return layout
            narrower = joined.withColumn("__width", F.when(F.col("__crowded"), narrow)
                                         .otherwise(F.col("__width"))).drop("__crowded")
        cuts = settle(narrower)


def over_rows(df: DataFrame, layout: Layout, reach: int,
              build: Callable[[DataFrame, WindowSpec], DataFrame]) -> DataFrame:
    """Apply ``build(rows, window)``, which may look back up to ``reach`` rows of the series.

    In a cut series the last rows of each slot are copied to the front of the slots that look back at them, usually just
    the next one, and the copies are dropped after the window.
    """
    placed = layout.place(df)
    if not layout.sliced:
        return layout.strip(build(placed, layout.window))
    ends = settle(_slot_ends(df, layout, reach))
    joined = attach(placed, ends, layout.parts, [US]).withColumn("__own", F.col(SLOT))
    later = F.transform(F.filter(F.coalesce("__next", F.array().cast(ends.df.schema["__next"].dataType)),
                                 lambda t: F.col(US) >= t["from"]), lambda t: t["slot"])
    copied = (joined.withColumn(SLOT, F.explode(F.concat(F.array(SLOT), later)))
              .withColumn("__copy", F.col(SLOT) != F.col("__own")).drop("__own", "__next"))
    return layout.strip(build(copied, layout.window).where("not __copy"))


def _slot_ends(df: DataFrame, layout: Layout, reach: int) -> DataFrame:
    """Per slot of a cut series, ``__next``: the later slots that look back into it, and from which time on.

    Counts over parts of a slot bracket the place; nothing is sorted.  A slot with rows has at least one, so only the
    ``reach`` slots behind it can look back into it, and only the first of them does where slots are full.
    """
    placed = layout.place(df, keep_cut=True).where("__width is not null")
    part = F.expr(f"({US} - __t0 - {SLOT} * __width) div greatest(1, __width div {PARTS_PER_SLOT})")
    counts = stage(placed.groupBy(*layout.parts, part.alias("__part")).agg(
        F.count(F.lit(1)).alias("n"), F.min(US).alias("__lo")), "slot-parts")
    from_end = (Window.partitionBy(*layout.parts).orderBy(F.desc("__part"))
                .rowsBetween(Window.unboundedPreceding, 0))
    parts = counts.select(*layout.parts, "__lo", F.sum("n").over(from_end).alias("__seen"))
    in_series = Window.partitionBy(layout.key).orderBy(SLOT)
    slots = counts.groupBy(*layout.parts).agg(F.sum("n").alias("__n")).withColumn(
        "__end", F.sum("__n").over(in_series.rowsBetween(Window.unboundedPreceding, 0)))
    following = F.collect_list(F.struct(F.col(SLOT).alias("slot"), (F.col("__end") - F.col("__n")).alias("start")))
    wanted = (slots.withColumn("__later", following.over(in_series.rowsBetween(1, reach)))
              .select(*layout.parts, "__end", F.explode("__later").alias("t")).where(F.col("t.start") - F.col("__end") < reach)
              .select(*layout.parts, F.col("t.slot").alias("__to"), (reach - F.col("t.start") + F.col("__end")).alias("__need")))
    found = wanted.join(parts, layout.parts).groupBy(*layout.parts, "__to").agg(F.coalesce(
        F.max(F.when(F.col("__seen") >= F.col("__need"), F.col("__lo"))), F.min("__lo")).alias("__from"))
    return found.groupBy(*layout.parts).agg(F.collect_list(F.struct(
        F.col("__to").alias("slot"), F.col("__from").alias("from"))).alias("__next"))


def halo(df: DataFrame, layout: Layout, horizon_us: int) -> DataFrame:
    """Rows placed in their slot and copied into the later slots that look back at them.

    Copies carry ``__copy``; drop them after the window.
    """
    placed = layout.place(df, keep_cut=True)
    if not layout.sliced:
        return placed.withColumn("__copy", F.lit(False))
    last = F.coalesce(F.expr(f"(least({US} + {horizon_us}, __t1) - __t0) div __width"), F.col(SLOT))
    return (placed.withColumn("__own", F.col(SLOT))
            .withColumn(SLOT, F.explode(F.sequence(F.col("__own"), F.greatest(F.col("__own"), last))))
            .withColumn("__copy", F.col(SLOT) != F.col("__own"))
            .drop("__own", *CUT))


def rows_before_slot(placed: DataFrame, df: DataFrame, layout: Layout, n: int) -> DataFrame:
    """Add ``__before``: rows of the series ahead of the row's slot, counted up to ``n``.

    Only later slots of a cut series with fewer than ``n`` rows ahead need a look-up; there are
    less than ``n`` of them per cut series.
    """
    if not layout.sliced:
        return placed.withColumn("__before", F.lit(0))
    early = (layout.slots(df).where((F.col(SLOT) > 0) & (F.col("offset") < n))
             .select(*layout.parts, F.col("offset").alias("__offset")))
    return attach(placed, settle(early), layout.parts, [US]).withColumn(
        "__before", F.when(F.col(SLOT) > 0, F.coalesce(F.col("__offset"), F.lit(n))).otherwise(F.lit(0))
    ).drop("__offset")


def neighbours(df: DataFrame, layout: Layout, columns: list[str]) -> DataFrame:
    """Add ``__prev_c`` and ``__next_c`` (structs of time and value) for each column.

    They hold the nearest known value strictly before and after the row.  Inside a slot a window
    finds them; across slots one known value per slot and side is carried on.
    """
    placed = layout.place(df)
    known = [F.when(F.col(c).isNotNull(), F.struct(F.col(US).alias("us"), F.col(c).alias("value"))).alias(f"__at_{c}")
             for c in columns]
    # LAG and LEAD that ignore NULLs share one sort and read on from the last hit; a frame that
    # shrinks (…, UNBOUNDED FOLLOWING) would be recomputed for every row.
    over = f"OVER (PARTITION BY {', '.join(f'`{p}`' for p in layout.parts)} ORDER BY {US})"
    found = placed.select("*", *known).select(
        "*", *[F.expr(f"lag(`__at_{c}`) IGNORE NULLS {over}").alias(f"__prev_{c}") for c in columns],
        *[F.expr(f"lead(`__at_{c}`) IGNORE NULLS {over}").alias(f"__next_{c}") for c in columns]
    ).drop(*[f"__at_{c}" for c in columns])
    if not layout.sliced:
        return found
    # max_by and min_by keep primitive buffers, so these ends combine in a hash table per task.
    ends = placed.groupBy(*layout.parts).agg(*[
        end for c in columns for at in [F.when(F.col(c).isNotNull(), F.col(US))] for end in (
            F.max(at).alias(f"__hi_us_{c}"), F.max_by(c, at).alias(f"__hi_{c}"),
            F.min(at).alias(f"__lo_us_{c}"), F.min_by(c, at).alias(f"__lo_{c}"))])

    def end(side: str, c: str):
        us = F.col(f"__{side}_us_{c}")
        return F.when(us.isNotNull(), F.struct(us.alias("us"), F.col(f"__{side}_{c}").alias("value")))

    grown = (Window.unboundedPreceding, -1)
    by_slot = Window.partitionBy(layout.key)
    earlier = by_slot.orderBy(SLOT).rowsBetween(*grown)
    later = by_slot.orderBy(F.desc(SLOT)).rowsBetween(*grown)
    carried = ends.select(
        *layout.parts,
        *[F.last(end("hi", c), ignorenulls=True).over(earlier).alias(f"__before_{c}") for c in columns],
        *[F.last(end("lo", c), ignorenulls=True).over(later).alias(f"__after_{c}") for c in columns])
    joined = found.join(carried, layout.parts, "left")
    for c in columns:
        joined = (joined.withColumn(f"__prev_{c}", F.coalesce(f"__prev_{c}", f"__before_{c}"))
                  .withColumn(f"__next_{c}", F.coalesce(f"__next_{c}", f"__after_{c}")))
    return joined.drop(*[f"__{side}_{c}" for c in columns for side in ("before", "after")])


def row_index(df: DataFrame, layout: Layout, name: str = "row_index") -> DataFrame:
    """Add the 0-based position of each row in its series."""
    placed = layout.place(df)
    local = (F.row_number().over(layout.window) - 1).cast("long")
    if not layout.sliced:
        return layout.strip(placed.withColumn(name, local))
    offsets = layout.slots(df).select(*layout.parts, F.col("offset").alias("__offset"))
    return layout.strip(placed.withColumn(name, local).join(offsets, layout.parts, "left")
                        .withColumn(name, F.col(name) + F.col("__offset")))


def row_positions(df: DataFrame, layout: Layout) -> DataFrame:
    """Add ``__position`` (from 0) and ``__total`` of each row in its series, ties included.

    Rows of one instant need an order of their own: without ties in the spec, they fail the job.
    """
    w = layout.window
    position = (F.row_number().over(w) - 1).cast("long")
    if not layout.spec.ties:
        position = F.when(F.lag(US).over(w) == F.col(US), same_instant("long")).otherwise(position)
    placed = layout.place(df).withColumn("__position", position)
    if not layout.sliced:
        return placed.withColumn("__total", F.count(F.lit(1)).over(Window.partitionBy(*layout.parts)))
    slots = layout.slots(df).select(*layout.parts, F.col("offset").alias("__offset"), F.col("total").alias("__total"))
    return (placed.join(slots, layout.parts, "left")
            .withColumn("__position", F.col("__position") + F.col("__offset")).drop("__offset"))


def same_instant(kind: str):
    return F.raise_error(F.lit("duplicate rows for an instant; downsample first or name ties")).cast(kind)


def instants_at(df: DataFrame, layout: Layout, rank) -> DataFrame:
    """The time coordinate of the ``rank(total)``-th row (1-based) of every series.

    The slot counts say which slot holds it; only that slot is sorted.
    """
    wanted = (layout.slots(df).withColumn("__rank", rank(F.col("total")))
              .where("__rank > offset and __rank <= offset + n")
              .select(*layout.parts, (F.col("__rank") - F.col("offset")).alias("__rank")))
    times = layout.place(df).select(*dict.fromkeys([*layout.parts, US, *layout.spec.ties]))
    picked = attach(times, settle(wanted), layout.parts, [US], "inner")
    return (picked.withColumn("__at", F.row_number().over(layout.window))
            .where("__at = __rank").select(layout.key, F.col(US).alias("instant_us")))
