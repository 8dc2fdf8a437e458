"""Mixing sources to target weights by hash-threshold histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..sources.staging import stage
from . import common

HASH_BITS = 60
#: Bits by which each level of the histogram refines the one above.
LEVEL_BITS = 12


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(common.WORD)), F.lit(0)).cast("long")


def place(id_col: Column, text: Column, seed: int) -> Column:
    """A document's place in the order of its source: 60 bits of a seeded hash of its id (of its text if it has none)."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.md5(F.coalesce(text, F.lit("")).cast("binary"))))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.0,
                   most: int = 3) -> DataFrame:
    """Target of every source from (source, source_size), one row per source.

    Sources in code point order, null last, take the weights in turn.  A target stops at ``most`` times its
    source's size and the excess goes to the others by weight.  In the order of size per weight the capped
    sources come first, so running sums find how far the capping goes without rounds.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    named = sizes.withColumn("n", F.row_number().over(by_name)).withColumn(
        "w", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("n") - 1) % len(weights) + 1).cast("long"))
    order = Window.orderBy(F.col("source_size").cast("double") / F.col("w"), "n")
    whole = Window.partitionBy()
    level = (F.col("total") * F.lit(float(share)) - F.col("capped")) / F.col("open")
    told = (named.withColumn("total", F.sum("source_size").over(whole).cast("double"))
            .withColumn("capped", F.coalesce(F.sum(most * F.col("source_size")).over(
                order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("double"))
            .withColumn("open", F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)).cast("double"))
            .withColumn("level", F.when(level * F.col("w") <= most * F.col("source_size"), level))
            .withColumn("level", F.first("level", ignorenulls=True).over(
                order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    cap = (most * F.col("source_size")).cast("double")
    return told.select("source", "source_size",
                       F.least(cap, F.coalesce(F.col("level") * F.col("w"), cap)).alias("target"))


def _thresholds(base: DataFrame, budgets: DataFrame) -> DataFrame:
    """The hash threshold of every (source, budget): documents below it hold about that many words.

    Level by level: histogram of words by the next bits of the hash, running sum within each budget's
    row of buckets, and on to the one bucket where the budget is crossed, until it holds a single place.
    """
    levels = HASH_BITS // LEVEL_BITS
    state = budgets.select("source", "budget", F.col("budget").alias("need"), F.lit(0).cast("long").alias("prefix"))
    done = None
    for level in range(levels):
        shift = HASH_BITS - LEVEL_BITS * (level + 1)
        at = F.shiftright(F.col("place"), shift)
        # Nested budgets of one source share its histogram: each adds only the row of its own boundary bucket.
        wanted = state.select(F.col("source").alias("s"), F.col("prefix").alias("p")).distinct()
        rows = base.join(wanted, F.col("source").eqNullSafe(F.col("s"))
                         & (F.shiftright(F.col("place"), shift + LEVEL_BITS) == F.col("p")))
        counts = stage(rows.groupBy("s", "p", at.alias("bucket")).agg(
            F.sum("size").alias("words"), F.min("place").alias("low"), F.max("place").alias("high")), "histogram")
        joined = counts.join(state, F.col("s").eqNullSafe(F.col("source")) & (F.col("p") == F.col("prefix")))
        upto = Window.partitionBy("source", "budget").orderBy("bucket")
        crossed = (joined.withColumn("upto", F.sum("words").over(upto)).where("upto > need")
                   .withColumn("nth", F.row_number().over(upto)).where("nth = 1")
                   .withColumn("need", F.col("need") - (F.col("upto") - F.col("words"))))
        crossed = stage(crossed.select("source", "budget", "need", "bucket", "words", "low", "high"), "boundaries")
        single = crossed.where("low = high").select(
            "source", "budget",
            (F.col("low") + F.when(F.col("words") - F.col("need") < F.col("need"), 1).otherwise(0)).alias("threshold"))
        done = single if done is None else done.unionByName(single)
        state = crossed.where("low < high").select("source", "budget", "need", F.col("bucket").alias("prefix"))
        if state.isEmpty():
            break
    return done


def plan_mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: tuple[int, ...] = (5, 2, 1), share: float = 1.0, most: int = 3, seed: int = 42) -> DataFrame:
    """What the mix takes of each source: source, source_size, target, times, threshold.

    Every document is taken ``times`` times, those whose place is below ``threshold`` once more.
    """
    base = stage(df.select(
        F.col(f"`{source_col}`").alias("source"), word_count(F.col(f"`{text_col}`")).alias("size"),
        place(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), seed).alias("place")), "mix-sizes")
    sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stage(source_targets(sizes, weights, share, most).withColumn(
        "times", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
        .cast("int")), "mix-targets")
    budgets = targets.select("source", (F.col("target") - F.col("times") * F.col("source_size")).alias("budget"))
    found = _thresholds(base, budgets.where("budget > 0"))
    return stage(targets.join(
        found.select(F.col("source").alias("s"), "threshold"), F.col("source").eqNullSafe(F.col("s")), "left")
        .select("source", "source_size", "target", "times", F.coalesce("threshold", F.lit(0)).alias("threshold")),
        "mix-plan")


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = (5, 2, 1), share: float = 1.0, most: int = 3, seed: int = 42) -> DataFrame:
    """Every row of ``df`` with how often the mix takes it: size, source_size, target, passes, taken.

    size is the number of words (0 for a null or blank text), taken is size times passes.  The words of all
    sources, times ``share``, are dealt out by weight (see ``source_targets``); no row is taken more than ``most`` times.
    Rows that share an id (or, without one, a text) share their fate, repeated rows too.  A null source is a
    source of its own.  Columns of ``df`` with the new names are replaced.  An empty table gives an empty result.

    Thresholds on a seeded hash choose the documents: nothing is sorted and reruns agree.  The rows are
    never shuffled: what is gathered are sums by source and hash bucket.
    """
    plan = plan_mix(df, id_col, text_col, source_col, weights, share, most, seed)
    plan = plan.select(F.struct("source", "source_size", "target", "times", "threshold").alias("__plan"))
    own = F.col(f"`{source_col}`")
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"), own.alias("__source"),
                     word_count(F.col(f"`{text_col}`")).alias("__size"),
                     place(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), seed).alias("__place"))
    joined = rows.join(plan, F.col("__source").eqNullSafe(F.col("__plan.source")))
    passes = F.col("__plan.times") + F.when(F.col("__place") < F.col("__plan.threshold"), 1).otherwise(0)
    new = {"size": F.col("__size"), "source_size": F.col("__plan.source_size"), "target": F.col("__plan.target"),
           "passes": passes, "taken": F.col("__size") * passes}
    old = [F.col("__row")[c].alias(c) for c in df.columns if c.lower() not in new]
    return joined.select(*old, *[c.alias(n) for n, c in new.items()])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(common.table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('42:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 15))::BIGINT AS place
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
n AS (SELECT *, row_number() OVER (ORDER BY encode(source) NULLS LAST) AS n FROM s),
w AS (SELECT *, [5, 2, 1][(n - 1) % 3 + 1] AS w FROM n),
r AS (SELECT *, sum(source_size) OVER ()::DOUBLE AS total,
        coalesce(sum(3 * source_size) OVER (ORDER BY source_size / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS capped,
        sum(w) OVER (ORDER BY source_size / w, n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS open FROM w),
l AS (SELECT *, (total - capped) / open AS level FROM r),
lev AS (SELECT level FROM l WHERE level * w <= 3 * source_size ORDER BY source_size / w, n LIMIT 1),
t AS (SELECT l.source, source_size, least((3 * source_size)::DOUBLE, lev.level * w) AS target FROM l, lev),
k AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS times FROM t),
b AS (SELECT *, target - times * source_size AS budget FROM k),
p AS (SELECT source, place, sum(size)::BIGINT AS words FROM d GROUP BY source, place),
c AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY place)::BIGINT AS upto FROM p),
x AS (SELECT c.source, place, words, budget - (upto - words) AS need,
        row_number() OVER (PARTITION BY c.source ORDER BY place) AS nth
      FROM c JOIN b ON c.source IS NOT DISTINCT FROM b.source WHERE budget > 0 AND upto > budget),
h AS (SELECT source, place + CASE WHEN words - need < need THEN 1 ELSE 0 END AS threshold FROM x WHERE nth = 1)
SELECT doc_id, size, source_size, target,
       size * (times + CASE WHEN place < coalesce(threshold, 0) THEN 1 ELSE 0 END) AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source LEFT JOIN h ON d.source IS NOT DISTINCT FROM h.source
"""
