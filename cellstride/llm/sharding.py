"""Random shards by a two-pass external shuffle, in built-in functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..sources.staging import stage
from . import common

#: Text bytes that one bucket may hold on average; a bucket is shuffled in memory.
BUCKET_BYTES = 16 << 20


def shard(df: DataFrame, n_shards: int = 8, seed: int = 42, bucket_bytes: int = BUCKET_BYTES,
          text_col: str = "text") -> DataFrame:
    """Every row of ``df`` with the ``shard`` it goes to and its ``slot`` there, in random order.

    First pass: rows are scattered uniformly into buckets by a seeded hash of their number in the table (see
    ``mark_rows``), so that no key, source or group of copies fills a bucket.  Second pass: each bucket is put in
    the order of the hash, shuffled by Fisher-Yates (``shuffle`` of Spark) and laid behind the buckets before it.
    A row's place in the whole decides: row counts of the shards differ by one at most, slots have no gaps.  The number of
    buckets follows the bytes alone, so the same table gives the same shards whatever the session's partitions.

    Nulls, empty texts and repeated rows are rows like others.  Columns of ``df`` named shard or slot are
    replaced.  An empty table gives an empty result.
    """
    spark = df.sparkSession
    marked = common.mark_rows(df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")), "mark")
    total = df.agg(F.sum(F.octet_length(F.col(f"`{text_col}`").cast("string")) + 1)).first()[0] or 0
    n = max(-(-total // bucket_bytes), 1)
    scattered = marked.select("row", F.xxhash64(F.lit(seed), "mark").alias("h")).select(
        F.pmod("h", F.lit(n)).cast("int").alias("bucket"), "h", "row")
    sizes = scattered.groupBy("bucket").agg(F.count("*").alias("n"))
    starts = stage(sizes.select("bucket", (F.sum("n").over(Window.orderBy("bucket")) - F.col("n")).alias("start")),
                   "bucket-starts")
    # One task per bucket: it holds one bucket and no other, and a repeated task deals the same order, since the generator
    # of ``shuffle`` starts anew with each task.
    held = scattered.repartitionById(n, F.col("bucket"))
    shuffled = held.groupBy("bucket").agg(F.collect_list(F.struct("h", "row")).alias("rows")).select(
        "bucket", F.shuffle(F.sort_array("rows"), F.lit(seed)).alias("rows"))
    placed = shuffled.join(starts, "bucket").select("start", F.posexplode("rows").alias("pos", "item")).select(
        "item.row", (F.col("start") + F.col("pos")).alias("place"))
    old = [F.col("row")[c].alias(c) for c in df.columns if c.lower() not in ("shard", "slot")]
    return placed.select(*old, (F.col("place") % n_shards).cast("int").alias("shard"),
                         F.floor(F.col("place") / n_shards).cast("long").alias("slot"))


def write_shards(df: DataFrame, path: str, n_shards: int = 8, seed: int = 42, **options) -> None:
    """One folder per shard under ``path``; ``slot`` gives the order of the rows within a shard."""
    shard(df, n_shards, seed, **options).write.partitionBy("shard").parquet(path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
                      F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
                      F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
