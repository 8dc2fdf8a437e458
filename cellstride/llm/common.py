"""What the operators share: table access, word patterns, row marks and column handling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

#: White space and words as every operator here understands them (Java regular expressions).
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


#: Bytes of rows that go to a Python worker at once, where the session names no bound: whole texts can be long.
BATCH_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; batches that go to Python are bounded in bytes from here on, if the session does not bound them."""
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(bound, None) is None or int(spark.conf.get(bound)) > 1 << 30:
        spark.conf.set(bound, str(BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mark_rows(df: DataFrame, name: str) -> DataFrame:
    """Number the rows, so that rows alike in all columns stay apart.

    ``df`` must be a stored table (or a plain selection of one): its partitions, and so the numbers,
    are then the same each time it is read.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less its columns of these names, in whatever case: an operator's own columns replace them."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def crc_bucket(id_col, n: int):
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % n


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
