"""Intermediate tables in the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table once and read it back.

    Cuts the lineage on storage that survives lost executors, and fixes values such as partition
    ids that a recomputation could change.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Staged tables of one computation whose result keeps none of them; they go as soon as they are dropped, all at its end.

    The shuffle files behind a staged table go once it is written.
    """

    CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, tuple[DataFrame, str]] = {}

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        for df, _ in list(self.paths.values()):
            self.drop(df)

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        path, was = scratch_path(self.spark, name), self.spark.conf.get(self.CLEANUP, None)
        self.spark.conf.set(self.CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(self.CLEANUP, was) if was is not None else self.spark.conf.unset(self.CLEANUP)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = out, path
        return out

    def drop(self, df: DataFrame) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(df))[1])
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
