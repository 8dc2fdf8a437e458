"""Measurement tables, results and object listings on any file system Spark reaches."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.project import only_series
from ..series import SeriesSpec, nan_to_null

SPEC = SeriesSpec()
QUARANTINE = "_corrupt_record"

# Media types by file extension.
MEDIA_TYPES = {
    "csv": "text/csv", "json": "application/json", "txt": "text/plain", "html": "text/html",
    "md": "text/markdown", "png": "image/png", "jpg": "image/jpeg", "pdf": "application/pdf",
    "zip": "application/zip", "gz": "application/gzip",
}
DEFAULT_MEDIA_TYPE = "application/octet-stream"


def measurement_schema(columns: list[str], numeric_type: str = "double",
                       spec: SeriesSpec = SPEC) -> T.StructType:
    """Types by role: the time, the key as string, everything else numeric."""
    number = T.FloatType() if numeric_type == "float" else T.DoubleType()
    kinds = {spec.time: T.TimestampNTZType(), **{k: T.StringType() for k in spec.keys}}
    return T.StructType([T.StructField(c, kinds.get(c, number)) for c in columns])


def read_measurements_csv(spark: SparkSession, path: str, series: str | None = None,
                          numeric_type: str = "double", drop_key: bool = False,
                          encoding: str | None = None, timestamp_format: str | None = None,
                          bad_rows: str = "fail", spec: SeriesSpec = SPEC) -> DataFrame:
    """A CSV file or folder with a header as a measurement table.

    ``series`` filters on the key, which ``drop_key`` then removes.  ``bad_rows`` is ``fail``, or
    ``quarantine`` to keep malformed rows with their text in ``_corrupt_record``.  Without
    ``encoding`` UTF-8 is taken if every line is valid UTF-8, else Latin-1.  A missing or
    empty file and a missing time column raise ``ValueError``.
    """
    options = {"header": True, "enforceSchema": False, "nanValue": "NaN"}
    if timestamp_format:
        options["timestampNTZFormat"] = timestamp_format
    if encoding is None:
        encoding = "UTF-8" if _decodes(spark, path) else "ISO-8859-1"
    options["encoding"] = encoding
    try:
        columns = spark.read.options(**options).csv(path).columns      # reads the header only
    except AnalysisException as error:
        raise ValueError(f"cannot read {path}: {error}") from error
    if not columns:
        raise ValueError(f"{path} is empty")
    if spec.time not in columns:
        raise ValueError(f"{path} has no column {spec.time!r}")
    if series is not None and spec.key not in columns:
        raise ValueError(f"{path} has no column {spec.key!r} to filter on")
    schema = measurement_schema(columns, numeric_type, spec)
    if bad_rows == "quarantine":
        schema = schema.add(QUARANTINE, T.StringType())
        # The header check knows nothing of the added column.
        options.update(mode="PERMISSIVE", columnNameOfCorruptRecord=QUARANTINE, enforceSchema=True)
    else:
        options["mode"] = "FAILFAST"
    table = nan_to_null(spark.read.schema(schema).options(**options).csv(path))
    if series is not None:
        table = only_series(table, series, spec, keep_key=not drop_key)
    return table


def _decodes(spark: SparkSession, path: str) -> bool:
    try:
        lines = spark.read.text(path)
        return lines.where(~F.is_valid_utf8("value")).limit(1).count() == 0
    except AnalysisException as error:
        raise ValueError(f"cannot read {path}: {error}") from error


def quarantined(table: DataFrame) -> DataFrame:
    """The malformed rows of a table read with ``bad_rows="quarantine"``."""
    return table.where(F.col(QUARANTINE).isNotNull())


def read_measurements(spark: SparkSession, path: str, series: str | None = None,
                      spec: SeriesSpec = SPEC) -> DataFrame:
    """A Parquet table; on a layout partitioned by the key, ``series`` reads one folder."""
    try:
        table = spark.read.parquet(path)
    except AnalysisException as error:
        raise ValueError(f"cannot read {path}: {error}") from error
    if spec.time not in table.columns:
        raise ValueError(f"{path} has no column {spec.time!r}")
    table = nan_to_null(table)
    return table if series is None else only_series(table, series, spec)


def write_measurements(df: DataFrame, path: str, rows_per_file: int = 5_000_000,
                       spec: SeriesSpec = SPEC) -> None:
    """Parquet, one folder per series.

    The rebalance hint gathers small series into few files and splits a busy series over many
    tasks; a file ends after ``rows_per_file`` rows.
    """
    keys = [k for k in spec.keys if k in df.columns]
    out = df.hint("rebalance", *keys) if keys else df
    writer = out.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    (writer.partitionBy(*keys) if keys else writer).parquet(path)


def write_csv(df: DataFrame, path: str, spec: SeriesSpec = SPEC) -> None:
    """CSV with a header, the time first."""
    (df.select(spec.time, *[c for c in df.columns if c != spec.time])
     .write.mode("overwrite").option("header", True)
     .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]").csv(path))


def write_metrics(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("overwrite").json(path)


def write_predictions(predictions: DataFrame, path: str) -> None:
    predictions.write.mode("overwrite").parquet(path)


def media_type(name: Column) -> Column:
    """Media type guessed from the extension of a file name column."""
    known = F.create_map(*[F.lit(v) for pair in MEDIA_TYPES.items() for v in pair])
    extension = F.lower(F.regexp_extract(name, r"\.([^./\\]+)$", 1))
    return F.coalesce(F.try_element_at(known, extension), F.lit(DEFAULT_MEDIA_TYPE))


def object_manifest(spark: SparkSession, root: str) -> DataFrame:
    """``(object_name, size_bytes, modified, media_type)`` of every file below a folder.

    Names are relative to the folder with ``/`` between parts.  File contents are not read.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
             .select("path", "length", "modificationTime"))
    base = root.rstrip("/\\").replace("\\", "/").split("://")[-1].split("file:")[-1]
    path = F.regexp_replace("path", r"\\", "/")
    name = F.substring_index(path, base + "/", -1)
    return files.select(name.alias("object_name"), F.col("length").alias("size_bytes"),
                        F.col("modificationTime").alias("modified")).withColumn(
        "media_type", media_type(F.col("object_name")))


def receipt(spark: SparkSession, root: str, bucket: str) -> DataFrame:
    """What was stored: ``(status, bucket, object_name, size_bytes)`` per object."""
    return object_manifest(spark, root).select(
        F.lit("success").alias("status"), F.lit(bucket).alias("bucket"), "object_name", "size_bytes")
