"""Sinks: gzipped CSV, JSON, dated landing, truncate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.sources.readers import CsvFormat


def write_csv_gz(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True) -> None:
    """CSV with a header, gzip, NULL as empty field, no index column."""
    df.write.mode(mode).options(**CsvFormat(skip_header=int(header)).writer_options()).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per line, possibly many files."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def land(df: DataFrame, root: str, ds: str, fmt: str = "parquet", partition_col: str = "ds",
         **options) -> None:
    """Land a day's rows under ``<root>/<partition_col>=<ds>/`` replacing only that day.

    Dynamic partition overwrite: re-running a day replaces that day's files
    and leaves every other day untouched (``replace=True`` of the reference).
    """
    w = (df.withColumn(partition_col, F.lit(ds)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(partition_col))
    for k, v in options.items():
        w = w.option(k, v)
    w.format(fmt).save(root)


def truncate(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Empty a raw table by overwriting it with no rows (runs even on an empty day)."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
