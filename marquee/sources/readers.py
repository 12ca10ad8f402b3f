"""Typed readers and the bulk load with per-file error tolerance.

Schemas are always declared (``StructType`` / DDL); nothing is inferred.
Gzip files are not splittable: one task reads one file, so callers that read a
few huge ``.gz`` files pass ``repartition`` to spread the work afterwards.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_tsv(spark: SparkSession, path, schema=None, null_token: str = "\\N",
             repartition: int | None = None, multi_line: bool = False) -> DataFrame:
    """Tab-separated file with a header row; the sentinel ``\\N`` reads as NULL.

    A quoted field may hold tabs and doubled quotes, and line ends with ``multi_line`` (one task
    then reads a file, as it does anyway for gzip).
    """
    r = (spark.read.option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"')
         .option("nullValue", null_token).option("mode", "PERMISSIVE").option("multiLine", multi_line))
    df = r.schema(schema).csv(path) if schema is not None else r.csv(path)
    return df.repartition(repartition) if repartition else df


class LoadAborted(RuntimeError):
    """A bulk load without tolerance met an error; nothing was loaded."""


def read_json_array(spark: SparkSession, path, schema=None) -> DataFrame:
    """A file holding one JSON array: each element becomes a row (S2, strip outer array).

    Elements are parsed one at a time. A malformed or truncated document fails the read.
    """
    r = spark.read.option("multiLine", True).option("mode", "FAILFAST")
    return r.schema(schema).json(path) if schema is not None else r.json(path)


def read_variant(spark: SparkSession, path, column: str = "content", lines: bool = False) -> DataFrame:
    """JSON file(s) -> one ``VARIANT`` column, one row per record (S3).

    ``lines=True`` reads one record per line: files are split over tasks and no value is larger
    than a record. This is the form in which the daily run lands reviews. A file that holds one
    array (an API page) is read as a single variant and exploded on the executors, so it must stay
    below the size limit of a variant; land such files as lines first if they can grow.
    """
    if lines:
        return spark.read.option("singleVariantColumn", column).option("mode", "FAILFAST").json(path)
    whole = (spark.read.option("singleVariantColumn", "__doc").option("multiLine", True).json(path))
    return whole.select(F.explode(F.col("__doc").cast("array<variant>")).alias(column))


@dataclass(frozen=True)
class CsvFormat:
    """Named CSV file format (S4): gzip, one header line, '' -> NULL, optional quotes."""
    compression: str = "gzip"
    skip_header: int = 1
    null_if: tuple = ("",)
    quote: str = '"'
    sep: str = ","
    multi_line: bool = False        # quoted fields may hold line ends; one task then reads a file

    def __post_init__(self):
        if self.skip_header not in (0, 1):
            raise ValueError("skip_header must be 0 or 1")

    def reader_options(self) -> dict:
        return {
            "header": self.skip_header >= 1,
            "sep": self.sep,
            "quote": self.quote,
            "escape": self.quote,
            "nullValue": self.null_if[0] if self.null_if else None,
            "emptyValue": "" if "" not in self.null_if else None,
            "enforceSchema": True,
            "multiLine": self.multi_line,
            "compression": self.compression,
        }

    def writer_options(self) -> dict:
        """Options under which Spark writes what ``reader_options`` reads back: quotes doubled, backslashes and
        blanks as they are, NULL as an empty field and an empty string as a quoted one."""
        return {
            "header": self.skip_header >= 1,
            "sep": self.sep,
            "quote": self.quote,
            "escape": self.quote,
            "nullValue": "",
            "emptyValue": self.quote * 2,
            "ignoreLeadingWhiteSpace": False,
            "ignoreTrailingWhiteSpace": False,
            "compression": self.compression,
        }


@dataclass(frozen=True)
class JsonFormat:
    strip_outer_array: bool = True


@dataclass(frozen=True)
class Stage:
    """A named location plus default file format and copy options."""
    base: str
    fmt: object = field(default_factory=CsvFormat)
    skip_file_pct: float | None = None

    def path(self, *names: str) -> list[str]:
        b = self.base.rstrip("/")
        return [f"{b}/{n}" for n in names] if names else [b]


def read_csv_format(spark: SparkSession, path, schema, fmt: CsvFormat = CsvFormat()) -> DataFrame:
    """Typed CSV read with a declared format; columns map by position.

    With several ``null_if`` tokens the fields are read as text, nulled and cast.
    """
    r = spark.read
    for k, v in fmt.reader_options().items():
        if v is not None and k != "compression":
            r = r.option(k, v)
    if len(fmt.null_if) <= 1:
        return r.schema(schema).csv(path)
    text = r.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])).csv(path)
    return text.select(*[_nulled(f.name, fmt).cast(f.dataType).alias(f.name) for f in schema.fields])


def _nulled(name: str, fmt: CsvFormat):
    """A text field with every ``null_if`` token as NULL."""
    return F.when(~F.col(name).isin(list(fmt.null_if)), F.col(name)) if fmt.null_if else F.col(name)


def copy_into(spark: SparkSession, paths, schema: T.StructType, fmt=CsvFormat(),
              skip_file_pct: float | None = None):
    """Bulk load of landed files into a typed table.

    Returns ``(rows, report)``. ``report`` has one row per file: ``file``,
    ``rows_parsed``, ``errors_seen``, ``rows_loaded``, ``status``.

    For CSV the files are read as text columns (by position), then cast to
    the declared types with ``try_cast``; a row is an error if the line is
    malformed or any non-NULL field fails its cast. With ``skip_file_pct``
    (``SKIP_FILE_<n>%``) a file whose error share exceeds ``n`` percent is
    skipped whole and the error rows of the other files are dropped. Without
    it any error aborts the load (``ABORT_STATEMENT``): the errors are counted in
    a first pass and ``LoadAborted`` is raised before a row is returned. This is also
    the only behaviour for JSON, where a malformed document is an error.

    The per-file report is an aggregate keyed by file (one row per file);
    the rows meet it in an equi-join that adaptive execution broadcasts when
    the measured report is small.
    """
    if isinstance(paths, str):
        paths = [paths]
    if isinstance(fmt, JsonFormat):
        checked = T.StructType([*schema.fields, T.StructField("__corrupt", T.StringType(), True)])
        rows = (spark.read.option("multiLine", True).option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", "__corrupt").schema(checked).json(paths)
                .withColumn("__file", F.col("_metadata.file_path")))
        # Spark wants a data column beside the corrupt record: a bad document has none.
        bad = F.col("__corrupt").isNotNull() & F.coalesce(*[F.col(f.name).cast("string") for f in schema.fields]).isNull()
        report = (rows.withColumn("__bad", bad).groupBy(F.col("__file").alias("file"))
                  .agg(F.count(F.lit(1)).alias("rows_parsed"),
                       F.count_if("__bad").alias("errors_seen"))
                  .select("file", "rows_parsed", "errors_seen",
                          F.when(F.col("errors_seen") > 0, 0).otherwise(F.col("rows_parsed")).cast("long")
                          .alias("rows_loaded"),
                          F.when(F.col("errors_seen") > 0, "LOAD_FAILED").otherwise("LOADED").alias("status")))
        _abort_on_errors(report)
        return rows.drop("__file", "__corrupt"), report

    text_schema = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields]
                               + [T.StructField("__corrupt", T.StringType(), True)])
    r = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "__corrupt")
    for k, v in fmt.reader_options().items():
        if v is not None and k != "compression":
            r = r.option(k, v)
    raw = r.schema(text_schema).csv(paths).withColumn("__file", F.col("_metadata.file_path"))

    casts = [_nulled(f.name, fmt).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    bad = F.col("__corrupt").isNotNull()
    for f in schema.fields:
        bad = bad | (_nulled(f.name, fmt).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull())
    checked = raw.select("__file", bad.alias("__bad"), *casts)

    per_file = (checked.groupBy(F.col("__file").alias("file"))
                .agg(F.count(F.lit(1)).alias("rows_parsed"), F.count_if("__bad").alias("errors_seen")))
    if skip_file_pct is None:
        skipped = F.col("errors_seen") > 0
        status = F.when(skipped, F.lit("LOAD_FAILED")).otherwise(F.lit("LOADED"))
    else:
        skipped = (F.col("errors_seen") * F.lit(100.0)) > (F.col("rows_parsed") * F.lit(float(skip_file_pct)))
        status = F.when(skipped, F.lit("SKIPPED")).when(F.col("errors_seen") > 0, F.lit("PARTIALLY_LOADED")) \
            .otherwise(F.lit("LOADED"))
    report = per_file.select(
        "file", "rows_parsed", "errors_seen",
        F.when(skipped, F.lit(0)).otherwise(F.col("rows_parsed") - F.col("errors_seen")).cast("long")
        .alias("rows_loaded"),
        status.alias("status"))

    if skip_file_pct is None:
        _abort_on_errors(report)
        return checked.select(*[f.name for f in schema.fields]), report
    good_files = report.filter(F.col("status") != "SKIPPED").select(F.col("file").alias("__file"))
    rows = (checked.filter(~F.col("__bad"))
            .join(good_files, "__file", "left_semi")
            .select(*[f.name for f in schema.fields]))
    return rows, report


def _abort_on_errors(report: DataFrame) -> None:
    """Raise if any file of a load report has errors (one aggregated row reaches the driver)."""
    n, example = report.filter("errors_seen > 0").agg(F.sum("errors_seen"), F.min("file")).first()
    if n:
        raise LoadAborted(f"{n} error(s), first in {example}; nothing was loaded")


def list_assets(spark: SparkSession, directory: str, regex: str = "(.*)") -> DataFrame:
    """Files of a folder as named assets: ``asset`` is group 1 of ``regex`` on the name.

    Lists through the binary-file source with only path columns selected, so
    file contents are not read.
    """
    files = spark.read.format("binaryFile").load(directory).select("path")
    name = F.regexp_extract(F.col("path"), r"([^/]+)$", 1)
    return files.select(F.col("path"), name.alias("file_name"),
                        F.regexp_extract(name, f"^{regex}$", 1).alias("asset"))


def sample_batch(df: DataFrame, n: int = 1000) -> DataFrame:
    """The first ``n`` rows, as used when a suite is authored."""
    return df.limit(n)


def batch(spark: SparkSession, reader, path: str) -> DataFrame:
    """A batch whose path is handed in at run time."""
    return reader(spark, path)
