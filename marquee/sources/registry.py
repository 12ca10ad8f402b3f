"""Id registry: the set of ids already landed for a feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.sources.catalog import Catalog

BUCKETS = 32


class IdRegistry:
    """A one-column Spark table of ids, bucketed by the id and appended after each successful load.

    The bucketing is the hash partitioning of a join, so looking up a day's rows exchanges those rows only: the
    registry, which grows with every day, is scanned bucket by bucket where it lies. Ids are registered *last*, after
    the load succeeded, so a failed run can be repeated without losing rows; registering an id twice changes nothing.
    """

    TABLE = "ids"

    def __init__(self, spark: SparkSession, path: str, column: str = "id",
                 dtype: T.DataType = T.StringType(), buckets: int = BUCKETS):
        self.spark, self.path, self.column, self.dtype, self.buckets = spark, path, column, dtype, buckets
        self.catalog = Catalog(spark, path)

    def read(self) -> DataFrame:
        """All registered ids; an empty frame if nothing was registered yet."""
        if self.catalog.exists(self.TABLE):
            return self.catalog.read_table(self.TABLE).select(self.column)
        return self.spark.createDataFrame([], T.StructType([T.StructField(self.column, self.dtype, True)]))

    def new_rows(self, df: DataFrame, key: str, null_safe: bool = False) -> DataFrame:
        """Rows of ``df`` whose ``key`` was never registered.

        ``null_safe``: a NULL key is old once a NULL was registered (one scalar subquery, pushed to the scan);
        otherwise it is always new. The join itself is a plain equality, which the buckets serve.
        """
        ids = self.read().select(F.col(self.column).alias("__id"))
        rows = df.join(ids, df[key].cast(self.dtype) == F.col("__id"), "left_anti")
        if not null_safe:
            return rows
        nulls = ids.filter(F.col("__id").isNull()).agg(F.count(F.lit(1))).scalar()
        return rows.filter(F.col(key).isNotNull() | (nulls == 0))

    def append(self, df: DataFrame, key: str) -> None:
        """Register the ids of ``df`` (distinct within the batch; map-side reduced)."""
        self._write(df.select(df[key].cast(self.dtype).alias(self.column)).distinct(), self.TABLE)

    def compact(self) -> None:
        """Rewrite all appends as one file per bucket, without duplicate ids."""
        if self.catalog.exists(self.TABLE):
            built = f"{self.TABLE}__built"
            self.catalog.drop(built)
            self._write(self.read().distinct(), built)
            self.catalog.drop(self.TABLE)
            self.spark.sql(f"ALTER TABLE {self.catalog.table(built)} RENAME TO {self.catalog.table(self.TABLE)}")

    def _write(self, ids: DataFrame, name: str) -> None:
        """One file per bucket: the rows are dealt by the bucketing itself."""
        dealt = ids.repartition(self.buckets, self.column)
        if self.catalog.exists(name):
            dealt.write.insertInto(self.catalog.table(name))
        else:
            dealt.write.bucketBy(self.buckets, self.column).sortBy(self.column).saveAsTable(self.catalog.table(name))
