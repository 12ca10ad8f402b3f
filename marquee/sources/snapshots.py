"""Stored type-2 snapshots, merged bucket by bucket (J12, SN1, SN2, S19), and histories that take late changes (ST3).

A snapshot is one Spark table partitioned by ``bucket`` (a hash of the key) and ``part``: the current
versions of a bucket, and one part per run for the versions that the run closed in it. A run

1. finds the buckets of its batch (at most ``buckets`` numbers),
2. reads the current versions of those buckets only (partition pruning on both columns),
3. merges them with the batch and stores the result, which cuts the lineage,
4. adds the closed versions, then replaces the current ones of the touched buckets (dynamic partition overwrite).

Buckets that a day does not touch are neither read nor written, and closed versions are never read. With a few
times more buckets than a day has keys, a day's work follows its own size. A run that failed anywhere is repeated
with the same ``run`` name and batch: buckets already replaced meet their own rows and change nothing, closed
versions land in the same part.
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.operators.scd2 import SCD_ID, VALID_TO, same_key, scd2_history
from marquee.session import scratch_path
from marquee.sources.catalog import Catalog, overwriting_partitions

BUCKETS = 256
BUCKET, PART, CURRENT = "bucket", "part", "current"


class SnapshotTable:
    """A snapshot of ``key`` in a catalog. ``buckets`` is fixed when the table is created."""

    def __init__(self, catalog: Catalog, name: str, key, buckets: int = BUCKETS):
        self.catalog, self.name = catalog, name
        self.keys = [key] if isinstance(key, str) else list(key)
        self.buckets = catalog.table_meta(name, "buckets") or buckets
        self.changed: DataFrame | None = None           # keys of the versions that the last run has opened

    def bucket(self) -> Column:
        """The bucket of a row; equal for equal keys whatever their integer or string width."""
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(self.buckets)).cast("int")

    def exists(self) -> bool:
        return self.catalog.exists(self.name)

    def read(self) -> DataFrame:
        """All versions."""
        copy = self._compacting()
        rows = self.catalog.read_table(self.name)
        if copy is not None:
            rows = rows.filter(F.col(PART) == CURRENT).unionByName(copy)
        return rows.drop(BUCKET, PART)

    def current(self) -> DataFrame:
        """Current versions; the closed parts are pruned."""
        return self.catalog.read_table(self.name).filter(F.col(PART) == CURRENT).drop(BUCKET, PART)

    def of_buckets(self, buckets: list[int], part: str | None = CURRENT) -> DataFrame:
        """Versions of some buckets: the current ones, or all (``part=None``)."""
        rows = self.catalog.read_table(self.name).filter(F.col(BUCKET).isin(buckets))
        return (rows if part is None else rows.filter(F.col(PART) == part)).drop(BUCKET, PART)

    def touched(self, batch: DataFrame) -> list[int]:
        """Buckets of a batch's keys: at most ``buckets`` numbers reach the driver."""
        return sorted(r[0] for r in batch.select(self.bucket().alias("b")).distinct().collect())

    def merge(self, batch: DataFrame, run: str, merge: Callable[[DataFrame | None, DataFrame], DataFrame],
              meta: dict | None = None) -> list[int]:
        """One run: ``merge(current versions, batch)`` gives the new current and the closed versions
        (``snapshot_check``, ``snapshot_timestamp``). Returns the buckets that were touched."""
        self._end_compaction()
        if not self.exists():
            self._replace(merge(None, batch), run, [])
            buckets = sorted(r[0] for r in self.catalog.read_table(self.name).select(BUCKET).distinct().collect())
        else:
            buckets = self.touched(batch)
            if buckets:
                self._replace(merge(self.of_buckets(buckets), batch), run, buckets)
        if meta:
            self.catalog.set_meta(self.name, meta)
        return buckets

    def _replace(self, rows: DataFrame, run: str, buckets: list[int]) -> None:
        """Store ``rows`` as the current versions of their buckets and as what ``run`` has closed."""
        spark = self.catalog.spark
        part = F.when(F.col(VALID_TO).isNull(), F.lit(CURRENT)).otherwise(F.lit(f"closed-{run}"))
        rows = rows.withColumns({BUCKET: self.bucket(), PART: part})
        table = self.catalog.table(self.name)
        if not self.exists():
            rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET, PART).saveAsTable(table)
            self.catalog.set_meta(self.name, {"buckets": self.buckets})
            self.changed = self.current().select(*self.keys)
            return
        columns = self.catalog.read_table(self.name).columns
        merged = scratch_path(spark, f"merge-{self.name}")
        rows.select(*columns).write.partitionBy(PART).parquet(merged)
        staged = spark.read.schema(rows.select(*columns).schema).parquet(merged).select(*columns)
        now = staged.filter(F.col(PART) == CURRENT).select(*self.keys, SCD_ID)
        before = self.of_buckets(buckets).select(SCD_ID)
        changed = now.join(before, SCD_ID, "left_anti").select(*self.keys)
        path = scratch_path(spark, f"changed-{self.name}")
        changed.hint("rebalance").write.parquet(path)
        self.changed = spark.read.schema(changed.schema).parquet(path)
        for current in (False, True):
            self._insert(staged, current)

    def _insert(self, staged: DataFrame, current: bool) -> None:
        """Replace the (bucket, part) partitions of the staged current or closed versions."""
        rows = staged.filter(F.col(PART) == CURRENT if current else F.col(PART) != CURRENT)
        with overwriting_partitions(self.catalog.spark):
            rows.hint("rebalance", BUCKET).write.insertInto(self.catalog.table(self.name), overwrite=True)

    def compact(self) -> None:
        """Gather the closed parts of every bucket into one.

        The closed versions are copied aside first, and a property names the copy: until the parts are rewritten from it,
        readers take the copy, so a compaction that breaks off anywhere loses and repeats nothing; the next one, or
        the next run, ends it.
        """
        self._end_compaction()
        copy = f"{self.catalog.root}/_compact/{self.name}-{uuid.uuid4().hex}"
        closed = self.catalog.read_table(self.name).filter(F.col(PART) != CURRENT)
        closed.withColumn(PART, F.lit("closed")).hint("rebalance", BUCKET).write.parquet(copy)
        self.catalog.set_meta(self.name, {"compacting": copy})
        self._end_compaction()

    def _compacting(self) -> DataFrame | None:
        """The copy of the closed versions while a compaction is under way."""
        copy = self.catalog.table_meta(self.name, "compacting")
        table = self.catalog.read_table(self.name)
        return self.catalog.spark.read.schema(table.schema).parquet(copy) if copy else None

    def _end_compaction(self) -> None:
        copy = self._compacting() if self.exists() else None
        if copy is None:
            return
        spark, table = self.catalog.spark, self.catalog.table(self.name)
        for r in spark.sql(f"SHOW PARTITIONS {table}").collect():
            bucket, part = (x.split("=", 1)[1] for x in r[0].split("/"))
            if part != CURRENT:
                spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({BUCKET} = {bucket}, {PART} = '{part}')")
        with overwriting_partitions(spark):
            copy.hint("rebalance", BUCKET).write.insertInto(table, overwrite=True)
        self.catalog.set_meta(self.name, {"compacting": None})


class EventHistory:
    """A history ordered by the events' own time, right for any order of delivery (ST3, late changes).

    A change that is older than the current version splits the interval it falls into and re-chains its
    neighbours. That can make a version of an event that opened none before (A, A, then a late B between them), so
    events which repeat the one before them are kept, too, marked as opening nothing. One Spark table
    partitioned by a hash bucket of the key; a batch reads and replaces its own buckets only, closed versions included, and an
    event that was delivered before (same key, order and tie-break) is ignored, so a batch can be replayed.
    """

    OPENS = "opens"

    def __init__(self, catalog: Catalog, name: str, key, order: str, check_cols, tiebreak=None,
                 buckets: int = BUCKETS, split_rows: int | None = 1_000_000):
        self.catalog, self.name, self.order = catalog, name, order
        self.keys = [key] if isinstance(key, str) else list(key)
        self.checks = list(check_cols)
        self.ties = [] if tiebreak is None else [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
        self.buckets = catalog.table_meta(name, "buckets") or buckets
        self.split_rows = split_rows

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(self.buckets)).cast("int")

    def read(self) -> DataFrame:
        """All versions, as ``scd2_history`` gives them for the events delivered so far."""
        return self.catalog.read_table(self.name).filter(F.col(self.OPENS)).drop(BUCKET, self.OPENS)

    def apply(self, batch: DataFrame) -> list[int]:
        """Insert a batch of events; returns the buckets it touched."""
        spark, table = self.catalog.spark, self.catalog.table(self.name)
        identity = [*self.keys, self.order, *self.ties]
        events = batch
        first = not self.catalog.exists(self.name)
        buckets = [] if first else sorted(r[0] for r in batch.select(self.bucket().alias("b")).distinct().collect())
        if not first:
            if not buckets:
                return []
            stored = self.catalog.read_table(self.name).filter(F.col(BUCKET).isin(buckets))
            events = stored.select(*batch.columns).unionByName(batch)
        events = events.dropDuplicates(identity)
        path = scratch_path(spark, f"events-{self.name}")
        events.write.parquet(path)
        events = spark.read.schema(events.schema).parquet(path)
        versions = scd2_history(events, self.keys, self.order, check_cols=self.checks, tiebreak=self.ties or None,
                                split_rows=self.split_rows)
        names = [f"__v{i}" for i in range(len(identity))]
        opened = versions.select(*[F.col(c).alias(n) for c, n in zip(identity, names)])
        silent = events.join(opened, same_key(events, opened, identity, names), "left_anti")
        rows = (versions.withColumn(self.OPENS, F.lit(True))
                .unionByName(silent.withColumn(self.OPENS, F.lit(False)), allowMissingColumns=True)
                .withColumn(BUCKET, self.bucket()).hint("rebalance", BUCKET))
        if first:
            rows.write.partitionBy(BUCKET).saveAsTable(table)
            self.catalog.set_meta(self.name, {"buckets": self.buckets})
            return sorted(r[0] for r in self.catalog.read_table(self.name).select(BUCKET).distinct().collect())
        columns = self.catalog.read_table(self.name).columns
        with overwriting_partitions(spark):
            rows.select(*columns).write.insertInto(table, overwrite=True)
        return buckets
