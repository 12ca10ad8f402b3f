"""Structured Streaming forms of ingest, id dedup and snapshots.

All sinks are ``foreachBatch`` functions that are idempotent by batch id, so
a micro-batch replayed after a failure (executor or driver loss) rewrites the
same output instead of duplicating it:

* data and registry ids of batch ``n`` go to ``.../batch_id=n`` folders,
  written in overwrite mode;
* a replayed batch computes its new rows against the registry *without* its
  own earlier partial output (``batch_id != n``).

Streams run with ``trigger(availableNow=True)``: each run drains what has
landed, then stops, which is how a daily schedule drives a stream.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators.joins import anti_by_registry
from marquee.operators.scd2 import dedupe_latest
from marquee.plans.daily import snapshot_run
from marquee.sources.catalog import Catalog
from marquee.sources.snapshots import BUCKETS, EventHistory


def ingest_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None, **options) -> DataFrame:
    """ST1: a streaming DataFrame over files landing in ``path`` (declared schema)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)


def dedup_stream(df: DataFrame, key, event_time: str, delay: str) -> DataFrame:
    """ST2, bounded-state form: drop repeats of ``key`` seen within the watermark delay."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ARRIVED = "__arrived"


def dedup_exact(df: DataFrame, key, ttl: str | None = None) -> DataFrame:
    """ST2 with Spark's state: the first row of each ``key``, however late its repeats come.

    The keys seen are the query's keyed state, kept by the state store beside the checkpoint and restored with it, so a
    micro-batch that is replayed gives the same rows and nothing is read again per batch. ``ttl`` bounds the state: a key is
    forgotten that long after its row arrived (the micro-batch's own time), and a repeat that comes later is new again.
    Without it the state grows with the keys. Run it with ``run_to_files``, which keeps the state in RocksDB: it is then
    bounded by disk, not by the executors' memory.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if ttl is None:
        return df.dropDuplicates(keys)
    timed = df.withColumn(ARRIVED, F.current_timestamp()).withWatermark(ARRIVED, ttl)
    return timed.dropDuplicatesWithinWatermark(keys).drop(ARRIVED)


def run_to_files(df: DataFrame, path: str, checkpoint: str) -> None:
    """Drain everything available into Parquet files (exactly once, by Spark's file sink), with state in RocksDB."""
    conf, name = df.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name, None)
    conf.set(name, ROCKSDB)
    try:
        query = (df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        conf.set(name, before) if before else conf.unset(name)
    if query.exception() is not None:
        raise query.exception()


class RegistryDedupSink:
    """ST2, exact form: each micro-batch keeps rows whose key was never seen.

    The seen keys live in a registry table (partitioned by batch id) instead
    of streaming state, so the key space can grow without bound. Per batch:
    one aggregate to drop in-batch repeats (latest by ``order``), one anti
    join against the registry (pre-filtered by the batch's keys when they
    are few), two writes.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, order=None):
        self.spark, self.key = spark, key
        self.order = order or [key]
        self.data_path = f"{root.rstrip('/')}/data"
        self.ids_path = f"{root.rstrip('/')}/ids"

    def _registry(self, batch_id: int) -> DataFrame | None:
        try:
            ids = self.spark.read.parquet(self.ids_path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":        # an unreadable registry is not an empty one
                raise
            return None
        return ids.filter(F.col("batch_id") != batch_id).select(self.key)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        rows = dedupe_latest(batch, self.key, self.order)
        seen = self._registry(batch_id)
        if seen is not None:
            rows = anti_by_registry(rows, seen, self.key)
        out = f"{self.data_path}/batch_id={batch_id}"
        rows.write.mode("overwrite").parquet(out)
        written = self.spark.read.parquet(out).select(self.key)
        written.write.mode("overwrite").parquet(f"{self.ids_path}/batch_id={batch_id}")

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.data_path).drop("batch_id")


class SnapshotSink:
    """ST3: each micro-batch is one snapshot run of a stored SCD2 table.

    Skips a batch whose id is not above the last committed one (replay after
    a failure between the table write and the checkpoint commit). ``now`` is the
    run's time, or a function of the micro-batch that tells it.
    """

    def __init__(self, catalog: Catalog, name: str, key, order, now=None, check_cols=None,
                 updated_at: str | None = None, buckets: int = BUCKETS):
        self.catalog, self.name, self.key, self.order, self.buckets = catalog, name, key, order, buckets
        self.now, self.check_cols, self.updated_at = now, check_cols, updated_at

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        last = self.catalog.table_meta(self.name, "batch_id")
        if last is not None and batch_id <= last:
            return
        now = self.now(batch) if callable(self.now) else self.now
        snapshot_run(self.catalog, self.name, batch, self.key, now=now, check_cols=self.check_cols,
                     updated_at=self.updated_at, order=self.order, meta={"batch_id": batch_id},
                     run=f"batch-{batch_id}", buckets=self.buckets)


class EventHistorySink:
    """ST3 for feeds that arrive in any order: each micro-batch is inserted into an ``EventHistory``.

    A replayed micro-batch brings events that are stored already and changes nothing.
    """

    def __init__(self, history: EventHistory):
        self.history = history

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.history.apply(batch)


def run_available(df: DataFrame, sink, checkpoint: str, query_name: str | None = None) -> None:
    """Drain everything available through ``sink`` (``foreachBatch``), then stop."""
    w = df.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if query_name:
        w = w.queryName(query_name)
    q = w.start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
