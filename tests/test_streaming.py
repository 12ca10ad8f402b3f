import datetime as dt

import pytest
from hypothesis import HealthCheck, Phase, example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marquee.operators import scd2_history
from marquee.sources import Catalog, EventHistory, SnapshotTable
from marquee.streaming import (
    EventHistorySink,
    RegistryDedupSink,
    SnapshotSink,
    dedup_exact,
    dedup_stream,
    ingest_stream,
    run_available,
    run_to_files,
)
from tests.conftest import rows

SCHEMA = "id long, k string, v string, updated date"


def _land(spark, root, batches):
    for b in batches:      # one write per delivery -> files in arrival order
        spark.createDataFrame(b, SCHEMA).coalesce(1).write.mode("append").parquet(root)


def test_registry_dedup_stream_is_exact_and_replay_safe(spark, tmp_root):
    land = f"{tmp_root}/landing"
    _land(spark, land, [[(1, "a", "x", dt.date(2024, 1, 1)), (2, "b", "y", dt.date(2024, 1, 1))],
                        [(2, "b", "y", dt.date(2024, 1, 1)), (3, "c", "z", dt.date(2024, 1, 2))],
                        [(1, "a", "x", dt.date(2024, 1, 1))]])
    sink = RegistryDedupSink(spark, f"{tmp_root}/out", key="id")
    stream = ingest_stream(spark, land, SCHEMA, max_files_per_trigger=1)
    run_available(stream, sink, f"{tmp_root}/ckpt")
    assert rows(sink.read(), "id") == [(1,), (2,), (3,)]
    # replaying batch 1 (e.g. after a crash before the commit) rewrites, never duplicates
    batch1 = spark.read.parquet(land).filter("id >= 2")
    sink(batch1, 1)
    assert rows(sink.read(), "id") == [(1,), (2,), (3,)]


def test_watermark_dedup_stream(spark, tmp_root):
    land = f"{tmp_root}/landing"
    data = [(1, "a", "x", dt.date(2024, 1, 1)), (1, "a", "x", dt.date(2024, 1, 1)), (2, "b", "y", dt.date(2024, 1, 1))]
    _land(spark, land, [data])
    stream = ingest_stream(spark, land, SCHEMA).withColumn("ts", F.col("updated").cast("timestamp"))
    out = dedup_stream(stream, "id", "ts", "1 day")
    q = out.writeStream.format("memory").queryName("wm_dedup").option(
        "checkpointLocation", f"{tmp_root}/ck2").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("wm_dedup").count() == 2


def test_snapshot_stream_equals_history(spark, tmp_root):
    land = f"{tmp_root}/landing"
    d = dt.date
    batches = [[(1, "a", "x", d(2024, 1, 5)), (2, "b", "y", d(2024, 1, 5))],
               [(3, "a", "x2", d(2024, 1, 3))],                    # older: ignored
               [(4, "a", "x3", d(2024, 1, 9)), (5, "b", "y", d(2024, 1, 5))]]
    _land(spark, land, batches)
    cat = Catalog(spark, f"{tmp_root}/wh")
    sink = SnapshotSink(cat, "snap", key="k", order=["updated", "id"], updated_at="updated", buckets=4)
    run_available(ingest_stream(spark, land, SCHEMA, max_files_per_trigger=1), sink, f"{tmp_root}/ckpt")
    table = SnapshotTable(cat, "snap", "k")
    snap = table.read()
    hist = scd2_history(spark.createDataFrame([r for b in batches for r in b], SCHEMA), "k", "id",
                        updated_at="updated")
    cols = ("k", "v", "dbt_valid_from", "dbt_valid_to")
    assert rows(snap, *cols) == rows(hist, *cols)
    # a replayed batch id is skipped
    last = cat.table_meta("snap", "batch_id")
    sink(spark.createDataFrame([(9, "a", "zz", d(2024, 2, 1))], SCHEMA), last)
    assert rows(table.read(), *cols) == rows(hist, *cols)


EVENTS = "k string, ts int, seq int, v string, note string"
COLS = ("k", "ts", "seq", "v", "note", "dbt_scd_id", "dbt_valid_from", "dbt_valid_to")


@settings(max_examples=8, deadline=None, phases=[Phase.explicit, Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 6)), st.sampled_from(["x", "y", None]),
                          st.integers(0, 2)), min_size=1, max_size=25), st.sampled_from([None, 3]))
@example([("a", 1, "x", 0), ("a", 3, "x", 0), ("a", 5, "y", 0), ("a", 2, "y", 1), ("a", 4, "x", 2)], None)
def test_any_order_of_delivery_gives_the_same_history(spark, data, split_rows):
    from marquee.session import scratch_path

    events = [(k, t, n, v, f"n{n}") for n, (k, t, v, _) in enumerate(data)]
    table = EventHistory(Catalog(spark, scratch_path(spark, "late")), "h", "k", "ts", ["v"], tiebreak="seq", buckets=4,
                         split_rows=split_rows)
    for delivery in (2, 0, 1, 0):                          # the last one is a replay
        table.apply(spark.createDataFrame([e for e, d in zip(events, data) if d[3] == delivery], EVENTS))
    want = scd2_history(spark.createDataFrame(events, EVENTS), "k", "ts", check_cols=["v"], tiebreak="seq")
    assert rows(table.read(), *COLS) == rows(want, *COLS)


def test_late_change_replaces_its_own_buckets_only(spark, tmp_root):
    cat = Catalog(spark, tmp_root)
    table = EventHistory(cat, "h", "k", "ts", ["v"], tiebreak="seq", buckets=64)
    table.apply(spark.createDataFrame([(f"k{i}", t, 10 * i + t, "xy"[t % 2], "") for i in range(40) for t in (1, 3)], EVENTS))
    before = set(cat.read_table("h").inputFiles())
    touched = table.apply(spark.createDataFrame([("k7", 2, 999, "z", "late")], EVENTS))
    after = set(cat.read_table("h").inputFiles())
    assert len(touched) == 1 and {f.split("bucket=")[1].split("/")[0] for f in before ^ after} == {str(touched[0])}
    assert rows(table.read().filter("k = 'k7'"), "ts", "v", "dbt_valid_to") == [(1, "y", 2), (2, "z", 3), (3, "y", None)]


def test_late_changes_through_a_stream(spark, tmp_root):
    land = f"{tmp_root}/landing"
    batches = [[(3, "a", "x3", dt.date(2024, 1, 9))], [(1, "a", "x", dt.date(2024, 1, 5)), (2, "b", "y", dt.date(2024, 1, 5))],
               [(4, "a", "x3", dt.date(2024, 1, 7))]]
    _land(spark, land, batches)
    table = EventHistory(Catalog(spark, f"{tmp_root}/wh"), "h", "k", "updated", ["v"], tiebreak="id", buckets=2)
    run_available(ingest_stream(spark, land, SCHEMA, max_files_per_trigger=1), EventHistorySink(table), f"{tmp_root}/ck")
    want = scd2_history(spark.createDataFrame([r for b in batches for r in b], SCHEMA), "k", "updated", check_cols=["v"],
                        tiebreak="id")
    cols = ("id", "k", "v", "dbt_valid_from", "dbt_valid_to")
    assert rows(table.read(), *cols) == rows(want, *cols)


def test_unreadable_registry_is_not_an_empty_one(spark, tmp_root):
    import os

    sink = RegistryDedupSink(spark, f"{tmp_root}/out", key="id")
    folder = f"{sink.ids_path.removeprefix('file://')}/batch_id=0"
    os.makedirs(folder)
    with open(f"{folder}/part-0.parquet", "wb") as f:
        f.write(b"broken")
    with pytest.raises(Exception, match="(?i)parquet|footer|schema"):
        sink(spark.createDataFrame([(1, "a", "x", dt.date(2024, 1, 1))], SCHEMA), 1)


def test_state_dedup_over_restarts_and_its_ttl(spark, tmp_root):
    import time

    land = f"{tmp_root}/landing"
    a, b, c = (dict(id=i, k=k, v="x", updated=dt.date(2024, 1, 1)) for i, k in ((1, "a"), (2, "b"), (3, "c")))

    def deliver(out, batch, ttl):
        spark.createDataFrame([tuple(r.values()) for r in batch], SCHEMA).coalesce(1).write.mode("append").parquet(f"{land}-{out}")
        run_to_files(dedup_exact(ingest_stream(spark, f"{land}-{out}", SCHEMA), "id", ttl), f"{tmp_root}/{out}",
                     f"{tmp_root}/ck-{out}")
        return rows(spark.read.schema(SCHEMA).parquet(f"{tmp_root}/{out}"), "id")

    for out, ttl in (("plain", None), ("long", "1 day")):
        assert deliver(out, [a, b, a], ttl) == [(1,), (2,)]
        assert deliver(out, [b, c], ttl) == [(1,), (2,), (3,)]          # a new run, restored from the checkpoint
        assert deliver(out, [a, b, c], ttl) == [(1,), (2,), (3,)]
    assert deliver("short", [a], "1 second") == [(1,)]
    time.sleep(1.5)
    deliver("short", [b], "1 second")                                    # moves the time on, the key of a is forgotten
    time.sleep(1.5)
    assert deliver("short", [a, c], "1 second") == [(1,), (1,), (2,), (3,)]
