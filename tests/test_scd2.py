import datetime as dt

from hypothesis import HealthCheck, Phase, example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marquee.operators import (
    as_of,
    current,
    dedupe_latest,
    scd2_history,
    snapshot_check,
    snapshot_timestamp,
)
from marquee.operators.scd2 import META_COLS
from tests.conftest import rows, srt

D1, D2, D3 = (dt.datetime(2024, 1, d) for d in (1, 2, 3))


def _basics(spark, data):
    return spark.createDataFrame(data, "id string, title string, year int, is_adult boolean")


def test_check_strategy_new_changed_unchanged_and_other_column(spark):
    day1 = _basics(spark, [("a", "Heat", 1995, False), ("b", "Up", 2009, False)])
    s1 = snapshot_check(None, day1, "id", ["title", "year"], D1)
    assert s1.columns == day1.columns + META_COLS
    assert rows(s1, "id", "dbt_valid_from", "dbt_valid_to") == srt([("a", D1, None), ("b", D1, None)])
    # a: unchanged re-send; b: only a non-check column changed; c: new
    day2 = _basics(spark, [("a", "Heat", 1995, False), ("b", "Up", 2009, True), ("c", "Jaws", 1975, False)])
    s2 = snapshot_check(s1, day2, "id", ["title", "year"], D2)
    assert rows(s2, "id", "dbt_valid_from", "dbt_valid_to") == srt([("a", D1, None), ("b", D1, None), ("c", D2, None)])
    # a: a check column changed -> close old at D3, insert new at D3; b missing -> stays current
    day3 = _basics(spark, [("a", "Heat (1995)", 1995, False)])
    s3 = snapshot_check(s2, day3, "id", ["title", "year"], D3)
    got = rows(s3, "id", "title", "dbt_valid_from", "dbt_valid_to")
    assert got == srt([("a", "Heat", D1, D3), ("a", "Heat (1995)", D3, None), ("b", "Up", D1, None),
                   ("c", "Jaws", D2, None)])
    assert s3.select("dbt_scd_id").distinct().count() == 4
    assert rows(current(s3), "id", "title") == srt([("a", "Heat (1995)"), ("b", "Up"), ("c", "Jaws")])
    assert rows(as_of(s3, dt.datetime(2024, 1, 2, 12)), "id", "title") == srt([("a", "Heat"), ("b", "Up"),
                                                                              ("c", "Jaws")])


def test_check_strategy_null_safe_compare(spark):
    s1 = snapshot_check(None, _basics(spark, [("a", None, 1995, False)]), "id", ["title"], D1)
    same = snapshot_check(s1, _basics(spark, [("a", None, 1995, False)]), "id", ["title"], D2)
    assert same.count() == 1
    filled = snapshot_check(s1, _basics(spark, [("a", "Heat", 1995, False)]), "id", ["title"], D2)
    assert filled.count() == 2


def _reviews(spark, data):
    return spark.createDataFrame(data, "id string, headline string, updated date")


def test_timestamp_strategy_same_later_earlier_day(spark):
    d = dt.date
    s1 = snapshot_timestamp(None, _reviews(spark, [("r", "v1", d(2022, 9, 13))]), "id", "updated")
    assert rows(s1, "headline", "dbt_valid_from", "dbt_valid_to") == srt([("v1", d(2022, 9, 13), None)])
    same_day = snapshot_timestamp(s1, _reviews(spark, [("r", "v1b", d(2022, 9, 13))]), "id", "updated")
    assert rows(same_day, "headline") == srt([("v1",)])                      # same-day edit missed
    earlier = snapshot_timestamp(s1, _reviews(spark, [("r", "v0", d(2022, 9, 1))]), "id", "updated")
    assert rows(earlier, "headline") == srt([("v1",)])                       # older arrival ignored
    later = snapshot_timestamp(s1, _reviews(spark, [("r", "v2", d(2022, 9, 20))]), "id", "updated")
    assert rows(later, "headline", "dbt_valid_from", "dbt_valid_to") == [
        ("v1", d(2022, 9, 13), d(2022, 9, 20)), ("v2", d(2022, 9, 20), None)]


def _fold_check(spark, feed, days):
    snap = None
    for day in days:
        batch = dedupe_latest(feed.filter(F.col("ts") == day), "k", ["ts", "seq"])
        snap = snapshot_check(snap, batch, "k", ["v"], day)
        snap = spark.createDataFrame(snap.collect(), snap.schema)   # cut lineage between days
    return snap


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["k1", "k2", "k3"]), st.integers(1, 4),
                          st.one_of(st.none(), st.sampled_from(["x", "y"]))), min_size=1, max_size=14))
def test_check_fold_equals_window_history(spark, data):
    # one row per key and day (the merge form takes the day's latest per key)
    seen, feed = set(), []
    for n, (k, day, v) in enumerate(data):
        if (k, day) not in seen:
            seen.add((k, day))
            feed.append((k, dt.datetime(2024, 1, day), n, v))
    df = spark.createDataFrame(feed, "k string, ts timestamp, seq int, v string")
    days = sorted({r[1] for r in feed})
    fold = _fold_check(spark, df, days)
    hist = scd2_history(df, "k", "ts", check_cols=["v"], tiebreak="seq")
    cols = ("k", "v", "dbt_scd_id", "dbt_valid_from", "dbt_valid_to")
    assert rows(fold, *cols) == rows(hist, *cols)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["k1", "k2"]), st.integers(1, 9)), min_size=1, max_size=12))
def test_timestamp_fold_equals_running_max_history(spark, data):
    feed = [(k, n, dt.date(2024, 1, u)) for n, (k, u) in enumerate(data)]
    df = spark.createDataFrame(feed, "k string, seq int, updated date")
    snap = None
    for n in range(len(feed)):          # one arrival per run
        snap = snapshot_timestamp(snap, df.filter(F.col("seq") == n), "k", "updated")
        snap = spark.createDataFrame(snap.collect(), snap.schema)
    hist = scd2_history(df, "k", "seq", updated_at="updated")
    cols = ("k", "updated", "dbt_scd_id", "dbt_valid_from", "dbt_valid_to")
    assert rows(snap, *cols) == rows(hist, *cols)


def test_dedupe_latest_one_row_per_key_with_tiebreak(spark):
    df = spark.createDataFrame([("a", 1, 1, "x"), ("a", 2, 1, "y"), ("a", 2, 2, "z"), ("b", 1, 1, "w")],
                               "k string, ts int, id int, v string")
    assert rows(dedupe_latest(df, "k", ["ts", "id"]), "k", "v") == srt([("a", "z"), ("b", "w")])
    plan = dedupe_latest(df, "k", ["ts", "id"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_max_by" in plan


def test_keys_of_latest_rows_need_no_rows(spark):
    from marquee.operators.scd2 import total_order

    data = [(k, n, v) for k in ("a", None, "c") for n, v in ((1, "x"), (3, None), (3, "w"), (None, "z"))]
    df = spark.createDataFrame(data, "k string, n int, v string")
    for order in (["n", "v"], total_order(df, "n"), "n", "k"):
        got = dedupe_latest(df, "k", order)
        assert got.columns == df.columns and got.schema.simpleString() == df.schema.simpleString()
        plan = got.select("k")._jdf.queryExecution().optimizedPlan().toString()
        assert "max" not in plan or order == "k"
    assert rows(dedupe_latest(df, "k", ["n", "v"])) == rows(spark.createDataFrame([(k, 3, "w") for k in ("a", None, "c")], df.schema))
    # numbers that are equal and look different: the latest row keeps its own key
    zeros = spark.createDataFrame([(0.0, 1), (-0.0, 2)], "k double, n int")
    assert [str(r.k) for r in dedupe_latest(zeros, "k", "n").collect()] == ["-0.0"]


def test_history_first_row_with_null_check_value_is_kept(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, None), ("a", 3, "x")], "k string, ts int, v string")
    h = scd2_history(df, "k", "ts", check_cols=["v"])
    assert rows(h, "ts", "v", "dbt_valid_to") == sorted([(1, None, 3), (3, "x", None)], key=repr)


ORDER_TYPES = {
    "timestamp": lambda h: dt.datetime(2024, 3, 9, 20) + dt.timedelta(hours=h),
    "timestamp_ntz": lambda h: dt.datetime(2024, 3, 9, 20) + dt.timedelta(hours=h),
    "date": lambda h: dt.date(2024, 3, 1) + dt.timedelta(days=h),
    "string": lambda h: f"day-{h:02d}",
    "int": lambda h: h,
}


@settings(max_examples=10, deadline=None, phases=[Phase.explicit, Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["k1", "k2", "k3"]), st.one_of(st.none(), st.integers(0, 30)),
                          st.one_of(st.none(), st.sampled_from(["x", "y"])), st.integers(1, 6)),
                min_size=1, max_size=40),
       st.integers(1, 6), st.sampled_from(sorted(ORDER_TYPES)), st.sampled_from(["UTC", "America/New_York"]))
@example([("k1", None, "x", 2), ("k1", None, "y", 3), ("k1", None, None, 5), ("k1", 3, "x", 1), ("k1", 3, "y", 6)],
         2, "timestamp", "UTC")
def test_split_hot_keys_equals_plain_windows(spark, data, split_rows, kind, zone):
    make = ORDER_TYPES[kind]
    df = spark.createDataFrame([(k, None if h is None else make(h), n, v, dt.date(2024, 1, u))
                                for n, (k, h, v, u) in enumerate(data)],
                               f"k string, ts {kind}, seq int, v string, upd date")
    cols = ("k", "seq", "dbt_scd_id", "dbt_valid_from", "dbt_valid_to")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for kw in (dict(check_cols=["v"]), dict(updated_at="upd")):
            plain = scd2_history(df, "k", "ts", tiebreak="seq", split_rows=None, **kw)
            split = scd2_history(df, "k", "ts", tiebreak="seq", split_rows=split_rows, **kw)
            assert rows(split, *cols) == rows(plain, *cols)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_split_hot_key_spreads_over_tasks(spark):
    from marquee.operators.scd2 import split_hot_keys

    # one key holds most rows, all of one order value: the tie-break column cuts it
    data = [("hot", dt.datetime(2024, 1, 1), i, "ab"[(i // 7) % 2]) for i in range(1000)]
    data += [(f"k{i}", dt.datetime(2024, 1, 1), 5000 + i, "a") for i in range(50)]
    df = spark.createDataFrame(data, "k string, ts timestamp, seq int, v string")
    split = scd2_history(df, "k", "ts", check_cols=["v"], tiebreak="seq", split_rows=100)
    plain = scd2_history(df, "k", "ts", check_cols=["v"], tiebreak="seq", split_rows=None)
    cols = ("k", "seq", "dbt_valid_from", "dbt_valid_to")
    assert rows(split, *cols) == rows(plain, *cols)
    rest, ranges = split_hot_keys(df, ["k"], ["ts", "seq"], 100)
    assert rest.count() == 50 and {r.k for r in ranges.collect()} == {"hot"}
    sizes = [r["count"] for r in ranges.groupBy("__chunk").count().collect()]
    assert len(sizes) >= 8 and max(sizes) <= 250
    spans = ranges.groupBy("__chunk").agg(F.min("seq").alias("a"), F.max("seq").alias("b")).orderBy("__chunk").collect()
    assert all(x.b < y.a for x, y in zip(spans, spans[1:]))


def test_chunks_of_few_rows_make_few_tasks(spark):
    from marquee.operators.scd2 import split_hot_keys

    # 400 chunks of 3 rows, as many files as the shuffle has partitions; whole rows come twice
    data = [(k, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i // 2), "ab"[i // 2 % 2]) for k in ("p", "q") for i in range(600)]
    df = spark.createDataFrame(data, "k string, ts timestamp, v string")
    _, ranges = split_hot_keys(df, ["k"], ["ts"], 3)
    assert len(ranges.inputFiles()) <= int(spark.conf.get("spark.sql.shuffle.partitions")) + 1
    sizes = [r["count"] for r in ranges.groupBy("__chunk").count().collect()]
    assert sum(sizes) == len(data) and len(sizes) >= 400 and max(sizes) == 3
    placed = [tuple(r) for r in ranges.orderBy("__pos").select("k", "ts", "__chunk").collect()]
    assert placed == sorted(placed)
    cols = ("k", "ts", "v", "dbt_valid_from", "dbt_valid_to")
    assert rows(scd2_history(df, "k", "ts", check_cols=["v"], split_rows=3), *cols) == rows(
        scd2_history(df, "k", "ts", check_cols=["v"], split_rows=None), *cols)


@settings(max_examples=12, deadline=None, phases=[Phase.explicit, Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["k1", "k2", None]), st.one_of(st.none(), st.integers(0, 20)),
                          st.sampled_from("xyz")), max_size=30),
       st.lists(st.tuples(st.sampled_from(["k1", "k2", "k3", None]), st.one_of(st.none(), st.integers(-1, 22))), max_size=30),
       st.sampled_from([None, 1, 4]))
def test_as_of_join_equals_nested_search(spark, changes, asked, split_rows):
    from marquee.operators.scd2 import as_of_join

    feed = spark.createDataFrame([(k, t, n, v) for n, (k, t, v) in enumerate(changes)], "k string, ts int, seq int, v string")
    history = scd2_history(feed, "k", "ts", check_cols=["v"], tiebreak="seq", split_rows=None).select(
        "k", "v", "seq", "dbt_valid_from", "dbt_valid_to")
    instants = spark.createDataFrame([(n, k, t) for n, (k, t) in enumerate(asked)], "n int, k string, at int")
    got = rows(as_of_join(instants, history, "k", "at", split_rows=split_rows), "n", "k", "at", "v_v", "v_seq")
    versions = history.collect()
    want = []
    for n, (k, t) in enumerate(asked):
        hit = [(r.v, r.seq) for r in versions if r.k == k and t is not None and r.dbt_valid_from is not None
               and r.dbt_valid_from <= t and (r.dbt_valid_to is None or t < r.dbt_valid_to)]
        assert len(hit) <= 1
        want.append((n, k, t, *(hit[0] if hit else (None, None))))
    assert got == sorted(want, key=repr)


def test_same_rows_in_any_input_order_give_one_winner(spark):
    from marquee.plans import models as M

    data = [("t1", "7.1", 5), ("t1", "7.4", 5), ("t1", None, 9), ("t2", "1.0", 1)]
    got = []
    for d in (data, data[::-1]):
        raw = spark.createDataFrame(d, "id string, average_rating string, num_votes int").repartition(3)
        got.append(rows(M.imdb_rating_snapshot(raw, None, "2024-01-01 00:00:00"), "id", "average_rating", "num_votes"))
    assert got[0] == got[1] == [("t1", "7.4", 5), ("t2", "1.0", 1)]
