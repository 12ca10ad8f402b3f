from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marquee.operators import (
    anti_by_registry,
    append_new,
    array_match_join,
    distinct_elements,
    fanout_join,
    groups_of_size,
    join_feeds,
    left_lookup,
    skew_join,
    unique_rows,
)
from tests.conftest import rows, srt
from tests.oracles import array_match_join_theta, unique_rows_selfjoin


def test_anti_by_registry_plain_and_null_safe(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "id string")
    ids = spark.createDataFrame([("a",), (None,)], "id string")
    assert rows(anti_by_registry(df, ids, "id")) == sorted([("b",), (None,)], key=repr)
    assert rows(anti_by_registry(df, ids, "id", null_safe=True)) == srt([("b",)])


def test_append_new_not_in_semantics(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "id string")
    empty = spark.createDataFrame([], "id string")
    with_null = spark.createDataFrame([("a",), (None,)], "id string")
    plain = spark.createDataFrame([("a",)], "id string")
    assert rows(append_new(df, None, "id")) == rows(df)
    # NOT IN (empty set) is TRUE for every row, NULL keys included
    assert rows(append_new(df, empty, "id", null_aware=True)) == rows(df)
    # NOT IN a set holding NULL is never TRUE
    assert rows(append_new(df, with_null, "id", null_aware=True)) == []
    # NULL NOT IN (non-empty set) is NULL -> dropped
    assert rows(append_new(df, plain, "id", null_aware=True)) == srt([("b",)])
    # and it equals Spark SQL's own NOT IN
    df.createOrReplaceTempView("t_df")
    plain.createOrReplaceTempView("t_plain")
    sql = spark.sql("select * from t_df where id not in (select id from t_plain)")
    assert rows(sql) == srt([("b",)])


def test_unique_rows_drops_duplicates_and_null_keys(spark):
    df = spark.createDataFrame(
        [("t1", "Heat", 1995, 170), ("t2", "Heat", 1995, 100), ("t3", "Heat", 1986, 120),
         ("t4", None, 2000, 90), ("t5", "Up", None, 96)],
        "id string, primary_title string, year int, runtime int")
    got = rows(unique_rows(df, ["primary_title", "year"], ["id", "runtime"]), "id", "primary_title", "year")
    assert got == srt([("t3", "Heat", 1986)])
    assert rows(unique_rows_selfjoin(df, ["primary_title", "year"], ["id", "runtime"]),
                "id", "primary_title", "year") == got
    assert rows(groups_of_size(df, ["primary_title", "year"], 2)) == srt([("Heat", 1995)])


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 2), st.integers(0, 9)),
                max_size=25))
def test_unique_rows_equals_selfjoin_property(spark, data):
    df = spark.createDataFrame(data, "k1 string, k2 int, v int")
    assert rows(unique_rows(df, ["k1", "k2"])) == rows(unique_rows_selfjoin(df, ["k1", "k2"]))


ARRAYS = [
    (1, ["Drama", "Drama", "Crime"]),   # duplicate element -> one row per dim row
    (2, ["Short"]),                     # no dim match -> one NULL row
    (3, None),                          # NULL array -> one NULL row
    (4, []),                            # empty array -> one NULL row
    (5, ["Drama", None]),               # NULL element never matches
    (6, ["Sci-Fi", "Crime"]),
]
DIM = [("g1", "Drama"), ("g2", "Crime"), ("g3", "Sci-Fi"), ("g4", "Sci-Fi"), ("g5", None)]


def test_array_match_join_equals_theta_on_edge_cases(spark):
    df = spark.createDataFrame(ARRAYS, "id int, genres array<string>")
    dim = spark.createDataFrame(DIM, "genre_id string, genre string")
    equi = array_match_join(df, "genres", dim, "genre", ["genre_id"])
    theta = array_match_join_theta(df, "genres", dim, "genre", ["genre_id"])
    assert rows(equi, "id", "genre_id") == rows(theta, "id", "genre_id")
    got = rows(equi, "id", "genre_id")
    assert got.count((1, "g1")) == 1 and (1, "g2") in got
    for i in (2, 3, 4):
        assert [r for r in got if r[0] == i] == srt([(i, None)])
    assert [r for r in got if r[0] == 6] == sorted([(6, "g2"), (6, "g3"), (6, "g4")])
    plan = equi._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(["a", "b", "c", "d", None]), max_size=4)),
                max_size=12),
       st.lists(st.sampled_from(["a", "b", "c", None]), max_size=5))
def test_array_match_join_equals_theta_property(spark, arrays, dim_values):
    df = spark.createDataFrame(list(enumerate(arrays)), "id int, g array<string>")
    dim = spark.createDataFrame([(f"d{i}", v) for i, v in enumerate(dim_values)], "did string, v string")
    assert rows(array_match_join(df, "g", dim, "v", ["did"]), "id", "did") == \
        rows(array_match_join_theta(df, "g", dim, "v", ["did"]), "id", "did")


def test_distinct_elements_flatten_drops_null_and_empty(spark):
    df = spark.createDataFrame([(["a", "b"],), (["a"],), (None,), ([],)], "g array<string>")
    assert rows(distinct_elements(df, "g", "genre")) == srt([("a",), ("b",)])


def test_lookups_and_fanout(spark):
    reviews = spark.createDataFrame([("Heat", "h1"), ("Up", "h2"), ("Nope", "h3")], "title string, head string")
    dim = spark.createDataFrame([("m1", "Heat"), ("m2", "Heat"), ("m3", "Up")], "mid string, name string")
    fan = fanout_join(reviews, dim, "title", right_on="name")
    assert rows(fan, "title", "mid") == srt([("Heat", "m1"), ("Heat", "m2"), ("Up", "m3")])
    left = left_lookup(reviews, dim.filter("mid != 'm2'"), "title", right_on="name")
    assert rows(left, "title", "mid") == srt([("Heat", "m1"), ("Nope", None), ("Up", "m3")])
    assert "name" not in left.columns


def test_join_feeds_year_only_with_switch(spark):
    imdb = spark.createDataFrame([("Heat", 1995, "i1")], "movie_name string, year int, imdb string")
    nyt = spark.createDataFrame([("Heat", 2020, "n1")], "movie_name string, year int, nyt string")
    parity = join_feeds(imdb, nyt, ["movie_name"], extra_keys=["year"])
    assert rows(parity, "imdb", "nyt") == srt([("i1", "n1")])
    strict = join_feeds(imdb, nyt, ["movie_name"], extra_keys=["year"], match_extra=True)
    assert rows(strict, "imdb", "nyt") == srt([("i1", None)])


def test_duplicate_conjunct_is_one_key(spark):
    a = spark.createDataFrame([("x",)], "k string")
    b = spark.createDataFrame([("x",)], "k2 string")
    j = a.join(b, (a.k == b.k2) & (a.k == b.k2), "left")
    assert "NestedLoopJoin" not in j._jdf.queryExecution().executedPlan().toString()
    assert j.filter(F.col("k2").isNotNull()).count() == 1


def test_skew_join_equals_plain_join(spark):
    left = spark.createDataFrame([("hot", i) for i in range(300)] + [("a", 1), ("b", 2), (None, 3)],
                                 "k string, lv int")
    right = spark.createDataFrame([("hot", "x"), ("hot", "y"), ("a", "z"), ("c", "w")], "k string, rv string")
    big_right = spark.createDataFrame([("hot", f"r{i}") for i in range(200)] + [("a", "z")], "k string, rv string")
    for how in ("inner", "left"):
        assert rows(skew_join(left, right, "k", how, "left", hot_rows=50)) == rows(left.join(right, "k", how))
        assert rows(skew_join(left, big_right, "k", how, "right", hot_rows=50)) == \
            rows(left.join(big_right, "k", how))
    salted = skew_join(left, right, "k", "inner", "left", hot_rows=50)
    assert "__salt" not in salted.columns


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(["a", "b", "c", None]), max_size=14),
       st.lists(st.sampled_from(["a", "b", "d", None]), max_size=14), st.integers(1, 4))
def test_skew_join_property(spark, lkeys, rkeys, hot_rows):
    left = spark.createDataFrame(list(zip(lkeys, range(99))), "k string, lv int")
    right = spark.createDataFrame(list(zip(rkeys, range(99))), "k string, rv int")
    for how in ("inner", "left"):
        for side in ("left", "right"):
            got = skew_join(left, right, "k", how, side, hot_rows=hot_rows)
            assert rows(got) == rows(left.join(right, "k", how)), (how, side)


def test_joins_build_without_jobs(spark):
    """No operator runs an action while its plan is built."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plans-only", "plans-only")
    try:
        a, b = spark.range(50).withColumn("k", F.col("id") % 3), spark.range(50).withColumn("k", F.col("id") % 3)
        skew_join(a, b.drop("id"), "k", "left", "right", hot_rows=2)
        array_match_join(a.select(F.array("k").alias("g")), "g", b.distinct(), "k", ["id"])
        anti_by_registry(a, b, "k")
        append_new(a, b, "k", null_aware=True)
        assert not tracker.getJobIdsForGroup("plans-only")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_array_match_join_takes_dim_columns_of_any_type(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, ["c"])], "id int, g array<string>")
    dim = spark.sql("SELECT 'a' AS v, map('x', 1) AS m, named_struct('n', 2) AS s")
    got = array_match_join(df, "g", dim, "v", ["m", "s"]).collect()
    assert sorted((r.id, r.m and dict(r.m), r.s and r.s.n) for r in got) == [(1, {"x": 1}, 2), (2, None, None)]


def test_equal_rows_of_a_hot_key_are_spread(spark):
    from marquee.operators.joins import _deal

    same = spark.range(10_000).select(F.lit("k").alias("k"), F.lit(1).alias("v"))
    hot = spark.createDataFrame([("k", 100)], "k string, __b long")
    sizes = [r["count"] for r in _deal(same, hot, ["k"]).groupBy("__bucket").count().collect()]
    assert len(sizes) == 100 and max(sizes) < 300
    joined = skew_join(same, spark.createDataFrame([("k", 7)], "k string, w int"), "k", "left", "left", hot_rows=100)
    assert joined.count() == 10_000 and joined.distinct().count() == 1
