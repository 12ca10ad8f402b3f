import pytest

from marquee.operators import quality as Q
from marquee.plans import suites as S
from tests.conftest import rows, srt


def _reviews(spark, data):
    return spark.createDataFrame(data, "display_title string, mpaa_rating string, critics_pick long")


def test_suite_runs_in_one_aggregate_and_reports_each_expectation(spark):
    df = _reviews(spark, [("Heat", "R", 1), ("Up", "", 0), ("Jaws", "PG", 1), (None, None, 2)])
    suite = [Q.not_null("display_title"), Q.not_null("display_title", mostly=0.7),
             Q.unique_proportion("display_title", 1.0, 1.0), Q.in_set("mpaa_rating", S.MPAA_RATINGS),
             Q.in_set("critics_pick", [0, 1]), Q.in_type_list("mpaa_rating", S.STRING_TYPE_NAMES),
             Q.in_type_list("critics_pick", S.INT_TYPE_NAMES), Q.in_type_list("critics_pick", S.STRING_TYPE_NAMES),
             Q.columns_match_set(["critics_pick", "display_title", "mpaa_rating"]),
             Q.columns_match_set(["display_title"])]
    res = Q.run_suite(df, suite)
    got = {r.expectation_index: r for r in res.collect()}
    assert len(got) == len(suite)
    assert got[0].success is False and got[0].unexpected_count == 1 and got[0].observed_value == 0.75
    assert got[1].success is True                      # mostly
    assert got[2].success is True                      # 3 distinct of 3 non-null
    assert got[3].success is True                      # '' allowed, NULL ignored
    assert got[4].success is False and got[4].unexpected_count == 1
    assert [got[i].success for i in (5, 6, 7, 8, 9)] == [True, True, False, True, False]
    plan = res._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") + plan.count("Scan ExistingRDD") == 1


def test_empty_batch_passes(spark):
    res = Q.run_suite(_reviews(spark, []), [Q.not_null("display_title"), Q.in_set("mpaa_rating", ["R"])])
    assert all(r.success for r in res.collect())


def test_gate_raises_on_failure(spark):
    bad = Q.run_suite(_reviews(spark, [(None, "R", 1)]), S.REVIEWS_RAW_SUITE[:1])
    with pytest.raises(Q.QualityGateError):
        Q.gate(bad)
    good = Q.run_suite(_reviews(spark, [("Heat", "R", 1)]), S.REVIEWS_RAW_SUITE[:3])
    assert Q.gate(good) is good


def test_dbt_tests(spark):
    df = _reviews(spark, [("Heat", "R", 1), ("", None, 0), (None, "X", 0), ("Up", "X", 1)])
    assert rows(Q.failing_nulls(df, "display_title"), "mpaa_rating") == srt([("X",)])
    # NULL passes accepted_values; each offending value once with its count
    assert rows(Q.accepted_values(df, "mpaa_rating", S.ACCEPTED_MPAA)) == srt([("X", 2)])
    # "nonnegative" test enforces strictly positive; NULL never fails
    assert rows(Q.failing_rows(df, "length(display_title) = 0"), "critics_pick") == srt([(0,)])
    assert Q.passes(Q.failing_rows(df, "critics_pick < 0"))


def test_suite_from_json_document():
    doc = {"expectations": [{"expectation_type": Q.NOT_NULL, "kwargs": {"column": "tconst"}}]}
    assert Q.from_json_suite(doc) == [Q.Expectation(Q.NOT_NULL, {"column": "tconst"})]


def test_absent_column_fails_its_expectations(spark):
    suite = [Q.not_null("gone"), Q.in_set("gone", ["x"]), Q.unique_proportion("gone", 1.0), Q.in_type_list("gone", ["string"]),
             Q.columns_match_set(["a", "gone"]), Q.not_null("a")]
    got = Q.run_suite(spark.createDataFrame([("v",)], "a string"), suite).collect()
    assert [r.success for r in got] == [False] * 5 + [True]
    assert got[0].unexpected_count == 1 and got[0].column == "gone"
