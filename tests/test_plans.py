"""Plan-shape checks: filters reach the scan, unused columns are pruned, no nested loops."""

import datetime as dt

from pyspark.sql import functions as F

from marquee.operators import array_match_join, current
from marquee.plans import models as M


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _basics_parquet(spark, path):
    rows = [("tt1", "movie", "Heat", "Heat", False, 1995, None, 170, "Action,Crime"),
            ("tt2", "short", "S", "S", False, 1995, None, 5, "Short")]
    spark.createDataFrame(rows, M.BASICS_RAW).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_movie_filter_and_current_filter_reach_the_scan(spark, tmp_root):
    raw = _basics_parquet(spark, f"{tmp_root}/raw")
    snap = M.imdb_basic_snapshot(raw, None, dt.datetime(2024, 1, 1))
    plan = _plan(snap)
    assert "EqualTo(title_type,movie)" in plan
    snap.write.mode("overwrite").parquet(f"{tmp_root}/snap")
    stored = spark.read.parquet(f"{tmp_root}/snap")
    assert "IsNull(dbt_valid_to)" in _plan(current(stored))
    cleansed = M.basics_cleansed(stored, as_of="2024-01-01")
    assert "LessThanOrEqual(start_year,2025)" in _plan(cleansed)


def test_unused_flags_and_columns_are_pruned(spark, tmp_root):
    raw = _basics_parquet(spark, f"{tmp_root}/raw")
    snap = M.imdb_basic_snapshot(raw, None, dt.datetime(2024, 1, 1))
    snap.write.mode("overwrite").parquet(f"{tmp_root}/snap")
    cleansed = M.basics_cleansed(spark.read.parquet(f"{tmp_root}/snap"), as_of="2024-01-01")
    plan = _plan(cleansed.select("id", "genres_array"))
    assert "is_Drama_genre" not in plan
    read_schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "original_title" not in read_schema and "genres" in read_schema


def test_large_dimension_j6_has_no_nested_loop(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, None)], "id int, g array<string>")
    dim = spark.range(1000).select(F.col("id").cast("string").alias("v"))
    out = array_match_join(df, "g", dim, "v", ["v"])
    assert "NestedLoopJoin" not in _plan(out)
