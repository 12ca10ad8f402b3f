"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from scripts.compare import TABLES, digest

SF = "/root/testdata/sf0.001"
DUCK_TO_SPARK = {"INTEGER": "int", "BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double",
                 "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz", "FLOAT": "float"}
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["imdb_movie_id", "nyt_movie_id", "genre_id", "nyt_author_id", "nyt_review_id",
                          "average_rating", "num_votes", "is_critics_pick"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    sql = oracle_sql().get(name)
    if sql is None:
        pytest.skip("no SQL oracle")
    rel = con.sql(sql)
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    duck_types = {c: DUCK_TO_SPARK.get(str(t), str(t).lower()) for c, t in zip(rel.columns, rel.types)}
    assert {f.name: f.dataType.simpleString() for f in df.schema.fields} == duck_types
    assert len(srows) == len(drows)
    assert digest(df.columns, srows) == digest(rel.columns, drows)


def test_fact_with_hot_titles_equals_plain(spark):
    from marquee.plans import models as M
    from marquee.plans.queries import _star_inputs

    ratings, basics, reviews, dims = _star_inputs(spark, SF)
    plain = M.fct_imdb_nyt(ratings, basics, reviews, **dims, hot_rows=None)
    salted = M.fct_imdb_nyt(ratings, basics, reviews, **dims, hot_rows=1)   # every repeated title is hot
    cols = plain.columns
    assert digest(cols, [tuple(r) for r in salted.collect()]) == digest(cols, [tuple(r) for r in plain.collect()])
