import datetime as dt

import duckdb
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from marquee.functions import (
    between_dates,
    blank_to_null,
    cast_columns,
    contains_any,
    flag_name,
    has_value,
    json_field,
    not_future,
    null_sentinel,
    null_to_false,
    scd_id,
    split_list,
    surrogate_key,
    variant_field,
)


def test_surrogate_key_matches_warehouse_text_and_duckdb(spark):
    df = spark.createDataFrame([("Heat", dt.date(1995, 12, 15))], "title string, d date")
    got = df.select(surrogate_key("title", "d").alias("k")).first().k
    want = duckdb.sql("select md5(coalesce('Heat','') || '-' || coalesce(cast(date '1995-12-15' as varchar),''))"
                      ).fetchall()[0][0]
    assert got == want


def test_surrogate_key_known_collisions_are_kept(spark):
    df = spark.createDataFrame([(None, "x"), ("", "x"), ("a-b", "c"), ("a", "b-c")], "a string, b string")
    ks = [r.k for r in df.select(surrogate_key("a", "b").alias("k")).collect()]
    assert ks[0] == ks[1]            # NULL and '' give the same key
    assert ks[2] == ks[3]            # separator inside a part collides


def test_scd_id_uses_pipe(spark):
    df = spark.createDataFrame([("k1", "2024-01-01")], "k string, t string")
    got = df.select(scd_id("k", "t").alias("x")).first().x
    assert got == duckdb.sql("select md5('k1|2024-01-01')").fetchall()[0][0]


def test_split_list_and_has_value(spark):
    df = spark.createDataFrame([("Drama,Sci-Fi",), ("",), (None,)], "g string")
    out = df.select(split_list("g", ",").alias("a")).collect()
    assert out[0].a == ["Drama", "Sci-Fi"] and out[1].a == [""] and out[2].a is None
    arr = spark.createDataFrame([(["a", None],), (None,), (["b"],)], "a array<string>")
    flags = [r.f for r in arr.select(has_value("a", "b").alias("f")).collect()]
    assert flags == [False, False, True]     # never NULL


def test_split_list_separator_is_literal(spark):
    df = spark.createDataFrame([("a.b|c",)], "s string")
    assert df.select(split_list("s", ".").alias("x")).first().x == ["a", "b|c"]
    assert df.select(split_list("s", "|").alias("x")).first().x == ["a.b", "c"]


def test_null_helpers(spark):
    df = spark.createDataFrame([("", None), ("PG", True), (r"\N", False)], "r string, b boolean")
    out = df.select(blank_to_null("r").alias("r"), null_to_false("b").alias("b")).collect()
    assert [(x.r, x.b) for x in out] == [(None, False), ("PG", True), (r"\N", False)]
    s = null_sentinel(df)
    assert [x.r for x in s.collect()] == ["", "PG", None]
    assert s.schema == df.schema


def test_cast_columns_chain_and_strictness(spark):
    df = spark.createDataFrame([("1", "x"), ("0", "2")], "a string, b string")
    out = cast_columns(df, {"a": ["int", "boolean"], "b": "int"}).collect()
    assert [(r.a, r.b) for r in out] == [(True, None), (False, 2)]
    with pytest.raises(PySparkException):
        cast_columns(df, {"b": "int"}, strict=True).collect()


def test_not_future_and_between(spark):
    df = spark.createDataFrame([(2024,), (2025,), (2026,), (None,)], "y int")
    kept = [r.y for r in df.filter(not_future("y", as_of="2024-06-01")).collect()]
    assert kept == [2024, 2025]
    ts = spark.createDataFrame([(dt.datetime(2022, 9, 13, 23, 59),), (dt.datetime(2022, 9, 14, 0, 0),)],
                               "t timestamp")
    assert ts.filter(between_dates("t", "2022-09-13", "2022-09-13")).count() == 1


def test_flag_name():
    assert flag_name("Sci-Fi") == "is_Sci_Fi_genre"
    assert flag_name("Film-Noir") == "is_Film_Noir_genre"


def test_variant_paths_json_null_versus_missing(spark):
    df = spark.createDataFrame(
        [('{"link": {"url": "u1"}, "multimedia": {"src": "s"}}',),
         ('{"link": {"url": "u2"}, "multimedia": null}',),
         ('{"link": {"url": "u3"}}',)], "j string")
    v = df.select(F.parse_json("j").alias("v"))
    out = v.select(variant_field("v", "link.url", "string").alias("u"),
                   variant_field("v", "multimedia.src", "string").alias("s")).collect()
    assert [(r.u, r.s) for r in out] == [("u1", "s"), ("u2", None), ("u3", None)]
    k = spark.createDataFrame([('{"k": 7}',), ("not json",)], "p string")
    assert [r.k for r in k.select(json_field("p", "$.k", "int").alias("k")).collect()] == [7, None]


def test_contains_any(spark):
    df = spark.createDataFrame([("https://x/title.basics.tsv.gz",), ("https://x/name.tsv.gz",)], "u string")
    got = [r.u for r in df.filter(contains_any("u", ["title.basics", "title.ratings"])).collect()]
    assert got == ["https://x/title.basics.tsv.gz"]


def test_one_hot_escapes_values_and_names(spark):
    from marquee.operators import one_hot

    df = spark.createDataFrame([(1, ["it's", "a\\b"]), (2, None)], "id int, g array<string>")
    out = one_hot(df, "g", ["it's", "a\\b", "Sci-Fi"], name_fn=lambda v: f"f[{v}]")
    got = {r.id: tuple(r)[2:] for r in out.collect()}
    assert got == {1: (True, True, False), 2: (False, False, False)}


def test_surrogate_key_name_and_column_forms_agree(spark):
    df = spark.createDataFrame([("a", None, dt.date(2020, 1, 2))], "x string, y string, d date")
    by_name = df.select(surrogate_key("x", "y", "d").alias("k")).first().k
    by_col = df.select(surrogate_key(F.col("x"), F.col("y"), F.col("d")).alias("k")).first().k
    assert by_name == by_col
