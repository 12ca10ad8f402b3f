"""Two daily runs over movie-shaped fixtures (FIXTURES.md section 3 edge rows)."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from marquee.functions import flag_name
from marquee.operators.quality import QualityGateError
from marquee.plans import models as M
from marquee.plans.daily import DayFeeds, run_day
from marquee.sources import Catalog
from tests.conftest import rows, srt

BASICS_COLS = "tconst string, titleType string, primaryTitle string, originalTitle string, isAdult string, " \
              "startYear string, endYear string, runtimeMinutes string, genres string"
RATINGS_COLS = "tconst string, averageRating string, numVotes string"

DAY1_BASICS = [
    ("tt1", "movie", "Heat", "Heat", "0", "1995", None, "170", "Action,Crime,Drama"),
    ("tt2", "short", "Shorty", "Shorty", "0", "1995", None, "5", "Short"),          # not a movie
    ("tt3", "movie", "Future", "Future", "0", "2099", None, "90", "Drama"),         # far future
    ("tt4", "movie", "NoYear", "NoYear", "0", None, None, "90", "Drama"),           # NULL year
    ("tt5", "movie", "NoGenre", "NoGenre", "0", "2001", None, "80", None),          # NULL genres
    ("tt6", "movie", "Alien", "Alien", "0", "1979", None, "117", "Sci-Fi,Sci-Fi"),  # hyphen + repeat
    ("tt7", "movie", "Twins", "Twins", "0", "1988", None, "107", "Comedy"),         # same name+year
    ("tt8", "movie", "Twins", "Twins", "0", "1988", None, "100", "Comedy"),
    ("tt9", "movie", "Up", "Up", "0", "2009", None, "96", "Animation"),
]
DAY1_RATINGS = [("tt1", "8.3", "700000"), ("tt5", "5.0", "10"), ("tt6", "8.5", "900000"),
                ("tt7", "6.1", "200"), ("tt8", "5.5", "300"), ("tt9", "8.2", "1000000")]


def review(title, byline, headline, opening, updated, mpaa="R", pick=1, multimedia="absent"):
    r = {"display_title": title, "mpaa_rating": mpaa, "critics_pick": pick, "byline": byline,
         "headline": headline, "summary_short": "s", "publication_date": "2022-09-13",
         "opening_date": opening, "date_updated": updated, "link": {"url": f"u/{headline}"}}
    if multimedia != "absent":
        r["multimedia"] = multimedia
    else:
        r["multimedia"] = {"src": f"img/{headline}"}
    return r


DAY1_REVIEWS = [
    review("Heat", "Critic A", "h-heat", "1995-12-15", "2022-09-13 08:00:00"),
    review("Up", "Critic B", "h-up1", "2009-05-29", "2022-09-13 08:00:00", mpaa="", multimedia=None),
    review("Twins", "", "h-twins", "1988-12-09", "2022-09-13 08:00:00"),
]


def _variant(spark, records):
    return spark.createDataFrame([(json.dumps(r),) for r in records], "j string") \
        .select(F.parse_json("j").alias("content"))


def _feeds(spark, basics, ratings, reviews):
    return DayFeeds(
        basics=spark.createDataFrame(basics, BASICS_COLS) if basics is not None else None,
        ratings=spark.createDataFrame(ratings, RATINGS_COLS) if ratings is not None else None,
        reviews=_variant(spark, reviews) if reviews is not None else None)


@pytest.fixture()
def day1(spark, tmp_root):
    cat = Catalog(spark, tmp_root)
    results = run_day(cat, _feeds(spark, DAY1_BASICS, DAY1_RATINGS, DAY1_REVIEWS),
                      now=dt.datetime(2022, 9, 13), as_of="2022-09-13")
    return cat, results


def test_day1_models(spark, day1):
    cat, results = day1
    basics = spark.table("imdb_basics_cleansed")
    assert rows(basics, "id") == srt([("tt1",), ("tt5",), ("tt6",), ("tt7",), ("tt8",), ("tt9",)])
    flags = {r.id: r for r in basics.collect()}
    assert not any(flags["tt5"][flag_name(g)] for g in M.GENRES)
    assert flags["tt6"]["is_Sci_Fi_genre"] is True and flags["tt1"]["is_Crime_genre"] is True
    assert len(basics.columns) == 6 + 28 + 1

    titles = cat.read_table("dim_imdb_movies")
    assert "Twins" not in {r.name for r in titles.collect()}
    genres = {r.genre for r in cat.read_table("dim_imdb_genres").collect()}
    assert genres == {"Action", "Crime", "Drama", "Sci-Fi", "Comedy", "Animation"}
    authors = cat.read_table("dim_nyt_authors")
    assert authors.count() == 3 and authors.select("id").distinct().count() == 3

    fact = cat.read_table("fct_imdb_nyt")
    assert fact.columns == M.FACT_COLUMNS
    heat = fact.filter(F.col("imdb_movie_id") == "tt1")
    assert heat.count() == 3 and heat.select("nyt_movie_id").distinct().count() == 1
    assert fact.filter(F.col("imdb_movie_id") == "tt9").count() == 1
    # duplicate titles: kept with a NULL movie id, no NYT match (NULL name never joins)
    twins = fact.filter(F.col("average_rating").isin(6.1, 5.5))
    assert twins.count() == 2 and twins.filter(F.col("imdb_movie_id").isNotNull()).count() == 0
    # NULL genres -> one fact row with NULL genre id
    assert rows(fact.filter(F.col("num_votes") == 10), "genre_id") == srt([(None,)])

    reviews = spark.table("nyt_reviews_cleansed")
    assert rows(reviews.filter(F.col("movie_title").isin("Up", "Heat")), "mpaa_rating", "image_url") == \
        srt([(None, None), ("R", "img/h-heat")])
    assert all(results[k].isEmpty() for k in results)


def test_day2_versions_dims_insert_only_and_rerun(spark, day1):
    cat, _ = day1
    basics2 = [("tt1", "movie", "Heat", "Heat", "0", "1995", None, "170", "Action,Crime,Drama"),      # unchanged
               ("tt9", "movie", "Up", "Up", "0", "2009", None, "97", "Animation,Family"),           # changed
               ("tt6", "movie", "Alien", "Alien", "1", "1979", "1980", "117", "Sci-Fi,Sci-Fi"),     # other cols
               ("tt10", "movie", "Jaws", "Jaws", "0", "1975", None, "124", "Thriller")]             # new
    reviews2 = [review("Heat", "Critic A", "h-heat", "1995-12-15", "2022-09-13 20:00:00"),   # same day: missed
                review("Twins", "", "h-twins", "1988-12-09", "2022-09-20 08:00:00", mpaa="G"),  # later day
                review("Up", None, "h-up2", "2010-01-01", "2022-09-14 08:00:00", mpaa="PG", pick=0)]  # 2nd opening
    for _ in range(2):            # the second run is a rerun of the same day
        run_day(cat, _feeds(spark, basics2, [("tt10", "8.1", "600000")], reviews2),
                now=dt.datetime(2022, 9, 14), as_of="2022-09-14")
    snap = cat.read_table("imdb_basic_snapshot")
    versions = {r.id: r for r in snap.groupBy("id").count().collect()}
    assert versions["tt9"]["count"] == 2 and versions["tt1"]["count"] == 1 and versions["tt6"]["count"] == 1
    assert snap.filter("id = 'tt9' and dbt_valid_to is null").first().runtime_minutes == 97
    nyt = cat.read_table("nyt_snapshot")
    assert nyt.filter(F.col("movie_title") == "Heat").count() == 1
    assert rows(nyt.filter(F.col("review_headline") == "h-twins"), "mpaa_rating", "dbt_valid_to") == \
        srt([("R", dt.date(2022, 9, 20)), ("G", None)])
    # same title, two opening dates -> fan-out: 2 reviews x 2 movie-dim rows x 2 genres
    fact = cat.read_table("fct_imdb_nyt")
    assert fact.filter(F.col("imdb_movie_id") == "tt9").count() == 8
    genres = cat.read_table("dim_imdb_genres")
    assert genres.count() == genres.select("id").distinct().count() == 8       # + Family, Thriller
    titles = cat.read_table("dim_imdb_movies")
    assert titles.filter("id = 'tt9'").count() == 1 and titles.filter("id = 'tt10'").count() == 1
    # a NULL author has the key of '' (already stored): the insert-only dim does not grow
    assert cat.read_table("dim_nyt_authors").count() == 3


def test_empty_day_keeps_snapshots(spark, day1):
    cat, _ = day1
    before = cat.read_table("imdb_basic_snapshot").count()
    run_day(cat, DayFeeds(), now=dt.datetime(2022, 9, 15), as_of="2022-09-15")
    assert cat.read_table("raw_imdb_basics").count() == 0            # truncated anyway
    assert cat.read_table("imdb_basic_snapshot").count() == before
    assert cat.read_table("raw_nyt_reviews").count() == 0


def write_sources(folder, day, basics, ratings, reviews=None):
    import os

    os.makedirs(f"{folder}/{day}", exist_ok=True)
    paths = {}
    for name, cols, data in (("basics", BASICS_COLS, basics), ("ratings", RATINGS_COLS, ratings)):
        paths[name] = f"{folder}/{day}/{name}.tsv"
        with open(paths[name], "w") as f:
            f.write("\t".join(c.split()[0] for c in cols.split(", ")) + "\n")
            f.writelines("\t".join("\\N" if v is None else v for v in r) + "\n" for r in data)
    if reviews is not None:
        paths["reviews"] = f"{folder}/{day}/reviews.json"
        with open(paths["reviews"], "w") as f:
            json.dump(reviews, f)
    return paths


def many_titles(n, junk):
    return [(f"tm{i}", "movie", f"Title {i}", f"Title {i}", "0", "1990", None, "junk" if i < junk else "100", "Drama")
            for i in range(n)]


def test_pipeline_from_landed_paths(spark, tmp_root, local_dir):
    from marquee.plans.daily import run_pipeline

    # day 1: no reviews at all; 0.1 % junk runtimes are dropped, everything else loads and is tested
    basics = DAY1_BASICS + many_titles(991, 1)
    ratings = DAY1_RATINGS + [("tm5", "0.0", "7")]
    out = run_pipeline(spark, tmp_root, write_sources(local_dir, "d1", basics, ratings), "2022-09-13")
    cat = out["catalog"]
    assert cat.read_table("raw_imdb_basics").count() == 999
    assert cat.read_table("dim_imdb_movies").count() > 900 and cat.read_table("fct_imdb_nyt").count() > 0
    assert cat.read_table("raw_nyt_reviews").count() == 0 and cat.read_table("dim_nyt_reviews").count() == 0
    assert rows(out["tests"]["imdb_ratings_positive_average_rating"], "id") == [("tm5",)]
    assert {r.status for r in out["loads"]["basics"].collect()} == {"PARTIALLY_LOADED"}
    stored = spark.read.parquet(f"{tmp_root}/validation/imdb-basic.raw/ds=2022-09-13")
    assert stored.count() == 4 and stored.filter("NOT success").count() == 0

    # day 2: known ids are not landed again; reviews arrive
    out = run_pipeline(spark, tmp_root, write_sources(local_dir, "d2", basics + [
        ("tt99", "movie", "Jaws", "Jaws", "0", "1975", None, "124", "Thriller")], ratings, DAY1_REVIEWS), "2022-09-14")
    assert rows(cat.read_table("raw_imdb_basics"), "id") == [("tt99",)]
    assert cat.read_table("raw_nyt_reviews").count() == 3 and cat.read_table("nyt_snapshot").count() == 3
    assert rows(out["catalog"].read_table("nyt_snapshot"), "mpaa_rating", "image_url") == srt(
        [("R", "img/h-heat"), ("", None), ("R", "img/h-twins")])
    assert cat.read_table("fct_imdb_nyt").filter("nyt_movie_id IS NOT NULL").count() > 0

    # day 3: nothing new anywhere: raw tables are truncated, the rest stays
    before = cat.read_table("fct_imdb_nyt").count()
    out = run_pipeline(spark, tmp_root, {}, "2022-09-15")
    assert [cat.read_table(t).count() for t in ("raw_imdb_basics", "raw_imdb_ratings", "raw_nyt_reviews")] == [0, 0, 0]
    assert cat.read_table("fct_imdb_nyt").count() == before and len(out["tests"]) == 12


def test_pipeline_skips_a_bad_file_and_registers_only_after_success(spark, tmp_root, local_dir):
    from marquee.plans.daily import run_pipeline

    out = run_pipeline(spark, tmp_root, write_sources(local_dir, "bad", many_titles(100, 2), DAY1_RATINGS), "2022-09-13")
    assert {r.status for r in out["loads"]["basics"].collect()} == {"SKIPPED"}
    assert out["catalog"].read_table("raw_imdb_basics").count() == 0

    nameless = [("tt1", "movie", None, None, "0", "1995", None, "1", "Drama")]
    root2 = f"{tmp_root}-gate"
    with pytest.raises(QualityGateError):
        run_pipeline(spark, root2, write_sources(local_dir, "gate", nameless, DAY1_RATINGS), "2022-09-13")
    failed = spark.read.parquet(f"{root2}/validation/imdb-basic.raw/ds=2022-09-13").filter("NOT success")
    assert failed.count() == 2
    # the day can be run again: nothing was registered
    out = run_pipeline(spark, root2, write_sources(local_dir, "again", DAY1_BASICS, DAY1_RATINGS), "2022-09-13")
    assert out["catalog"].read_table("raw_imdb_basics").count() == len(DAY1_BASICS)


def test_rows_that_were_not_loaded_come_again(spark, tmp_root, local_dir):
    from marquee.plans.daily import run_pipeline

    titles = [("tt1", "movie", "Heat", "Heat", "0", "1995", None, "170", "Drama"),
              ("tt2", "movie", "Alien", "Alien", "0", "1979", None, "junk", "Sci-Fi"),
              ("tt3", "movie", "Up", "Up", "0", "2009", None, "96", "Animation")]
    mended = [t if t[0] != "tt2" else (*t[:7], "117", t[8]) for t in titles]
    for register, after in (("loaded", [["tt1", "tt3"], ["tt1", "tt3"], ["tt1", "tt2", "tt3"]]), ("landed", [[], [], []])):
        root = f"{tmp_root}-{register}"
        out = run_pipeline(spark, root, write_sources(local_dir, f"{register}1", titles, DAY1_RATINGS), "2022-09-13",
                           register=register, buckets=4)
        assert {r.status for r in out["loads"]["basics"].collect()} == {"SKIPPED"}
        # the good rows of the skipped file come again, the unreadable one when it is mended
        for day, (source, want) in enumerate(zip((titles, titles, mended), after), 14):
            out = run_pipeline(spark, root, write_sources(local_dir, f"{register}{day}", source, DAY1_RATINGS),
                               f"2022-09-{day}", register=register, buckets=4)
            assert [r.id for r in out["catalog"].read_table("imdb_basic_snapshot").orderBy("id").collect()] == want


def test_suite_observed_by_the_landing_write_equals_the_suite_on_the_rows(spark, tmp_root):
    from marquee.operators import quality as Q
    from marquee.plans.daily import land_observed

    suite = [Q.not_null("a"), Q.not_null("b", mostly=0.5), Q.in_set("b", ["x", "y"], mostly=0.5), Q.unique_proportion("a", 0.5, 1.0),
             Q.in_type_list("a", ["StringType"]), Q.columns_match_set(["a", "b"]), Q.not_null("gone")]
    df = spark.createDataFrame([("1", "x"), ("2", "z"), ("2", None), ("3", "y"), (None, "x")], "a string, b string")
    landed, seen = land_observed(df, f"{tmp_root}/l", "2024-01-01", suite)
    assert seen.rows == 5 and rows(seen.result(landed)) == rows(Q.run_suite(landed, suite))
    empty, seen = land_observed(df.limit(0), f"{tmp_root}/e", "2024-01-01", suite)
    assert empty is None and seen.rows == 0
    # the source is read once, by the write
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    land_observed(df.mapInArrow(counted, df.schema), f"{tmp_root}/once", "2024-01-01", suite)
    assert reads.value == 5


def test_failing_gate_blocks_the_load(spark, tmp_root):
    cat = Catalog(spark, tmp_root)
    bad = [("tt1", "movie", None, None, "0", "1995", None, "1", "Drama")]     # titles below 99 % non-null
    with pytest.raises(QualityGateError):
        run_day(cat, _feeds(spark, bad, None, None), now=dt.datetime(2022, 9, 13))
    assert not cat.exists("raw_imdb_basics")


def test_extract_land_and_register_last(spark, tmp_root):
    from marquee.plans.daily import commit_ids, extract_new, land_day
    from marquee.sources import IdRegistry

    reg = IdRegistry(spark, f"{tmp_root}/ids")
    src = spark.createDataFrame([("tt1", "1995"), ("tt2", "\\N"), ("tt3", "NA")], "tconst string, startYear string")
    day1 = extract_new(reg, src, "tconst")
    assert rows(day1) == srt([("tt1", "1995"), ("tt2", None), ("tt3", "NA")])
    assert rows(extract_new(reg, src, "tconst", pandas_na=True), "startYear") == srt([("1995",), (None,), (None,)])
    landed = land_day(day1, f"{tmp_root}/landing", "2022-09-13")
    # a failed load before commit_ids: the rerun sees the same new rows again
    assert extract_new(reg, src, "tconst").count() == 3
    commit_ids(reg, landed, "tconst")
    src2 = src.union(spark.createDataFrame([("tt4", "2001")], src.schema))
    assert rows(extract_new(reg, src2, "tconst"), "tconst") == [("tt4",)]
    assert rows(extract_new(reg, src2, "tconst", mode="all"), "tconst") == srt(
        [("tt1",), ("tt2",), ("tt3",), ("tt4",)])
    assert land_day(extract_new(reg, src, "tconst"), f"{tmp_root}/landing", "2022-09-14") is None


def test_post_build_tests_report_one_failing_row_each(spark, tmp_root):
    cat = Catalog(spark, tmp_root)
    basics = [("tt1", "movie", "Zero Runtime", "Z", "0", "2001", None, "0", "Drama"),
              ("tt2", "movie", "Year Zero", "Y", "0", "0", None, "90", "Drama")]
    ratings = [("tt1", "0.0", "10"), ("tt2", "7.0", "0")]
    reviews = [review("", "Critic A", "h-empty", "2001-01-01", "2022-09-13 08:00:00")]
    results = run_day(cat, _feeds(spark, basics, ratings, reviews), now=dt.datetime(2022, 9, 13),
                      as_of="2022-09-13")
    expected_one = ["dim_imdb_movies_runtime_minutes_nonnegative", "dim_imdb_movies_year_positive",
                    "imdb_ratings_positive_average_rating", "imdb_ratings_positive_num_votes",
                    "nyt_reviews_movie_title_has_length"]
    for name in expected_one:
        assert results[name].count() == 1, name
    others = [k for k in results if k not in expected_one]
    assert all(results[k].isEmpty() for k in others)
