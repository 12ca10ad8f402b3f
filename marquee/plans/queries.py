"""Registered queries over the driver tables, each with its DuckDB oracle SQL.

Every query reads whole driver tables (or frames Spark derives from them),
runs the library's operators, and returns a DataFrame whose column names match
its oracle SQL. ``QUERIES`` maps a key to ``(fn(spark, sf_dir) -> DataFrame,
oracle_sql | None)``; ``None`` means no SQL form (a rows-only check).
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions import (
    contains_any,
    ends_with,
    flag_name,
    between_dates,
    blank_to_null,
    cast_columns,
    json_field,
    not_future,
    null_sentinel,
    split_list,
    surrogate_key,
    without,
)
from marquee.operators import quality as Q
from marquee.operators.joins import (
    anti_by_registry,
    append_new,
    array_match_join,
    fanout_join,
    left_lookup,
    unique_rows,
)
from marquee.operators.onehot import one_hot
from marquee.operators.scd2 import as_of, as_of_join, current, dedupe_latest, scd2_history, snapshot_check, snapshot_timestamp
from marquee.plans import models as M
from marquee.plans import standins as SI
from marquee.plans import suites as S
from marquee.plans.daily import RATINGS_COLUMNS, failure_counts, land_observed, load_and_build, run_pipeline, snapshot_run
from marquee.plans.fact import FactTable, KeyCounts
from marquee.session import scratch_path, table_path
from marquee.sources.catalog import Catalog
from marquee.sources.html import extract_links, match_tables, union_pages
from marquee.sources.readers import (
    CsvFormat,
    JsonFormat,
    Stage,
    batch,
    copy_into,
    list_assets,
    read_csv_format,
    read_tsv,
    read_variant,
    sample_batch,
)
from marquee.sources.registry import IdRegistry
from marquee.sources.snapshots import EventHistory, SnapshotTable
from marquee.sources.writers import write_csv_gz, write_json

QUERIES: dict[str, tuple] = {}


def query(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return deco


def _t(spark, d, name):
    return SI.read(spark, d, name)


# Words of part names (the stand-in genre vocabulary) used as one-hot values,
# and the words left out of the theta-join dimension to exercise unmatched rows.
PART_WORDS = ["anvil", "blue", "bolt", "cold", "gear", "gizmo", "hot", "large", "new", "old",
              "plate", "red", "ring", "rod", "small", "widget"]
WORDS_MISSING_FROM_DIM = ["anvil", "red", "widget"]

# Buckets of the snapshot tables in queries whose days touch most keys; a day of few keys wants many more.
BUCKETS = 16
AS_OF_TS = "2024-01-15 12:00:00"
RUN_TS = "2024-02-01 00:00:00"


def _md5_sql(*parts, sep="-"):
    inner = f" || '{sep}' || ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts)
    return f"md5({inner})"


# ------------------------------------------------------------------ J1 / J2

@query("anti_registry", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate
FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
""")
def q_anti_registry(spark, d):
    orders = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    return anti_by_registry(orders, _t(spark, d, "lineitem"), "o_orderkey", "l_orderkey")


@query("incremental_not_in", """
SELECT o_orderkey AS id, o_totalprice
FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
""")
def q_incremental_not_in(spark, d):
    rows = _t(spark, d, "orders").select(F.col("o_orderkey").alias("id"), "o_totalprice")
    target = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"))
    return append_new(rows, target, "id", null_aware=True)


# ------------------------------------------------------------------ P3 / P12

@query("sentinel_null", """
SELECT p_partkey, nullif(p_name, 'SMALL') AS p_name, nullif(p_brand, 'SMALL') AS p_brand,
       nullif(nullif(p_type, 'SMALL'), '') AS p_type, p_size, p_retailprice
FROM part
""")
def q_sentinel_null(spark, d):
    part = null_sentinel(_t(spark, d, "part"), "SMALL")
    return part.withColumn("p_type", blank_to_null("p_type"))


# ----------------------------------------------------------------- J3 / A1

@query("unique_rows", """
SELECT p_partkey, p_name, p_size, p_brand FROM part
QUALIFY count(*) OVER (PARTITION BY p_name, p_size) = 1
""")
def q_unique_rows(spark, d):
    return unique_rows(_t(spark, d, "part"), ["p_name", "p_size"], ["p_partkey", "p_brand"])


# ------------------------------------------------------------ A2 / F6 (M9)

@query("distinct_dim", f"""
SELECT {_md5_sql('name')} AS id, name
FROM (SELECT DISTINCT c_mktsegment AS name FROM customer)
""")
def q_distinct_dim(spark, d):
    reviews = _t(spark, d, "customer").select(F.col("c_mktsegment").alias("author_name"))
    return M.dim_authors(reviews)


# ------------------------------------------------------ A3 / A4 / J11 (M7)

@query("flatten_dim", f"""
SELECT {_md5_sql('genre')} AS id, genre
FROM (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS genre FROM part)
""")
def q_flatten_dim(spark, d):
    basics = _t(spark, d, "part").select(split_list("p_name", " ").alias("genres_array"))
    return M.dim_genres(basics)


# --------------------------------------------------------------- P14 / P13 / F2

def _one_hot_sql():
    flags = ",\n       ".join(
        f"coalesce(list_contains(string_split(p_name, ' '), '{w}'), false) AS is_{w}_genre"
        for w in PART_WORDS)
    return f"SELECT p_partkey,\n       {flags}\nFROM part"


@query("one_hot", _one_hot_sql())
def q_one_hot(spark, d):
    part = _t(spark, d, "part").select("p_partkey", split_list("p_name", " ").alias("genres_array"))
    return one_hot(part, "genres_array", PART_WORDS, keep=["p_partkey"])


# ------------------------------------------------------------------------ J6

def _missing_words_sql():
    return ", ".join(f"'{w}'" for w in WORDS_MISSING_FROM_DIM)


@query("theta_join", f"""
WITH dim AS (
  SELECT {_md5_sql('genre')} AS id, genre
  FROM (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS genre FROM part)
  WHERE genre NOT IN ({_missing_words_sql()})
)
SELECT p.p_partkey, dim.id AS genre_id, dim.genre
FROM part p LEFT JOIN dim ON list_contains(string_split(p.p_name, ' '), dim.genre)
""")
def q_theta_join(spark, d):
    part = _t(spark, d, "part").select("p_partkey", split_list("p_name", " ").alias("genres_array"))
    dim = M.dim_genres(part).filter(~F.col("genre").isin(WORDS_MISSING_FROM_DIM))
    out = array_match_join(part, "genres_array", dim.withColumnRenamed("id", "genre_id"), "genre",
                           ["genre_id", "genre"])
    return out.select("p_partkey", "genre_id", "genre")


THETA_SQL = QUERIES["theta_join"][1]


@query("theta_join_equi", THETA_SQL)
def q_theta_join_equi(spark, d):
    """J6 again, under the name by which round 1 registered its equi form (now the only one)."""
    part = _t(spark, d, "part").select("p_partkey", split_list("p_name", " ").alias("genres_array"))
    dim = M.dim_genres(part).filter(~F.col("genre").isin(WORDS_MISSING_FROM_DIM))
    out = array_match_join(part, "genres_array", dim.withColumnRenamed("id", "genre_id"), "genre",
                           ["genre_id", "genre"])
    return out.select("p_partkey", "genre_id", "genre")


# ------------------------------------------------------------- star fact

def _reviews(spark, d):
    """Stand-in review feed -> first-run timestamp snapshot -> cleansed view."""
    parsed = SI.reviews_parsed(_t(spark, d, "customer"))
    parsed = parsed.select(surrogate_key(*M.REVIEW_KEY_PARTS).alias("id"), "*")
    reviews_snap = snapshot_timestamp(None, dedupe_latest(parsed, "id", ["review_date_updated", "review_url"]),
                                      "id", "review_date_updated")
    return M.reviews_cleansed(reviews_snap)


def _star_inputs(spark, d):
    """Stand-in feeds -> first-run snapshots -> cleansed views -> dimensions."""
    basics_snap = M.imdb_basic_snapshot(SI.basics_raw(_t(spark, d, "part")), None, RUN_TS)
    ratings_snap = M.imdb_rating_snapshot(SI.ratings_raw(_t(spark, d, "orders")), None, RUN_TS)
    basics = M.basics_cleansed(basics_snap, as_of=RUN_TS)
    ratings = M.ratings_cleansed(ratings_snap)
    reviews = _reviews(spark, d)
    dims = dict(
        d_genres=M.dim_genres(basics), d_titles=M.dim_titles(basics), d_authors=M.dim_authors(reviews),
        d_movies=M.dim_review_movies(reviews), d_reviews=M.dim_reviews(reviews))
    return ratings, basics, reviews, dims


def _pick_sql(values, number):
    return f"[{', '.join(repr(v) for v in values)}][{number} % {len(values)} + 1]"


# The stand-in feeds as the models should see them, stated from their meaning: a movie of a year that
# has begun, a score, the newest notice of a key; "sole" rows are those no other row shares the key with.
FEED_SQL = f"""
film AS (
  SELECT CAST(p_partkey AS VARCHAR) AS film_id, 'Title ' || (p_partkey // 4) AS label, 1990 + p_size AS made,
         60 + p_size AS minutes, p_name AS original, p_size % 7 = 0 AS adult,
         [{_pick_sql(M.GENRES, 'p_size')}, {_pick_sql(M.GENRES, 'p_partkey')}] AS tags
  FROM part WHERE {_pick_sql(SI.KINDS, 'p_size')} = 'movie' AND 1990 + p_size <= 2025),
score AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS film_id, CAST(1 + (o_custkey % 90) / 10 AS DECIMAL(3,1)) AS points,
         CAST(o_custkey * 10 AS INTEGER) AS votes FROM orders),
notice AS (
  SELECT {_md5_sql('c_mktsegment', "'Title ' || (c_custkey // 3)", "c_mktsegment || ' on ' || (c_custkey // 2)")} AS notice_key,
         c_mktsegment AS critic, c_nationkey % 2 = 1 AS pick,
         CAST(DATE '2002-01-01' + CAST(c_nationkey AS INTEGER) AS DATE) AS touched, 'Title ' || (c_custkey // 3) AS about,
         c_mktsegment || ' on ' || (c_custkey // 2) AS heading, 'https://reviews.example/' || c_custkey AS link,
         nullif({_pick_sql(SI.MPAA_LABELS, 'c_nationkey')}, '') AS mpaa,
         CASE WHEN c_nationkey % 3 <> 0 THEN 'img/' || c_custkey END AS picture,
         CAST(DATE '2000-01-01' + CAST(c_nationkey % 3 AS INTEGER) AS DATE) AS opened,
         CAST(DATE '2001-01-01' + CAST(c_nationkey AS INTEGER) AS DATE) AS printed
  FROM customer
  QUALIFY row_number() OVER (PARTITION BY notice_key ORDER BY touched DESC, link DESC) = 1)"""

STAR_SQL = f"""
WITH {FEED_SQL},
sole_film AS (SELECT film_id, label, made FROM film QUALIFY count(*) OVER (PARTITION BY label, made) = 1),
sole_opening AS (
  SELECT {_md5_sql('about', 'opened')} AS opening_key, about, opened FROM notice
  QUALIFY count(*) OVER (PARTITION BY about, opened) = 1),
sole_article AS (
  SELECT {_md5_sql('heading', 'printed')} AS article_key, heading, printed, pick, link FROM notice
  QUALIFY count(*) OVER (PARTITION BY heading, printed) = 1),
rated AS (
  SELECT s.points, s.votes, f.film_id, f.tags, sole_film.film_id AS sole_id, sole_film.label, sole_film.made
  FROM film f JOIN score s USING (film_id) LEFT JOIN sole_film USING (film_id)),
tagged AS (
  SELECT r.* EXCLUDE (tags), t.tag FROM rated r
  LEFT JOIN (SELECT film_id, unnest(list_distinct(tags)) AS tag FROM film) t USING (film_id)),
told AS (
  SELECT o.opening_key, {_md5_sql('critic')} AS critic_key, a.article_key, a.pick, o.about, year(o.opened) AS opened_in
  FROM sole_opening o JOIN notice n USING (about) LEFT JOIN sole_article a USING (heading, printed))"""

FACT_SELECT_SQL = f"""
SELECT t.sole_id AS imdb_movie_id, told.opening_key AS nyt_movie_id, {_md5_sql('t.tag')} AS genre_id,
       told.critic_key AS nyt_author_id, told.article_key AS nyt_review_id, t.points AS average_rating,
       t.votes AS num_votes, told.pick AS is_critics_pick
FROM tagged t LEFT JOIN told ON told.about = t.label"""


@query("star_fact", STAR_SQL + FACT_SELECT_SQL)
def q_star_fact(spark, d):
    ratings, basics, reviews, dims = _star_inputs(spark, d)
    return M.fct_imdb_nyt(ratings, basics, reviews, **dims)


@query("join_feeds", STAR_SQL + FACT_SELECT_SQL + " AND told.opened_in = t.made")
def q_join_feeds(spark, d):
    ratings, basics, reviews, dims = _star_inputs(spark, d)
    return M.fct_imdb_nyt(ratings, basics, reviews, **dims, match_year=True)


@query("fanout_join", STAR_SQL + """
SELECT about AS movie_title, heading AS review_headline, opening_key AS nyt_movie_id, sole_opening.opened AS opening_date
FROM sole_opening JOIN notice USING (about)
""")
def q_fanout_join(spark, d):
    reviews = _reviews(spark, d)
    nm = M.dim_review_movies(reviews).select(F.col("id").alias("nyt_movie_id"), "title", "opening_date")
    n = reviews.select("movie_title", "review_headline")
    return fanout_join(n, nm, "movie_title", right_on="title")


@query("two_key_left", STAR_SQL + """
SELECT n.about AS movie_title, heading AS review_headline, printed AS review_date, article_key AS nyt_review_id, a.link AS url
FROM notice n LEFT JOIN sole_article a USING (heading, printed)
""")
def q_two_key_left(spark, d):
    reviews = _reviews(spark, d)
    nr = M.dim_reviews(reviews).select(F.col("id").alias("nyt_review_id"), "headline", F.col("review_date").alias("rd"),
                                  "url")
    n = reviews.select("movie_title", "review_headline", "review_date")
    return left_lookup(n, nr, ["review_headline", "review_date"], right_on=["headline", "rd"])


# --------------------------------------------------------------- P9 / P10 / F7

@query("json_path", """
SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k FROM events
""")
def q_json_path(spark, d):
    return _t(spark, d, "events").select("event_id", json_field("props", "$.k", "int").alias("k"))


# ----------------------------------------------------------------------- P11

@query("cast_chain", """
SELECT doc_id, CAST(CAST(quality AS INTEGER) AS BOOLEAN) AS quality,
       CAST(CAST(toxic AS INTEGER) AS BOOLEAN) AS toxic
FROM labels
""")
def q_cast_chain(spark, d):
    return cast_columns(_t(spark, d, "labels"), {"quality": ["int", "boolean"], "toxic": ["int", "boolean"]})


# ---------------------------------------------------------------- P17 / P6

@query("date_window", """
SELECT o_orderkey, o_orderdate FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1995-06-01' AND DATE '1998-12-31'
  AND YEAR(o_orderdate) <= 1996
""")
def q_date_window(spark, d):
    o = _t(spark, d, "orders")
    return (o.filter(between_dates("o_orderdate", "1995-06-01", "1998-12-31"))
            .filter(not_future(F.year("o_orderdate"), as_of="1995-06-15"))
            .select("o_orderkey", "o_orderdate"))


# ---------------------------------------------------------- M3 -> M6 over VARIANT

REVIEW_ROWS_SQL = f"""
WITH {FEED_SQL}
SELECT notice_key AS id, critic AS author_name, pick AS is_critics_pick, touched AS review_date_updated,
       about AS movie_title, heading AS review_headline, link AS review_url, mpaa AS mpaa_rating,
       picture AS image_url, opened AS opening_date, printed AS review_date, critic AS summary_short
FROM notice"""


@query("review_snapshot", REVIEW_ROWS_SQL)
def q_review_snapshot(spark, d):
    """Raw VARIANT documents -> parsed, keyed, de-duplicated -> timestamp snapshot -> cleansed view."""
    snap = M.review_snapshot(SI.reviews_raw(_t(spark, d, "customer")), None)
    return M.reviews_cleansed(snap)


@query("json_load", REVIEW_ROWS_SQL)
def q_json_load(spark, d):
    """Review documents written as JSON lines, read as VARIANT, and snapshotted twice: the second
    run meets the stored snapshot with the same documents and must add nothing."""
    root = scratch_path(spark, "json_load")
    SI.review_documents(_t(spark, d, "customer")).write.text(f"{root}/landed")
    raw = read_variant(spark, f"{root}/landed", lines=True)
    table = SnapshotTable(Catalog(spark, f"{root}/warehouse"), "nyt_snapshot", "id", BUCKETS)
    for run in ("1", "2"):
        table.merge(M.review_source(raw), run,
                    lambda prev, rows: snapshot_timestamp(prev, rows, "id", "review_date_updated"))
    return M.reviews_cleansed(table.read())


# --------------------------------------------------------------------- M4 / O3

def _flags_sql():
    return ",\n       ".join(f"list_contains(tags, '{g}') AS {flag_name(g)}" for g in M.GENRES)


CLEANSED_SQL = f"""
WITH {FEED_SQL}
SELECT film_id AS id, label AS primary_title, original AS original_title, adult AS is_adult,
       CAST(made AS INTEGER) AS year, CAST(minutes AS INTEGER) AS runtime_minutes,
       {_flags_sql()},
       array_to_string(tags, ',') AS genres_array
FROM film"""


@query("basics_cleansed", CLEANSED_SQL)
def q_basics_cleansed(spark, d):
    """M1 and M4: movies only, no future years, all genre flags; the genre array as text."""
    snapshot = M.imdb_basic_snapshot(SI.basics_raw(_t(spark, d, "part")), None, RUN_TS)
    return M.basics_cleansed(snapshot, as_of=RUN_TS).withColumn("genres_array", F.array_join("genres_array", ","))


@query("dims_second_run", f"""
WITH {FEED_SQL}
SELECT 'title' AS dim, film_id AS id FROM film QUALIFY count(*) OVER (PARTITION BY label, made) = 1
UNION ALL SELECT DISTINCT 'genre', {_md5_sql('tag')} FROM (SELECT unnest(tags) AS tag FROM film)
UNION ALL SELECT DISTINCT 'author', {_md5_sql('critic')} FROM notice
""")
def q_dims_second_run(spark, d):
    """Insert-only dimensions (M7-M9): stored, then run again on the same views; nothing is added twice."""
    _, basics, reviews, _ = _star_inputs(spark, d)
    catalog = Catalog(spark, scratch_path(spark, "dims"))
    out = None
    for name, fn, source in (("title", M.dim_titles, basics), ("genre", M.dim_genres, basics),
                             ("author", M.dim_authors, reviews)):
        for _ in range(2):
            this = catalog.read_table(name) if catalog.exists(name) else None
            catalog.append_table(name, fn(source, this))
        rows = catalog.read_table(name).select(F.lit(name).alias("dim"), "id")
        out = rows if out is None else out.unionByName(rows)
    return out


ORIGINAL_SQL = """CASE CAST(film_id AS BIGINT) % 7
    WHEN 0 THEN 'say "' || original || '"' WHEN 1 THEN original || ', "the end"' WHEN 2 THEN original || chr(92) || 'n' || chr(92)
    WHEN 3 THEN original || chr(10) || 'II' WHEN 4 THEN ' ' || original || ' ' WHEN 5 THEN '"' || original || '"' ELSE original END"""
LOADED_SQL = "CAST(film_id AS BIGINT) % 997 <> 0"


def _two_days(spark, d, name):
    """Two whole days of the pipeline from source files: day 1 brings everything, with some unreadable rows (dropped
    by the tolerant load), day 2 the same files, of which only the rows that day 1 could not load are new."""
    root = scratch_path(spark, name)
    paths = SI.source_files(spark, d, f"{root}/source")
    day = {}
    for ds in ("2024-02-01", "2024-02-02"):
        day = run_pipeline(spark, f"{root}/run", paths, ds, buckets=BUCKETS)
    return day


@query("daily_pipeline", CLEANSED_SQL.replace("original AS original_title", f"{ORIGINAL_SQL} AS original_title")
       + f" WHERE {LOADED_SQL}")
def q_daily_pipeline(spark, d):
    """The cleansed titles of the stored snapshot after two days of the pipeline."""
    catalog = _two_days(spark, d, "daily_pipeline")["catalog"]
    cleansed = M.basics_cleansed(catalog.read_table("imdb_basic_snapshot").drop("bucket", "part"), as_of=RUN_TS)
    return cleansed.withColumn("genres_array", F.array_join("genres_array", ","))


DAY_TESTS = {"nyt_reviews_cleansed.movie_title.not_null": "0",
             "nyt_reviews_cleansed.mpaa_rating.accepted_values":
                 f"(SELECT count(DISTINCT mpaa) FROM notice WHERE mpaa NOT IN ({', '.join(repr(v) for v in S.ACCEPTED_MPAA)}))",
             "imdb_ratings_cleansed.id.not_null": "0", "imdb_ratings_cleansed.average_rating.not_null": "0",
             "imdb_ratings_cleansed.num_votes.not_null": "0", "imdb_basics_cleansed.id.not_null": "0",
             "imdb_basics_cleansed.primary_title.not_null": "0",
             "dim_imdb_movies_runtime_minutes_nonnegative": "(SELECT count(*) FROM sole_film JOIN film USING (film_id) WHERE minutes <= 0)",
             "dim_imdb_movies_year_positive": "(SELECT count(*) FROM sole_film WHERE made <= 0)",
             "imdb_ratings_positive_average_rating": "(SELECT count(*) FROM score WHERE points <= 0)",
             "imdb_ratings_positive_num_votes": "(SELECT count(*) FROM score WHERE votes <= 0)",
             "nyt_reviews_movie_title_has_length": "(SELECT count(*) FROM notice WHERE length(about) = 0)"}


def _day_sql():
    """Every relation of a built day as (relation, content), stated from the feeds."""
    loaded = STAR_SQL.replace("= 'movie' AND", "= 'movie' AND p_partkey % 997 <> 0 AND").replace(
        "'Title ' || (c_custkey // 3)", "'Title ' || c_custkey")
    fact = FACT_SELECT_SQL.strip()
    tests = " UNION ALL ".join(f"SELECT 'test', '{name}|' || {n}" for name, n in DAY_TESTS.items())
    fields = ["imdb_movie_id", "nyt_movie_id", "genre_id", "nyt_author_id", "nyt_review_id", "average_rating", "num_votes",
              "is_critics_pick"]
    row = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in fields)
    return f"""{loaded}
SELECT 'rating' AS relation, film_id || '|' || points || '|' || votes AS content FROM score
UNION ALL SELECT 'review', notice_key || '|' || about || '|' || critic || '|' || coalesce(mpaa, '') || '|' || coalesce(picture, '')
  || '|' || opened || '|' || printed || '|' || touched || '|' || pick FROM notice
UNION ALL SELECT 'title', film_id || '|' || label || '|' || made || '|' || minutes
  FROM film JOIN (SELECT film_id FROM sole_film) USING (film_id)
UNION ALL SELECT DISTINCT 'author', {_md5_sql('critic')} || '|' || critic FROM notice
UNION ALL SELECT DISTINCT 'genre', {_md5_sql('tag')} || '|' || tag FROM (SELECT unnest(tags) AS tag FROM film)
UNION ALL SELECT 'opening', opening_key || '|' || about || '|' || opened FROM sole_opening
UNION ALL SELECT 'article', article_key || '|' || heading || '|' || printed || '|' || link || '|' || pick FROM sole_article
UNION ALL SELECT 'fact', {row} FROM ({fact})
UNION ALL {tests}"""


@query("daily_tables", _day_sql())
def q_daily_tables(spark, d):
    """All that two days of the pipeline have built, row by row: ratings, reviews, the five dimensions, the fact, and the
    number of failing rows of each of the twelve tests (Q6-Q8)."""
    day = _two_days(spark, d, "daily_tables")
    c = day["catalog"]
    tests = failure_counts(day["tests"])
    relations = {
        "rating": (spark.table("imdb_ratings_cleansed"), ["id", "average_rating", "num_votes"]),
        "review": (spark.table("nyt_reviews_cleansed"), ["id", "movie_title", "author_name", "mpaa_rating", "image_url",
                                                         "opening_date", "review_date", "review_date_updated", "is_critics_pick"]),
        "title": (c.read_table("dim_imdb_movies"), ["id", "name", "year", "runtime_minutes"]),
        "author": (c.read_table("dim_nyt_authors"), ["id", "name"]),
        "genre": (c.read_table("dim_imdb_genres"), ["id", "genre"]),
        "opening": (c.read_table("dim_nyt_movies"), ["id", "title", "opening_date"]),
        "article": (c.read_table("dim_nyt_reviews"), ["id", "headline", "review_date", "url", "is_critics_pick"]),
        "fact": (c.read_table("fct_imdb_nyt"), M.FACT_COLUMNS),
        "test": (tests, ["test", "failures"]),
    }
    out = None
    for name, (df, columns) in relations.items():
        text = F.concat_ws("|", *[F.coalesce(F.col(x).cast("string"), F.lit("")) for x in columns])
        rows = df.select(F.lit(name).alias("relation"), text.alias("content"))
        out = rows if out is None else out.unionByName(rows)
    return out


# Three days: two thirds of the titles, all ratings and half of the reviews; the other titles and new votes of every fifth
# rating; the other reviews. Dimensions only grow: what was unique on an earlier day stays in them.
DELTA_SQL = f"""
WITH {FEED_SQL.replace("CAST(o_custkey * 10 AS INTEGER)", "CAST(o_custkey * 10 + CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS INTEGER)")
      .replace("c_mktsegment AS critic", "c_mktsegment AS critic, c_custkey % 2 AS half")
      .replace("notice AS (", "sent AS (").replace("PARTITION BY notice_key", "PARTITION BY notice_key, c_custkey % 2")},
early AS (SELECT * FROM sent WHERE half = 0),
notice AS (SELECT * FROM sent QUALIFY row_number() OVER (PARTITION BY notice_key ORDER BY touched DESC, half) = 1),
sole_film AS (
  SELECT film_id, label, made FROM film WHERE CAST(film_id AS BIGINT) % 3 <> 1 QUALIFY count(*) OVER (PARTITION BY label, made) = 1
  UNION SELECT film_id, label, made FROM film QUALIFY count(*) OVER (PARTITION BY label, made) = 1),
sole_opening AS (
  SELECT {_md5_sql('about', 'opened')} AS opening_key, about, opened FROM early QUALIFY count(*) OVER (PARTITION BY about, opened) = 1
  UNION SELECT {_md5_sql('about', 'opened')}, about, opened FROM notice QUALIFY count(*) OVER (PARTITION BY about, opened) = 1),
first_article AS (
  SELECT {_md5_sql('heading', 'printed')} AS article_key, heading, printed, pick FROM early
  QUALIFY count(*) OVER (PARTITION BY heading, printed) = 1),
sole_article AS (
  SELECT * FROM first_article UNION ALL
  SELECT {_md5_sql('heading', 'printed')} AS article_key, heading, printed, pick FROM notice
  WHERE {_md5_sql('heading', 'printed')} NOT IN (SELECT article_key FROM first_article)
  QUALIFY count(*) OVER (PARTITION BY heading, printed) = 1),
{STAR_SQL[STAR_SQL.index("rated AS ("):]}"""


def _fact_days(spark, d):
    """(titles, ratings, review documents) of three days; None: nothing came."""
    titles, ratings = SI.basics_raw(_t(spark, d, "part")), SI.ratings_raw(_t(spark, d, "orders"))
    customer = _t(spark, d, "customer")
    third = F.col("id").cast("long") % 3 == 1
    votes = F.col("num_votes") + F.when(F.col("id").cast("long") % 5 == 0, 1).otherwise(0)
    return [(titles.filter(~third), ratings, SI.reviews_raw(customer.filter("c_custkey % 2 = 0"))),
            (titles.filter(third), ratings.withColumn("num_votes", votes.cast("int")), None),
            (None, None, SI.reviews_raw(customer.filter("c_custkey % 2 = 1")))]


@query("fact_by_deltas", DELTA_SQL + FACT_SELECT_SQL)
def q_fact_by_deltas(spark, d):
    """M12 kept up to date by the changes of three days."""
    catalog = Catalog(spark, scratch_path(spark, "fact_by_deltas"))
    for n, (titles, ratings, reviews) in enumerate(_fact_days(spark, d), 1):
        load_and_build(catalog, titles, ratings, reviews, F.lit(f"2024-01-0{n} 00:00:00").cast("timestamp"), RUN_TS,
                       run=f"day{n}", buckets=BUCKETS, fact="delta")
    return FactTable(catalog).read()


@query("unique_counts", """
WITH t AS (SELECT p_partkey, 'Title ' || (p_partkey // 4) AS label, p_size AS made FROM part),
one AS (SELECT label, made, count(*) AS n FROM t WHERE p_partkey % 3 <> 1 GROUP BY ALL),
two AS (SELECT label, made, count(*) AS n FROM t WHERE p_partkey % 7 <> 2 GROUP BY ALL)
SELECT coalesce(one.label, two.label) AS label, coalesce(one.made, two.made) AS made, CAST(coalesce(one.n, 0) AS BIGINT) AS n_before,
       CAST(coalesce(two.n, 0) AS BIGINT) AS n_after
FROM one FULL JOIN two ON one.label = two.label AND one.made = two.made
WHERE coalesce(one.n, 0) <> coalesce(two.n, 0)""")
def q_unique_counts(spark, d):
    """J3, A1 kept as counts: titles per (name, size); a day brings some titles and takes others away, and the keys whose
    count has changed come out, those that became or stopped being unique among them."""
    key = F.col("p_partkey")
    titles = _t(spark, d, "part").select(key, F.concat(F.lit("Title "), F.expr("p_partkey div 4")).alias("label"),
                                         F.col("p_size").alias("made"))
    counts = KeyCounts(Catalog(spark, scratch_path(spark, "unique_counts")), "titles", ["label", "made"], BUCKETS)
    first, second = key % 3 != 1, key % 7 != 2
    counts.apply(added=titles.filter(first))
    return counts.apply(added=titles.filter(second & ~first), removed=titles.filter(first & ~second))


@query("suites_while_landing", """
SELECT 'basics' AS feed, 0 AS expectation_index, CAST(count(*) AS BIGINT) AS element_count, CAST(0 AS BIGINT) AS unexpected_count, true AS success FROM part
UNION ALL SELECT 'basics', 2, count(*), 0, true FROM part UNION ALL SELECT 'basics', 3, count(*), 0, true FROM part
UNION ALL SELECT 'ratings', 0, count(*), 0, true FROM orders
""")
def q_suites_while_landing(spark, d):
    """Q9, A6 observed: the counts of two raw suites taken by the writes that land the feeds, no scan for the suites."""
    root = scratch_path(spark, "suites_while_landing")
    paths = SI.source_files(spark, d, f"{root}/source")
    columns = {"basics": S.BASICS_COLUMNS, "ratings": RATINGS_COLUMNS}
    suites = {"basics": S.BASICS_RAW_SUITE, "ratings": [e for e in S.RATINGS_RAW_SUITE if e.column == "tconst"
                                                        and e.type == Q.NOT_NULL]}
    out = None
    for feed, suite in suites.items():
        text = T.StructType([T.StructField(c, T.StringType()) for c in columns[feed]])
        landed, seen = land_observed(read_tsv(spark, paths[feed], text, multi_line=True), f"{root}/landing/{feed}",
                                     "2024-02-01", suite)
        rows = seen.result(landed).filter("element_count IS NOT NULL").select(
            F.lit(feed).alias("feed"), "expectation_index", "element_count", "unexpected_count", "success")
        out = rows if out is None else out.unionByName(rows)
    return out


# ------------------------------------------------------------------ SCD2 (SN4/6/7)

SCD_CHECK_SQL = f"""
WITH e AS (
  SELECT event_id, user_id, event_type, ts,
         lag(event_type) OVER w AS prev_type, row_number() OVER w AS rn
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
), k AS (SELECT * FROM e WHERE rn = 1 OR event_type IS DISTINCT FROM prev_type)
SELECT event_id, user_id, event_type, ts, {_md5_sql('user_id', 'ts', sep='|')} AS dbt_scd_id,
       ts AS dbt_updated_at, ts AS dbt_valid_from,
       lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS dbt_valid_to
FROM k"""


def _scd_check(spark, d):
    return scd2_history(SI.change_feed(_t(spark, d, "events")), "user_id", "ts",
                        check_cols=["event_type"], tiebreak="event_id")


@query("scd2_check", SCD_CHECK_SQL)
def q_scd2_check(spark, d):
    return _scd_check(spark, d)


@query("scd2_current", f"SELECT * FROM ({SCD_CHECK_SQL}) s WHERE dbt_valid_to IS NULL")
def q_scd2_current(spark, d):
    return current(_scd_check(spark, d))


@query("scd2_as_of", f"""
SELECT * FROM ({SCD_CHECK_SQL}) s
WHERE dbt_valid_from <= TIMESTAMP '{AS_OF_TS}'
  AND (dbt_valid_to IS NULL OR TIMESTAMP '{AS_OF_TS}' < dbt_valid_to)""")
def q_scd2_as_of(spark, d):
    return as_of(_scd_check(spark, d), F.lit(AS_OF_TS).cast("timestamp_ntz"))


@query("scd2_timestamp", f"""
WITH e AS (
  SELECT event_id, user_id, ts, CAST(DATE '2024-01-01' + CAST(props->>'$.k' AS INTEGER) AS DATE) AS updated_at
  FROM events
), m AS (
  SELECT *, max(updated_at) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_max,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM e
), k AS (SELECT * FROM m WHERE rn = 1 OR updated_at > prev_max)
SELECT event_id, user_id, ts, updated_at, {_md5_sql('user_id', 'updated_at', sep='|')} AS dbt_scd_id,
       updated_at AS dbt_updated_at, updated_at AS dbt_valid_from,
       lead(updated_at) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS dbt_valid_to
FROM k""")
def q_scd2_timestamp(spark, d):
    return scd2_history(SI.timestamp_feed(_t(spark, d, "events")), "user_id", "ts",
                        updated_at="updated_at", tiebreak="event_id")


@query("scd2_hot", f"""
WITH e AS (
  SELECT event_id, event_type, CASE WHEN event_id % 5 > 0 THEN ts END AS seen, 'all' AS stream FROM events),
n AS (SELECT *, row_number() OVER w AS place, lag(event_type) OVER w AS earlier FROM e
      WINDOW w AS (PARTITION BY stream ORDER BY seen NULLS FIRST, event_id)),
k AS (SELECT * FROM n WHERE place = 1 OR event_type IS DISTINCT FROM earlier)
SELECT stream, event_id, event_type, seen, {_md5_sql('stream', 'seen', sep='|')} AS dbt_scd_id, seen AS dbt_updated_at,
       seen AS dbt_valid_from, lead(seen) OVER (PARTITION BY stream ORDER BY place) AS dbt_valid_to
FROM k""")
def q_scd2_hot(spark, d):
    """All events as the history of one key, a fifth of them without a time, cut into chunks of about 500 rows."""
    feed = _t(spark, d, "events").select(
        F.lit("all").alias("stream"), "event_id", "event_type",
        F.when(F.col("event_id") % 5 > 0, F.col("ts")).alias("seen"))
    return scd2_history(feed, "stream", "seen", check_cols=["event_type"], tiebreak="event_id", split_rows=500)


AS_OF_JOIN_SQL = f"""
WITH v AS (SELECT user_id, event_type, dbt_valid_from, dbt_valid_to FROM ({SCD_CHECK_SQL}) s
           WHERE dbt_valid_to IS NULL OR dbt_valid_from < dbt_valid_to),
i AS (SELECT event_id, user_id, ts - INTERVAL 6 HOUR AS asked FROM events)
SELECT i.event_id, i.user_id, i.asked, v.event_type AS v_event_type, v.dbt_valid_from AS v_dbt_valid_from
FROM i ASOF LEFT JOIN v ON i.user_id = v.user_id AND i.asked >= v.dbt_valid_from"""


def _state_before(spark, d, split_rows):
    """The state of each event's user six hours before the event."""
    asked = _t(spark, d, "events").select("event_id", "user_id", (F.col("ts") - F.expr("INTERVAL 6 HOURS")).alias("asked"))
    versions = _scd_check(spark, d).select("user_id", "event_type", "dbt_valid_from", "dbt_valid_to")
    return as_of_join(asked, versions, "user_id", "asked", split_rows=split_rows).drop("v_dbt_valid_to")


@query("as_of_join", AS_OF_JOIN_SQL)
def q_as_of_join(spark, d):
    """SN7 for a table of instants."""
    return _state_before(spark, d, 1_000_000)


@query("as_of_join_hot", AS_OF_JOIN_SQL)
def q_as_of_join_hot(spark, d):
    """The same with every user over 50 rows split into ranges of time."""
    return _state_before(spark, d, 50)


# ---------------------------------------------------------------------- SN8

@query("dedupe_latest", """
SELECT event_id, user_id, event_type, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
) WHERE rn = 1""")
def q_dedupe_latest(spark, d):
    ev = _t(spark, d, "events").select("event_id", "user_id", "event_type", "ts", "value")
    return dedupe_latest(ev, "user_id", ["ts", "event_id"])


# ---------------------------------------------------------- two-day snapshot run (O3, SN1)

DAY1_END = "2024-01-16 00:00:00"
DAY2_END = "2024-01-31 00:00:00"


@query("two_day_run", f"""
WITH d1 AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT event_id, user_id, event_type, ts,
           row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
    FROM events WHERE ts < TIMESTAMP '{DAY1_END}') WHERE rn = 1
), d2 AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT event_id, user_id, event_type, ts,
           row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
    FROM events WHERE ts >= TIMESTAMP '{DAY1_END}') WHERE rn = 1
), changed AS (
  SELECT d2.* FROM d2 JOIN d1 USING (user_id) WHERE d1.event_type IS DISTINCT FROM d2.event_type
), fresh AS (
  SELECT * FROM d2 WHERE user_id NOT IN (SELECT user_id FROM d1)
)
SELECT event_id, user_id, event_type, ts,
       {_md5_sql('user_id', f"TIMESTAMP '{DAY1_END}'", sep='|')} AS dbt_scd_id,
       TIMESTAMP '{DAY1_END}' AS dbt_updated_at, TIMESTAMP '{DAY1_END}' AS dbt_valid_from,
       CASE WHEN user_id IN (SELECT user_id FROM changed) THEN TIMESTAMP '{DAY2_END}' END AS dbt_valid_to
FROM d1
UNION ALL
SELECT event_id, user_id, event_type, ts,
       {_md5_sql('user_id', f"TIMESTAMP '{DAY2_END}'", sep='|')} AS dbt_scd_id,
       TIMESTAMP '{DAY2_END}' AS dbt_updated_at, TIMESTAMP '{DAY2_END}' AS dbt_valid_from,
       CAST(NULL AS TIMESTAMP) AS dbt_valid_to
FROM (SELECT * FROM changed UNION ALL SELECT * FROM fresh)""")
def q_two_day_run(spark, d):
    feed = SI.change_feed(_t(spark, d, "events"))
    catalog = Catalog(spark, scratch_path(spark, "two_day_run"))
    days = [(feed.filter(F.col("ts") < F.lit(DAY1_END).cast("timestamp_ntz")), DAY1_END),
            (feed.filter(F.col("ts") >= F.lit(DAY1_END).cast("timestamp_ntz")), DAY2_END)]
    snap = None
    for batch, now in days:
        snap = snapshot_run(catalog, "events_snapshot", batch, "user_id",
                            now=F.lit(now).cast("timestamp_ntz"), check_cols=["event_type"],
                            order=["ts", "event_id"], run=now[:10], buckets=BUCKETS)
    return snap


@query("snapshot_few_keys", f"""
WITH late AS (SELECT max(o_orderdate) AS day FROM orders)
SELECT o_orderkey, o_orderstatus, {_md5_sql('o_orderkey', f"TIMESTAMP '{DAY1_END}'", sep='|')} AS dbt_scd_id,
       TIMESTAMP '{DAY1_END}' AS dbt_valid_from, CASE WHEN o_orderdate = late.day THEN TIMESTAMP '{DAY2_END}' END AS dbt_valid_to
FROM orders, late
UNION ALL
SELECT o_orderkey, 'returned', {_md5_sql('o_orderkey', f"TIMESTAMP '{DAY2_END}'", sep='|')}, TIMESTAMP '{DAY2_END}', NULL
FROM orders, late WHERE o_orderdate = late.day""")
def q_snapshot_few_keys(spark, d):
    """A snapshot of all orders, then a run in which the orders of one date have come back: it reads and
    replaces the buckets of those orders only."""
    orders = _t(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    table = SnapshotTable(Catalog(spark, scratch_path(spark, "snapshot_few_keys")), "orders", "o_orderkey", 64)
    last = orders.agg(F.max("o_orderdate")).scalar()
    returned = orders.filter(F.col("o_orderdate") == last).withColumn("o_orderstatus", F.lit("returned"))
    for rows, now in ((orders, DAY1_END), (returned, DAY2_END)):
        at = F.lit(now).cast("timestamp_ntz")
        table.merge(rows.drop("o_orderdate"), now[:10],
                    lambda prev, batch, at=at: snapshot_check(prev, batch, "o_orderkey", ["o_orderstatus"], at))
    return table.read().drop("dbt_updated_at")


@query("late_changes", SCD_CHECK_SQL)
def q_late_changes(spark, d):
    """All events in three deliveries that are not in the order of time, a third of the events each, the second one
    delivered twice: every delivery splits intervals of the ones before."""
    feed = SI.change_feed(_t(spark, d, "events"))
    history = EventHistory(Catalog(spark, scratch_path(spark, "late_changes")), "events", "user_id", "ts", ["event_type"],
                           tiebreak="event_id", buckets=8)
    for part in (2, 0, 0, 1):
        history.apply(feed.filter(F.col("event_id") % 3 == part))
    return history.read()


# ------------------------------------------------------------------ S20 / S21

ANCHOR_SQL = r"""(?i)<a\b[^>]*?\bhref\s*=\s*["'']([^"'']*)["'']"""


@query("html_links", f"""
SELECT page_id, CAST(unnest(range(len(h))) AS INTEGER) AS link_pos, unnest(h) AS href
FROM (SELECT page_id, regexp_extract_all(html, '{ANCHOR_SQL}', 1) AS h FROM pages)
""")
def q_html_links(spark, d):
    return extract_links(_t(spark, d, "pages"), "html", keep=["page_id"])


@query("page_union", "SELECT conv_id, turn, role, text FROM conversations")
def q_page_union(spark, d):
    pages = SI.paged_feed(_t(spark, d, "conversations"))
    return union_pages(pages, "results", keep=["conv_id"])


@query("match_tables", f"""
WITH hrefs AS (
  SELECT page_id, CAST(unnest(range(len(h))) AS INTEGER) AS link_pos, unnest(h) AS href
  FROM (SELECT page_id, regexp_extract_all(html, '{ANCHOR_SQL}', 1) AS h FROM pages))
SELECT page_id, link_pos, href, wanted AS table_name
FROM hrefs JOIN (VALUES ('th'), ('tion'), ('ver')) w(wanted) ON contains(href, wanted)
""")
def q_match_tables(spark, d):
    """Every link of every page with the wanted names it contains."""
    links = extract_links(_t(spark, d, "pages"), "html", keep=["page_id"])
    return match_tables(links, ["th", "tion", "ver"])


@query("contains_any", """
SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'ring') OR contains(p_name, 'rod')
""")
def q_contains_any(spark, d):
    part = _t(spark, d, "part").select("p_partkey", "p_name")
    return part.filter(contains_any("p_name", ["ring", "rod"]))


# ------------------------------------------------- S7, S8, S15-S19, S2 with S10

@query("registry_run", QUERIES["anti_registry"][1])
def q_registry_run(spark, d):
    """Ids registered by two loads, merged, and the rows of ``orders`` that no load brought."""
    registry = IdRegistry(spark, scratch_path(spark, "registry_run"), "id", T.LongType())
    lines = _t(spark, d, "lineitem")
    for load in (lines.filter("l_linenumber = 1"), lines):
        registry.append(load, "l_orderkey")
    registry.compact()
    orders = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    return registry.new_rows(orders, "o_orderkey")


@query("catalog_models", """
SELECT 'kept' AS table_name, c_mktsegment AS segment, count(*) AS customers FROM customer GROUP BY c_mktsegment
""")
def q_catalog_models(spark, d):
    """A source alias, a view on it, an insert-only table run twice, and a truncated table."""
    catalog = Catalog(spark, scratch_path(spark, "catalog_models"), {"crm": table_path(d, "customer")})
    catalog.register("segments", lambda c: c.source("crm").groupBy(F.col("c_mktsegment").alias("segment"))
                     .agg(F.count(F.lit(1)).alias("customers")))
    catalog.materialize("segments_view", catalog.ref("segments"), "view")
    for _ in range(2):
        catalog.materialize("kept", spark.table("segments_view"), "incremental", key="segment")
    catalog.materialize("emptied", catalog.ref("segments"), "table")
    catalog.truncate("emptied", catalog.read_table("emptied"))
    return (catalog.read_table("kept").select(F.lit("kept").alias("table_name"), "*")
            .unionByName(catalog.read_table("emptied").select(F.lit("emptied").alias("table_name"), "*")))


@query("json_array_load", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def q_json_array_load(spark, d):
    """Pages of at most 1000 customers, one JSON array a file, bulk-loaded into rows."""
    cust = _t(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    folder = scratch_path(spark, "json_array_load")
    (cust.groupBy(F.expr("c_custkey div 1000").alias("page"))
     .agg(F.to_json(F.collect_list(F.struct(*cust.columns))).alias("value"))
     .write.partitionBy("page").text(folder))
    rows, _ = copy_into(spark, f"{folder}/page=*", cust.schema, JsonFormat())
    return rows


# ----------------------------------------------------------------- Q1-Q9

CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
SEGMENTS_ALLOWED = ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"]
CUSTOMER_SUITE = [
    Q.not_null("c_custkey"),
    Q.not_null("c_name", mostly=0.99),
    Q.in_set("c_mktsegment", SEGMENTS_ALLOWED),
    Q.unique_proportion("c_custkey", 1.0, 1.0),
    Q.unique_proportion("c_nationkey", 1.0, 1.0),
    Q.in_type_list("c_name", S.STRING_TYPE_NAMES),
    Q.in_type_list("c_acctbal", S.INT_TYPE_NAMES),
    Q.columns_match_set(CUSTOMER_COLUMNS),
]


def _suite_sql():
    seg = ", ".join(f"'{s}'" for s in SEGMENTS_ALLOWED)
    return f"""
WITH s AS (
  SELECT count(*) AS n, count(c_custkey) AS nn_key, count(c_name) AS nn_name,
         count(c_mktsegment) AS nn_seg,
         count(*) FILTER (WHERE c_mktsegment IS NOT NULL AND c_mktsegment NOT IN ({seg})) AS bad_seg,
         count(DISTINCT c_custkey) AS nd_key, count(c_nationkey) AS nn_nat,
         count(DISTINCT c_nationkey) AS nd_nat
  FROM customer)
SELECT 0 AS expectation_index, 'expect_column_values_to_not_be_null' AS expectation_type,
       'c_custkey' AS "column", n AS element_count, n - nn_key AS unexpected_count,
       CASE WHEN n > 0 THEN nn_key / n END AS observed_value,
       n = 0 OR nn_key / n >= 1.0 AS success FROM s
UNION ALL
SELECT 1, 'expect_column_values_to_not_be_null', 'c_name', n, n - nn_name,
       CASE WHEN n > 0 THEN nn_name / n END, n = 0 OR nn_name / n >= 0.99 FROM s
UNION ALL
SELECT 2, 'expect_column_values_to_be_in_set', 'c_mktsegment', n, bad_seg,
       CASE WHEN nn_seg > 0 THEN (nn_seg - bad_seg) / nn_seg END,
       nn_seg = 0 OR (nn_seg - bad_seg) / nn_seg >= 1.0 FROM s
UNION ALL
SELECT 3, 'expect_column_proportion_of_unique_values_to_be_between', 'c_custkey', n, NULL,
       CASE WHEN nn_key > 0 THEN nd_key / nn_key END,
       coalesce(nd_key / nn_key >= 1.0 AND nd_key / nn_key <= 1.0, false) FROM s
UNION ALL
SELECT 4, 'expect_column_proportion_of_unique_values_to_be_between', 'c_nationkey', n, NULL,
       CASE WHEN nn_nat > 0 THEN nd_nat / nn_nat END,
       coalesce(nd_nat / nn_nat >= 1.0 AND nd_nat / nn_nat <= 1.0, false) FROM s
UNION ALL
SELECT 5, 'expect_column_values_to_be_in_type_list', 'c_name', NULL, NULL, NULL, true FROM s
UNION ALL
SELECT 6, 'expect_column_values_to_be_in_type_list', 'c_acctbal', NULL, NULL, NULL, false FROM s
UNION ALL
SELECT 7, 'expect_table_columns_to_match_set', NULL, NULL, NULL, NULL, true FROM s
"""


@query("quality_suite", _suite_sql())
def q_quality_suite(spark, d):
    return Q.run_suite(_t(spark, d, "customer"), CUSTOMER_SUITE)


@query("gate_results", """
WITH s AS (SELECT count(*) AS n, count(c_name) AS named FROM customer)
SELECT 0 AS expectation_index, 'expect_column_values_to_not_be_null' AS expectation_type, 'c_name' AS "column",
       n AS element_count, n - named AS unexpected_count, named / n AS observed_value, named = n AS success FROM s
UNION ALL SELECT 1, 'expect_column_values_to_not_be_null', 'c_phone', n, n, NULL, false FROM s
UNION ALL SELECT 2, 'expect_table_columns_to_match_set', NULL, NULL, NULL, NULL, false FROM s
""")
def q_gate_results(spark, d):
    """Stored results of a suite that names a column the batch lacks, read back after the gate refused it."""
    suite = [Q.not_null("c_name"), Q.not_null("c_phone"), Q.columns_match_set([*CUSTOMER_COLUMNS, "c_phone"])]
    root = scratch_path(spark, "gate_results")
    stored = Q.store_result(Q.run_suite(_t(spark, d, "customer"), suite), root, "customer.raw", "2024-02-01")
    try:
        Q.gate(stored, "customer.raw")
    except Q.QualityGateError:
        return stored
    raise AssertionError("the gate let a failing suite pass")


@query("failing_rows", """
SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount <= 0
""")
def q_failing_rows(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    return Q.failing_rows(li, "l_discount <= 0")


@query("failing_nulls", f"""
WITH {FEED_SQL}
SELECT notice_key AS id, about AS movie_title FROM notice WHERE mpaa IS NULL
""")
def q_failing_nulls(spark, d):
    """Q6: the reviews without a rating label (blank in the feed)."""
    return Q.failing_nulls(_reviews(spark, d), "mpaa_rating").select("id", "movie_title")


TYPES_ACCEPTED = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "STANDARD"]


@query("accepted_values", f"""
SELECT p_type AS value_field, count(*) AS n_records FROM part
WHERE p_type NOT IN ({", ".join(f"'{t}'" for t in TYPES_ACCEPTED)})
GROUP BY p_type
""")
def q_accepted_values(spark, d):
    return Q.accepted_values(_t(spark, d, "part"), "p_type", TYPES_ACCEPTED)


# --------------------------------------------------------------- S1-S6, S12

@query("csv_roundtrip", "SELECT * FROM customer")
def q_csv_roundtrip(spark, d):
    cust = _t(spark, d, "customer")
    path = scratch_path(spark, "csv_roundtrip")
    write_csv_gz(cust, path)
    return read_csv_format(spark, path, cust.schema, CsvFormat())


@query("json_roundtrip", "SELECT * FROM orders")
def q_json_roundtrip(spark, d):
    orders = _t(spark, d, "orders")
    path = scratch_path(spark, "json_roundtrip")
    write_json(orders, path)
    return spark.read.schema(orders.schema).json(path)


# Declared raw type of the landed ``value`` column: two integer digits, so
# values of 100 and more are load errors.
SKIP_FILE_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("value", T.DecimalType(4, 2)),
])
SKIP_FILE_PCT = 0.5   # fixed value of the reference: ON_ERROR = SKIP_FILE_0.5%


@query("skip_file", """
SELECT event_type, count(*) AS rows_parsed,
       count(*) FILTER (WHERE TRY_CAST(CAST(value AS VARCHAR) AS DECIMAL(4,2)) IS NULL) AS errors_seen
FROM events GROUP BY event_type
""")
def q_skip_file(spark, d):
    """Events landed as gzipped CSV under ``event_type=`` folders (each task writes its
    own part files), bulk-loaded with ``SKIP_FILE_0.5%``; the per-file load report is
    summed per landing folder. Which files are skipped depends on how rows fell into
    files, so only the split-independent sums are returned (the skip rule itself is
    tested on fixed files in ``tests/test_sources.py``)."""
    ev = _t(spark, d, "events").select("event_id", "ts", "user_id", "value", "event_type")
    land_dir = f"{scratch_path(spark, 'skip_file')}/landed"
    (ev.write.mode("overwrite").partitionBy("event_type")
     .option("header", True).option("compression", "gzip").csv(land_dir))
    _, report = copy_into(spark, land_dir, SKIP_FILE_SCHEMA, CsvFormat(), skip_file_pct=SKIP_FILE_PCT)
    folder = F.regexp_extract("file", r"event_type=([^/]+)", 1).alias("event_type")
    return (report.groupBy(folder)
            .agg(F.sum("rows_parsed").alias("rows_parsed"), F.sum("errors_seen").alias("errors_seen")))


@query("skip_file_rows", """
SELECT event_type, event_id, ts, user_id, CAST(value AS DECIMAL(4,2)) AS value FROM (
  SELECT *, TRY_CAST(CAST(value AS VARCHAR) AS DECIMAL(4,2)) IS NULL AS bad,
         avg(CASE WHEN TRY_CAST(CAST(value AS VARCHAR) AS DECIMAL(4,2)) IS NULL THEN 100.0 ELSE 0.0 END)
           OVER (PARTITION BY event_type) AS bad_percent
  FROM events) WHERE NOT bad AND bad_percent <= 12
""")
def q_skip_file_rows(spark, d):
    """One landed file per event type, loaded with a tolerance of 12 %: whole files above it are
    skipped, the bad rows of the others dropped; the loaded rows themselves are compared."""
    ev = _t(spark, d, "events").select("event_id", "ts", "user_id", "value", "event_type")
    land_dir = f"{scratch_path(spark, 'skip_file_rows')}/landed"
    (ev.repartition(8, "event_type").write.partitionBy("event_type")
     .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").option("header", True).option("compression", "gzip").csv(land_dir))
    kinds = [r[0] for r in ev.select("event_type").distinct().collect()]
    out = None
    for kind in kinds:
        rows, _ = copy_into(spark, f"{land_dir}/event_type={kind}", SKIP_FILE_SCHEMA, CsvFormat(), skip_file_pct=12.0)
        rows = rows.select(F.lit(kind).alias("event_type"), "*")
        out = rows if out is None else out.unionByName(rows)
    return out


# ------------------------------------------------------------------- F6 / F1 / F3 / F5

@query("surrogate_key", f"""
SELECT o_orderkey, {_md5_sql('o_orderkey', 'CAST(o_orderdate AS DATE)')} AS order_key FROM orders
""")
def q_surrogate_key(spark, d):
    o = _t(spark, d, "orders")
    return o.select("o_orderkey", surrogate_key(F.col("o_orderkey"), F.to_date("o_orderdate")).alias("order_key"))


@query("split_list", """
SELECT p_partkey, CAST(unnest(range(len(w))) AS INTEGER) AS pos, unnest(w) AS word
FROM (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part)
""")
def q_split_list(spark, d):
    p = _t(spark, d, "part")
    return p.select("p_partkey", F.posexplode(split_list("p_name", " ")).alias("pos", "word"))


@query("scalar_misc", """
SELECT o_orderkey, CAST(YEAR(o_orderdate) AS INTEGER) AS order_year,
       CAST(length(o_orderpriority) AS INTEGER) AS priority_len FROM orders
""")
def q_scalar_misc(spark, d):
    o = _t(spark, d, "orders")
    return o.select("o_orderkey", F.year("o_orderdate").alias("order_year"),
                    F.length("o_orderpriority").alias("priority_len"))


# ------------------------------------------------ S11, S22-S24, L1, F4, F10, F11

@query("stage_load", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def q_stage_load(spark, d):
    """Customers landed below a stage, one folder per market segment, loaded by the stage's names, format and
    tolerance."""
    stage = Stage(scratch_path(spark, "stage_load"), CsvFormat(), skip_file_pct=0.5)
    segments = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    customer = _t(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    names = F.when(F.col("c_mktsegment").isin(segments), F.col("c_mktsegment")).otherwise("OTHER")
    (customer.withColumn("folder", names).write.options(**stage.fmt.writer_options()).partitionBy("folder")
     .csv(stage.path("customers")[0]))
    rows, _ = copy_into(spark, stage.path("customers/*"), customer.schema, stage.fmt, stage.skip_file_pct)
    return rows


def _landed_assets(spark, d, name):
    """Three feeds landed as one folder of files ``<feed>-<n>.tsv.gz``-like names each; returns the folder."""
    folder = scratch_path(spark, name)
    for table, columns in (("nation", ["n_nationkey", "n_name"]), ("region", ["r_regionkey", "r_name"]),
                           ("supplier", ["s_suppkey", "s_name"])):
        (_t(spark, d, table).select(*columns).write.option("sep", "\t").option("header", True)
         .option("compression", "gzip").csv(f"{folder}/{table}.raw"))
    return folder


@query("assets_and_batches", """
SELECT 'nation' AS asset, CAST(n_nationkey AS VARCHAR) AS key, n_name AS name FROM nation
UNION ALL SELECT 'region', CAST(r_regionkey AS VARCHAR), r_name FROM region
UNION ALL SELECT 'supplier', CAST(s_suppkey AS VARCHAR), s_name FROM supplier""")
def q_assets_and_batches(spark, d):
    """Files found by name below a landing folder, each folder an asset, each asset read as a batch whose path
    is known at run time only."""
    folder = _landed_assets(spark, d, "assets")
    files = list_assets(spark, f"{folder}/*", r"part-.*\.csv\.gz")
    found = files.select(F.regexp_extract("path", r"([^/]+)\.raw/[^/]+$", 1).alias("asset")).distinct()
    out = None
    for asset in sorted(r.asset for r in found.collect()):        # folders of a landing zone, not rows
        rows = batch(spark, lambda s, path: read_tsv(s, path, "key string, name string"), f"{folder}/{asset}.raw")
        rows = rows.select(F.lit(asset).alias("asset"), "key", "name")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("authoring_sample", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 1000")
def q_authoring_sample(spark, d):
    """The first 1000 rows, which a suite is authored on."""
    return sample_batch(_t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice").orderBy("o_orderkey"))


@query("released_by_now", """
SELECT p_partkey, CAST(1990 + p_size AS INTEGER) AS start_year FROM part WHERE 1990 + p_size <= year(current_timestamp) + 1""")
def q_released_by_now(spark, d):
    """Titles of no later year than the next one, by the session's clock."""
    titles = _t(spark, d, "part").selectExpr("p_partkey", "CAST(1990 + p_size AS INT) AS start_year")
    return titles.filter(not_future("start_year"))


@query("dumped_tables", f"""
WITH hrefs AS (SELECT page_id, unnest(h) AS href FROM (SELECT page_id, regexp_extract_all(html, '{ANCHOR_SQL}', 1) AS h FROM pages))
SELECT page_id, href, replace(href, '/th', '') AS suffix FROM hrefs WHERE ends_with(href, 'on')""")
def q_dumped_tables(spark, d):
    """links with a wanted ending, and what is left of their names without a prefix."""
    links = extract_links(_t(spark, d, "pages"), "html", keep=["page_id"]).filter(ends_with("href", "on"))
    return links.select("page_id", "href", without("href", "/th").alias("suffix"))


# Markup of every kind; '@' stands for a page's number.
LINK_MARKUP = """<!-- <a href="comment@"> --><A id=1 HREF = "quoted@.gz">x</A><script>var t="<a href=script@>"</script>
<a title='href=none@>' href=plain@>t</a><abbr href=abbr@><style>a{}<a href=style@></style><a href='single @' href=second@>
<a data-href='data@'><a name=anchor@><a href="?a=@&amp;b=&#65;"><title><a href=title@>"""


@query("link_cases", """
SELECT page_id, CAST(link_pos AS INTEGER) AS link_pos, replace(href, '@', CAST(page_id AS VARCHAR)) AS href
FROM pages, (VALUES (0, 'quoted@.gz'), (1, 'plain@'), (2, 'single @'), (3, '?a=@&b=A')) c(link_pos, href)""")
def q_link_cases(spark, d):
    """S20 on such markup made around each page's number; the expected links are known by construction."""
    html = F.replace(F.lit(LINK_MARKUP), F.lit("@"), F.col("page_id").cast("string"))
    return extract_links(_t(spark, d, "pages").select("page_id", html.alias("html")), "html", keep=["page_id"])


# ------------------------------------------------------------------ ST1 / ST2

RESEND_FROM = "2024-01-15 00:00:00"


@query("stream_dedup", "SELECT event_id, user_id, event_type, ts, value FROM events")
def q_stream_dedup(spark, d):
    """Two deliveries land (all events, then a re-sent second half); a file
    stream drains them in micro-batches of 4 files into the exact dedup sink."""
    from marquee.streaming import RegistryDedupSink, ingest_stream, run_available

    ev = _t(spark, d, "events").select("event_id", "user_id", "event_type", "ts", "value")
    root = scratch_path(spark, "stream_dedup")
    landing = f"{root}/landing"
    ev.write.mode("append").parquet(landing)
    ev.filter(F.col("ts") >= F.lit(RESEND_FROM).cast("timestamp_ntz")).write.mode("append").parquet(landing)
    sink = RegistryDedupSink(spark, f"{root}/out", key="event_id", order=["event_id"])
    run_available(ingest_stream(spark, landing, ev.schema, "parquet", max_files_per_trigger=4),
                  sink, f"{root}/_checkpoint")
    return sink.read()


@query("stream_state_dedup", QUERIES["stream_dedup"][1])
def q_stream_state_dedup(spark, d):
    """Three deliveries drained one by one, each run restarted from the checkpoint: all events, their second half again, all
    again. The keys seen are the query's state in RocksDB, kept for a day."""
    from marquee.streaming import dedup_exact, ingest_stream, run_to_files

    ev = _t(spark, d, "events").select("event_id", "user_id", "event_type", "ts", "value")
    root = scratch_path(spark, "stream_state_dedup")
    late = ev.filter(F.col("ts") >= F.lit(RESEND_FROM).cast("timestamp_ntz"))
    for delivery in (ev, late, ev):
        delivery.write.mode("append").parquet(f"{root}/landing")
        run_to_files(dedup_exact(ingest_stream(spark, f"{root}/landing", ev.schema), "event_id", ttl="1 day"),
                     f"{root}/out", f"{root}/_checkpoint")
    return spark.read.schema(ev.schema).parquet(f"{root}/out")


@query("stream_watermark", QUERIES["stream_dedup"][1])
def q_stream_watermark(spark, d):
    """The same two deliveries through the bounded-state form: repeats of an event id within the
    watermark delay (which here covers the whole feed) are dropped."""
    from marquee.streaming import dedup_stream, ingest_stream

    ev = _t(spark, d, "events").select("event_id", "user_id", "event_type", "ts", "value")
    root = scratch_path(spark, "stream_watermark")
    landing = f"{root}/landing"
    timed = ev.withColumn("ts", F.col("ts").cast("timestamp"))
    timed.write.mode("append").parquet(landing)
    timed.filter(F.col("ts") >= F.lit(RESEND_FROM).cast("timestamp")).write.mode("append").parquet(landing)
    stream = dedup_stream(ingest_stream(spark, landing, timed.schema, "parquet", max_files_per_trigger=4),
                          "event_id", "ts", "1000 days")
    query = (stream.writeStream.format("parquet").option("path", f"{root}/out")
             .option("checkpointLocation", f"{root}/_checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(timed.schema).parquet(f"{root}/out").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


# ------------------------------------------------------------------------ ST3

def _day_end(batch):
    """The end of the (last) day that a micro-batch of events belongs to, from its newest event."""
    newest = batch.agg(F.max("ts")).first()[0]
    return F.lit(DAY1_END if newest is None or str(newest) < DAY1_END else DAY2_END).cast("timestamp_ntz")


@query("stream_snapshot", QUERIES["two_day_run"][1])
def q_stream_snapshot(spark, d):
    """The two-day snapshot run driven by a file stream: each day's change feed
    lands, and one availableNow run drains it as one micro-batch into the
    snapshot sink (check strategy, ``now`` = the end of that day)."""
    from marquee.streaming import SnapshotSink, ingest_stream, run_available

    feed = SI.change_feed(_t(spark, d, "events"))
    root = scratch_path(spark, "stream_snapshot")
    landing, checkpoint = f"{root}/landing", f"{root}/_checkpoint"
    catalog = Catalog(spark, f"{root}/warehouse")
    sink = SnapshotSink(catalog, "events_snapshot", key="user_id", order=["ts", "event_id"],
                        now=_day_end, check_cols=["event_type"], buckets=BUCKETS)
    day1 = F.col("ts") < F.lit(DAY1_END).cast("timestamp_ntz")
    for day in (day1, ~day1):
        feed.filter(day).write.mode("append").parquet(landing)
        run_available(ingest_stream(spark, landing, feed.schema), sink, checkpoint)
    return SnapshotTable(catalog, "events_snapshot", "user_id").read()
