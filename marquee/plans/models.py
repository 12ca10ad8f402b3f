"""The reference's models as DataFrame functions.

Graph: 3 raw sources -> 3 snapshots -> 3 cleansed views -> 5 dimensions ->
1 fact; the fact also reads the cleansed views. Each function takes and
returns DataFrames; storage (views, tables, incremental appends) is the
catalog's job (``marquee.plans.daily``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions.columns import not_future, split_list, variant_field
from marquee.functions.keys import surrogate_key
from marquee.operators.joins import (
    append_new,
    array_match_join,
    distinct_elements,
    distinct_values,
    fanout_join,
    join_feeds,
    left_lookup,
    rated_titles,
    unique_rows,
)
from marquee.operators.onehot import one_hot
from marquee.operators.scd2 import current, dedupe_latest, snapshot_check, snapshot_timestamp, total_order

# ---------------------------------------------------------------- fixed values
# Fixed values of the reference: the genre list of the one-hot projection, in
# its order.
GENRES = [
    "Comedy", "War", "Talk-Show", "Sci-Fi", "Action", "Horror", "Crime", "Short", "Drama",
    "History", "Musical", "Animation", "Western", "Game-Show", "Family", "News", "Adult",
    "Thriller", "Music", "Mystery", "Romance", "Biography", "Reality-TV", "Film-Noir",
    "Documentary", "Sport", "Adventure", "Fantasy",
]
# Fixed values of the reference: snapshot configuration.
BASICS_CHECK_COLS = ["primary_title", "original_title", "start_year", "runtime_minutes", "genres"]
RATINGS_CHECK_COLS = ["average_rating", "num_votes"]
REVIEW_KEY_PARTS = ["author_name", "movie_title", "review_headline"]
MOVIE_TITLE_TYPE = "movie"

# A title with more rows than this on one side of a join is split over tasks.
HOT_KEY_ROWS = 1_000_000

# Raw tables (column names and types of the reference's DDL; NUMBER without a
# scale is kept as a decimal with one fractional digit for ratings - see
# ``parity_rounding`` in ``ratings_raw_schema``).
BASICS_RAW = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title_type", T.StringType()),
    T.StructField("primary_title", T.StringType()),
    T.StructField("original_title", T.StringType()),
    T.StructField("is_adult", T.BooleanType()),
    T.StructField("start_year", T.IntegerType()),
    T.StructField("end_year", T.IntegerType()),
    T.StructField("runtime_minutes", T.IntegerType()),
    T.StructField("genres", T.StringType()),
])


def ratings_raw_schema(parity_rounding: bool = False) -> T.StructType:
    """Ratings DDL. ``parity_rounding`` stores NUMBER as (38,0), rounding 7.4 to 7."""
    rating = T.DecimalType(38, 0) if parity_rounding else T.DecimalType(3, 1)
    return T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("average_rating", rating),
        T.StructField("num_votes", T.IntegerType()),
    ])


RATINGS_RAW = ratings_raw_schema()

# Fixed values of the reference: JSON paths of the review feed -> snapshot columns (name, path, type).
REVIEW_FIELDS = [
    ("author_name", "byline", "string"),
    ("is_critics_pick", "critics_pick", "int"),
    ("review_date_updated", "date_updated", "date"),
    ("movie_title", "display_title", "string"),
    ("review_headline", "headline", "string"),
    ("review_url", "link.url", "string"),
    ("mpaa_rating", "mpaa_rating", "string"),
    ("image_url", "multimedia.src", "string"),
    ("opening_date", "opening_date", "string"),
    ("review_date", "publication_date", "string"),
    ("summary_short", "summary_short", "string"),
]


# Fixed values of the reference: raw JSON field -> type, as the raw review suite sees them (objects stay VARIANT).
REVIEW_RAW_TYPES = [
    ("display_title", "string"), ("mpaa_rating", "string"), ("critics_pick", "long"),
    ("byline", "string"), ("headline", "string"), ("summary_short", "string"),
    ("publication_date", "string"), ("opening_date", "string"), ("date_updated", "string"),
    ("link", None), ("multimedia", None),
]


# The records of a review file as they are read: the fields above, objects with the parts that the snapshot uses.
REVIEW_DOCUMENT = T.StructType([
    T.StructField(name, T.LongType() if t == "long" else T.StringType() if t else
                  T.StructType([T.StructField("url" if name == "link" else "src", T.StringType())]))
    for name, t in REVIEW_RAW_TYPES])


def review_raw_fields(raw_variant: DataFrame, content: str = "content", keep: bool = False) -> DataFrame:
    """The landed review records as top-level columns (input of the raw review suite); ``keep``: beside the record."""
    return raw_variant.select(*([content] if keep else []),
                              *[variant_field(content, name, t).alias(name) for name, t in REVIEW_RAW_TYPES])


# ------------------------------------------------------------------ snapshots

def basic_source(raw: DataFrame) -> DataFrame:
    """The title snapshot's source: movies only, one row per id."""
    src = raw.filter(F.col("title_type") == MOVIE_TITLE_TYPE)
    return dedupe_latest(src, "id", total_order(src))


def imdb_basic_snapshot(raw: DataFrame, snapshot: DataFrame | None, now) -> DataFrame:
    """M1: movies only, check strategy on five columns."""
    return snapshot_check(snapshot, basic_source(raw), "id", BASICS_CHECK_COLS, now)


def rating_source(raw: DataFrame) -> DataFrame:
    """The rating snapshot's source: one row per id."""
    return dedupe_latest(raw, "id", total_order(raw))


def imdb_rating_snapshot(raw: DataFrame, snapshot: DataFrame | None, now) -> DataFrame:
    """M2: check strategy on rating and votes."""
    return snapshot_check(snapshot, rating_source(raw), "id", RATINGS_CHECK_COLS, now)


def parse_reviews(raw_variant: DataFrame, content: str = "content") -> DataFrame:
    """The review snapshot's source query: variant paths -> columns, md5 id first."""
    parsed = raw_variant.select(*[variant_field(content, path, t).alias(name)
                                  for name, path, t in REVIEW_FIELDS])
    return parsed.select(surrogate_key(*REVIEW_KEY_PARTS).alias("id"), "*")


def review_source(raw_variant: DataFrame) -> DataFrame:
    """The review snapshot's source: parsed documents, the newest of each id."""
    parsed = parse_reviews(raw_variant)
    return dedupe_latest(parsed, "id", total_order(parsed, "review_date_updated", "review_url"))


def review_snapshot(raw_variant: DataFrame, snapshot: DataFrame | None) -> DataFrame:
    """M3: timestamp strategy on ``review_date_updated`` (a DATE)."""
    return snapshot_timestamp(snapshot, review_source(raw_variant), "id", "review_date_updated")


# ------------------------------------------------------------------- staging

def basics_cleansed(snapshot: DataFrame, as_of=None) -> DataFrame:
    """M4: current movies not in the far future, one-hot genre flags, genre array."""
    cur = current(snapshot).filter(not_future("start_year", as_of))
    base = cur.select(
        "id", "primary_title", "original_title", "is_adult",
        F.col("start_year").alias("year"), "runtime_minutes",
        split_list("genres", ",").alias("genres_array"))
    return one_hot(base, "genres_array", GENRES, place_before="genres_array")


def ratings_cleansed(snapshot: DataFrame) -> DataFrame:
    """M5."""
    return current(snapshot).select("id", "average_rating", "num_votes")


def reviews_cleansed(snapshot: DataFrame) -> DataFrame:
    """M6: typed columns, '' rating -> NULL, 0/1 -> boolean (casts as in the model)."""
    return current(snapshot).selectExpr(
        "id",
        "CAST(author_name AS STRING) AS author_name",
        "CAST(CAST(is_critics_pick AS INT) AS BOOLEAN) AS is_critics_pick",
        "review_date_updated",
        "CAST(movie_title AS STRING) AS movie_title",
        "CAST(review_headline AS STRING) AS review_headline",
        "CAST(review_url AS STRING) AS review_url",
        "NULLIF(CAST(mpaa_rating AS STRING), '') AS mpaa_rating",
        "CAST(image_url AS STRING) AS image_url",
        "CAST(opening_date AS DATE) AS opening_date",
        "CAST(review_date AS DATE) AS review_date",
        "CAST(summary_short AS STRING) AS summary_short",
    )


# ---------------------------------------------------------------- dimensions

def dim_genres(basics: DataFrame, this: DataFrame | None = None) -> DataFrame:
    """M7: distinct genres (pre-reduced on distinct arrays), md5 id, insert-only."""
    g = distinct_elements(basics, "genres_array", "genre")
    dim = g.select(surrogate_key("genre").alias("id"), F.col("genre").cast("string").alias("genre"))
    return append_new(dim, this, "id")


def dim_titles(basics: DataFrame, this: DataFrame | None = None) -> DataFrame:
    """M8: titles whose (name, year) is unique; raw id may be NULL -> null-aware NOT IN."""
    u = unique_rows(basics, ["primary_title", "year"], ["id", "runtime_minutes"])
    dim = u.select("id", F.col("primary_title").alias("name"), "year", "runtime_minutes")
    return append_new(dim, this, "id", null_aware=True)


def dim_authors(reviews: DataFrame, this: DataFrame | None = None) -> DataFrame:
    """M9: distinct author names (NULL is one author, keyed like '')."""
    names = distinct_values(reviews, "author_name", "name")
    dim = names.select(surrogate_key("name").alias("id"), "name")
    return append_new(dim, this, "id")


def dim_review_movies(reviews: DataFrame, this: DataFrame | None = None) -> DataFrame:
    """(title, opening date) pairs seen exactly once."""
    u = unique_rows(reviews, ["movie_title", "opening_date"], ["mpaa_rating"])
    dim = u.select(F.col("movie_title").alias("title"), "opening_date", "mpaa_rating")
    dim = dim.select(surrogate_key("title", "opening_date").alias("id"), "*")
    return append_new(dim, this, "id")


def dim_reviews(reviews: DataFrame, this: DataFrame | None = None) -> DataFrame:
    """(headline, review date) pairs seen exactly once."""
    u = unique_rows(reviews, ["review_headline", "review_date"],
                    ["review_url", "summary_short", "is_critics_pick"])
    dim = u.select(F.col("review_headline").alias("headline"), F.col("review_url").alias("url"),
                   F.col("summary_short").alias("summary"), "review_date", "is_critics_pick")
    dim = dim.select(surrogate_key("headline", "review_date").alias("id"), "*")
    return append_new(dim, this, "id")


# ---------------------------------------------------------------------- fact

FACT_COLUMNS = ["imdb_movie_id", "nyt_movie_id", "genre_id", "nyt_author_id", "nyt_review_id",
                "average_rating", "num_votes", "is_critics_pick"]


def imdb_combined(ratings: DataFrame, basics: DataFrame, d_titles: DataFrame,
                  d_genres: DataFrame, keep: tuple = ()) -> DataFrame:
    """Ratings x titles, title dim lookup, genre dim by array membership (J4, J5, J6). ``keep=("id",)`` keeps the rating's id."""
    rb = rated_titles(ratings.select("id", "average_rating", "num_votes"),
                      basics.select("id", "genres_array"))
    im = d_titles.select(F.col("id").alias("__im_id"), F.col("id").alias("imdb_movie_id"),
                         F.col("year"), F.col("name").alias("movie_name"))
    with_movie = left_lookup(rb, im, "id", right_on="__im_id")
    with_genre = array_match_join(with_movie, "genres_array",
                                  d_genres.select(F.col("id").alias("genre_id"), "genre"),
                                  "genre", ["genre_id"])
    return with_genre.select(*keep, "imdb_movie_id", "average_rating", "num_votes", "genre_id",
                             "year", "movie_name")


def reviews_per_title(reviews: DataFrame) -> DataFrame:
    """Reviews per title (partially aggregated): the rows per key of the fan-out join's left side."""
    return reviews.groupBy("movie_title").agg(F.count(F.lit(1)).alias("__n"))


def nyt_rows_per_title(reviews: DataFrame, d_movies: DataFrame) -> DataFrame:
    """Rows per title after the fan-out join: reviews of the title times its movie-dim rows.

    Exact, because the author and review lookups that follow meet unique keys.
    """
    dims = d_movies.groupBy(F.col("title").alias("movie_title")).agg(F.count(F.lit(1)).alias("__m"))
    return (reviews_per_title(reviews).join(dims, "movie_title")
            .select("movie_title", (F.col("__n") * F.col("__m")).alias("__n")))


def nyt_combined(reviews: DataFrame, d_movies: DataFrame, d_authors: DataFrame,
                 d_reviews: DataFrame, title_rows: DataFrame | None = None,
                 hot_rows: int | None = HOT_KEY_ROWS) -> DataFrame:
    """Reviews x movie dim on title only (fan-out), author and review lookups."""
    n = reviews.select("movie_title", "author_name", "review_headline", "review_date")
    nm = d_movies.select(F.col("id").alias("nyt_movie_id"), F.col("title").alias("movie_name"),
                         F.year("opening_date").alias("year"))
    x = fanout_join(n, nm, "movie_title", right_on="movie_name", hot_rows=hot_rows, key_rows=title_rows)
    x = x.withColumn("movie_name", F.col("movie_title"))
    na = d_authors.select(F.col("id").alias("nyt_author_id"), F.col("name").alias("__a_name"))
    x = left_lookup(x, na, "author_name", right_on="__a_name")
    nr = d_reviews.select(F.col("id").alias("nyt_review_id"), F.col("headline").alias("__r_head"),
                          F.col("review_date").alias("__r_date"), "is_critics_pick")
    x = left_lookup(x, nr, ["review_headline", "review_date"], right_on=["__r_head", "__r_date"])
    return x.select("nyt_movie_id", "nyt_author_id", "nyt_review_id", "is_critics_pick",
                    "movie_name", "year")


def fct_imdb_nyt(ratings: DataFrame, basics: DataFrame, reviews: DataFrame, d_genres: DataFrame,
                 d_titles: DataFrame, d_authors: DataFrame, d_movies: DataFrame,
                 d_reviews: DataFrame, match_year: bool = False,
                 hot_rows: int | None = HOT_KEY_ROWS, keep: tuple = ()) -> DataFrame:
    """grain = rating x genre x review; the feeds meet on the movie name.

    A title with more than ``hot_rows`` reviews is split in the fan-out join, one with more
    than ``hot_rows`` rows on the NYT side in the join of the feeds. The counts are lazy
    inputs of the joins. Titles hot on the IMDB side are split by AQE's skew join; rows
    without a title name (every title that is not unique) are spread, not one hot key.
    """
    left = imdb_combined(ratings, basics, d_titles, d_genres, keep)
    if hot_rows is None:
        right = nyt_combined(reviews, d_movies, d_authors, d_reviews, hot_rows=None)
        fact = join_feeds(left, right, ["movie_name"], extra_keys=["year"], match_extra=match_year)
        return fact.select(*keep, *FACT_COLUMNS)
    right = nyt_combined(reviews, d_movies, d_authors, d_reviews, title_rows=reviews_per_title(reviews),
                         hot_rows=hot_rows)
    rows = nyt_rows_per_title(reviews, d_movies).withColumnRenamed("movie_title", "movie_name")
    fact = join_feeds(left, right, ["movie_name"], extra_keys=["year"], match_extra=match_year,
                      hot_rows=hot_rows, key_rows=rows)
    return fact.select(*keep, *FACT_COLUMNS)
