"""Movie-shaped inputs mapped from the driver's tables.

The driver has no movie data, so each feed is a column mapping of a whole
driver table into the schema the models expect. These functions only rename,
cast and format columns of every row; they filter nothing and compute none
of the models' work (snapshots, dimensions, joins). The models must be right
on any data of these schemas; nothing downstream relies on how these columns
are formed.

Mapping:

* titles from ``part``: title = 'Title ' || (p_partkey div 4), so names repeat and some (name,
  year) pairs do, too; kind = one of five by p_size; year = 1990 + p_size (the latest lie in the
  future); runtime = 60 + p_size; genres = two of the genre list, by p_size and p_partkey
* ratings from ``orders``: id = o_orderkey (only some are titles), rating and votes by o_custkey
* reviews from ``customer``: title = 'Title ' || (c_custkey div 3), author and summary =
  c_mktsegment, headline = c_mktsegment || ' on ' || (c_custkey div 2), the dates and the rating
  label by c_nationkey
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.plans.models import GENRES
from marquee.session import table_path
from marquee.sources.readers import CsvFormat


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


KINDS = ["movie", "short", "movie", "tvSeries", "movie"]
MPAA_LABELS = ["", "G", "PG", "PG-13", "R", "NC-17"]


def _pick(values: list[str], number: str) -> str:
    """SQL: the value at ``number`` modulo the list's length."""
    return f"element_at(array({', '.join(repr(v) for v in values)}), CAST({number} % {len(values)} + 1 AS INT))"


LABEL = _pick(MPAA_LABELS, "c_nationkey")
REVIEW_TITLE = "concat('Title ', CAST(c_custkey div 3 AS STRING))"
HEADLINE = "concat(c_mktsegment, ' on ', CAST(c_custkey div 2 AS STRING))"


def basics_raw(part: DataFrame) -> DataFrame:
    """Raw titles table (``BASICS_RAW`` columns)."""
    return part.selectExpr(
        "CAST(p_partkey AS STRING) AS id",
        f"{_pick(KINDS, 'p_size')} AS title_type",
        "concat('Title ', CAST(p_partkey div 4 AS STRING)) AS primary_title",
        "p_name AS original_title",
        "p_size % 7 = 0 AS is_adult",
        "CAST(1990 + p_size AS INT) AS start_year",
        "CAST(NULL AS INT) AS end_year",
        "CAST(60 + p_size AS INT) AS runtime_minutes",
        f"concat({_pick(GENRES, 'p_size')}, ',', {_pick(GENRES, 'p_partkey')}) AS genres",
    )


def ratings_raw(orders: DataFrame) -> DataFrame:
    """Raw ratings table: id, average_rating, num_votes."""
    return orders.selectExpr(
        "CAST(o_orderkey AS STRING) AS id",
        "CAST(1 + (o_custkey % 90) / 10 AS DECIMAL(3,1)) AS average_rating",
        "CAST(o_custkey * 10 AS INT) AS num_votes",
    )


def reviews_parsed(customer: DataFrame) -> DataFrame:
    """Review feed after variant parsing (the review snapshot's source columns, no id)."""
    return customer.selectExpr(
        "c_mktsegment AS author_name",
        "CAST(c_nationkey % 2 AS INT) AS is_critics_pick",
        "date_add(DATE'2002-01-01', CAST(c_nationkey AS INT)) AS review_date_updated",
        f"{REVIEW_TITLE} AS movie_title",
        f"{HEADLINE} AS review_headline",
        "concat('https://reviews.example/', CAST(c_custkey AS STRING)) AS review_url",
        f"{LABEL} AS mpaa_rating",
        "CAST(NULL AS STRING) AS image_url",
        "CAST(date_add(DATE'2000-01-01', CAST(c_nationkey % 3 AS INT)) AS STRING) AS opening_date",
        "CAST(date_add(DATE'2001-01-01', CAST(c_nationkey AS INT)) AS STRING) AS review_date",
        "c_mktsegment AS summary_short",
    )


def change_feed(events: DataFrame) -> DataFrame:
    """Check-strategy change feed: key user_id, tracked attribute event_type, arrival ts."""
    return events.select("event_id", "user_id", "event_type", "ts")


def timestamp_feed(events: DataFrame) -> DataFrame:
    """Timestamp-strategy feed: ``updated_at`` = 2024-01-01 + k days, k from the JSON props."""
    k = F.get_json_object("props", "$.k").cast("int")
    return events.select("event_id", "user_id", "ts",
                         F.date_add(F.lit("2024-01-01").cast("date"), k).alias("updated_at"))


def paged_feed(conversations: DataFrame, page_size: int = 20) -> DataFrame:
    """Conversation turns landed as API pages of at most ``page_size`` records."""
    page = F.expr(f"turn div {page_size}")
    return (conversations.groupBy("conv_id", page.alias("page"))
            .agg(F.collect_list(F.struct("turn", "role", "text")).alias("results")))


def review_documents(customer: DataFrame, title: str = REVIEW_TITLE, keep=()) -> DataFrame:
    """Review documents as JSON text (column ``value``) with the feed's field names; ``multimedia``
    is null for every third nation."""
    doc = f"""named_struct(
        'display_title', {title},
        'mpaa_rating', {LABEL},
        'critics_pick', CAST(c_nationkey % 2 AS INT),
        'byline', c_mktsegment,
        'headline', {HEADLINE},
        'summary_short', c_mktsegment,
        'publication_date', CAST(date_add(DATE'2001-01-01', CAST(c_nationkey AS INT)) AS STRING),
        'opening_date', CAST(date_add(DATE'2000-01-01', CAST(c_nationkey % 3 AS INT)) AS STRING),
        'date_updated', CAST(date_add(DATE'2002-01-01', CAST(c_nationkey AS INT)) AS STRING),
        'link', named_struct('url', concat('https://reviews.example/', CAST(c_custkey AS STRING))),
        'multimedia', CASE WHEN c_nationkey % 3 != 0
                           THEN named_struct('src', concat('img/', CAST(c_custkey AS STRING))) END)"""
    return customer.selectExpr(f"to_json({doc}) AS value", *keep)


def reviews_raw(customer: DataFrame) -> DataFrame:
    """Raw review table: one VARIANT column ``content`` per review document."""
    return review_documents(customer).selectExpr("parse_json(value) AS content")


# Decorations of original titles in the source files, by p_partkey modulo 7: what a CSV file must carry unharmed.
ORIGINAL_TITLE = """CASE CAST(id AS BIGINT) % 7
    WHEN 0 THEN concat('say "', original_title, '"') WHEN 1 THEN concat(original_title, ', "the end"')
    WHEN 2 THEN concat(original_title, chr(92), 'n', chr(92)) WHEN 3 THEN concat(original_title, chr(10), 'II')
    WHEN 4 THEN concat(' ', original_title, ' ') WHEN 5 THEN concat('"', original_title, '"') ELSE original_title END"""


def source_files(spark: SparkSession, sf_dir: str, folder: str) -> dict[str, str]:
    """The feeds as source files: titles and ratings as TSV with ``\\N`` for NULL, the runtime of every
    997th title unreadable, quotes, commas, backslashes, line ends and blanks in the original titles; reviews as JSON
    arrays of at most 1000, one per file. Returns the paths by feed."""
    part = basics_raw(read(spark, sf_dir, "part"))
    titles = part.selectExpr(
        "id AS tconst", "title_type AS titleType", "primary_title AS primaryTitle", f"{ORIGINAL_TITLE} AS originalTitle",
        "CAST(CAST(is_adult AS INT) AS STRING) AS isAdult", "CAST(start_year AS STRING) AS startYear",
        "CAST(end_year AS STRING) AS endYear",
        "CASE WHEN id % 997 = 0 THEN 'about 90' ELSE CAST(runtime_minutes AS STRING) END AS runtimeMinutes", "genres")
    ratings = ratings_raw(read(spark, sf_dir, "orders")).selectExpr(
        "id AS tconst", "CAST(average_rating AS STRING) AS averageRating", "CAST(num_votes AS STRING) AS numVotes")
    paths = {"basics": f"{folder}/title.basics", "ratings": f"{folder}/title.ratings", "reviews": f"{folder}/reviews/*"}
    for feed, df in (("basics", titles), ("ratings", ratings)):
        tsv = CsvFormat(sep="\t").writer_options() | {"nullValue": "\\N"}
        df.write.options(**tsv).csv(paths[feed])
    # The review suite wants every title once in a batch.
    documents = review_documents(read(spark, sf_dir, "customer"), "concat('Title ', CAST(c_custkey AS STRING))",
                                 ["c_custkey div 1000 AS page"])
    array = documents.groupBy("page").agg(F.concat(F.lit("["), F.array_join(F.collect_list("value"), ","), F.lit("]")))
    array.write.partitionBy("page").text(f"{folder}/reviews")
    return paths
