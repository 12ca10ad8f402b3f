"""The reference's raw-file expectation suites, as data.

Fixed values of the reference: column names, thresholds, accepted sets and
type-name lists of its three raw suites, in their order.
"""

from __future__ import annotations

from marquee.operators.quality import columns_match_set, in_set, in_type_list, not_null, unique_proportion

# Fixed values of the reference: type-name lists accepted for text and integer columns.
STRING_TYPE_NAMES = ["CHAR", "NCHAR", "NTEXT", "NVARCHAR", "STRING", "StringType", "StringType()",
                     "TEXT", "VARCHAR", "dtype('O')", "object", "str", "string"]
INT_TYPE_NAMES = ["BIGINT", "BYTEINT", "ByteType()", "INT", "INT64", "INTEGER", "Int16Dtype",
                  "Int32Dtype", "Int64Dtype", "Int8Dtype", "IntegerType", "IntegerType()", "LongType",
                  "LongType()", "SMALLINT", "ShortType()", "TINYINT", "UInt16Dtype", "UInt32Dtype",
                  "UInt64Dtype", "UInt8Dtype", "int", "int16", "int32", "int64", "int8", "int_",
                  "integer", "uint16", "uint32", "uint64", "uint8"]

# Fixed values of the reference: the three raw suites.
BASICS_COLUMNS = ["tconst", "titleType", "primaryTitle", "originalTitle", "isAdult", "startYear",
                  "endYear", "runtimeMinutes", "genres"]
BASICS_RAW_SUITE = [
    not_null("tconst"),
    columns_match_set(BASICS_COLUMNS),
    not_null("originalTitle", mostly=0.99),
    not_null("primaryTitle", mostly=0.99),
]

RATINGS_RAW_SUITE = [
    not_null("tconst"),
    not_null("averageRating"),
    not_null("numVotes", mostly=0.9),
]

MPAA_RATINGS = ["", "G", "PG", "PG-13", "R", "NC-17"]
REVIEW_COLUMNS = ["display_title", "mpaa_rating", "critics_pick", "byline", "headline",
                  "summary_short", "publication_date", "opening_date", "date_updated", "link",
                  "multimedia"]
REVIEWS_RAW_SUITE = [
    not_null("display_title"),
    unique_proportion("display_title", 1.0, 1.0),
    in_set("mpaa_rating", MPAA_RATINGS),
    not_null("mpaa_rating"),
    in_type_list("mpaa_rating", STRING_TYPE_NAMES),
    in_set("critics_pick", [0, 1]),
    not_null("critics_pick"),
    in_type_list("critics_pick", INT_TYPE_NAMES),
    not_null("publication_date"),
    in_type_list("publication_date", STRING_TYPE_NAMES),
    not_null("opening_date"),
    in_type_list("opening_date", STRING_TYPE_NAMES),
    columns_match_set(REVIEW_COLUMNS),
]

# Fixed values of the reference: accepted MPAA ratings of the cleansed reviews test.
ACCEPTED_MPAA = ["G", "PG", "PG-13", "R", "NC-17"]
