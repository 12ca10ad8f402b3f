"""Quality rules: per-text counts and cross-document line frequency, all native.

Lines are normalised (A-Z lower-cased, runs of blanks to one space, trimmed) and
hashed; a line is boilerplate of a host if more distinct documents (distinct
texts) of that host hold it than the limit, the larger of ``min_documents`` and
``share`` of the host's distinct documents. Boilerplate lines are removed; a
document that loses more than ``max_removed`` of its words is rejected.

Defined results: null text has no words (base rules reject it); a null host is a
host of its own; copies of a text count as one document, so a repeated row is
judged like its first; lines without a word are never counted or removed; extra
columns pass through, and columns named like a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import BLANKS, WORD, lookup_join, lower_ascii, stored

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

FEW_REPEATS = 64     # up to so many repeated windows, membership is tested by scanning them


def base_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) and
    base_failed (boolean)."""
    t = F.coalesce(F.col(text), F.lit(""))
    df = df.withColumns({
        "_words": F.regexp_extract_all(t, F.lit(WORD), F.lit(0)),
        "word_chars": F.length(F.translate(t, BLANKS, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
        "_lines": F.filter(F.split(t, "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != ""),
    })
    w = F.col("_words")
    df = df.withColumns({
        "n_words": F.size(w).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_windows": F.transform(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
                                lambda x, i: F.xxhash64(x, w[i + 1], w[i + 2])),
    }).drop("_words", "_lines")
    h = F.col("_windows")
    df = df.withColumn("_sorted", F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(h)))
    s, n = F.col("_sorted"), F.size("_sorted")
    df = df.withColumn("_again", F.when(s.isNotNull(), F.array_distinct(F.filter(
        F.zip_with(F.slice(s, 1, n - 1), F.slice(s, 2, n - 1), lambda a, b: F.when(a == b, a)),
        lambda x: x.isNotNull())))).drop("_sorted")
    df = df.withColumn("_places", F.when(F.col("_again").isNull(), F.array().cast("array<int>"))
                       .when(F.size("_again") <= FEW_REPEATS, _places_by_scan(h))
                       .otherwise(_places_by_sort(h)))
    df = df.withColumn("n_repeat_words", F.size(F.array_distinct(F.flatten(F.transform(
        "_places", lambda i: F.array(i, i + 1, i + 2))))).cast("long"))
    return df.drop("_windows", "_again", "_places").withColumn("base_failed", (
        (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))))


def _places_by_scan(windows: Column) -> Column:
    """Where a window stands that is in the short list ``_again``."""
    return F.filter(F.transform(windows, lambda x, i: F.when(F.array_contains(F.col("_again"), x), i)),
                    lambda i: i.isNotNull())


def _places_by_sort(windows: Column) -> Column:
    """The same for any number of repeats: sort (window, place) and compare neighbours."""
    s = F.array_sort(F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    n = F.size(windows)
    pairs = F.zip_with(F.slice(s, 1, n - 1), F.slice(s, 2, n - 1),
                       lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    return F.flatten(F.filter(pairs, lambda p: p.isNotNull()))


def normal_line(line: Column) -> Column:
    return F.btrim(F.regexp_replace(lower_ascii(line), r"[\x20\x09-\x0D]+", " "))


def text_lines(df: DataFrame, text: str, host: str, *keep: str) -> DataFrame:
    """One row per line that has a word: host, hashed line, its words, the hash of the text."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = df.select(*keep, F.col(host).alias("_host"), F.xxhash64(t).alias("_text"),
                      F.explode(F.split(t, "\n", -1)).alias("_raw"))
    lines = lines.withColumn("_line", normal_line(F.col("_raw"))).filter(F.col("_line") != "")
    return lines.select(*keep, "_host", "_text", F.xxhash64("_line").alias("_line"),
                        F.regexp_count("_line", F.lit(WORD)).cast("long").alias("_n"))


def frequent_lines(df: DataFrame, text: str = "text", host: str = "source", min_documents: int = 20) -> DataFrame:
    """(_host, _line) of every line that more than ``min_documents`` distinct texts of a host hold, the same limit for
    hosts of any size. Distinct (host, line, text) rows first, so counts are pre-aggregated and no host or
    line is one task's work."""
    seen = text_lines(df, text, host).groupBy("_host", "_line", "_text").agg(F.lit(1).alias("_one"))
    counts = seen.groupBy("_host", "_line").agg(F.count("*").alias("_documents"))
    return counts.filter(F.col("_documents") > min_documents).select("_host", "_line")


def judge(df: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
          min_documents: int = 20, max_removed: float = 0.5) -> DataFrame:
    """``df`` without its text, plus the base counts, removed_words (long) and kept."""
    results = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
               "removed_words", "kept")
    df = df.drop(*results)
    frequent = stored(frequent_lines(df, text, host, min_documents), "frequent-lines")
    frequent = frequent.select(F.coalesce("_host", F.lit("")).alias("_host"),
                               F.col("_host").isNull().alias("_no_host"), "_line", F.lit(True).alias("_hit"))
    lines = text_lines(df, text, host, doc_id).withColumns({
        "_no_host": F.col("_host").isNull(), "_host": F.coalesce("_host", F.lit(""))})
    hits = lookup_join(lines, frequent, ["_host", "_no_host", "_line"], "inner")
    removed = hits.groupBy(F.col(doc_id).alias("_id"), "_text").agg(F.sum("_n").alias("_removed"))
    rows = df.groupBy(F.col(doc_id).alias("_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_text")
                      ).agg(F.count("*").alias("_rows"))
    # A row that stands several times has its lines counted as often.
    removed = removed.join(rows, removed["_id"].eqNullSafe(rows["_id"]) & (removed["_text"] == rows["_text"])
                           ).select(removed["_id"], removed["_text"], (F.col("_removed") / F.col("_rows"))
                                    .cast("long").alias("removed_words"))
    counted = base_counts(df.withColumn("_key", F.xxhash64(F.coalesce(F.col(text), F.lit("")))), text).drop(text)
    out = counted.join(removed, counted[doc_id].eqNullSafe(removed["_id"])
                       & (counted["_key"] == removed["_text"]), "left").drop("_id", "_text", "_key")
    out = out.withColumn("removed_words", F.coalesce("removed_words", F.lit(0).cast("long")))
    return out.withColumn("kept", ~F.col("base_failed")
                          & (F.col("removed_words") <= max_removed * F.col("n_words")))


def strip_lines(df: DataFrame, text: str = "text", host: str = "source", min_documents: int = 20) -> DataFrame:
    """``df`` with the boilerplate lines of its host taken out of ``text``.

    Texts with such a line are taken apart once per (host, text), joined line by line and put together again;
    nothing is gathered per host.
    """
    names = {c: f"_c{i}" for i, c in enumerate(df.columns)}
    rows = df.toDF(*names.values())
    t, h = names[text], names[host]
    frequent = stored(frequent_lines(rows, t, h, min_documents), "frequent-lines").select(
        F.coalesce("_host", F.lit("")).alias("_host"), F.col("_host").isNull().alias("_none"), "_line", F.lit(True).alias("_hit"))
    key = {"_none": F.col(h).isNull(), "_host": F.coalesce(h, F.lit("")), "_text": F.xxhash64(t)}
    rows = rows.withColumns(key)
    bodies = rows.filter(F.col(t).isNotNull()).groupBy("_none", "_host", "_text").agg(F.any_value(t).alias("_body"))
    lines = bodies.select("_none", "_host", "_text", F.posexplode(F.split("_body", "\n", -1)).alias("_at", "_raw"))
    lines = lines.withColumn("_line", F.when(normal_line(F.col("_raw")) != "", F.xxhash64(normal_line(F.col("_raw")))))
    marked = lookup_join(lines, frequent, ["_host", "_none", "_line"])
    kept = F.filter(F.array_sort(F.collect_list(F.struct("_at", "_raw", F.col("_hit").isNull().alias("_stays")))), lambda x: x["_stays"])
    clean = (marked.groupBy("_none", "_host", "_text")
             .agg(F.array_join(F.transform(kept, lambda x: x["_raw"]), "\n").alias("_clean"), F.count("_hit").alias("_hits"))
             .filter("_hits > 0").drop("_hits"))
    out = lookup_join(rows, stored(clean, "clean-texts"), ["_none", "_host", "_text"], bound_rows=0)
    return out.withColumn(t, F.coalesce("_clean", t)).select(*names.values()).toDF(*df.columns)
