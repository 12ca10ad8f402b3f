"""The fact table kept up to date by deltas.

A fact row belongs to one rating id. A day changes the rows of few ids: those whose title or rating has a new version,
those that entered the title dimension, and those whose name meets a review or a dimension row that came or changed.
``affected_ids`` finds them from the day's changes; ``FactTable.refresh`` computes the fact of these ids
only and replaces their buckets. Nothing else is joined or written again.

``KeyCounts`` holds how many rows have each key, so that a key which becomes unique or stops being unique is found from
the day's added and removed rows, without regrouping all others.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.operators.scd2 import same_key
from marquee.plans import models as M
from marquee.session import scratch_path
from marquee.sources.catalog import Catalog, overwriting_partitions

BUCKETS = 256
BUCKET = "bucket"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.hint("rebalance").write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class BucketedTable:
    """A Spark table partitioned by a hash bucket of ``keys``, whose buckets are replaced one by one."""

    def __init__(self, catalog: Catalog, name: str, keys, buckets: int = BUCKETS):
        self.catalog, self.name = catalog, name
        self.keys = [keys] if isinstance(keys, str) else list(keys)
        self.buckets = catalog.table_meta(name, "buckets") or buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(self.buckets)).cast("int")

    def exists(self) -> bool:
        return self.catalog.exists(self.name)

    def read(self) -> DataFrame:
        return self.catalog.read_table(self.name).drop(BUCKET)

    def touched(self, rows: DataFrame) -> list[int]:
        """Buckets of the rows' keys: at most ``buckets`` numbers reach the driver."""
        return sorted(r[0] for r in rows.select(self.bucket().alias("b")).distinct().collect())

    def of_buckets(self, buckets: list[int]) -> DataFrame:
        return self.catalog.read_table(self.name).filter(F.col(BUCKET).isin(buckets)).drop(BUCKET)

    def write(self, rows: DataFrame) -> None:
        """Replace all buckets."""
        if self.exists():
            self.replace(rows, sorted(r[0] for r in self.catalog.read_table(self.name).select(BUCKET).distinct().collect()))
            return
        rows.withColumn(BUCKET, self.bucket()).hint("rebalance", BUCKET).write.partitionBy(BUCKET).saveAsTable(
            self.catalog.table(self.name))
        self.catalog.set_meta(self.name, {"buckets": self.buckets})

    def replace(self, rows: DataFrame, buckets: list[int]) -> None:
        """Replace the given buckets by ``rows`` (which may come from them); a bucket left without rows is dropped."""
        columns = self.catalog.read_table(self.name).columns
        staged = stored(rows.withColumn(BUCKET, self.bucket()).select(*columns), f"replace-{self.name}")
        with overwriting_partitions(self.catalog.spark):
            staged.hint("rebalance", BUCKET).write.insertInto(self.catalog.table(self.name), overwrite=True)
        left = {r[0] for r in staged.select(BUCKET).distinct().collect()}
        for b in buckets:
            if b not in left:
                self.catalog.spark.sql(f"ALTER TABLE {self.catalog.table(self.name)} DROP IF EXISTS PARTITION ({BUCKET} = {b})")


class KeyCounts(BucketedTable):
    """Rows per key, kept by +1 and -1. A NULL in a key is a value here; readers that drop such keys filter them."""

    def apply(self, added: DataFrame | None = None, removed: DataFrame | None = None) -> DataFrame:
        """Count rows in and out; returns (keys, n_before, n_after) of the keys whose count has changed."""
        deltas = None
        for rows, sign in ((added, 1), (removed, -1)):
            if rows is not None:
                part = rows.groupBy(*self.keys).agg((F.count(F.lit(1)) * sign).cast("long").alias("delta"))
                deltas = part if deltas is None else deltas.unionByName(part)
        deltas = stored(deltas.groupBy(*self.keys).agg(F.sum("delta").alias("delta")).filter("delta <> 0"), "deltas")
        if not self.exists():
            self.write(deltas.withColumnRenamed("delta", "n"))
            return deltas.select(*self.keys, F.lit(0).cast("long").alias("n_before"), F.col("delta").alias("n_after"))
        buckets = self.touched(deltas)
        names = [f"__d{i}" for i in range(len(self.keys))]
        d = deltas.select(*[F.col(k).alias(n) for k, n in zip(self.keys, names)], "delta")
        old = self.of_buckets(buckets)
        met = old.join(d, same_key(old, d, self.keys, names), "full_outer").select(
            *[F.when(F.col("n").isNotNull(), F.col(k)).otherwise(F.col(n)).alias(k) for k, n in zip(self.keys, names)],
            F.coalesce("n", F.lit(0)).cast("long").alias("n_before"), F.col("delta").isNotNull().alias("met"),
            (F.coalesce("n", F.lit(0)) + F.coalesce("delta", F.lit(0))).cast("long").alias("n_after"))
        met = stored(met, "counts")
        if buckets:
            self.replace(met.filter("n_after > 0").select(*self.keys, F.col("n_after").alias("n")), buckets)
        return met.filter("met").select(*self.keys, "n_before", "n_after")

    def unique(self) -> DataFrame:
        """Keys that exactly one row has (A1)."""
        return self.read().filter("n = 1").select(*self.keys)


@dataclass
class FactInputs:
    """The cleansed views and dimensions that the fact is built from."""
    ratings: DataFrame
    basics: DataFrame
    reviews: DataFrame
    d_genres: DataFrame
    d_titles: DataFrame
    d_authors: DataFrame
    d_movies: DataFrame
    d_reviews: DataFrame

    def fact(self, **changes) -> DataFrame:
        parts = {**self.__dict__, **changes}
        return M.fct_imdb_nyt(**parts, keep=("id",))


@dataclass
class DayChanges:
    """What a day has changed: ids of titles and ratings, reviews (current rows), and rows that entered dimensions."""
    ids: list[DataFrame] = field(default_factory=list)            # frames with an ``id`` column
    reviews: list[DataFrame] = field(default_factory=list)        # frames with a ``movie_title`` column
    titles: DataFrame | None = None                               # new rows of each dimension
    authors: DataFrame | None = None
    movies: DataFrame | None = None
    articles: DataFrame | None = None


def affected_ids(now: FactInputs, day: DayChanges) -> DataFrame:
    """(id): the rating ids whose fact rows the day may have changed (J4-J10, read backwards).

    Genres need no step of their own: a genre enters its dimension with a title that has changed.
    """
    ids = [d.select("id") for d in day.ids]
    if day.titles is not None:
        ids.append(day.titles.select("id"))
    names = [d.select(F.col("movie_title").alias("name")) for d in day.reviews]
    if day.movies is not None:
        names.append(day.movies.select(F.col("title").alias("name")))
    if day.authors is not None:
        names.append(now.reviews.join(day.authors.select(F.col("name").alias("author_name")), "author_name", "left_semi")
                     .select(F.col("movie_title").alias("name")))
    if day.articles is not None:
        heads = day.articles.select(F.col("headline").alias("review_headline"), "review_date")
        names.append(now.reviews.join(heads, ["review_headline", "review_date"], "left_semi")
                     .select(F.col("movie_title").alias("name")))
    if names:
        ids.append(now.d_titles.join(_union(names).distinct(), "name", "left_semi").select("id"))
    return _union(ids).distinct()


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


class FactTable(BucketedTable):
    """The stored fact, partitioned by a hash bucket of the rating id."""

    def __init__(self, catalog: Catalog, name: str = "fct_imdb_nyt", buckets: int = BUCKETS):
        super().__init__(catalog, name, "id", buckets)

    def read(self) -> DataFrame:
        return self.catalog.read_table(self.name).select(*M.FACT_COLUMNS)

    def rebuild(self, now: FactInputs) -> None:
        self.write(now.fact())

    def refresh(self, now: FactInputs, day: DayChanges) -> list[int]:
        """Bring the fact up to date with a day's changes; returns the buckets that were replaced."""
        if not self.exists():
            self.rebuild(now)
            return list(range(self.buckets))
        ids = stored(affected_ids(now, day), "affected")
        buckets = self.touched(ids)
        if not buckets:
            return []
        names = now.d_titles.join(ids, "id", "left_semi").select(F.col("name").alias("movie_title")).distinct()
        new = now.fact(ratings=now.ratings.join(ids, "id", "left_semi"), basics=now.basics.join(ids, "id", "left_semi"),
                       reviews=now.reviews.join(names, "movie_title", "left_semi"))
        kept = self.of_buckets(buckets).join(ids, "id", "left_anti")
        self.replace(kept.unionByName(new), buckets)
        return buckets
