"""The fact by deltas against a rebuild, and uniqueness kept as counts."""

import datetime as dt
import random

from pyspark.sql import functions as F

from marquee.operators import unique_rows
from marquee.plans import models as M
from marquee.plans.daily import load_and_build
from marquee.plans.fact import FactTable, KeyCounts
from marquee.sources import Catalog
from tests.conftest import rows

REVIEW = ["author_name", "movie_title", "review_headline", "opening_date", "review_date", "review_date_updated"]


def _titles(spark, data):
    return spark.createDataFrame([(f"tt{i}", "movie", name, name, False, year, None, 90, genres) for i, name, year, genres in data],
                                 M.BASICS_RAW)


def _ratings(spark, data):
    return spark.createDataFrame([(f"tt{i}", r, v) for i, r, v in data], "id string, average_rating string, num_votes int").select(
        "id", F.col("average_rating").cast("decimal(3,1)").alias("average_rating"), "num_votes")


def _reviews(spark, data):
    docs = [{"byline": a, "display_title": t, "headline": h, "opening_date": o, "publication_date": "2020-01-01",
             "date_updated": u, "critics_pick": 1, "mpaa_rating": "R", "summary_short": "s", "link": {"url": h}}
            for a, t, h, o, u in data]
    import json

    return spark.createDataFrame([(json.dumps(d),) for d in docs], "j string").select(F.parse_json("j").alias("content"))


def test_days_applied_as_deltas_equal_rebuilds(spark, tmp_root):
    days = [
        ([(1, "Heat", 1995, "Crime,Drama"), (2, "Up", 2009, "Animation"), (3, "Twins", 1988, "Comedy"), (4, "Solo", 2000, None),
          (5, "Later", 2024, "Drama"), (6, "Lone", 1999, "War")],
         [(i, "7.0", 10 * i) for i in range(1, 8)], [("A", "Heat", "h1", "1995-12-15", "2022-01-01"), ("B", "Up", "h2", "2009-05-29", "2022-01-01")]),
        # a title that stops being unique, a new genre, a changed rating, a second opening of a title
        ([(7, "Twins", 1988, "Comedy"), (2, "Up", 2009, "Animation,Family"), (8, "Gone", 2001, "War")], [(1, "8.0", 11), (8, "5.0", 1)],
         [("C", "Heat", "h3", "1996-01-01", "2022-01-02"), ("A", "Twins", "h4", "1988-12-09", "2022-01-02")]),
        (None, None, [("B", "Up", "h2", "2009-05-29", "2022-01-03"), ("D", "Up", "h2", "2009-06-01", "2022-01-03"), ("E", "Nowhere", "h9", None, "2022-01-03")]),
        # a title moves far into the future and leaves; nothing else
        ([(6, "Lone", 2999, "War")], None, None),
        (None, None, None),
    ]
    one, two = Catalog(spark, f"{tmp_root}/delta"), Catalog(spark, f"{tmp_root}/rebuild")
    for n, (titles, ratings, reviews) in enumerate(days, 1):
        # the last day comes a year later: a title of 2024 becomes visible without any change
        as_of = "2022-06-01" if n < 5 else "2023-06-01"
        for catalog, fact in ((one, "delta"), (two, "rebuild")):
            load_and_build(catalog, titles and _titles(spark, titles), ratings and _ratings(spark, ratings),
                           reviews and _reviews(spark, reviews), F.lit(dt.datetime(2022, 1, n)), as_of, f"day{n}", 8, fact)
        got, want = rows(FactTable(one).read()), rows(two.read_table("fct_imdb_nyt"))
        assert got == want and len(want) > 5, n


def test_a_day_replaces_the_buckets_of_its_ids(spark, tmp_root):
    catalog = Catalog(spark, tmp_root)
    titles = [(i, f"T{i}", 1990, "Drama") for i in range(40)]
    args = dict(as_of="2022-06-01", buckets=64, fact="delta")
    load_and_build(catalog, _titles(spark, titles), _ratings(spark, [(i, "7.0", 1) for i in range(40)]), None,
                   F.lit(dt.datetime(2022, 1, 1)), run="1", **args)
    before = set(catalog.read_table("fct_imdb_nyt").inputFiles())
    load_and_build(catalog, None, _ratings(spark, [(7, "9.0", 2)]), None, F.lit(dt.datetime(2022, 1, 2)), run="2", **args)
    changed = {f.split("bucket=")[1].split("/")[0] for f in before ^ set(catalog.read_table("fct_imdb_nyt").inputFiles())}
    assert len(changed) == 1
    assert FactTable(catalog).read().filter("num_votes = 2").count() == 1


def test_counts_by_deltas_equal_grouping(spark, tmp_root):
    rng = random.Random(5)
    counts = KeyCounts(Catalog(spark, tmp_root), "c", ["a", "b"], buckets=8)
    held = []
    for day in range(5):
        removed = [held.pop(rng.randrange(len(held))) for _ in range(min(len(held), 12))] if day else []
        added = [(rng.choice(["x", "y", None]), rng.randrange(12)) for _ in range(0 if day == 3 else 25)]
        before = {k: held.count(k) + removed.count(k) for k in {*held, *removed}}
        held += added
        frame = [spark.createDataFrame(x, "a string, b int") for x in (added, removed)]
        changed = {(r.a, r.b): (r.n_before, r.n_after) for r in counts.apply(*frame).collect()}
        now = {k: held.count(k) for k in set(held)}
        assert {(r.a, r.b): r.n for r in counts.read().collect()} == now
        assert changed == {k: (before.get(k, 0), now.get(k, 0)) for k in {*before, *now} if before.get(k, 0) != now.get(k, 0)}
    rest = spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(held)], "a string, b int, i int")
    assert rows(counts.unique().filter("a IS NOT NULL")) == rows(unique_rows(rest, ["a", "b"]), "a", "b")
