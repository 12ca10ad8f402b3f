import datetime as dt
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions import variant_field
from marquee.sources import (
    Catalog,
    CsvFormat,
    IdRegistry,
    SnapshotTable,
    JsonFormat,
    Stage,
    copy_into,
    extract_links,
    land,
    list_assets,
    match_tables,
    read_csv_format,
    read_json_array,
    read_tsv,
    read_variant,
    sample_batch,
    union_pages,
    write_csv_gz,
    write_json,
)
from marquee.sources.readers import LoadAborted
from tests.conftest import rows, srt

TSV = ("tconst\ttitleType\tprimaryTitle\toriginalTitle\tisAdult\tstartYear\tendYear\truntimeMinutes\tgenres\n"
       "tt1\tmovie\tHeat\tHeat\t0\t1995\t\\N\t170\tAction,Crime,Drama\n"
       "tt2\tshort\tShorty\tShorty\t0\t\\N\t\\N\t\\N\t\\N\n")


def test_read_tsv_gz_sentinel_is_null(spark, local_dir):
    p = os.path.join(local_dir, "title.basics.tsv.gz")
    with gzip.open(p, "wt") as f:
        f.write(TSV)
    schema = "tconst string, titleType string, primaryTitle string, originalTitle string, isAdult int, " \
             "startYear int, endYear int, runtimeMinutes int, genres string"
    df = read_tsv(spark, p, schema, repartition=4)
    assert df.rdd.getNumPartitions() == 4
    got = rows(df, "tconst", "startYear", "genres")
    assert got == srt([("tt1", 1995, "Action,Crime,Drama"), ("tt2", None, None)])


REVIEWS = [
    {"display_title": "Heat", "mpaa_rating": "R", "critics_pick": 1, "byline": "A", "headline": "h1",
     "summary_short": "s", "publication_date": "2022-09-13", "opening_date": "2022-09-13",
     "date_updated": "2022-09-13 10:00:00", "link": {"url": "u1"}, "multimedia": {"src": "m1"}},
    {"display_title": "Up", "mpaa_rating": "", "critics_pick": 0, "byline": None, "headline": "h2",
     "summary_short": "s2", "publication_date": "2022-09-13", "opening_date": "2022-09-13",
     "date_updated": "2022-09-14 10:00:00", "link": {"url": "u2"}, "multimedia": None},
]


def test_json_array_and_variant_readers(spark, local_dir):
    p = os.path.join(local_dir, "nyt-review-2022-09-13.json")
    with open(p, "w") as f:
        json.dump(REVIEWS, f, indent=4)
    flat = read_json_array(spark, p)
    assert flat.count() == 2 and "display_title" in flat.columns
    v = read_variant(spark, p)
    assert v.columns == ["content"] and v.count() == 2
    got = rows(v.select(variant_field("content", "display_title", "string").alias("t"),
                        variant_field("content", "multimedia.src", "string").alias("img")))
    assert got == srt([("Heat", "m1"), ("Up", None)])


def _csv_file(path, n_rows, n_bad):
    lines = ["id,average_rating,num_votes"]
    for i in range(n_rows):
        votes = "many" if i < n_bad else str(i)
        lines.append(f"tt{i},7.{i % 10},{votes}")
    with gzip.open(path, "wt") as f:
        f.write("\n".join(lines) + "\n")


RATINGS = T.StructType([T.StructField("id", T.StringType()), T.StructField("average_rating", T.DecimalType(3, 1)),
                        T.StructField("num_votes", T.IntegerType())])


def test_copy_into_skip_file_half_percent(spark, local_dir):
    d = os.path.join(local_dir, "stage")
    os.makedirs(d)
    _csv_file(os.path.join(d, "a.csv.gz"), 1000, 4)    # 0.4 % bad -> loaded without the bad rows
    _csv_file(os.path.join(d, "b.csv.gz"), 1000, 6)    # 0.6 % bad -> skipped whole
    stage = Stage(d, CsvFormat(), skip_file_pct=0.5)
    loaded, report = copy_into(spark, stage.path(), RATINGS, stage.fmt, skip_file_pct=stage.skip_file_pct)
    rep = {os.path.basename(r.file): r for r in report.collect()}
    assert rep["a.csv.gz"].status == "PARTIALLY_LOADED" and rep["a.csv.gz"].rows_loaded == 996
    assert rep["b.csv.gz"].status == "SKIPPED" and rep["b.csv.gz"].rows_loaded == 0
    assert loaded.count() == 996
    assert loaded.schema == RATINGS


def test_copy_into_without_tolerance_aborts(spark, local_dir):
    d = os.path.join(local_dir, "stage2")
    os.makedirs(d)
    _csv_file(os.path.join(d, "a.csv.gz"), 10, 0)
    _csv_file(os.path.join(d, "b.csv.gz"), 10, 1)
    with pytest.raises(LoadAborted, match="1 error"):
        copy_into(spark, d, RATINGS)


def test_bad_json_aborts(spark, local_dir):
    p = os.path.join(local_dir, "cut.json")
    with open(p, "w") as f:
        f.write('[{"a": 1}, {"a": 2}, {"a"')
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    with pytest.raises(LoadAborted):
        copy_into(spark, p, schema, JsonFormat())
    with pytest.raises(Exception, match="(?i)malformed"):
        read_json_array(spark, p, schema).collect()


def test_variant_lines(spark, tmp_root):
    spark.createDataFrame([('{"a": 1}',), ('{"a": null, "b": [1]}',)], "value string").write.text(f"{tmp_root}/lines")
    v = read_variant(spark, f"{tmp_root}/lines", lines=True)
    assert rows(v.select(F.to_json("content").alias("j"))) == srt([('{"a":1}',), ('{"a":null,"b":[1]}',)])


def test_csv_with_several_null_tokens(spark, local_dir):
    p = os.path.join(local_dir, "n.csv")
    with open(p, "w") as f:
        f.write("a,b\n1,x\n\\N,\n,NA\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    fmt = CsvFormat(compression="none", null_if=("", "\\N", "NA"))
    assert rows(read_csv_format(spark, p, schema, fmt)) == srt([(1, "x"), (None, None), (None, None)])
    loaded, report = copy_into(spark, p, schema, fmt)
    assert rows(loaded) == srt([(1, "x"), (None, None), (None, None)]) and report.first().errors_seen == 0
    with pytest.raises(ValueError):
        CsvFormat(skip_header=2)


def test_copy_into_json(spark, local_dir):
    p = os.path.join(local_dir, "r.json")
    with open(p, "w") as f:
        json.dump(REVIEWS, f)
    schema = T.StructType([T.StructField("display_title", T.StringType())])
    loaded, report = copy_into(spark, p, schema, JsonFormat())
    assert loaded.count() == 2 and report.first().rows_loaded == 2


def test_csv_gz_roundtrip_and_null_as_empty(spark, tmp_root):
    df = spark.createDataFrame([("tt1", 7.4, None), ("tt2", None, 10)], "id string, r double, v int")
    write_csv_gz(df, f"{tmp_root}/csv")
    assert any(n.endswith(".csv.gz") for n in os.listdir(f"{tmp_root}/csv"))
    back = read_csv_format(spark, f"{tmp_root}/csv", df.schema)
    assert rows(back) == rows(df)


def test_json_sink(spark, tmp_root):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    write_json(df, f"{tmp_root}/json")
    assert rows(spark.read.schema(df.schema).json(f"{tmp_root}/json")) == srt([("a", 1)])


def test_land_replaces_only_that_day(spark, tmp_root):
    root = f"{tmp_root}/landing"
    land(spark.createDataFrame([("a",)], "id string"), root, "2024-01-01")
    land(spark.createDataFrame([("b",)], "id string"), root, "2024-01-02")
    land(spark.createDataFrame([("c",)], "id string"), root, "2024-01-01")   # rerun of day 1
    got = rows(spark.read.parquet(root).withColumn("ds", F.col("ds").cast("string")), "id", "ds")
    assert got == srt([("b", "2024-01-02"), ("c", "2024-01-01")])


def test_id_registry(spark, tmp_root):
    reg = IdRegistry(spark, f"{tmp_root}/ids")
    df = spark.createDataFrame([("tt1",), ("tt2",)], "tconst string")
    assert reg.read().count() == 0
    assert reg.new_rows(df, "tconst").count() == 2
    reg.append(df.limit(1).filter("tconst = 'tt1'"), "tconst")
    assert rows(reg.new_rows(df, "tconst")) == srt([("tt2",)])


def test_catalog_tables_and_incremental(spark, tmp_root):
    cat = Catalog(spark, tmp_root, sources={"nyt": spark.createDataFrame([("x",)], "id string")})
    assert cat.source("nyt").count() == 1
    assert not cat.exists("dim")
    cat.materialize("dim", spark.createDataFrame([("a",), ("b",)], "id string"), "incremental", key="id")
    # rebuilding from its own stored rows is allowed (built beside the old table)
    cat.write_table("dim", cat.read_table("dim").union(spark.createDataFrame([("z",)], "id string")))
    cat.materialize("dim", spark.createDataFrame([("b",), ("c",)], "id string"), "incremental", key="id")
    assert rows(cat.read_table("dim")) == srt([("a",), ("b",), ("c",), ("z",)])
    cat.register("v", lambda c: c.read_table("dim").filter("id > 'b'"))
    assert rows(cat.ref("v")) == srt([("c",), ("z",)])
    cat.write_table("t", spark.range(3), meta={"batch_id": 7})
    assert cat.table_meta("t", "batch_id") == 7 and cat.table_meta("none", "batch_id") is None
    view = cat.materialize("vv", spark.range(2), "view")
    assert spark.table("vv").count() == view.count() == 2
    # appends go by name, another catalog on the same root sees the same tables, truncate keeps the columns
    cat.write_table("pair", spark.createDataFrame([(1, "a")], "n int, k string"))
    cat.append_table("pair", spark.createDataFrame([("b", 2)], "k string, n int"))
    again = Catalog(spark, tmp_root)
    assert rows(again.read_table("pair")) == srt([(1, "a"), (2, "b")])
    assert again.truncate("pair").columns == ["n", "k"] and again.read_table("pair").isEmpty()


def test_failed_build_keeps_the_table(spark, tmp_root):
    cat = Catalog(spark, tmp_root)
    cat.write_table("t", spark.createDataFrame([("old",)], "v string"))
    broken = spark.range(4).select(F.raise_error(F.lit("lost")).cast("string").alias("v"))
    with pytest.raises(Exception, match="lost"):
        cat.write_table("t", broken)
    assert rows(cat.read_table("t")) == [("old",)]
    cat.write_table("t", spark.createDataFrame([("newer",)], "v string"))
    assert rows(cat.read_table("t")) == [("newer",)]


def test_first_run_of_a_snapshot_reads_its_batch_once(spark, tmp_root):
    from marquee.operators.scd2 import snapshot_check
    from marquee.sources.snapshots import SnapshotTable

    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    batch = spark.createDataFrame([(f"k{i}", i) for i in range(100)], "k string, v int").mapInArrow(counted, "k string, v int")
    table = SnapshotTable(Catalog(spark, tmp_root), "s", "k", buckets=8)
    buckets = table.merge(batch, "1", lambda p, b: snapshot_check(p, b, "k", ["v"], "2024-01-01 00:00:00"))
    assert read.value == 100 and table.read().count() == 100
    assert buckets == table.touched(table.read())


def test_partition_mode_is_restored_by_the_last_thread(spark):
    import threading

    from marquee.session import together
    from marquee.sources.catalog import overwriting_partitions

    name, entered = "spark.sql.sources.partitionOverwriteMode", threading.Barrier(2)
    left = threading.Event()

    def first():
        with overwriting_partitions(spark):
            entered.wait(30)
        left.set()

    def second():
        with overwriting_partitions(spark):
            entered.wait(30)
            assert left.wait(30)
            return spark.conf.get(name).lower()

    before = spark.conf.get(name, "static").lower()
    assert together(first, second) == [None, "dynamic"] and spark.conf.get(name).lower() == before


def test_compacted_table_keeps_rows_and_meta(spark, tmp_root):
    cat = Catalog(spark, tmp_root)
    cat.write_table("d", spark.createDataFrame([("x",)], "id string"), meta={"a": 1})
    for day in range(12):
        cat.append_table("d", spark.createDataFrame([(f"k{day}",)] if day % 2 else [], "id string"))
    before = rows(cat.read_table("d"))
    cat.compact("d")
    assert rows(cat.read_table("d")) == before and len(before) == 7 and cat.table_meta("d", "a") == 1
    assert len(cat.read_table("d").inputFiles()) <= 2


HTML = ('<html><body><a href="https://x/title.basics.tsv.gz">b</a> <A HREF=\'https://x/name.basics.tsv.gz\'>n</A>'
        '<a class="k" href="https://x/title.ratings.tsv.gz">r</a><a href="/readme.txt">t</a></body></html>')


def test_extract_and_match_links(spark):
    pages = spark.createDataFrame([(1, HTML)], "page_id int, html string")
    links = extract_links(pages, "html", suffix="gz", keep=["page_id"])
    assert [r.href for r in links.orderBy("link_pos").collect()] == [
        "https://x/title.basics.tsv.gz", "https://x/name.basics.tsv.gz", "https://x/title.ratings.tsv.gz"]
    matched = match_tables(links, ["title.basics", "title.ratings"])
    assert rows(matched, "table_name", "href") == srt([("title.basics", "https://x/title.basics.tsv.gz"),
                                                       ("title.ratings", "https://x/title.ratings.tsv.gz")])


def test_union_pages_skips_null_pages(spark):
    pages = spark.createDataFrame([(0, True, [("Heat", 1)]), (20, True, None), (40, False, [("Up", 0), ("Jaws", 1)])],
                                  "offset int, has_more boolean, results array<struct<t:string,p:int>>")
    assert rows(union_pages(pages)) == srt([("Heat", 1), ("Jaws", 1), ("Up", 0)])


def test_list_assets_and_sample(spark, local_dir):
    for n in ("title.basics-2022-09-12.csv.gz", "title.ratings-2022-09-12.csv.gz"):
        with open(os.path.join(local_dir, n), "wb") as f:
            f.write(b"x")
    assets = list_assets(spark, local_dir, r"(.*)-\d{4}-\d{2}-\d{2}\.csv\.gz")
    assert rows(assets, "asset") == srt([("title.basics",), ("title.ratings",)])
    assert sample_batch(spark.range(5000), 1000).count() == 1000
    from marquee.sources import batch
    assert batch(spark, lambda sp, p: list_assets(sp, p), local_dir).count() == 2


@pytest.mark.parametrize("token", ["\\N", "NA"])
def test_sentinel_token_parameter(spark, local_dir, token):
    p = os.path.join(local_dir, f"t{len(token)}.tsv")
    with open(p, "w") as f:
        f.write(f"a\tb\nx\t{token}\n")
    df = read_tsv(spark, p, "a string, b string", null_token=token)
    assert df.first().b is None


def test_parity_rounding_and_positional_csv_mapping(spark, local_dir):
    from marquee.plans.models import ratings_raw_schema
    from marquee.sources import truncate

    p = os.path.join(local_dir, "ratings.csv")
    with open(p, "w") as f:
        f.write('tconst,averageRating,numVotes\ntt1,7.4,"10"\ntt2,7.5,\n')
    # header names differ from the table's: columns map by position; '' and an empty quoted value read as NULL
    exact = read_csv_format(spark, p, ratings_raw_schema(), CsvFormat(compression="none"))
    assert rows(exact, "id", "num_votes") == srt([("tt1", 10), ("tt2", None)])
    assert {str(r.average_rating) for r in exact.collect()} == {"7.4", "7.5"}
    rounded = read_csv_format(spark, p, ratings_raw_schema(parity_rounding=True), CsvFormat(compression="none"))
    assert {str(r.average_rating) for r in rounded.collect()} == {"7", "8"}
    out = os.path.join(local_dir, "raw_table")
    truncate(spark, out, ratings_raw_schema())
    assert spark.read.parquet(out).count() == 0


def test_id_registry_appends_and_compacts(spark, tmp_root):
    reg = IdRegistry(spark, f"{tmp_root}/ids2", buckets=4)
    reg.append(spark.createDataFrame([("tt1",), ("tt1",), ("tt2",)], "tconst string"), "tconst")
    reg.append(spark.createDataFrame([("tt2",), ("tt3",)], "tconst string"), "tconst")
    batch = spark.createDataFrame([("tt1",), ("tt4",), (None,)], "tconst string")
    assert rows(reg.new_rows(batch, "tconst")) == srt([("tt4",), (None,)])
    reg.compact()
    assert rows(reg.read()) == [("tt1",), ("tt2",), ("tt3",)]
    assert rows(reg.new_rows(batch, "tconst", null_safe=True)) == srt([("tt4",), (None,)])
    reg.append(spark.createDataFrame([(None,)], "tconst string"), "tconst")
    assert rows(reg.new_rows(batch, "tconst", null_safe=True)) == [("tt4",)]


@pytest.mark.parametrize("null_safe", [False, True])
def test_registry_lookup_exchanges_the_days_rows_only(spark, tmp_root, null_safe):
    import random

    from marquee.operators.joins import anti_by_registry

    reg = IdRegistry(spark, f"{tmp_root}/ids3", "tconst", buckets=4)
    rng = random.Random(3)
    ids = [(f"tt{rng.randrange(600)}",) for _ in range(500)] + ([(None,)] if null_safe else [])
    reg.append(spark.createDataFrame(ids, "tconst string"), "tconst")
    day = spark.createDataFrame([(f"tt{i}", i) for i in range(700)] + [(None, -1)], "tconst string, n int")
    new = reg.new_rows(day, "tconst", null_safe=null_safe)
    assert rows(new) == rows(anti_by_registry(day, reg.read(), "tconst", null_safe=null_safe))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)       # a registry is not small
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        plan = reg.new_rows(day, "tconst", null_safe=null_safe)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", True)
    join = plan.split("===== Subqueries")[0]
    assert "Bucketed: true" in join and join.count("Exchange hashpartitioning") == 1
    left, right = join[join.index("SortMergeJoin"):].split("FileScan")[:2]
    assert "Exchange" not in left.rsplit("+- ", 2)[-1] and "Exchange" not in right


def snapshot_files(spark, table):
    """Data files by (bucket, part)."""
    cat = table.catalog
    found = {}
    for f in cat.read_table(table.name).inputFiles():
        bucket, part = f.split("bucket=")[1].split("/part=")
        found.setdefault((int(bucket), part.split("/")[0]), set()).add(f)
    return found


def buckets_of(versions, table):
    return table.touched(table.catalog.spark.createDataFrame([(r[0],) for r in versions], "k string"))


@pytest.mark.parametrize("strategy", ["check", "timestamp"])
def test_snapshot_run_touches_the_buckets_of_its_keys(spark, tmp_root, strategy, monkeypatch):
    from marquee.operators.scd2 import snapshot_check, snapshot_timestamp

    def merge(prev, batch, day):
        if strategy == "check":
            return snapshot_check(prev, batch, "k", ["v"], f"2024-01-0{day} 00:00:00")
        return snapshot_timestamp(prev, batch, "k", "upd")

    schema = "k string, v int, upd timestamp"
    days = [[(f"k{i}", i, dt.datetime(2024, 1, 1)) for i in range(300)],
            [("k1", -1, dt.datetime(2024, 1, 2)), ("k2", 2, dt.datetime(2024, 1, 2)), ("new", 0, dt.datetime(2024, 1, 2))],
            [], [("k1", -2, dt.datetime(2024, 1, 4)), ("other", 5, dt.datetime(2024, 1, 4))]]
    table = SnapshotTable(Catalog(spark, tmp_root), "s", "k", buckets=1024)
    whole = None
    for day, data in enumerate(days, 1):
        batch = spark.createDataFrame(data, schema)
        before = snapshot_files(spark, table) if whole is not None else {}
        touched = table.merge(batch, f"day{day}", lambda p, b, day=day: merge(p, b, day))
        after = snapshot_files(spark, table)
        whole = rows(merge(None if whole is None else spark.createDataFrame(whole, like), batch, day))
        like = table.read().schema
        assert rows(table.read()) == whole
        if day > 1:
            assert len(touched) == len({k for k, _, _ in data})
            assert {b for (b, _), files in after.items() if files != before.get((b, _))} == set(touched)
            plan = table.of_buckets(touched)._jdf.queryExecution().executedPlan().toString() if touched else ""
            assert not touched or "PartitionFilters: [" in plan
            assert {int(f.split("bucket=")[1].split("/")[0]) for f in (table.of_buckets(touched).inputFiles() if touched else [])
                    } <= set(touched)
    # the same run again, as after a crash that lost its commit: nothing changes
    table.merge(spark.createDataFrame(days[3], schema), "day4", lambda p, b: merge(p, b, 4))
    assert rows(table.read()) == whole
    assert rows(table.current()) == srt([r for r in whole if r[-1] is None])
    with monkeypatch.context() as m:                 # a compaction that breaks off is ended by the next run
        m.setattr(SnapshotTable, "_end_compaction", lambda self: None)
        table.compact()
    b, = buckets_of([("k1",)], table)
    spark.sql(f"ALTER TABLE {table.catalog.table('s')} DROP PARTITION (bucket = {b}, part = 'closed-day2')")
    assert rows(table.read()) == whole
    table.merge(spark.createDataFrame(days[3], schema), "day5", lambda p, b: merge(p, b, 4))
    assert rows(table.read()) == whole and {p for _, p in snapshot_files(spark, table)} == {"current", "closed"}
    table.compact()
    assert rows(table.read()) == whole and len(snapshot_files(spark, table)) >= len(buckets_of(whole, table))


def test_crash_between_the_two_writes_of_a_run(spark, tmp_root, monkeypatch):
    """Closed versions are written, current ones are not: the repeated run gives the whole result."""
    from marquee.operators.scd2 import snapshot_check

    def merge(p, b, day):
        return snapshot_check(p, b, "k", ["v"], f"2024-01-0{day} 00:00:00")

    table = SnapshotTable(Catalog(spark, tmp_root), "s", "k", buckets=8)
    table.merge(spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"), "1", lambda p, b: merge(p, b, 1))
    day2 = spark.createDataFrame([("a", 2), ("b", 1), ("c", 1)], "k string, v int")
    with monkeypatch.context() as m:
        m.setattr(SnapshotTable, "_insert", lambda self, staged, current, full=SnapshotTable._insert:
                  full(self, staged, current) if not current else (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.merge(day2, "2", lambda p, b: merge(p, b, 2))
    for _ in range(2):
        table.merge(day2, "2", lambda p, b: merge(p, b, 2))
    assert sorted((r.k, r.v, r.dbt_valid_to is None) for r in table.read().collect()) == [
        ("a", 1, False), ("a", 2, True), ("b", 1, True), ("c", 1, True)]


@pytest.mark.parametrize("title", ['say "hi"', 'The "Big", One', "back\\slash\\", "two\nlines", "cr\r\nlf", " blanks ", '"quoted"', "a,b", "'", '"'])
def test_landed_text_is_loaded_unharmed(spark, tmp_root, title):
    from marquee.plans.daily import LANDING, land_day

    df = spark.createDataFrame([("tt1", title, None, ""), ("tt2", "plain", "x", title)], "id string, a string, b string, c string")
    back = land_day(df, f"{tmp_root}/landing", "2024-01-01")
    want = srt([("tt1", title, None, None), ("tt2", "plain", "x", title)])         # '' loads as NULL
    loaded, report = copy_into(spark, f"{tmp_root}/landing/ds=2024-01-01", df.schema, LANDING, skip_file_pct=0.5)
    assert rows(loaded) == want and {r.status for r in report.collect()} == {"LOADED"}
    assert [r.a for r in back.orderBy("id").collect()] == [title, "plain"]
    write_csv_gz(df, f"{tmp_root}/csv")
    assert rows(read_csv_format(spark, f"{tmp_root}/csv", df.schema, CsvFormat(multi_line=True)), "a", "c") == srt(
        [(title, None), ("plain", title)])


def test_tsv_with_quoted_fields(spark, local_dir):
    p = os.path.join(local_dir, "quoted.tsv")
    with open(p, "w") as f:
        f.write('tconst\ttitle\ntt1\t"a ""b"" c"\ntt2\tsay "hi"\ntt3\t"two\nlines"\ntt4\tback\\\ntt5\t\\N\n')
    assert rows(read_tsv(spark, p, "tconst string, title string", multi_line=True)) == srt(
        [("tt1", 'a "b" c'), ("tt2", 'say "hi"'), ("tt3", "two\nlines"), ("tt4", "back\\"), ("tt5", None)])


LINK_CASES = [
    ("<a href='x'>", ["x"]), ('<A  HREF = "x y">', ["x y"]), ("<a href=x/y.gz>t</a>", ["x/y.gz"]), ("<a\nid=k\nhref=x>", ["x"]),
    ('<!-- <a href="c"> --><a href="d">', ["d"]), ('<!-- <a href="c">', []), ('<script>"<a href=s>"</script><a href=t>', ["t"]),
    ("<style>a{}<a href=s></style>", []), ('<title><a href="no"></title>', []), ('<a title=">" href="q">', ["q"]),
    ('<a data-href="n">', []), ("<a title=' href=n ' href=y>", ["y"]), ('<a href="1" href="2">', ["1"]), ("<a href>", [""]),
    ("<a name=n>", []), ("<abbr href=n>", []), ('<a href="?a=1&amp;b=2&#38;c=&#x41;&#128512;&lt;&unknown;&">', ["?a=1&b=2&c=A😀<&unknown;&"]),
    ('<a href="&amp;amp;">', ["&amp;"]), ('<a href="open>', []), ("<a/href=s>", ["s"]), ('<img alt="<a href=i>"><a href=j>', ["j"]),
    ("<p>1 < 2 <a href=k>", ["k"]), ("", []), (None, []), ("<a href='" + "y" * 100_000 + "'>", ["y" * 100_000]),
    ("<textarea><a href=n></textarea ><a href=m>", ["m"]), ("<scripted><a href=w></scripted>", ["w"]),
]


def test_links_of_all_kinds_of_markup(spark):
    df = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(LINK_CASES)], "n int, html string")
    got = {}
    for r in extract_links(df, "html", keep=["n"]).orderBy("n", "link_pos").collect():
        got.setdefault(r.n, []).append(r.href)
    for i, (html, want) in enumerate(LINK_CASES):
        assert got.get(i, []) == want, html and html[:60]
