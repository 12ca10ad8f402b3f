"""WARC archives and HTML extraction: odd rows, brute force on whole tables."""

import hashlib
import re
from html import unescape

from pyspark.sql import functions as F

from marquee.llm import html_template as H
from marquee.llm import warc

SF = "/root/testdata/sf0.01"


# -- WARC

def pages(spark, data):
    return spark.createDataFrame(data, "page_id long, url string, html string")


def test_archives_round_trip(spark):
    data = [(1, "http://a/é", "<p>x</p>"), (2, None, None), (3, "http://b/%20 \r\nX: y", ""), (4, "http://c/", "y\r\n\r\nz"),
            (5, "http://a/", "<p>x</p>"), (None, "http://n/", "<p>x</p>"), (6, "u", "é" * 300_000), (7, "same", "dup"), (7, "same", "dup")]
    folder, index = warc.write_archives(pages(spark, data))
    got = warc.read_records(spark, folder, index).collect()
    assert len(got) == len(data)
    assert sorted((r.page_id or 0, r.url or "") for r in got) == sorted((i or 0, u or "") for i, u, _ in data)
    by = {(r.page_id, r.url): r for r in got}
    assert by[1, "http://a/é"].record_type == "revisit" and by[1, "http://a/é"].refers_to == 5
    assert by[2, None].refers_to == 3 and by[None, "http://n/"].record_type == "response"
    assert bytes(by[4, "http://c/"].payload) == b"y\r\n\r\nz" and by[4, "http://c/"].payload_bytes == 6
    assert bytes(by[6, "u"].payload).decode() == "é" * 300_000
    assert [r.record_type for r in got if r.page_id == 7] == ["response"] * 2
    for r in got:
        if r.payload is not None:
            assert r.payload_digest == warc.payload_digest(bytes(r.payload))


def test_only_selected_records_are_read(spark):
    folder, index = warc.write_archives(spark.read.parquet(f"{SF}/pages.parquet"))
    some = index.filter("page_id % 50 = 3")
    got = warc.read_records(spark, folder, some)
    assert got.count() == some.count() and got.filter("page_id % 50 <> 3").count() == 0


def test_min_bytes_and_empty_table(spark):
    folder, index = warc.write_archives(pages(spark, [(1, "u", "abc"), (2, "u", "abc")]), min_bytes=4)
    assert {r.record_type for r in index.collect()} == {"response"}
    folder, index = warc.write_archives(pages(spark, []))
    assert warc.read_records(spark, folder, index).count() == 0


def test_ranges_are_merged_and_bounded(monkeypatch):
    rows = [{"offset": o, "length": n} for o, n in ((0, 10), (10, 10), (40, 10), (10_000_000, 5), (10_000_005, 20))]
    monkeypatch.setattr(warc, "RANGE_BYTES", 45)
    monkeypatch.setattr(warc, "RANGE_GAP", 30)
    got = [(a, b, len(r)) for a, b, r in warc._ranges(iter(rows))]
    assert got == [(0, 20, 2), (40, 50, 1), (10_000_000, 10_000_025, 2)]


def test_archives_are_closed_at_their_size(spark, monkeypatch):
    import pyarrow as pa

    folder = warc.scratch_path(spark, "warc-size")
    uri = folder if ":" in folder.split("/")[0] else f"file://{folder}"
    fs, root = warc.pafs.FileSystem.from_uri(uri)
    fs.create_dir(root, recursive=True)
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 500)
    batch = pa.RecordBatch.from_pylist([{"page_id": i, "url": "u", "html": str(i), "refers_to": None} for i in range(9)])
    rows = [r for b in warc._write(iter([batch]), uri, "2024-01-01T00:00:00Z", 6) for r in b.to_pylist()]
    assert len({r["archive"] for r in rows}) > 2
    assert warc.read_records(spark, uri, spark.createDataFrame(rows, warc.INDEX)).count() == 9


# -- HTML

def test_whole_table_equals_brute_force(spark):
    source = spark.read.parquet(f"{SF}/pages.parquet")
    html = {r.page_id: r.html for r in source.collect()}
    got = H.main_text(source, keep=["page_id"]).collect()
    assert len(got) == len(html)
    for r in got:
        article = re.search(r"<article>(.*?)</article>", html[r.page_id], re.S)[1]
        parts = re.sub(r"<[^>]+>", "", re.sub(r"</?(p|h1)>", "\0", article).replace("<br>", " ")).split("\0")
        want = "\n\n".join(x for x in (" ".join(unescape(p).split()) for p in parts) if x)
        assert r.text == want and r.n_chars == len(want)


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="<p>no</p>";</script></head>
<body class="page"><header>Site</header><nav><ul><li><a href=/a>One</a><li>Two</ul></nav><!-- <p>gone</p> -->
<div class="ad banner">Buy</div><div id='cookie-notice'>We use cookies</div>
<main><h1>Head &mdash; line</h1><p>First  para<b>graph</b>&#33;<br>next
line<p>Second &lt;b&gt;<form><input name="q"><button>Go</button></form><aside>Side</aside><ul><li>x<li>y</ul>
<table><tr><td>c1<td>c2</table><div class="comments"><p>Reader says</p></div></main>
<div class="sidebar"><p>More</p></div><footer>&copy; 2024</footer></body></html>"""
MAIN = "Head — line\n\nFirst paragraph! next line\n\nSecond <b>\n\nx\n\ny\n\nc1\n\nc2"


def test_element_rules():
    assert H.extract(PAGE) == MAIN
    assert H.extract("<p>a &amp; b<p>c <div class=menu>m</div> d") == "a & b\n\nc\n\nd"
    assert H.extract("<div class='adventure headers'>kept</div><div class='ad-slot'>not</div>") == "kept"
    assert H.extract("plain < text > here") == "plain < text > here"
    for odd in (None, "", "<", "<p", "<!-- open", "<script>never closed", "</p></div>", "<p></p>"):
        assert H.extract(odd) == ("<" if odd == "<" else ""), odd


def test_templates_find_slots_and_fixed_text(spark):
    page = "<html><body><div>Our site rules apply</div><h2>{t}</h2><section><p>{a}</p>{more}</section><div>All rights</div></body></html>"
    data = [(i, f"http://h.x/{i}", page.format(t=f"Title {i}", a=f"Text {i}", more=f"<p>extra {i}</p>" * (i % 3))) for i in range(12)]
    data += [(50, "http://h.x/odd", "<body><p>Alone</p></body>"), (51, None, "<p>No host</p>"), (52, "http://h.x/none", None),
             (0, "http://h.x/0", data[0][2])]
    got = {r.page_id: r.text for r in H.main_text(pages(spark, data).withColumn("text", F.lit("old")), keep=["page_id"]).collect()}
    assert got[4] == "Title 4\n\nText 4\n\nextra 4" and got[0] == "Title 0\n\nText 0"
    assert got[50] == "Alone" and got[51] == "No host" and got[52] == ""
    assert H.main_text(pages(spark, [])).count() == 0


def test_vector_sums_tell_classes_apart(spark):
    page = "<body><nav><a>x</a></nav><article>{items}</article></body>"
    data = [(i, "http://h/", page.format(items="<p><i>t</i></p>" * (1 + i % 4))) for i in range(40)]
    source = pages(spark, data).select(F.lit("h").alias("host"), "url", "html").repartition(5)
    row = H.templates(source).first()
    assert len(row.root) == 8 and [len(c) for c in row.nested] == [4]
    assert H.main_slots([(r.token, r.main) for r in row.root]) == {5}


def test_very_long_page_and_digest():
    body = "".join(f"<p>para {i}</p>" for i in range(60_000))
    text = H.extract(f"<article>{body}</article>")
    assert text.count("\n\n") == 59_999 and hashlib.md5(text[-10:].encode())
