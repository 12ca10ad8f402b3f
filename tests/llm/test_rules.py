"""Line rules, mixing and URL filters: odd rows, and the paths that whole tables rarely take."""

import pytest
from pyspark.sql import functions as F

from marquee.llm import common, line_rules, mixing, url_filter


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


# -- line rules

def base(spark, text):
    df = spark.createDataFrame([(text, 7)], "text string, n_words int")
    return line_rules.base_counts(df.drop("n_words")).drop("text").first().asDict()


def brute_repeats(words):
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    hit = {i for i, w in enumerate(windows) if windows.count(w) > 1}
    return len({p for i in hit for p in (i, i + 1, i + 2)})


@pytest.mark.parametrize("text", [None, "", "a", "a b", "a b c", "a b c a b c", "x x x x", "\u00a0 é#*",
                                  "l one\n\nl one\n \nl one\nL one", "p q r s p q r t p q r"])
def test_base_counts(spark, text):
    got = base(spark, text)
    t = text or ""
    words = t.replace("\n", " ").split(" ")
    words = [w for w in words if w]
    lines = [x for x in t.split("\n") if x.strip(" ")]
    assert got == {"n_words": len(words), "word_chars": sum(map(len, words)),
                   "n_symbols": sum(c in "#*$%&|<>" for c in t), "n_dup_lines": len(lines) - len(set(lines)),
                   "n_repeat_words": brute_repeats(words), "base_failed": True}


def test_many_repeats_take_the_sorted_path(spark):
    words = [f"w{i}" for i in range(300)]
    text = " ".join(words + ["gap"] + words + ["end"] + [f"u{i}" for i in range(50)])
    assert base(spark, text)["n_repeat_words"] == 600


def corpus(spark):
    body = " ".join(f"word{i}" for i in range(60))
    line = "Subscribe to this page today"
    data = [(i, f"{body} {i}\n{line}  " if i % 2 else f"{line.upper()}\n{body} {i}", "h1", "x") for i in range(30)]
    data += [(100, "\n".join([line] * 2 + [body]), "h2", "x"), (101, None, "h1", "x"), (102, line, None, "x"),
             (3, data[3][1], "h1", "x"), (None, body, "h1", "x"), (200, body + " z\n" + (line + "\n") * 40, "h1", "x")]
    return spark.createDataFrame(data, "doc_id long, text string, source string, kept string")


def test_line_frequency(spark):
    got = line_rules.judge(corpus(spark), min_documents=20).collect()
    assert len(got) == 36
    by = {r.doc_id: r for r in got}
    assert all(by[i].removed_words == 5 and by[i].kept for i in range(30))
    assert by[100].removed_words == 0 and by[100].kept                    # another host
    assert by[200].removed_words == 200 and not by[200].kept              # depleted
    assert not by[101].kept and not by[102].kept and by[None].kept
    assert line_rules.judge(corpus(spark).limit(0)).count() == 0


def test_strip_lines(spark):
    out = {r.doc_id: r.text for r in line_rules.strip_lines(corpus(spark), min_documents=20).collect()}
    assert "ubscribe" not in out[1] and "SUBSCRIBE" not in out[2] and "Subscribe" in out[100]


def test_one_limit_for_hosts_of_every_size(spark):
    """A line in 30 documents goes, one in 20 stays, in a host of 100 texts as in one of 100,000."""
    line, rare = "a line that thirty documents hold", "a line that twenty documents hold"
    body = F.concat_ws(" ", F.lit(" ".join(f"w{i}" for i in range(60))), F.col("id"))
    docs = None
    for host, n in (("small", 100), ("large", 100_000)):
        text = F.when(F.col("id") < 30, F.concat_ws("\n", body, F.lit(line))).when(
            F.col("id") < 50, F.concat_ws("\n", F.lit(rare), body)).otherwise(body)
        rows_ = spark.range(n).select(F.col("id").alias("doc_id"), F.lit(host).alias("source"), text.alias("text"))
        docs = rows_ if docs is None else docs.unionByName(rows_)
    got = line_rules.judge(docs).groupBy("source", "removed_words").count().collect()
    assert sorted(map(tuple, got)) == [("large", 0, 99_970), ("large", 6, 30), ("small", 0, 70), ("small", 6, 30)]


def test_strip_lines_keeps_rows_columns_and_other_lines(spark):
    line = "the same line everywhere"
    data = [(i, f"own {i}\n{line}\n\nmore {i}" if i else None, "h" if i % 2 else None, i, "x") for i in range(60)]
    data += [(7, data[7][1], "h", 7, "x"), (90, f"{line}\n{line.upper()}", "h", 9, "y"), (91, "", "h", 9, "y")]
    df = spark.createDataFrame(data, "doc_id long, text string, source string, _host long, _line string")
    out = line_rules.strip_lines(df)
    assert out.columns == df.columns
    want = [(i, t if t is None else "\n".join(x for x in t.split("\n") if x.strip().lower() != line), *r) for i, t, *r in data]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)
    assert line_rules.strip_lines(df.limit(0)).count() == 0


def test_lookup_join_beyond_its_bound_gives_the_same_rows(spark, monkeypatch):
    want = rows(line_rules.judge(corpus(spark), min_documents=20), "doc_id", "removed_words", "kept")
    salted = common.lookup_join
    monkeypatch.setattr(line_rules, "lookup_join", lambda *a, **k: salted(*a, **k, bound_rows=0, salts=4))
    assert rows(line_rules.judge(corpus(spark), min_documents=20), "doc_id", "removed_words", "kept") == want


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_join_never_broadcasts_a_repeated_table(spark, how):
    left = spark.createDataFrame([(i % 50, i) for i in range(200)] + [(None, 1)], "k long, v long")
    right = common.stored(spark.createDataFrame([(i, -i) for i in range(0, 90, 3)], "k long, w long"), "test-lookup")
    joined = common.lookup_join(left, right, ["k"], how, bound_rows=0)
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
    assert rows(joined, *joined.columns) == rows(left.join(right, "k", how), *joined.columns)


# -- mixing

def test_shortage_goes_to_siblings_before_ancestors(spark):
    leaves = spark.createDataFrame([("a", "x", "s1", 100), ("a", "x", "s2", 1000), ("a", "y", "s3", 1000),
                                    ("b", "x", "s4", 50), ("b", "y", None, 1000)],
                                   "domain string, lang string, source string, tokens long")
    out = mixing.leaf_budgets(leaves, {"domain": {"a": 3, "b": 1}}, F.sum("tokens") * 0 + 1200)
    assert {r.source: round(r.budget, 6) for r in out.collect()} == {
        "s1": 100, "s2": 350, "s3": 450, "s4": 50, None: 250}
    # b as a whole is short: what it lacks goes to a.
    out = mixing.leaf_budgets(leaves, {"domain": {"b": 9}}, F.sum("tokens") * 0 + 2000)
    assert {r.source: round(r.budget, 6) for r in out.collect()} == {
        "s1": 100, "s2": 375, "s3": 475, "s4": 50, None: 1000}
    out = mixing.leaf_budgets(leaves, {"lang": {"x": 0}}, F.sum("tokens") * 0 + 800)
    assert {r.source: round(r.budget, 6) for r in out.collect()} == {"s1": 0, "s2": 0, "s3": 400, "s4": 0, None: 400}


def documents(spark, n=400):
    return spark.createDataFrame([(i, "w " * (1 + i % 7), "en", f"s{i % 3}", "d", 1) for i in range(n)]
                                 + [(None, "a b", None, None, "d", 1), (None, "a b", None, None, "d", 1), (7, None, "en", "s1", "d", 1)],
                                 "doc_id long, text string, lang string, source string, domain string, epoch int")


def test_prefixes_do_not_depend_on_buckets(spark):
    runs = [rows(mixing.mix(documents(spark), {"source": {"s0": 5}}, 0.6, 2.0, bucket_rows=b), "doc_id", "epoch")
            for b in (1, 7, 10_000)]
    assert runs[0] == runs[1] == runs[2]
    picked = [r for r in runs[0] if r[0] is not None]
    assert len(picked) == len(set(picked)) and any(e == 1 for _, e in picked)
    first = {d for d, e in picked if e == 0}
    assert {d for d, e in picked if e == 1} <= first


def test_mix_of_odd_tables(spark):
    docs = documents(spark)
    assert mixing.mix(docs.limit(0), {}).count() == 0
    assert mixing.mix(docs, {}, 0.0).count() == 0
    every = mixing.mix(docs, {}, 1.0)
    assert every.count() == 402 and every.columns == docs.columns[:-1] + ["n_tokens", "epoch"]
    assert mixing.mix(docs, {}, 0.5, seed=1).exceptAll(mixing.mix(docs, {}, 0.5, seed=2)).count() > 0


# -- URL filters

URLS = ["http://a.NET", "http://a.net/", "https://example.net/en/x", "http://sub.example.net/de/", "http://x.example.com/de/y?q#f",
        "http://notexample.com/de/", "http://m.org/fr/1", "ftp://h.org:21/en", "no scheme", None, "", "http://Spam.io/a/?utm_x=1",
        "https://spam.io:443/a#z", "http://spam.io/a?b=1", "://", "http://?q://b.net/"]


def test_url_filter(spark):
    pages = spark.createDataFrame([(i, u, "old") for i, u in enumerate(URLS)] + [(0, URLS[0], "old")],
                                  "page_id long, url string, verdict string")
    listed = spark.createDataFrame([("http://spam.io/a",), ("http://spam.io/a/",), (None,), ("x",)], "url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.listed, r.verdict) for r in url_filter.filter_urls(pages, listed).collect()}
    assert got == {
        0: ("a.net", "", None, False, "allow"), 1: ("a.net", "/", "net/", False, "block"),
        2: ("example.net", "/en/x", "example.net/en/", False, "allow"), 3: ("sub.example.net", "/de/", "net/", False, "block"),
        4: ("x.example.com", "/de/y", "example.com/de/", False, "block"), 5: ("notexample.com", "/de/", None, False, "allow"),
        6: ("m.org", "/fr/1", "org/fr/", False, "allow"), 7: ("h.org:21", "/en", None, False, "allow"),
        8: ("", "", None, False, "allow"), 9: ("", "", None, False, "allow"), 10: ("", "", None, False, "allow"),
        11: ("spam.io", "/a/", None, True, "block"), 12: ("spam.io:443", "/a", None, True, "block"),
        13: ("spam.io", "/a", None, False, "allow"), 14: ("", "", None, False, "allow"), 15: ("", "", None, False, "allow")}
    assert url_filter.filter_urls(pages, listed.limit(0)).filter("listed").count() == 0
    assert url_filter.filter_urls(pages.limit(0), listed).count() == 0


def test_bloom_filter_has_no_false_negatives_and_few_false_positives(spark):
    listed = spark.range(4200).select(F.concat(F.lit("h/"), "id").alias("u"))
    bloom = url_filter.bloom_filter(listed, "u", 100)
    assert bloom.count() <= 100
    assert url_filter.possible_hits(listed, "u", bloom, 100).count() == 4200
    others = spark.range(4200, 24_200).select(F.concat(F.lit("h/"), "id").alias("u"))
    assert url_filter.possible_hits(others, "u", bloom, 100).count() < 0.03 * 20_000
