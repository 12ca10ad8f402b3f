"""The join against brute force: all pairs of a small fixture."""

import random
import re
from functools import partial

import numpy as np
import pytest

from marquee.llm import common, components
from marquee.llm import ngram_join as N
from marquee.llm.components import connected_components
from marquee.llm.shingles import Shingler

SF = "/root/testdata/sf0.001"


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    """(doc_id, n_shingles, component_id) of every row by comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            same = len(sets[i] & sets[j])
            if sets[i] and 100 * same >= 75 * (len(sets[i]) + len(sets[j]) - same):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def check(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in N.link_groups(df, **kw).collect()]
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)


def near_copies(rng, n, words=60, edits=3):
    base = [f"w{rng.randrange(500)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randrange(edits + 1)):
            own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(own))
    return out


@pytest.fixture(scope="module")
def mixed():
    rng = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(30))
    texts = [" ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randrange(3, 80))) for _ in range(60)]
    texts += [passage + " " + " ".join(f"w{rng.randrange(3000)}" for _ in range(12)) for _ in range(25)]
    for n, words, edits in ((40, 60, 3), (12, 30, 1), (8, 200, 9), (5, 5, 1)):
        texts += near_copies(rng, n, words, edits)
    texts += [texts[0]] * 6 + ["A b C", "a B c", "one", "", None, " \n\t"]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_mixed_fixture_equals_brute_force(spark, mixed):
    check(spark, mixed)


def test_large_families_in_blocks_equal_brute_force(spark, mixed):
    check(spark, mixed, unit_postings=150)


def test_hot_shingles_equal_brute_force(spark, mixed, monkeypatch):
    full = N.hot_shingles
    monkeypatch.setattr(N, "hot_shingles", lambda docs, text, size, above: full(docs, text, size, above, sample=1))
    check(spark, mixed, hot_rows=8)


def test_table_equals_brute_force(spark):
    check(spark, [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()])


def test_odd_ids_and_empty_table(spark):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    check(spark, [(5, a), (5, b), (None, a), (None, "only null ids here in this text"), (7, b), (None, None)])
    assert N.link_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_extra_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b c d e f", "s", 9), (2, "a b c d e f", "t", 9)],
                               "doc_id long, text string, bucket string, component_id long")
    assert sorted(map(tuple, N.link_groups(df).collect())) == [(1, "s", 2, 1), (2, "t", 2, 1)]


def test_very_long_text(spark):
    text = " ".join(f"w{i}" for i in range(300_000))
    df = spark.createDataFrame([(1, text), (2, text + " end"), (3, "short")], "doc_id long, text string")
    assert sorted(map(tuple, N.link_groups(df).collect())) == [(1, 299_996, 1), (2, 299_997, 1), (3, 1, 3)]


def test_shingle_hashes_match_shingles():
    rng = random.Random(2)
    texts = [" ".join(rng.choice("ab Ab cé d").strip() for _ in range(rng.randrange(0, 40))) for _ in range(200)]
    sets = Shingler().sets(texts)
    assert [len(s) for s in sets] == [len(shingle_set(t)) for t in texts]
    for _ in range(300):
        i, j = rng.randrange(200), rng.randrange(200)
        assert len(np.intersect1d(sets[i], sets[j])) == len(shingle_set(texts[i]) & shingle_set(texts[j]))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (None, 3), (100, 101)]
    for by_size in (False, True):
        df = spark.createDataFrame(edges, "a long, b long")
        got = dict(map(tuple, connected_components(df, by_size=by_size).collect()))
        assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
        assert connected_components(df.limit(0), by_size=by_size).count() == 0


def brute_links(rows):
    """(doc_id, number of other rows it links to) of every row by comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    n = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            same = len(sets[i] & sets[j])
            if sets[i] and 100 * same >= 75 * (len(sets[i]) + len(sets[j]) - same):
                n[i] += 1
                n[j] += 1
    return [(d, k) for (d, _), k in zip(rows, n)]


@pytest.mark.parametrize("unit_postings", [N.UNIT_POSTINGS, 150])
def test_every_link_is_counted(spark, mixed, unit_postings):
    df = spark.createDataFrame(mixed, "doc_id long, text string")
    got = N.link_groups(df, unit_postings=unit_postings, count_links=True).collect()
    assert sorted((r.doc_id, r.n_links) for r in got) == sorted(brute_links(mixed))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute(mixed))


def test_query_returns_the_number_of_links(spark):
    from marquee.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op1_ngram_jaccard"][0](spark, SF).collect()
    assert sorted((r.doc_id, r.n_links) for r in got) == sorted(brute_links(rows))


def planned(monkeypatch, *modules):
    """Plans of the tables that ``modules`` store, by name, as if every table were over the bounds of a broadcast."""
    plans = {}

    def seen(df, name, **kw):
        plans.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString())
        return common.stored(df, name, **kw)

    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    lookup = partial(common.lookup_join, bound_rows=-1, salts=4)
    for module in modules:
        monkeypatch.setattr(module, "stored", seen)
        if hasattr(module, "lookup_join"):
            monkeypatch.setattr(module, "lookup_join", lookup)
    return plans


def test_tables_over_the_bound_are_merged_not_broadcast(spark, mixed, monkeypatch):
    plans = planned(monkeypatch, N, components)
    out = N.link_groups(spark.createDataFrame(mixed, "doc_id long, text string"), count_links=True)
    for name in ("edges", "stars", "families", "links"):
        assert plans[name] and not any("BroadcastHashJoin" in p for p in plans[name]), name
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    got = out.collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=repr) == sorted(brute(mixed), key=repr)
    assert sorted([(r.doc_id, r.n_links) for r in got], key=repr) == sorted(brute_links(mixed), key=repr)


def test_components_over_the_bound_are_merged(spark, monkeypatch):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)], "a long, b long")
    for by_size in (False, True):
        with monkeypatch.context() as m:
            plans = planned(m, components)
            got = connected_components(edges, by_size=by_size)
            assert not any("BroadcastHashJoin" in p for p in plans["stars"])
            assert "BroadcastHashJoin" not in edges.join(
                got.withColumnRenamed("node", "a"), "a")._jdf.queryExecution().executedPlan().toString()
            assert dict(map(tuple, got.collect())) == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
