import hashlib
import random

import pytest
from pyspark.sql import functions as F

from marquee.llm import components
from marquee.llm import edit_fingerprint as E
from tests.llm.test_ngram_join import planned

SF = "/root/testdata/sf0.001"


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def brute(rows):
    """(doc_id, n_chars, sha256 of the edited text) with the follower found on the driver."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] or ""))
    out = []
    for (i, t), (_, u) in zip(rows, rows[1:] + rows[:1]):
        t, u = t or "", u or ""
        half = len(t) // 2
        e = t[:len(t) - half] + u[:half]
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), e))
    return out


def check(spark, rows, slices):
    got = E.with_edits(frame(spark, rows), slices=slices).collect()
    want = brute(rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_chars, r.edited_sha256) for r in got) == sorted(
        (i if i is not None else -1, n, h) for i, n, h, _ in want)
    positions = E.Positions()
    prints = dict(zip([w[2] for w in want], E.walk([w[3] for w in want], positions)))
    for r in got:
        assert r.edited_fingerprint == prints[r.edited_sha256]
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    return got


def test_whole_table_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = check(spark, rows, 7)
    assert sum(r.near_edited > r.near_next for r in got) > 0.95 * len(got)


def test_nulls_empty_ties_and_single_rows(spark):
    check(spark, [(5, None), (3, ""), (None, "lost id"), (9, "x" * 70_000), (4, "a"), (4, "a"), (4, "zb"), (-7, "👩‍👧 ß")], 3)
    check(spark, [(1, "alone here")], 4)
    assert E.with_edits(frame(spark, [])).count() == 0


def test_equal_texts_have_equal_fingerprints_and_edits_keep_likeness(spark):
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    shifted = text[:200] + "x" + text[200:]
    other = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    a, b, c, d = E.walk([text, text, shifted, other], E.Positions())
    assert a == b
    assert E.likeness_of(a, c) > 0.9 > 0.3 > E.likeness_of(a, d)


def test_lockstep_and_single_walks_agree():
    rng = random.Random(4)
    texts = ["".join(rng.choice("abc de") for _ in range(rng.randrange(0, 900))) for _ in range(120)]
    p = E.Positions()
    assert E.walk(texts, p) == [E.walk([t], p)[0] for t in texts]


def test_banding_finds_near_copies_without_all_pairs(spark):
    rng = random.Random(5)
    base = "".join(rng.choice("abcdefgh ") for _ in range(2000))
    rows = [(i, base[:50 * i + 9] + "y" + base[50 * i + 9:]) for i in range(20)] + [
        (100 + i, "".join(rng.choice("abcdefgh ") for _ in range(2000))) for i in range(20)]
    fp = E.fingerprint(frame(spark, rows).withColumn("fingerprint", F.lit("old")))
    near = {r.fingerprint for r in E.near_copies(fp).collect()}
    found = {r.doc_id for r in fp.collect() if r.fingerprint in near}
    assert len(found & set(range(20))) >= 18 and not found & set(range(100, 120))


def test_native_likeness_equals_numpy(spark):
    a, b = E.walk(["the one text of some length", "the one text of same length"], E.Positions())
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(E.likeness(F.col("a"), F.col("b"))).first()[0] == pytest.approx(E.likeness_of(a, b))


def hexed(samples):
    return "".join("0123456789abcdef"[x] for x in samples)


def brute_classes(prints, least=0.8):
    """Class of each fingerprint that has a near copy: all pairs that share a band, compared."""
    prints = sorted(set(prints))
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    paired = set()
    for i, a in enumerate(prints):
        for b in prints[:i]:
            if E._shared_bands(a, b) and E.likeness_of(a, b) >= least:
                paired |= {a, b}
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {p: find(p) for p in paired}


@pytest.mark.parametrize("unit_rows", [2000, 3])
def test_crowded_buckets_lose_no_near_copy(spark, unit_rows):
    rng = random.Random(6)
    passage = [0] * 8                                 # a band that all share
    groups = [[rng.randrange(16) for _ in range(E.SLOTS - 8)] for _ in range(5)]
    prints = [hexed(passage + [rng.randrange(16) if rng.random() < 0.15 else x for x in g])
              for g in groups for _ in range(6)]
    prints += [hexed(passage + [rng.randrange(16) for _ in range(E.SLOTS - 8)]) for _ in range(10)]
    fp = spark.createDataFrame(list(enumerate(prints)), "doc_id long, fingerprint string")
    got = dict(map(tuple, E.near_copies(fp, least=0.65, unit_rows=unit_rows).collect()))
    want = brute_classes(prints, 0.65)
    assert got == want and len(want) >= 25 and len(set(want.values())) == 5


def test_classes_of_all_documents_are_a_column(spark):
    from marquee.llm.queries import QUERIES

    got = QUERIES["op10_edit_fingerprint"][0](spark, SF).collect()
    want = brute_classes([r.fingerprint for r in got])
    least = {}
    for r in got:
        c = want.get(r.fingerprint, r.fingerprint)
        least[c] = min(r.doc_id, least.get(c, r.doc_id))
    assert all(r.near_class == least[want.get(r.fingerprint, r.fingerprint)] for r in got)
    assert sum(r.near_class != r.doc_id for r in got) > 0


def test_near_class_of_null_ids_and_copies(spark):
    a, b = "some text that stands twice " * 9, "quite another one " * 9
    got = E.with_near_classes(frame(spark, [(5, a), (3, a), (None, a), (None, b), (7, "")])).collect()
    assert sorted((r.doc_id or 0, r.near_class) for r in got if r.near_class) == [(0, 3), (3, 3), (5, 3), (7, 7)]
    assert E.with_near_classes(frame(spark, [])).count() == 0


def test_extra_and_clashing_columns_are_left_out(spark):
    df = spark.createDataFrame([(1, "some text", 5, "x", "y", 0.5), (2, "other", 6, "x", "y", 0.1)],
                               "doc_id int, text string, _slice int, fingerprint string, fid string, near_class double")
    plain = df.select("doc_id", "text")
    assert sorted(E.with_edits(df).collect()) == sorted(E.with_edits(plain).collect())
    got = E.with_near_classes(df)
    assert got.columns == [*E.with_edits(plain).columns, "near_class"]
    assert sorted(got.collect()) == sorted(E.with_near_classes(plain).collect())
    kept = E.fingerprint(df)
    assert kept.columns == ["doc_id", "text", "_slice", "fid", "near_class", "fingerprint"]


def test_tables_over_the_bound_are_merged_not_broadcast(spark, monkeypatch):
    rng = random.Random(8)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(600)) for _ in range(12)]
    texts = [t[:k] + "x" * k + t[k:] for t in base for k in range(4)] + base
    df = frame(spark, list(enumerate(texts)))
    want = sorted(map(tuple, E.with_near_classes(df).collect()), key=repr)
    plans = planned(monkeypatch, E, components)
    out = E.with_near_classes(df)
    for name in ("band-members", "band-groups", "stars"):
        assert plans[name] and not any("BroadcastHashJoin" in p for p in plans[name]), name
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, out.collect()), key=repr) == want
