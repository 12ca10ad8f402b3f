"""Every stage of corpus_pipeline against brute force, on its own input."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from marquee.llm.queries import MIX_FRACTION, domain_of, mix_sql
from tests.llm.test_ngram_join import brute, planned

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    from marquee.llm.common import read, stored

    docs = read(spark, SF, "documents")
    out = [docs]
    for name, stage in P.STAGES:
        docs = stored(stage(spark, docs, SF), "test-stage")
        out.append(docs)
    return out


def test_order_and_columns(steps):
    assert [n.split()[0] for n, _ in P.STAGES] == ["quality", "language", "n-gram", "mixing", "byte-level"]
    for df in steps[:-1]:
        assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert steps[-1].columns == ["doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_quality_stage_drops_junk_and_keeps_the_rest(spark, steps):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before = {r.doc_id for r in steps[0].select("doc_id").collect()}
    after = {r.doc_id for r in steps[1].select("doc_id").collect()}
    assert after < before
    held = [d for d in before if d in labels and zlib.crc32(str(d).encode()) % 5 == 0]
    assert sum(labels[d] == 1 and d not in after for d in held) <= 0.02 * len(held)
    assert sum(labels[d] == 0 and d not in after for d in held) >= 0.6 * sum(labels[d] == 0 for d in held)


def test_language_stage_keeps_clean_documents(steps):
    assert steps[2].count() >= 0.99 * steps[1].count()


def test_near_duplicate_stage_equals_brute_force(steps):
    rows = [(r.doc_id, r.text) for r in steps[2].collect()]
    want = {d for d, _, c in brute(rows) if d == c}
    got = [r.doc_id for r in steps[3].collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_mixing_stage_equals_sql(steps, tmp_path):
    import duckdb

    table = steps[3].toPandas()
    con = duckdb.connect()
    con.register("kept", table)
    want = {r[0] for r in con.sql(mix_sql("kept", 1.0)).fetchall()}
    got = [r.doc_id for r in steps[4].collect()]
    assert len(got) == len(set(got)) and set(got) == want
    share = steps[4].selectExpr("sum(size(split(trim(text), '\\\\s+')))").first()[0] / steps[3].selectExpr(
        "sum(size(split(trim(text), '\\\\s+')))").first()[0]
    assert MIX_FRACTION <= share < MIX_FRACTION + 0.06     # a leaf passes its budget by less than a document


def test_token_stage_equals_tiktoken(steps):
    import public_tokenizers
    import tiktoken

    from marquee.llm.bpe import load_ranks

    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    texts = {r.doc_id: r.text or "" for r in steps[4].collect()}
    rows = steps[5].collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = enc.encode_ordinary(texts[r.doc_id])
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_stages_take_odd_rows_and_empty_tables(spark):
    long = "the of and in " + "wordy text that runs on and on " * 3000
    rows = [(1, None, "en", None, 3, "x"), (2, "", None, "src1", None, "x"), (None, "no id here at all", "en", "src1", 1, "x"),
            (None, "no id here at all", "en", "src1", 1, "y"), (4, long, "en", "src2", 2, "z"), (5, long, "de", "src3", 2, "z"),
            (6, "same id twice one", "en", "src2", 2, "b"), (6, "same id twice one", "en", "src2", 2, "a")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string"
    docs = spark.createDataFrame(rows, schema)
    for name, stage in P.STAGES:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        out.count()
        if stage is not P.token_stage:
            assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), "/root/testdata/sf0.001").count() == 0, name
    kept = P.near_duplicate_stage(spark, docs, "").orderBy(F.col("doc_id").asc_nulls_first()).collect()
    assert [(r.doc_id, r.score) for r in kept] == [(None, "x"), (1, "x"), (2, "x"), (4, "z"), (6, "a")]
    assert P.mixing_stage(spark, docs, "").filter("text IS NULL OR text = ''").count() == 0


def test_domains(spark):
    df = spark.createDataFrame([("src0",), ("src19",), ("else",), (None,)], "s string")
    assert [r[0] for r in df.select(domain_of(F.col("s"))).collect()] == ["web", "forum", "other", "other"]


def test_near_duplicates_go_by_row_not_by_id(spark):
    a = "one two three four five six seven eight nine ten"
    rows = [(1, a, "x"), (5, a + " eleven", "x"), (5, "an unlike text that stands under the same id", "y"), (7, "more of it here", "z"),
            (7, "two unlike texts of one id", "z"), (9, a, "x"), (9, "more of it here", "w"), (None, a, "n"), (None, "only here", "n"),
            (None, "only here", "m"), (3, None, "q"), (3, None, "p"), (4, None, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _group string")
    got = sorted(P.near_duplicate_stage(spark, docs, "").collect(), key=repr)
    groups = [[r for r in rows if r[1] in texts and (r[0] in ids or ids is None)] for texts, ids in (
        ({a, a + " eleven"}, {1, 5, 9, None}), ({rows[2][1]}, {5}), ({rows[3][1]}, {7, 9}), ({rows[4][1]}, {7}), ({"only here"}, {None}))]
    want = [min(g, key=lambda r: (r[0] is None, r[0] or 0, r[2])) for g in groups] + [(3, None, "p"), (4, None, "q")]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_near_duplicates_of_many_groups_are_merged_not_broadcast(spark, monkeypatch):
    from marquee.llm import components, ngram_join

    words = [f"w{i} " * 3 + " ".join(f"v{i}x{j}" for j in range(30)) for i in range(20)]
    rows = [(100 * k + i, t + " end" * k, str(k)) for i, t in enumerate(words) for k in range(i % 3 + 1)] + [(7, words[7], "0")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n string")
    plans = planned(monkeypatch, P, ngram_join, components)
    out = P.near_duplicate_stage(spark, docs, "")
    assert "BroadcastHashJoin" not in plans["members"][0] + out._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, out.collect())) == sorted((i, t, "0") for i, t in enumerate(words))
