"""Held-out accuracy and defined results of the two trained classifiers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import langid, quality_cnn
from marquee.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    got = QUERIES["op3_language_id"][0](spark, SF)
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    rows = got.join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 1000
    held = [r for r in rows if r.held_out]
    assert 250 < len(held) < 420
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.rejected for r in rows]) < 0.01


def test_quality_held_out_accuracy(spark):
    got = QUERIES["op5_quality_cnn"][0](spark, SF)
    rows = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id", "left").collect()
    assert len(rows) == 1000
    held = [r for r in rows if r.held_out and r.quality is not None]
    good, bad = ([r.score for r in held if r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.9
    assert np.mean([r.predicted == 1 for r in held if r.quality == 1]) > 0.97
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)


def odd_rows(spark):
    return spark.createDataFrame(
        [(1, None, "x"), (2, "", None), (3, "1234 !!", "x"), (None, "der die das und", "y"), (4, "a" * 700_000, "z"),
         (4, "a" * 700_000, "z")], "doc_id long, text string, score string")


def test_language_of_odd_rows(spark):
    texts = ["the cat and the dog went over the hill"] * 20 + ["der hund und die katze auf dem berg"] * 20
    model = langid.fit(texts, ["en"] * 20 + ["de"] * 20)
    rows = langid.identify(odd_rows(spark), model).collect()
    by = {(r.doc_id, r.text): r for r in rows}
    assert len(rows) == 6
    for key in ((1, None), (2, ""), (3, "1234 !!")):
        assert by[key].lang_pred == "und" and by[key].score == 0 and by[key].rejected
    assert by[(None, "der die das und")].lang_pred == "de"
    assert by[(4, "a" * 700_000)].lang_pred in ("de", "en")
    assert langid.identify(odd_rows(spark).limit(0), model).count() == 0
    rows = langid.identify(odd_rows(spark), langid.fit([], [])).collect()
    assert {(r.lang_pred, r.score) for r in rows} == {("und", 0.0)}
    assert sorted(r.rejected for r in rows) == [False] * 3 + [True] * 3


def test_language_sample_is_bounded(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("text of it").alias("text"),
                                  F.when(F.col("id") % 9 == 0, "de").otherwise("en").alias("lang"))
    texts, langs = langid.training_sample(df, "lang", rows=200)
    assert len(texts) == 200 and langs.count("de") == 100


def test_no_language_of_the_sample_is_missed(spark):
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("text of it").alias("text"),
                                  F.concat(F.lit("l"), F.when(F.col("id") < 3, 999).otherwise(F.col("id") % 600)).alias("lang"))
    texts, langs = langid.training_sample(df, "lang", rows=2000)
    counts = {x: langs.count(x) for x in set(langs)}
    assert len(counts) == 601 and counts.pop("l999") == 3 and set(counts.values()) == {langid.LEAST_ROWS}
    again = langid.training_sample(df.repartition(7), "lang", rows=2000)
    assert again == (texts, langs)


def test_language_scores_equal_a_plain_sum_over_subwords():
    texts = ["the cat and the dog went over the hill"] * 20 + ["der hund und die katze auf dem berg"] * 20
    model = langid.fit(texts, ["en"] * 20 + ["de"] * 20)

    def bucket(run):
        h = (int.from_bytes(run, "big") + len(run)) * 2654435761 % 2**32
        return (h ^ h >> 15) * 2246822519 % 2**32 >> 18

    for text in ("Die Katze", "a", "über den Berg " * 40, "x1 y2", "the DOG und der hund"):
        raw = f" {text.lower()} ".encode()
        found = [bucket(raw[i:i + n]) for n in (2, 3, 4) for i in range(len(raw) - n + 1)]
        logits = np.mean([model.table[b].astype(float) for b in found], axis=0) + model.bias
        e = np.exp((logits - logits.max()) / model.temperature)
        langs, score, rejected = langid.predict(model, [text])
        assert langs[0] == model.langs[int(e.argmax())] and score[0] == pytest.approx((e / e.sum()).max(), rel=1e-4)
        assert rejected[0] == (score[0] < model.reject_below)


def small_net():
    good = [f"plain words run on here and there {i} for ever" for i in range(30)]
    bad = [f"plain### words*** run%%% on&&& here### {i}" for i in range(30)]
    return quality_cnn.fit(good + bad, [1] * 30 + [0] * 30, epochs=12)


def test_quality_of_odd_rows(spark):
    net = small_net()
    rows = quality_cnn.classify(odd_rows(spark), net).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not r.text}) == 1
    assert quality_cnn.classify(odd_rows(spark).limit(0), net).count() == 0
    assert quality_cnn.score(quality_cnn.fit(["a", "b"], [1, 1]), "any text") > 0.99
    assert quality_cnn.score(quality_cnn.fit([], []), "any text") > 0.99


def test_quality_pieces_cover_the_whole_text():
    net = small_net()
    text = "plain words run on " * 3000 + "plain### words*** run%%%"
    whole = quality_cnn.score(net, text, piece=1 << 20)
    assert quality_cnn.score(net, text, piece=quality_cnn.CHUNK * 8) == pytest.approx(whole, rel=1e-4)
    assert whole != pytest.approx(quality_cnn.score(net, text[:-30]), rel=1e-3)


def test_quality_gradient_matches_differences():
    rng = np.random.default_rng(1)
    net = small_net()
    net.embed, net.filters = net.embed.astype(np.float64), net.filters.astype(np.float64)
    raw = rng.integers(32, 120, 1500).astype(np.uint8)
    grads = [np.zeros_like(w, dtype=np.float64) for w in net.weights()] + [0.0]
    quality_cnn._accumulate(net, raw, 0.0, grads, 1.0)

    def loss():
        p = quality_cnn.pooled(net, raw)
        return -np.log(1 - quality_cnn.combine(net, p.mean(0), p.max(0)))

    for k, w in enumerate(net.weights()[:2]):
        at = np.unravel_index(np.abs(grads[k]).argmax(), w.shape)
        base = w[at]
        w[at] = base + 1e-4
        up = loss()
        w[at] = base - 1e-4
        assert grads[k][at] == pytest.approx((up - loss()) / 2e-4, rel=0.05)
        w[at] = base


def test_quality_scores_equal_a_plain_convolution():
    net = small_net()
    rng = np.random.default_rng(4)
    q = quality_cnn
    for text in ("short", "plain words run on " * 60, "".join(chr(c) for c in rng.integers(32, 400, 700))):
        raw = text.encode()
        chunks = max(1, -(-len(raw) // q.CHUNK))
        padded = raw + b" " * (chunks * q.CHUNK + q.OVERLAP - len(raw))
        best = np.zeros((chunks, q.FILTERS))
        for k in range(chunks * q.PER_CHUNK):
            at = k * q.STRIDE
            span = []
            for i in range(at, at + q.SPAN):
                span += [*net.embed[padded[i]], *(float(i >= lag and padded[i] == padded[i - lag]) for lag in q.LAGS)]
            best[k // q.PER_CHUNK] = np.maximum(best[k // q.PER_CHUNK], np.array(span) @ net.filters + net.offset)
        z = best.mean(0) @ net.chunk + best.max(0) @ net.top + net.bias
        assert q.score(net, text) == pytest.approx(1 / (1 + np.exp(-z)), rel=1e-3)
