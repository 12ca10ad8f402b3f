"""Language ID: averaged hashed subword embeddings with a linear softmax, trained by
stochastic gradient descent in numpy, with calibrated rejection.

A text is lower-cased and encoded as UTF-8; every run of 2, 3 and 4 bytes of the
whole text is a subword, hashed to one of ``BUCKETS`` embeddings. The average of
the embeddings goes through a linear layer and a softmax. Training sees a bounded
sample of labelled rows; prediction runs over all rows where they lie.

A fifth of the sample is kept back: it sets the temperature of the softmax, and
the confidence below which a prediction is rejected (``reject_share`` of the rows
that were predicted right fall below it).

Defined results: null text and text without a letter give ``und`` with score 0,
rejected; repeated rows each get their result; extra columns pass through, and columns
named like a result are replaced. Null labels are not learned; without any label
every language is ``und`` with score 0, and only texts without a letter are rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import arrow_map, blocks

UNKNOWN = "und"
BUCKETS = 1 << 14
WIDTH = 16                   # embedding dimensions
BLOCK_BYTES = 2 << 20
SAMPLE_ROWS = 2000           # labelled rows that training sees, about
SAMPLE_TEXT_BYTES = 64 << 10 # longest text it sees
LEAST_ROWS = 8               # of each language, or all if it has fewer
MAX_LANGS = 1000             # languages of the sample: bounds the model


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray        # bucket -> logits of a text made of that subword only
    bias: np.ndarray
    temperature: float
    reject_below: float


def buckets(raw: np.ndarray) -> list[np.ndarray]:
    """Bucket of each 2-, 3- and 4-byte run of a byte array."""
    b = raw.astype(np.uint32)
    out = []
    key = b[:-1] << np.uint32(8) | b[1:]
    for n in (2, 3, 4):
        if n > 2:
            key = key[:-1] << np.uint32(8) | b[n - 1:]
        h = (key + np.uint32(n)) * np.uint32(2654435761)
        out.append((h ^ h >> np.uint32(15)) * np.uint32(2246822519) >> np.uint32(18))
    return out


def _bytes(text: str) -> np.ndarray:
    return np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)


def counts(text: str) -> np.ndarray:
    """Share of each bucket among the subwords of a text."""
    c = np.bincount(np.concatenate(buckets(_bytes(text))), minlength=BUCKETS).astype(np.float32)
    return c / max(c.sum(), 1)


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def fit(texts: list[str], labels: list[str], epochs: int = 30, batch: int = 32, rate: float = 2.0,
        reject_share: float = 0.001, seed: int = 7) -> Model:
    """Train on whole texts by stochastic gradient descent; calibrate on a fifth of them."""
    langs = sorted(set(labels))
    if not langs:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32), 1.0, 0.0)
    rng = np.random.default_rng(seed)
    x = np.stack([counts(t) for t in texts])
    y = np.searchsorted(langs, labels)
    order = rng.permutation(len(x))
    held = order[:len(x) // 5] if len(x) >= 50 else order
    train = order[len(x) // 5:] if len(x) >= 50 else order
    emb = rng.normal(0, 1, (BUCKETS, WIDTH)).astype(np.float32)
    out = np.zeros((WIDTH, len(langs)), np.float32)
    bias = np.zeros(len(langs), np.float32)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        rng.shuffle(train)
        for i in range(0, len(train), batch):
            at = train[i:i + batch]
            mean = x[at] @ emb
            grad = _softmax(mean @ out + bias)
            grad[np.arange(len(at)), y[at]] -= 1
            grad /= len(at)
            back = grad @ out.T
            out -= step * (mean.T @ grad)
            bias -= step * grad.sum(0)
            # A subword's share is small: its embedding moves with a larger step.
            emb -= 20 * step * (x[at].T @ back)
    table = emb @ out
    logits = x[held] @ table + bias
    scales = np.geomspace(0.05, 20, 60)
    loss = [-np.log(_softmax(logits / s)[np.arange(len(held)), y[held]] + 1e-9).mean() for s in scales]
    temperature = float(scales[int(np.argmin(loss))])
    p = _softmax(logits / temperature)
    right = p.argmax(1) == y[held]
    reject_below = float(np.quantile(p.max(1)[right], reject_share)) if right.any() else 0.0
    return Model(langs, table.astype(np.float32), bias, temperature, min(reject_below, 0.5))


def predict(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and rejection of each text."""
    if not model.langs:
        letters = np.array([any(map(str.isalpha, t or "")) for t in texts], bool)
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), ~letters
    logits = np.zeros((len(texts), len(model.langs)), np.float32)
    known = np.zeros(len(texts), bool)
    for i, t in enumerate(texts):
        if not t or not (t.isalpha() or any(map(str.isalpha, t))):
            continue
        known[i] = True
        raw = _bytes(t)
        # Runs of a very long text are summed piece by piece.
        total, n = 0, 0
        for a in range(0, len(raw), 1 << 20):
            for run in buckets(raw[max(0, a - 3):a + (1 << 20)] if a else raw[:1 << 20]):
                c = np.bincount(run, minlength=BUCKETS) if len(run) > BUCKETS // 4 else None
                total = total + (c @ model.table if c is not None else model.table[run].sum(0))
                n += len(run)
        logits[i] = total / max(n, 1) + model.bias
    p = _softmax(logits / model.temperature)
    best = p.argmax(1)
    score = np.where(known, p.max(1), 0.0).astype(np.float64)
    langs = [model.langs[b] if k else UNKNOWN for b, k in zip(best, known)]
    return langs, score, ~known | (score < model.reject_below)


def training_sample(df: DataFrame, lang: str, rows: int = SAMPLE_ROWS, key: str = "doc_id",
                    text: str = "text") -> tuple[list[str], list[str]]:
    """About ``rows`` labelled rows, as many of each language (at least ``LEAST_ROWS``): those with the least hash of the key.

    The sample holds the ``MAX_LANGS`` most frequent languages; it, and with it the model, is bounded by that.
    A first cut by the hash, wide enough for three times the rows wanted, keeps the ranking off the frequent languages' rows.
    """
    labelled = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.col(lang).alias("_lang")).filter(
        F.col("_lang").isNotNull() & (F.octet_length("_text") <= SAMPLE_TEXT_BYTES))
    sizes = {r[0]: r[1] for r in labelled.groupBy("_lang").count()
             .orderBy(F.desc("count"), "_lang").limit(MAX_LANGS).collect()}
    each = max(LEAST_ROWS, rows // max(1, len(sizes)))
    u = F.pmod(F.xxhash64("_key", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    langs = df.sparkSession.createDataFrame([(name, min(1.0, (3 * each + 30) / n)) for name, n in sizes.items()],
                                            "_lang string, _chance double")
    some = labelled.join(F.broadcast(langs), "_lang").filter(u < F.col("_chance"))
    order = Window.partitionBy("_lang").orderBy(F.xxhash64("_key", F.lit("sample")), "_key", "_text")
    got = (some.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= each)
           .orderBy(F.xxhash64("_key", F.lit("sample")), "_key", "_lang", "_text").collect())
    return [r["_text"] for r in got], [r["_lang"] for r in got]


def _predictions(batches: Iterator[pa.RecordBatch], shared, text: str,
                 keep: list[str]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, text, BLOCK_BYTES):
        langs, score, rejected = predict(shared.value, block.column(block.schema.names.index(text)).to_pylist())
        yield pa.RecordBatch.from_arrays(
            [*(block.column(c) for c in keep), pa.array(langs), pa.array(score), pa.array(rejected)],
            names=[*keep, "lang_pred", "score", "rejected"])


def identify(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all by default) plus lang_pred, score and rejected."""
    results = ("lang_pred", "score", "rejected")
    keep = [c for c in (df.columns if keep is None else keep) if c not in results]
    shared = df.sparkSession.sparkContext.broadcast(model)     # bounded: BUCKETS x languages
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    return arrow_map(df.select(*{*keep, text}), lambda it: _predictions(it, shared, text, keep), schema)
