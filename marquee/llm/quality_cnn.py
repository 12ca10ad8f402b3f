"""Quality classifier: a byte-level convolutional network in numpy.

The bytes of a text (UTF-8) become short vectors: a learned embedding, and for each
of ``LAGS`` distances whether the byte equals the one so far before it. Learned
filters of ``SPAN`` bytes slide over overlapping chunks that together cover the
whole document; each filter's largest response in a chunk is pooled, a linear
layer turns a chunk's pooled responses into evidence, and the mean evidence of all
chunks and of the highest one are combined into one probability.

Training (Adam, numpy) sees a bounded sample of labelled rows; scoring runs over all
rows where they lie, piece by piece, so a text of any length takes bounded memory.

Defined results: null text counts as empty; an empty text is scored by the bias
alone; repeated rows each get their score; extra columns pass through, and columns
named like a result are replaced. A training set without rows of both labels teaches
nothing: every score is the share of label 1 (of no labels at all: 1).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import arrow_map, blocks

EMBED = 6
LAGS = (2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 14, 16, 18)
CHANNELS = EMBED + len(LAGS)
SPAN = 8                     # bytes a filter sees
STRIDE = 4
FILTERS = 16
CHUNK = 512                  # bytes of a chunk
OVERLAP = SPAN - STRIDE      # shared by neighbouring chunks, so no span is lost
THRESHOLD = 0.3
BLOCK_BYTES = 1 << 20
SAMPLE_ROWS = 3000           # labelled rows that training sees at most
SAMPLE_TEXT_BYTES = 64 << 10 # longest text it sees


@dataclass
class Network:
    embed: np.ndarray        # 256 x EMBED
    filters: np.ndarray      # SPAN * CHANNELS x FILTERS
    offset: np.ndarray       # FILTERS
    chunk: np.ndarray        # FILTERS
    top: np.ndarray          # FILTERS: weight of the pooled maximum over chunks
    bias: float

    def weights(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.offset, self.chunk, self.top]


PER_CHUNK = CHUNK // STRIDE  # spans that begin in a chunk


def _padded(raw: np.ndarray) -> np.ndarray:
    """The bytes of a text filled up with blanks to whole chunks and the last span's end."""
    n = max(1, -(-len(raw) // CHUNK)) * CHUNK + OVERLAP
    out = np.full(n, 32, np.uint8)
    out[:len(raw)] = raw
    return out


def lag_channels(raw: np.ndarray) -> np.ndarray:
    """Whether each byte equals the one at each lag before it (n x lags, float32)."""
    out = np.zeros((len(raw), len(LAGS)), np.float32)
    for k, lag in enumerate(LAGS):
        if len(raw) > lag:
            out[lag:, k] = raw[lag:] == raw[:-lag]
    return out


def responses(net: Network, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Span inputs, padded bytes, and chunk x span x filter responses of a text."""
    b = _padded(raw)
    x = np.concatenate([net.embed[b], lag_channels(b)], axis=1)
    windows = np.lib.stride_tricks.sliding_window_view(x, SPAN, axis=0)[::STRIDE]
    n = len(b) // CHUNK * PER_CHUNK
    flat = np.ascontiguousarray(windows[:n].transpose(0, 2, 1)).reshape(n, SPAN * CHANNELS)
    return flat, b, (flat @ net.filters + net.offset).reshape(-1, PER_CHUNK, FILTERS)


def pooled(net: Network, raw: np.ndarray) -> np.ndarray:
    """Largest response of each filter in each chunk, at least 0."""
    return np.maximum(responses(net, raw)[2].max(1), 0)


def combine(net: Network, mean: np.ndarray, top: np.ndarray) -> float:
    z = float(mean @ net.chunk + top @ net.top + net.bias)
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def score(net: Network, text: str | None, piece: int = 1 << 18) -> float:
    """Probability of label 1. Long texts are taken in pieces of whole chunks that
    begin where a chunk begins and carry the bytes a lag or a span needs."""
    raw = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    if not len(raw):
        return combine(net, np.zeros(FILTERS), np.zeros(FILTERS))
    total, top, chunks = np.zeros(FILTERS), np.zeros(FILTERS), 0
    for a in range(0, len(raw), piece):
        back = CHUNK if a else 0
        p = pooled(net, raw[a - back:a + piece + (OVERLAP if a + piece < len(raw) else 0)])[back // CHUNK:]
        if a + piece < len(raw):
            p = p[:piece // CHUNK]
        total += p.sum(0)
        top = np.maximum(top, p.max(0))
        chunks += len(p)
    return combine(net, total / chunks, top)


def untrained(share: float) -> Network:
    """The network that scores every text with ``share``."""
    zero = [np.zeros(n, np.float32) for n in ((256, EMBED), (SPAN * CHANNELS, FILTERS), FILTERS, FILTERS, FILTERS)]
    return Network(*zero, float(_log_odds(share)))


def _log_odds(share: float) -> float:
    share = min(max(share, 1e-6), 1 - 1e-6)
    return float(np.log(share / (1 - share)))


def fit(texts: list[str], labels: list[int], epochs: int = 8, rate: float = 0.01, batch: int = 16,
        seed: int = 11) -> Network:
    """Train by Adam on whole texts. Both labels weigh the same share they have in the sample."""
    y = np.array(labels, np.float64)
    if not 0 < y.sum() < len(y):
        return untrained(float(y.mean()) if len(y) else 1.0)
    rng = np.random.default_rng(seed)
    net = Network(rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
                  rng.normal(0, (SPAN * CHANNELS) ** -0.5, (SPAN * CHANNELS, FILTERS)).astype(np.float32),
                  np.zeros(FILTERS, np.float32), rng.normal(0, 0.3, FILTERS).astype(np.float32),
                  rng.normal(0, 0.3, FILTERS).astype(np.float32), float(np.log(y.mean() / (1 - y.mean()))))
    raws = [np.frombuffer((t or "").encode("utf-8", "replace"), np.uint8) for t in texts]
    usable = np.array([i for i, r in enumerate(raws) if len(r)])
    first = [np.zeros_like(w) for w in net.weights()] + [0.0]
    second = [np.zeros_like(w) for w in net.weights()] + [0.0]
    t = 0
    for epoch in range(epochs):
        rng.shuffle(usable)
        step = rate * (1 - 0.9 * epoch / epochs)
        for s in range(0, len(usable), batch):
            grads = [np.zeros_like(w) for w in net.weights()] + [0.0]
            at = usable[s:s + batch]
            for i in at:
                _accumulate(net, raws[i], y[i], grads, 1 / len(at))
            t += 1
            weights = net.weights() + [net.bias]
            for k, (w, g) in enumerate(zip(weights, grads)):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                move = step * (first[k] / (1 - 0.9 ** t)) / (np.sqrt(second[k] / (1 - 0.999 ** t)) + 1e-8)
                if k < 5:
                    w -= move.astype(np.float32)
                else:
                    net.bias -= float(move)
    return net


def _accumulate(net: Network, raw: np.ndarray, label: float, grads: list, share: float) -> None:
    """Add one text's gradient. Only the spans that were pooled carry any."""
    flat, b, r = responses(net, raw)
    best = r.argmax(1)                                     # chunk x filter
    value = np.take_along_axis(r, best[:, None, :], 1)[:, 0]
    p = np.maximum(value, 0)
    lead = p.argmax(0)
    mean, top = p.mean(0), p[lead, np.arange(FILTERS)]
    err = share * (combine(net, mean, top) - label)
    grads[3] += err * mean
    grads[4] += err * top
    grads[5] += err
    d = np.repeat(err * net.chunk[None] / len(p), len(p), 0)
    d[lead, np.arange(FILTERS)] += err * net.top
    d = np.where(value > 0, d, 0).astype(np.float32)       # chunk x filter
    grads[2] += d.sum(0)
    rows = best + np.arange(len(p))[:, None] * PER_CHUNK
    picked = flat[rows]                                    # chunk x filter x inputs
    grads[1] += np.einsum("cf,cfi->if", d, picked)
    dx = (d[:, :, None] * net.filters.T[None]).reshape(-1, SPAN, CHANNELS)[:, :, :EMBED]
    where = b[(rows.reshape(-1, 1) * STRIDE + np.arange(SPAN)[None, :])]
    np.add.at(grads[0], where.reshape(-1), dx.reshape(-1, EMBED))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS,
                    max_bytes: int = SAMPLE_TEXT_BYTES, key: str = "doc_id", text: str = "text",
                    ) -> tuple[list[str], list[int], float]:
    """Texts and labels of a bounded sample, and the share of label 1 among all labelled rows.

    About ``rows`` keys, half of them (or as many as there are) of each label, are chosen from the
    labels by a hash of the key; only their texts are fetched, those of at most ``max_bytes`` bytes.
    """
    known = labels.select(key, F.col(label).cast("int").alias("_y")).filter(F.col("_y").isin(0, 1))
    sizes = {r[0]: r[1] for r in known.groupBy("_y").count().collect()}
    if len(sizes) < 2:
        return [], [], float(sizes.get(1, 0) > 0 or not sizes)
    u = F.pmod(F.xxhash64(F.col(key), F.lit("quality")), F.lit(1 << 30)) / float(1 << 30)
    chance = F.when(F.col("_y") == 1, min(1.0, rows / 2 / sizes[1])).otherwise(min(1.0, rows / 2 / sizes[0]))
    chosen = known.filter(u < chance).dropDuplicates([key]).limit(2 * rows)
    got = (docs.select(key, F.coalesce(text, F.lit("")).alias("_t")).filter(F.octet_length("_t") <= max_bytes)
           .join(F.broadcast(chosen), key).orderBy(F.xxhash64(F.col(key), F.lit("quality")), key, "_t")
           .limit(2 * rows).collect())
    return [r["_t"] for r in got], [r["_y"] for r in got], sizes[1] / sum(sizes.values())


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", **sample) -> Network:
    """Train on a bounded sample, then set the bias to the share of label 1 among all labels."""
    texts, y, share = training_sample(docs, labels, label, **sample)
    if not 0 < sum(y) < len(y):
        return untrained(share)
    return shift_prior(fit(texts, y), sum(y) / len(y), share)


def shift_prior(net: Network, sample_share: float, true_share: float) -> Network:
    """The network for rows of which ``true_share`` have label 1, trained on a sample with another share."""
    return Network(*net.weights(), net.bias + _log_odds(true_share) - _log_odds(sample_share))


def _scores(batches: Iterator[pa.RecordBatch], shared, text: str, keep: list[str]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, text, BLOCK_BYTES):
        s = [score(shared.value, t) for t in block.column(block.schema.names.index(text)).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*(block.column(c) for c in keep), pa.array(s, pa.float64()),
             pa.array([int(x >= THRESHOLD) for x in s], pa.int32())], names=[*keep, "score", "predicted"])


def classify(df: DataFrame, net: Network, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all by default) plus score and predicted (1 from THRESHOLD on)."""
    keep = [c for c in (df.columns if keep is None else keep) if c not in ("score", "predicted")]
    shared = df.sparkSession.sparkContext.broadcast(net)       # bounded: a few thousand weights
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])
    return arrow_map(df.select(*{*keep, text}), lambda it: _scores(it, shared, text, keep), schema)
