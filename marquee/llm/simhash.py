"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into two halves. Of two fingerprints with at most three differing
bits, one half differs in at most one bit. Every half is indexed under its 32 variants with one
bit deleted (a wildcard), so such a pair meets under an equal variant; the other half is then
verified. A pair is only looked at under one of its common variants: equal halves meet under the
variant of bit 0, halves that differ in one bit under the variant of that bit.

Buckets (rows of one variant) can be large where near copies abound. Those that may exceed
``BUCKET`` fingerprints are known beforehand from the counts of whole halves, and are not formed:
their rows are indexed one level deeper, under a variant of the first half and one of the 32
variants of the other half's two 16-bit quarters, one of which differs in at most one bit as well.
Such a bucket has 18 free bits, so it holds at most 2^18 different fingerprints whatever the data.

Defined results: null texts and texts without words have fingerprint zero and link like any other;
repeated rows stay repeated; a null ``doc_id`` never is a component's id (a component of null ids
only has a null id); an empty table gives an empty one. Other columns are not returned, so none can
clash.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import arrow_map, blocks, lookup_join, stored
from marquee.llm.components import connected_components

SEED = 42
WORDS = 3
MAX_BITS = 3
BUCKET = 1 << 15          # from here on one more level of variants costs less than comparing a bucket's pairs
BLOCK_BYTES = 1 << 20
PIECE = 1 << 16           # hashes unpacked at a time
LAGS = 24                 # buckets up to this size are compared by shifted rows, larger ones by search
DEEP = 1 << 62            # marks variants of the second level

_LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())


def shingle_hashes(text: str | None) -> np.ndarray:
    """XXH64 of every shingle of a text, repeats included."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    edges = np.cumsum([0, *(len(w) + 1 for w in words)])
    k = min(WORDS, len(words))
    starts, ends = edges[:len(words) - k + 1].tolist(), (edges[k:] - 1).tolist()
    return np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends)], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), PIECE):
        part = hashes[i:i + PIECE]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp) of every row; fp: the fingerprint as a signed long."""
    def run(batches):
        for batch in blocks(batches, "text", BLOCK_BYTES):
            found = np.array([fingerprint(shingle_hashes(t)) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return arrow_map(docs, run, "doc_id long, fp long")


def _half(fp, half: str):
    """Lower (0) or upper (1) 32 bits of a long."""
    return F.expr(f"CASE {half} WHEN 0 THEN {fp} & 4294967295L ELSE shiftrightunsigned({fp}, 32) END")


def variants(prints: DataFrame, halves: str = "explode(sequence(0, 1))") -> DataFrame:
    """(key, fp): the 64 one-wildcard variants of the halves of every fingerprint."""
    rows = (prints.select("fp", F.expr(halves).alias("h")).select("fp", "h", _half("fp", "h").alias("v"))
            .select("fp", "h", "v", F.expr("explode(sequence(0, 31))").alias("p")))
    return rows.select(F.expr("(h * 32L + p) * 4294967296L + (v & ~shiftleft(1L, p))").alias("key"), "fp")


def deeper(rows: DataFrame) -> DataFrame:
    """Second level: rows of a variant (key, fp) under the 32 variants of the other half's quarters."""
    rows = rows.withColumn("o", F.expr("CASE WHEN key < 32 * 4294967296L THEN shiftrightunsigned(fp, 32) "
                                       "ELSE fp & 4294967295L END"))
    rows = rows.select("key", "fp", "o", F.expr("explode(sequence(0, 1))").alias("q")).select(
        "key", "fp", "q", F.expr("shiftrightunsigned(o, 16 * q) & 65535L").alias("v"))
    rows = rows.select("key", "fp", "q", "v", F.expr("explode(sequence(0, 15))").alias("p"))
    # 57 bits of the first key without its deleted bit would do; a deleted bit is zero, so the key is halved around it.
    packed = ("shiftleft(shiftright(key, 32), 31) | shiftleft(shiftright(key & 4294967295L, cast(shiftright(key, 32) % 32 "
              "AS int) + 1), cast(shiftright(key, 32) % 32 AS int)) | (key & (shiftleft(1L, cast(shiftright(key, 32) % 32 "
              "AS int)) - 1L))")
    tail = "shiftleft(shiftright(v, p + 1), p) | (v & (shiftleft(1L, p) - 1L))"
    return rows.select(F.expr(f"{DEEP}L | shiftleft({packed}, 20) | shiftleft(q * 16L + p, 15) | ({tail})").alias("key"), "fp")


def _crowded(prints: DataFrame, bucket: int) -> DataFrame:
    """(key): variants of halves that over ``bucket`` / 2 fingerprints hold whole. A bucket over ``bucket``
    rows joins two whole halves, so it is among these; there are at most 128 of them per ``bucket`` fingerprints."""
    halves = prints.select("fp", F.expr("explode(sequence(0, 1))").alias("h")).select("h", _half("fp", "h").alias("v"))
    hot = halves.groupBy("h", "v").count().filter(F.col("count") > bucket // 2)
    return hot.select(F.expr("explode(sequence(0, 31))").alias("p"), "h", "v").select(
        F.expr("(h * 32L + p) * 4294967296L + (v & ~shiftleft(1L, p))").alias("key")).distinct()


def near_pairs(prints: DataFrame, bucket: int = BUCKET, lags: int = LAGS) -> DataFrame:
    """(a, b): pairs of different fingerprints with at most three differing bits that connect all
    fingerprints which any such pairs connect. ``prints``: (fp), each once.

    Small buckets give every pair; in larger ones a search spreads from each fingerprint to those
    near it that it has not reached yet, and gives one pair per fingerprint reached.
    """
    rows = variants(prints)
    crowded = stored(_crowded(prints, bucket), "crowded", rebalance=True)
    if not crowded.isEmpty():
        plain = lookup_join(rows, crowded, ["key"], "left_anti")
        rows = plain.unionByName(deeper(lookup_join(rows, crowded, ["key"], "left_semi")))
    rows = rows.repartition("key").sortWithinPartitions("key", "fp")

    def run(batches):
        seen = _Edges()
        for key, fp in _whole_runs(batches):
            cut = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            size = np.diff(np.append(cut, len(key)))
            small = np.repeat(size <= lags, size)
            yield from seen.add(*_by_lag(key[small], fp[small], lags))
            for a, n in zip(cut[size > lags].tolist(), size[size > lags].tolist()):
                yield from seen.add(*_by_search(int(key[a]), fp[a:a + n]))
        yield from seen.rest()

    return arrow_map(rows, run, "a long, b long").distinct()


class _Edges:
    """Distinct pairs of a task, handed on in batches."""

    ROWS = 1 << 18

    def __init__(self):
        self.held, self.n = [], 0

    def add(self, a, b):
        if len(a):
            self.held.append(np.stack([a, b]))
            self.n += len(a)
        if self.n >= self.ROWS:
            yield from self.rest()

    def rest(self):
        if self.held:
            pairs = np.unique(np.concatenate(self.held, axis=1), axis=1)
            self.held, self.n = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0].view(np.int64)), pa.array(pairs[1].view(np.int64))],
                                             ["a", "b"])


def _whole_runs(batches):
    """Arrays (key, fp) of sorted rows, cut between keys only."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        key = batch.column(0).to_numpy(zero_copy_only=False)
        fp = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
        if not len(key):
            continue
        if held and held[-1][0][-1] != key[0]:
            yield tuple(np.concatenate(x) for x in zip(*held))
            held = []
        last = int(np.searchsorted(key, key[-1]))             # first row of the batch's last key
        if last:
            held.append((key[:last], fp[:last]))
            yield tuple(np.concatenate(x) for x in zip(*held))
            held = []
        held.append((key[last:], fp[last:]))
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held))


def _looked_at(key: np.ndarray, diff: np.ndarray) -> np.ndarray:
    """Whether a pair with differing bits ``diff`` is looked at in the bucket ``key`` of the first level:
    equal halves under bit 0 only. Deep buckets look at every pair."""
    slot = key >> 32
    half = np.where(slot < 32, diff & np.uint64(0xFFFFFFFF), diff >> np.uint64(32))
    return (key >= DEEP) | (half != 0) | (slot % 32 == 0)


def _by_lag(key: np.ndarray, fp: np.ndarray, lags: int):
    """Near pairs of small buckets: every row against the rows 1, 2, ... below it."""
    left, right = [], []
    for lag in range(1, lags):
        at = np.flatnonzero(key[lag:] == key[:-lag])
        if not len(at):
            break
        diff = fp[at] ^ fp[at + lag]
        at = at[(np.bitwise_count(diff) <= MAX_BITS) & _looked_at(key[at], diff)]
        left.append(fp[at])
        right.append(fp[at + lag])
    return (np.concatenate(left), np.concatenate(right)) if left else (fp[:0], fp[:0])


_FLIPS = {}


def _flips(bits: tuple[int, ...]) -> np.ndarray:
    """All numbers of one to three of the given bits."""
    if bits not in _FLIPS:
        ones = [1 << b for b in bits]
        n = len(ones)
        out = ones + [ones[i] | ones[j] for i in range(n) for j in range(i)]
        out += [ones[i] | ones[j] | ones[k] for i in range(n) for j in range(i) for k in range(j)]
        _FLIPS.clear()
        _FLIPS[bits] = np.array(out, np.uint64)
    return _FLIPS[bits]


def _by_search(key: int, fp: np.ndarray):
    """One pair per fingerprint that a search through near pairs of the bucket reaches.

    Compares with all fingerprints not yet reached, or, in crowded deep buckets, looks up the
    987 fingerprints that differ in one to three of the 18 free bits, whichever is less.
    """
    free = np.bitwise_or.reduce(fp ^ fp[0])
    bits = tuple(i for i in range(64) if int(free) >> i & 1)
    if len(bits) <= 18 and len(fp) > 4096:
        return _by_flips(fp, _flips(bits))
    plain = key < DEEP and (key >> 32) % 32
    side = _side(key, fp) if plain else None                  # halves with and without the deleted bit
    left, right = [], []
    rest = np.arange(len(fp))
    wave = rest[:0]
    while len(rest):
        if not len(wave):
            wave, rest = rest[:1], rest[1:]
        source, wave = wave, []
        for i in source.tolist():
            if not len(rest):
                break
            near = np.bitwise_count(fp[rest] ^ fp[i]) <= MAX_BITS
            if plain:
                near &= side[rest] != side[i]
            if near.any():
                found = rest[near]
                left.append(np.full(len(found), fp[i]))
                right.append(fp[found])
                wave.append(found)
                rest = rest[~near]
        wave = np.concatenate(wave) if wave else rest[:0]
    a, b = (np.concatenate(left), np.concatenate(right)) if left else (fp[:0], fp[:0])
    return np.minimum(a, b), np.maximum(a, b)


def _side(key: int, fp: np.ndarray) -> np.ndarray:
    slot = key >> 32
    return (fp >> np.uint64(slot % 32 + (0 if slot < 32 else 32))) & np.uint64(1)


def _by_flips(fp: np.ndarray, flips: np.ndarray):
    """One pair per fingerprint reached, by looking up neighbours among the sorted fingerprints."""
    fp = np.sort(fp)
    new = np.ones(len(fp), bool)
    left, right = [], []
    start, wave = 0, np.zeros(0, np.int64)
    while True:
        if not len(wave):
            while start < len(fp) and not new[start]:
                start += 1
            if start == len(fp):
                break
            wave = np.array([start])
            new[start] = False
        reached = []
        for part in np.array_split(wave, len(wave) // 256 + 1):
            want = (fp[part][:, None] ^ flips[None, :]).ravel()
            at = np.minimum(np.searchsorted(fp, want), len(fp) - 1)
            hit = np.flatnonzero((fp[at] == want) & new[at])
            found, first = np.unique(at[hit], return_index=True)
            new[found] = False
            left.append(fp[part][hit[first] // len(flips)])
            right.append(fp[found])
            reached.append(found)
        wave = np.concatenate(reached)
    a, b = np.concatenate(left), np.concatenate(right)
    return np.minimum(a, b), np.maximum(a, b)


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bucket: int = BUCKET) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row; component_id: smallest doc_id reachable by links."""
    prints = stored(fingerprints(docs, doc_id, text), "fingerprints")
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes", rebalance=True)
    parts = connected_components(near_pairs(classes.select("fp"), bucket))
    labels = classes.join(parts.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    ids = labels.groupBy("component").agg(F.min("least").alias("component_id"))
    labels = stored(labels.join(ids, "component").select("fp", "component_id"), "labels", rebalance=True)
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return lookup_join(prints, labels, ["fp"]).select("doc_id", hexed, "component_id")
