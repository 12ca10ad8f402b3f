"""Exact integer k-means with bounded search (Shallot).

Every vector remembers its centroid, the second nearest one, an upper bound of the distance to the
first and a lower bound of the distance to all others. Where the bounds (or half the distance to
the centroid's nearest neighbour) leave no doubt, nothing is computed. Otherwise the two remembered
centroids are measured, the search starts from the closer one and walks through its neighbours by
growing distance, as far as they lie within the ball whose radius is the distance to that centroid
plus the distance to the second nearest found so far; the ball shrinks with every better one found.
Distances are exact integers, bounds are doubles rounded to the safe side, so ties (smaller number
wins) come out as in a full comparison.

Vectors travel as blocks of ``BLOCK_ROWS`` rows. A round is one map over the blocks, cached with the
bounds it leaves (spilled to disk where memory is short; a lost block is computed anew from the
stored vectors), and one sum of counts and components by cluster: k * (1 + 64) numbers reach the driver.

Defined results: vectors that are null, have another number of components, or a null or non-finite
one are left out; repeated rows count each; a null id is kept, but is never a first centroid; with
fewer kept ids than k there are as many centroids, with none an empty result. Vectors beyond
``SMALL`` in size are compared with every centroid in unbounded integers; a distance or sum of
distances beyond a long is null. Other columns are not returned, so none can clash.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import arrow_map, stored

DIM = 64
K = 8
ROUNDS = 10
SCALE = 1024
BLOCK_ROWS = 4096
SMALL = 1 << 27           # below, squared distances of 64 components fit a long
LIMB = 48
LONG = (1 << 63) - 1

VECTORS = "ids binary, named binary, wide boolean, comps binary"
STATE = VECTORS + ", near binary, second binary, upper binary, lower binary, sums array<long>"


def kept_vectors(vectors: DataFrame, vec_id: str, embedding: str, dim: int) -> DataFrame:
    """(vec_id, embedding) of vectors with exactly ``dim`` finite components."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"),
                          F.col(embedding).cast("array<double>").alias("embedding"))
    return rows.filter((F.size("embedding") == dim) & fine)


def first_centroids(kept: DataFrame, k: int, seed: int) -> list[list[int]]:
    """Integers of the ``k`` vectors with the smallest hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.filter("vec_id IS NOT NULL").orderBy(digest, "embedding").limit(k).select("embedding").collect()
    return [[_integer(x) for x in r.embedding] for r in rows]


def _integer(x: float) -> int:
    """floor(SCALE * x), also where the product leaves the doubles."""
    return int(np.floor(x * SCALE)) if abs(x) < 2.0**900 else int(x) * SCALE


def blocks_of(kept: DataFrame, dim: int) -> DataFrame:
    """Kept vectors as blocks of integers."""
    def run(batches):
        for batch in _grouped(batches):
            ids = batch.column(0)
            real = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            named = ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8)
            whole = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            big = (np.abs(real) * SCALE >= SMALL).any(axis=1)
            for wide in (False, True):
                at = np.flatnonzero(big == wide)
                if len(at):
                    comps = _pack([[_integer(x) for x in row] for row in real[at].tolist()] if wide
                                  else np.floor(real[at] * SCALE).astype(np.int64), wide)
                    yield pa.RecordBatch.from_pylist([{"ids": whole[at].tobytes(), "named": named[at].tobytes(),
                                                       "wide": wide, "comps": comps}], schema=_arrow(VECTORS))

    return arrow_map(kept, run, VECTORS)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"binary": pa.binary(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "long": pa.int64(),
             "int": pa.int32(), "string": pa.string()}
    return pa.schema([(n, kinds[t]) for n, t in (c.split() for c in schema.split(", "))])


def _grouped(batches):
    """Arrow batches joined and cut to at most ``BLOCK_ROWS`` rows."""
    held, n = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, BLOCK_ROWS - n)
            held.append(part)
            n += part.num_rows
            batch = batch.slice(part.num_rows)
            if n == BLOCK_ROWS:
                yield pa.concat_batches(held)
                held, n = [], 0
    if n:
        yield pa.concat_batches(held)


def _pack(comps, wide: bool) -> bytes:
    if wide:
        return json.dumps(comps).encode()
    least = next(t for t in (np.int16, np.int32) if len(comps) == 0 or (np.abs(comps).max() <= np.iinfo(t).max))
    return bytes([np.dtype(least).itemsize]) + comps.astype(least).tobytes()


def _unpack(comps: bytes, wide: bool, dim: int) -> np.ndarray:
    if wide:
        return np.array(json.loads(comps), dtype=object).reshape(-1, dim)
    return np.frombuffer(comps, f"i{comps[0]}", offset=1).reshape(-1, dim).astype(np.int64)


def _square(rows: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Exact squared distances between rows of integers."""
    diff = rows - other
    return (diff * diff).sum(axis=1) if diff.dtype == object else np.einsum("ij,ij->i", diff, diff)


def _above(square: np.ndarray) -> np.ndarray:
    return np.sqrt(square.astype(float)) * (1 + 1e-15)


def _below(square: np.ndarray) -> np.ndarray:
    return np.sqrt(square.astype(float)) * (1 - 1e-15)


@dataclass
class Centroids:
    """Centroids of a round, their neighbours by distance, and how far each has moved since the last round."""

    comps: list[list[int]]
    moved: list[float]

    @classmethod
    def of(cls, comps: list[list[int]], before: list[list[int]] | None = None) -> Centroids:
        wide = _is_wide(comps) or (before is not None and _is_wide(before))
        if before is None or wide:
            return cls(comps, [0.0] * len(comps))
        return cls(comps, _above(_square(np.array(comps), np.array(before))).tolist())

    def tables(self):
        """The centroids as an array, and for each the others by distance with their distances."""
        wide = _is_wide(self.comps)
        comps = np.array(self.comps, dtype=object if wide else np.int64)
        k = len(comps)
        if wide:
            return comps, None, None
        apart = np.stack([_square(comps, c) for c in comps])
        order = np.argsort(apart, axis=1, kind="stable")
        order = np.stack([order[i][order[i] != i] for i in range(k)]).reshape(k, k - 1)
        return comps, order, _below(np.take_along_axis(apart, order, axis=1))


def _is_wide(comps) -> bool:
    return any(abs(x) >= SMALL for c in comps for x in c)


def search(rows, centroids: Centroids, near, second, upper, lower):
    """New (near, second, upper, lower) of a block, the bounds being those after the centroids' move."""
    comps, order, apart = centroids.tables()
    k = len(comps)
    if rows.dtype == object or comps.dtype == object:
        square = np.stack([_square(rows.astype(object), c.astype(object)) for c in comps], axis=1)
        near = np.array([min(range(k), key=lambda j, s=s: (s[j], j)) for s in square], np.int32)
        return near, near.copy(), np.full(len(rows), np.inf), np.zeros(len(rows))
    near, second, upper, lower = near.copy(), second.copy(), upper.copy(), lower.copy()
    if k == 1:
        return near, second, np.zeros(len(rows)), np.full(len(rows), np.inf)
    clear = np.maximum(lower, apart[near, 0] / 2)
    at = np.flatnonzero(~(upper < clear))
    best = _square(rows[at], comps[near[at]])
    upper[at] = _above(best)
    open_ = ~(upper[at] < clear[at])
    at, best = at[open_], best[open_]
    # A block without history has equal near and second: its second is the centroid's next neighbour.
    a, b = near[at], np.where(second[at] == near[at], order[near[at], 0], second[at])
    other = _square(rows[at], comps[b])
    swap = (other < best) | ((other == best) & (b < a))
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    best, other = np.where(swap, other, best), np.where(swap, best, other)
    home, known = a.copy(), b.copy()
    reach = _above(best)
    live = np.arange(len(at))
    for step in range(k - 1):
        live = live[apart[home[live], step] <= (reach[live] + _above(other[live])) * (1 + 1e-15)]
        if not len(live):
            break
        j = order[home[live], step]
        new = j != known[live]
        i, j = live[new], j[new]
        square = _square(rows[at[i]], comps[j])
        first = (square < best[i]) | ((square == best[i]) & (j < a[i]))
        runner = ~first & (square < other[i])
        up, mid = i[first], i[runner]
        other[up], b[up] = best[up], a[up]
        best[up], a[up] = square[first], j[first]
        other[mid], b[mid] = square[runner], j[runner]
    near[at], second[at], upper[at], lower[at] = a, b, _above(best), _below(other)
    return near, second, upper, lower


def _moved(centroids: Centroids, near, upper, lower):
    """Bounds after the centroids' move."""
    moved = np.array(centroids.moved)
    most = np.array([max((m for j, m in enumerate(centroids.moved) if j != i), default=0.0) for i in range(len(moved))])
    return (upper + moved[near]) * (1 + 1e-15), lower - most[near] - np.abs(lower) * 1e-15 - most[near] * 1e-15


def _limbs(total) -> list[list[int]]:
    """Integers as lists of longs, lowest 48 bits first; one list where all are small."""
    if all(abs(t) < 1 << 62 for t in total):
        return [[int(t) for t in total]]
    n = max(abs(t) for t in total).bit_length() // LIMB + 1
    return [[int(t >> LIMB * i) if i == n - 1 else int(t >> LIMB * i) & ((1 << LIMB) - 1) for t in total] for i in range(n)]


def _totals(rows, near, k: int) -> list[int]:
    """Counts by cluster, then the limbs of the component sums by cluster."""
    sums = [rows[near == j].sum(axis=0) if (near == j).any() else [0] * rows.shape[1] for j in range(k)]
    counts = np.bincount(near, minlength=k).tolist()
    return counts + [x for limb in _limbs([int(t) for s in sums for t in s]) for x in limb]


def _round(blocks: DataFrame, centroids: Centroids, dim: int, fresh: bool) -> DataFrame:
    """State of all blocks after one assignment."""
    k = len(centroids.comps)

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                rows = _unpack(r["comps"], r["wide"], dim)
                if fresh:
                    near, second = np.zeros(len(rows), np.int32), np.zeros(len(rows), np.int32)
                    upper, lower = np.full(len(rows), np.inf), np.zeros(len(rows))
                else:
                    near, second = np.frombuffer(r["near"], np.int32), np.frombuffer(r["second"], np.int32)
                    upper, lower = _moved(centroids, near, np.frombuffer(r["upper"]), np.frombuffer(r["lower"]))
                near, second, upper, lower = search(rows, centroids, near, second, upper, lower)
                yield pa.RecordBatch.from_pylist([{
                    **{c: r[c] for c in ("ids", "named", "wide", "comps")}, "near": near.astype(np.int32).tobytes(),
                    "second": second.astype(np.int32).tobytes(), "upper": upper.tobytes(), "lower": lower.tobytes(),
                    "sums": _totals(rows, near, k)}], schema=_arrow(STATE))

    return arrow_map(blocks, run, STATE)


def _means(state: DataFrame, comps: list[list[int]], dim: int) -> list[list[int]]:
    """Exact floored means by cluster; an empty cluster keeps its centroid."""
    k = len(comps)
    rows = (state.select(F.posexplode("sums").alias("at", "part")).groupBy("at")
            .agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect())
    found = {r["at"]: int(r["total"]) for r in rows}
    sums = [0] * (k * dim)
    for at, total in found.items():
        if at >= k:
            limb, i = divmod(at - k, k * dim)
            sums[i] += total << LIMB * limb
    return [[sums[j * dim + i] // found[j] for i in range(dim)] if found.get(j) else comps[j] for j in range(k)]


RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def clusters(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = 3, dim: int = DIM,
             vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector."""
    kept = kept_vectors(vectors, vec_id, embedding, dim)
    comps = first_centroids(kept, k, seed)
    spark = vectors.sparkSession
    if not comps:
        return spark.createDataFrame([], RESULT)
    blocks = stored(blocks_of(kept, dim), "vectors")
    centroids, state = Centroids.of(comps), blocks
    done = None
    for i in range(rounds):
        state = _round(state, centroids, dim, fresh=i == 0).persist(StorageLevel.MEMORY_AND_DISK)
        new = _means(state, comps, dim)
        if done is not None:
            done.unpersist()
        done = state
        if new == comps:                   # all further rounds would repeat this one
            break
        centroids, comps = Centroids.of(new, comps), new
    last = stored(_finished(_round(state, centroids, dim, fresh=rounds == 0), comps, dim), "clusters")
    if done is not None:
        done.unpersist()
    return _with_inertia(last, comps)


def _finished(state: DataFrame, comps: list[list[int]], dim: int) -> DataFrame:
    """(vec_id, cluster, distance) per vector; a distance beyond a long is null."""
    def run(batches):
        centres = np.array(comps, dtype=object if _is_wide(comps) else np.int64)
        for batch in batches:
            for r in batch.to_pylist():
                rows = _unpack(r["comps"], r["wide"], dim)
                near = np.frombuffer(r["near"], np.int32)
                square = [int(d) if d <= LONG else None for d in _square(rows, centres[near]).tolist()]
                ids = pa.array(np.frombuffer(r["ids"], np.int64), mask=np.frombuffer(r["named"], np.uint8) == 0)
                yield pa.RecordBatch.from_arrays([ids, pa.array(near), pa.array(square, pa.int64())],
                                                 ["vec_id", "cluster", "distance"])

    return arrow_map(state, run, "vec_id long, cluster int, distance long")


def _with_inertia(last: DataFrame, comps: list[list[int]]) -> DataFrame:
    """Adds the sums of distances and the centroids' digests, one small table of k rows."""
    exact = F.col("distance").cast("decimal(38,0)")
    sums = {r.cluster: r for r in last.groupBy("cluster").agg(
        F.sum(exact).alias("d"), F.bool_or(F.col("distance").isNull()).alias("gap")).collect()}
    per = {j: None if r.gap else int(r.d) for j, r in sums.items()}
    whole = None if None in per.values() else sum(per.values())
    fits = {j: d if d is not None and d <= LONG else None for j, d in per.items()}
    rows = [(j, fits.get(j), whole if whole is not None and whole <= LONG else None,
             hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(comps)]
    table = last.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return last.join(F.broadcast(table), "cluster").select(*(c.split()[0] for c in RESULT.split(", ")))
