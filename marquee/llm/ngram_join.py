"""N-gram Jaccard join: T-occurrence search with DivideSkip.

Documents are sets of word shingles. Two link when their sets are alike enough,
``100 * intersection >= percent * union``; the join returns the linked groups.

1. Equal sets are one class (a digest of the set). Only classes are searched.
2. Inverted index: tasks send packed postings (shingle, class) by shingle. A shingle
   that one class alone holds has no list and is dropped: it can match nothing.
3. Back at the class the remaining shingles are put in one global order, rarest
   first. Classes that link must share one of their first ``n - T + 1`` shingles
   (T: least overlap; dropped ones come first). Chains of such shared shingles split
   the classes into families; no link leaves a family.
4. Within a family a T-occurrence search runs for every class: of its inverted lists,
   DivideSkip sets the L longest aside, merges the short ones (a heap; many entries are
   merged by sorting), keeps classes that occur in at least T - L of them, and probes the
   long lists for these by binary search. Where only components are asked for, classes
   already connected are skipped, so a dense group costs one chain of links, not all its
   pairs. With ``count_links`` nothing is skipped: every linked pair is found and counted at
   both of its classes, weighted by their rows, and what leaves a task is one count per class.

A family of more postings than ``unit_postings`` is searched in blocks: first each
block in itself; then every class outside the family's largest group so far against
all blocks, in bounded chunks. That leaves no pair untested but those already
connected. With ``count_links`` all blocks of a large family are searched against each
other. A shingle held by more than ``hot_rows`` classes never has its list in
one place; it goes straight to its classes, last in the order.

Exact but for 64-bit hashes: of n distinct texts about n^2 / 2^65 pairs share an id.

Defined results: null text and text without words have no shingle, link with nothing
and are their own component; rows with equal doc_id are separate documents whose
component is found by their text; a component with null ids only has a null id; extra
columns pass through, and columns named like a result are replaced.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import arrow_map, blocks, lookup_join, merged, stored
from marquee.llm.components import connected_components
from marquee.llm.shingles import Shingler

SIZE = 5
PERCENT = 75
BLOCK_BYTES = 2 << 20        # text shingled at once
TASK_POSTINGS = 1_000_000    # postings a task sorts and sends at once
BUCKET_POSTINGS = 1_000_000  # postings of one bucket of the inverted index
UNIT_POSTINGS = 4_000_000    # postings of one family searched in one task
HOT_ROWS = 200_000
HEAP_ENTRIES = 256           # list entries merged by a heap; more are merged by sorting
MU = 0.0085                  # DivideSkip: weight of the longest list in the choice of L
LOW48 = np.uint64((1 << 48) - 1)


def class_id(shingles: np.ndarray) -> int:
    """Signed 64-bit id of a set (its digest)."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


# -- 1. classes ---------------------------------------------------------------------------

def _class_rows(batches: Iterator[pa.RecordBatch], text: str, keep: list[str], size: int) -> Iterator[pa.RecordBatch]:
    shingler = Shingler(size)
    for block in blocks(batches, text, BLOCK_BYTES):
        sets = shingler.sets(block.column(block.schema.names.index(text)).to_pylist())
        ids = pa.array([class_id(s) if len(s) else None for s in sets], pa.int64())
        counts = pa.array([len(s) for s in sets], pa.int64())
        yield pa.RecordBatch.from_arrays([*(block.column(c) for c in keep), counts, ids],
                                         names=[*keep, "n_shingles", "_class"])


# -- 2. inverted index --------------------------------------------------------------------

def _postings(batches: Iterator[pa.RecordBatch], text: str, size: int, buckets: int, hot) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, data): packed postings of one block of texts for one bucket.

    data: u32 number of classes k, u32 number of postings m, k class ids, m x u16 class
    numbers, m x (u32 + u16) lower 48 bits of the shingle. Bucket -1 - b holds postings of hot
    shingles for class bucket b, as ``_kept`` writes them.
    """
    shingler = Shingler(size)
    seen: set[int] = set()
    hot = np.sort(hot.value)
    sets: dict[int, np.ndarray] = {}
    held = 0
    for block in blocks(batches, text, BLOCK_BYTES):
        for s in shingler.sets(block.column(block.schema.names.index(text)).to_pylist()):
            if len(s) and (c := class_id(s)) not in seen:
                seen.add(c)
                sets[c] = s
                held += len(s)
            if held >= TASK_POSTINGS or len(sets) >= 60_000:       # classes are numbered by 16 bits
                yield _packed(sets, buckets, hot)
                sets, held = {}, 0
        if len(seen) > 500_000:
            seen.clear()
    if sets:
        yield _packed(sets, buckets, hot)


def _packed(sets: dict[int, np.ndarray], buckets: int, hot: np.ndarray) -> pa.RecordBatch:
    ids = np.fromiter(sets, np.int64, len(sets))
    value = np.concatenate(list(sets.values()))
    owner = np.repeat(np.arange(len(ids), dtype=np.uint16), [len(s) for s in sets.values()])
    rows = []
    if len(hot):
        at = np.minimum(np.searchsorted(hot, value), len(hot) - 1)
        is_hot = hot[at] == value
        rows += _kept(ids[owner[is_hot]], (np.uint64(1 << 63) | (value[is_hot] >> np.uint64(1))),
                      np.full(is_hot.sum(), 65535, np.uint16), buckets, sign=-1)
        value, owner = value[~is_hot], owner[~is_hot]
    order = np.argsort(value)
    value, owner = value[order], owner[order]
    cuts = np.searchsorted(_bucket(value, buckets), np.arange(buckets + 1)).tolist()
    for b, (i, j) in enumerate(zip(cuts, cuts[1:])):
        if j > i:
            used, number = np.unique(owner[i:j], return_inverse=True)
            low = value[i:j] & LOW48
            rows.append((b, b"".join((
                np.array([len(used), j - i], np.uint32).tobytes(), ids[used].tobytes(),
                number.astype(np.uint16).tobytes(), (low >> np.uint64(16)).astype(np.uint32).tobytes(),
                low.astype(np.uint16).tobytes()))))
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                       pa.array([r[1] for r in rows], pa.binary())], names=["bucket", "data"])


def _bucket(value: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of a shingle by its upper 16 and its following 16 bits (ascending in the value)."""
    return ((value >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _read_postings(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Class id and 48-bit shingle of each posting."""
    k, m = np.frombuffer(data, np.uint32, 2).tolist()
    ids = np.frombuffer(data, np.int64, k, 8)
    at = 8 + 8 * k
    number = np.frombuffer(data, np.uint16, m, at)
    high = np.frombuffer(data, np.uint32, m, at + 2 * m).astype(np.uint64)
    low = np.frombuffer(data, np.uint16, m, at + 6 * m).astype(np.uint64)
    return ids[number], high << np.uint64(16) | low


def _kept(ids: np.ndarray, token: np.ndarray, often: np.ndarray, buckets: int, sign: int = 1) -> list[tuple[int, bytes]]:
    """Postings (class, token, list length) packed by bucket of the class: u32 classes k, u32
    postings m, k ids, k x u32 counts, m x u64 tokens, m x u16 lengths."""
    bucket = (ids.view(np.uint64) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((ids, bucket))
    ids, token, often, bucket = ids[order], token[order], often[order], bucket[order]
    out = []
    cuts = np.searchsorted(bucket, np.arange(buckets + 1)).tolist()
    for b, (i, j) in enumerate(zip(cuts, cuts[1:])):
        if j > i:
            used, n = np.unique(ids[i:j], return_counts=True)
            out.append((b if sign > 0 else -1 - b, b"".join((
                np.array([len(used), j - i], np.uint32).tobytes(), used.tobytes(), n.astype(np.uint32).tobytes(),
                token[i:j].tobytes(), often[i:j].tobytes()))))
    return out


def _lists(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Packed postings sorted by bucket -> packed postings of shingles that two classes or
    more hold, by class bucket. A shingle's token is its bucket and its number there."""
    def rows():
        for batch in batches:
            yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())

    for bucket, group in groupby(rows(), key=lambda r: r[0]):
        if bucket < 0:
            out = [(-1 - bucket, data) for _, data in group]
        else:
            ids, value = (np.concatenate(x) for x in zip(*(_read_postings(data) for _, data in group)))
            order = np.lexsort((ids, value))
            ids, value = ids[order], value[order]
            new = np.concatenate(([True], value[1:] != value[:-1]))
            fresh = new | np.concatenate(([True], ids[1:] != ids[:-1]))     # a class sent by two tasks counts once
            ids, number = ids[fresh], (np.cumsum(new) - 1)[fresh]
            length = np.bincount(number)[number]
            many = length > 1
            out = _kept(ids[many], (np.uint64(bucket) << np.uint64(32)) | number[many].astype(np.uint64),
                        np.minimum(length[many], 65535).astype(np.uint16), buckets)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int32()),
                                              pa.array([r[1] for r in out], pa.binary())], names=["bucket", "data"])


# -- 3. prefixes --------------------------------------------------------------------------

SETS = "_class long, n long, tokens binary, prefix int"


def least_overlap(n: int, percent: int) -> int:
    """T: shingles that a set of n shares at least with any set it links to."""
    return -(-percent * n // 100)


def _prefixes(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, data, sizes) sorted by bucket -> one row per class that has a shared
    shingle in its prefix: its shared tokens, rarest first, and how many belong to the prefix.

    ``sizes`` rows hold (id, n) pairs of the classes of the bucket.
    """
    def rows():
        for batch in batches:
            yield from zip(*(batch.column(i).to_pylist() for i in range(3)))

    for _, group in groupby(rows(), key=lambda r: r[0]):
        ids, tokens, often, size = [], [], [], {}
        for _, data, pairs in group:
            if data is None:
                a = np.frombuffer(pairs, np.int64).reshape(-1, 2)
                size.update(zip(a[:, 0].tolist(), a[:, 1].tolist()))
                continue
            k, m = np.frombuffer(data, np.uint32, 2).tolist()
            own = np.frombuffer(data, np.int64, k, 8)
            ids.append(np.repeat(own, np.frombuffer(data, np.uint32, k, 8 + 8 * k)))
            tokens.append(np.frombuffer(data, np.uint64, m, 8 + 12 * k))
            often.append(np.frombuffer(data, np.uint16, m, 8 + 12 * k + 8 * m))
        if not ids:
            continue
        ids, tokens, often = (np.concatenate(x) for x in (ids, tokens, often))
        order = np.lexsort((tokens, often, ids))
        ids, tokens = ids[order], tokens[order]
        cuts = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1]))).tolist()
        out = []
        for i, j in zip(cuts, [*cuts[1:], len(ids)]):
            c = int(ids[i])
            own = tokens[i:j]
            if len(own) > 1 and (own[1:] == own[:-1]).any():      # a hot posting sent by two tasks
                own = own[np.sort(np.unique(own, return_index=True)[1])]
            n = size[c]
            prefix = n - least_overlap(n, percent) + 1 - (n - len(own))
            if prefix > 0:
                out.append((c, n, own.tobytes(), min(prefix, len(own))))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (
                pa.int64(), pa.int64(), pa.binary(), pa.int32()))], names=["_class", "n", "tokens", "prefix"])


def _prefix_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        d = batch.to_pydict()
        firsts = [np.frombuffer(t, np.int64, p) for t, p in zip(d["tokens"], d["prefix"])]
        if firsts:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(d["_class"], np.int64), [len(f) for f in firsts])),
                 pa.array(np.concatenate(firsts))], names=["_class", "token"])


# -- 4. T-occurrence search ---------------------------------------------------------------

class Lists:
    """Inverted lists of some sets: token -> ascending numbers of the sets that hold it."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray):
        self.sizes = sizes
        token = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(token, kind="stable")
        token, self.owner = token[order], owner[order]
        self.start = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
        self.token = token[self.start]
        self.end = np.append(self.start[1:], len(token))

    def search(self, tokens: np.ndarray, n: int, percent: int, wanted) -> np.ndarray:
        """Numbers of the sets that link to the set of ``tokens`` (of size ``n``), among those for which
        ``wanted(numbers)`` is true."""
        at = np.searchsorted(self.token, tokens)
        at = at[np.flatnonzero(self.token[np.minimum(at, len(self.token) - 1)] == tokens)]
        least = least_overlap(n, percent)
        if len(at) < least:
            return at[:0]
        length = self.end[at] - self.start[at]
        at = at[np.argsort(length, kind="stable")]
        longest = int(length.max())
        aside = min(least - 1, int(least / (MU * math.log2(longest + 1) + 1)))
        short, long = at[:len(at) - aside], at[len(at) - aside:]
        found, count = self._merge([self.owner[self.start[i]:self.end[i]] for i in short])
        enough = count >= least - aside
        found, count = found[enough], count[enough]
        other = self.sizes[found]
        ok = (100 * other >= percent * n) & (100 * n >= percent * other) & wanted(found)
        found, count, other = found[ok], count[ok], other[ok]
        need = -(-percent * (n + other) // (100 + percent))
        for k, i in enumerate(long):
            alive = count + len(long) - k >= need
            if not alive.all():
                found, count, need = found[alive], count[alive], need[alive]
            if not len(found):
                break
            one = self.owner[self.start[i]:self.end[i]]
            probe = np.minimum(np.searchsorted(one, found), len(one) - 1)
            count = count + (one[probe] == found)
        return found[count >= need]

    @staticmethod
    def _merge(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Distinct numbers of the lists, and in how many lists each stands."""
        if sum(map(len, lists)) <= HEAP_ENTRIES:
            merged = [(x, sum(1 for _ in g)) for x, g in groupby(heapq.merge(*(x.tolist() for x in lists)))]
            return np.array([x for x, _ in merged], np.int64), np.array([c for _, c in merged], np.int64)
        return np.unique(np.concatenate(lists), return_counts=True)


class Groups:
    """Union of sets with an array of labels; the smaller group is relabelled."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.members = {i: [i] for i in range(n)}

    def join(self, a: int, b: int) -> None:
        a, b = int(self.label[a]), int(self.label[b])
        if a == b:
            return
        if len(self.members[a]) < len(self.members[b]):
            a, b = b, a
        moved = self.members.pop(b)
        self.label[moved] = a
        self.members[a].extend(moved)


def _search_units(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (unit, query, _class, n, tokens) sorted by unit, query -> links (a, b) that connect
    what is linked. A unit without query rows is searched in itself, else its query rows
    are searched in the others."""
    def rows():
        for batch in batches:
            yield from zip(*(batch.column(i).to_pylist() for i in range(5)))

    links: list[tuple[int, int]] = []
    for _, group in groupby(rows(), key=lambda r: r[0]):
        inside, asked = [], []
        for _, query, c, n, tokens in group:
            (asked if query else inside).append((c, n, np.frombuffer(tokens, np.uint64)))
        if not inside or len(inside) + len(asked) < 2:
            continue
        links += _links(inside, asked, percent)
        if len(links) > 10_000:
            yield _link_batch(links)
            links = []
    if links:
        yield _link_batch(links)


def _link_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*links)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _links(inside: list, asked: list, percent: int) -> list[tuple[int, int]]:
    sizes = np.array([n for _, n, _ in inside], np.int64)
    lists = Lists([t for _, _, t in inside], sizes)
    out: list[tuple[int, int]] = []
    if asked:
        for c, n, tokens in asked:
            hits = lists.search(tokens, n, percent, lambda found: np.ones(len(found), bool))
            out += [(c, inside[i][0]) for i in hits.tolist() if inside[i][0] != c]
        return out
    groups = Groups(len(inside))
    for q, (c, n, tokens) in enumerate(inside):
        for i in lists.search(tokens, n, percent, lambda found: groups.label[found] != groups.label[q]).tolist():
            if groups.label[i] != groups.label[q]:
                groups.join(q, i)
                out.append((c, inside[i][0]))
    return out


def _count_units(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (unit, query, _class, n, tokens, w) sorted by unit, query -> links (a, b, null) that
    connect what is linked, and counts (a, null, n) of the rows that class a links to in the unit."""
    def rows():
        for batch in batches:
            yield from zip(*(batch.column(i).to_pylist() for i in range(6)))

    for _, group in groupby(rows(), key=lambda r: r[0]):
        inside, asked = [], []
        for _, query, c, n, tokens, w in group:
            (asked if query else inside).append((c, n, np.frombuffer(tokens, np.uint64), w))
        if not inside or len(inside) + len(asked) < 2:
            continue
        ids = np.array([r[0] for r in inside], np.int64)
        weight = np.array([r[3] for r in inside], np.int64)
        lists = Lists([r[2] for r in inside], np.array([r[1] for r in inside], np.int64))
        number = {c: i for i, c in enumerate(ids.tolist())}
        groups = Groups(len(inside) + len(asked))
        out: list[tuple] = []
        for k, (c, n, tokens, _) in enumerate(asked or inside):
            q = number.get(c, len(inside) + k)
            hits = lists.search(tokens, n, percent, lambda found: ids[found] != c)
            if len(hits):
                out.append((c, None, int(weight[hits].sum())))
            for i in hits[groups.label[hits] != groups.label[q]].tolist():
                if groups.label[i] != groups.label[q]:
                    groups.join(q, i)
                    out.append((c, int(ids[i]), None))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=["a", "b", "n"])


# -- the join -----------------------------------------------------------------------------

def hot_shingles(docs: DataFrame, text: str, size: int, above: float, sample: int = 64) -> np.ndarray:
    """Shingles that more than about ``above`` texts hold, from every ``sample``-th text (by a hash of it)."""
    some = docs.filter(F.pmod(F.xxhash64(text), F.lit(sample)) == 0).select(text)

    def rows(batches):
        shingler = Shingler(size)
        for block in blocks(batches, text, BLOCK_BYTES):
            for s in shingler.sets(block.column(0).to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(s.view(np.int64))], names=["h"])

    often = (arrow_map(some, rows, "h long").groupBy("h").count()
             .filter(F.col("count") > above / sample).select("h"))
    return np.array([r[0] for r in often.collect()], np.int64).view(np.uint64)


def links(classes: DataFrame, docs: DataFrame, text: str, size: int, percent: int, unit_postings: int,
          hot_rows: int, count_links: bool = False) -> DataFrame:
    """Links (a, b) between classes, enough to connect all that are linked. ``count_links``:
    rows (a, b, n), beside the links (n null) counts of linked rows (b null) as ``_count_units`` has them."""
    spark = docs.sparkSession
    sizes = classes.filter("n_shingles > 0").groupBy("_class").agg(F.first("n_shingles").alias("n"))
    sizes = stored(sizes, "class-sizes", rebalance=True)
    n_classes, total = sizes.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    buckets = int(max(1, -(-total // BUCKET_POSTINGS), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    # At most a million shingles are hot, so the list of them is bounded.
    above = max(hot_rows, total / 1_000_000)
    hot = hot_shingles(docs, text, size, above) if n_classes > above else np.zeros(0, np.uint64)
    shared = spark.sparkContext.broadcast(hot)
    packed = "bucket int, data binary"
    postings = arrow_map(docs.select(text), lambda it: _postings(it, text, size, buckets, shared), packed)
    lists = arrow_map(postings.repartition(buckets, "bucket").sortWithinPartitions("bucket"),
                      lambda it: _lists(it, buckets), packed)
    pairs = arrow_map(sizes.select("_class", "n"), lambda it: _size_rows(it, buckets),
                      "bucket int, data binary, sizes binary")
    by_class = lists.withColumn("sizes", F.lit(None).cast("binary")).unionByName(pairs)
    sets = arrow_map(by_class.repartition(buckets, "bucket").sortWithinPartitions("bucket"),
                     lambda it: _prefixes(it, percent), SETS)
    sets = stored(sets, "class-tokens", rebalance=True)

    prefix = arrow_map(sets.select("_class", "tokens", "prefix"), _prefix_rows, "_class long, token long")
    heads = prefix.groupBy("token").agg(F.min("_class").alias("b"), F.count("*").alias("k")).filter("k > 1")
    edges = prefix.join(merged(heads), "token").filter("_class <> b").select(F.col("_class").alias("a"), "b").distinct()
    family = connected_components(edges)                      # node, component; families of two or more
    members = stored(sets.join(family.withColumnRenamed("node", "_class"), "_class")
                     .select("_class", "n", "tokens", F.col("component").alias("family")), "families", rebalance=True)
    weight = F.octet_length("tokens") / 8
    large = (members.groupBy("family").agg(F.sum(weight).alias("w")).filter(F.col("w") > unit_postings)
             .select("family", F.ceil(F.col("w") / unit_postings).cast("int").alias("parts")))
    rows = lookup_join(members, large, ["family"])
    part = F.pmod(F.xxhash64("_class"), F.coalesce("parts", F.lit(1)))
    if count_links:
        weights = classes.filter("_class IS NOT NULL").groupBy("_class").agg(F.count("*").alias("w"))
        return stored(_counted(rows.join(merged(weights, n_classes), "_class"), part, percent, buckets), "links", rebalance=True)
    unit = rows.select(F.concat_ws(":", "family", part).alias("unit"), F.lit(False).alias("query"),
                       "_class", "n", "tokens")
    found = stored(_searched(unit, percent, buckets), "links", rebalance=True)
    if large.isEmpty():
        return found
    return found.unionByName(_links_across(lookup_join(members, large, ["family"], "inner"), found, percent,
                                           unit_postings, buckets))


def _size_rows(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, n = (batch.column(i).to_numpy() for i in range(2))
        bucket = (ids.view(np.uint64) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        pairs = np.stack([ids[order], n[order]], 1)
        held, cuts = np.unique(bucket[order], return_index=True)
        data = [pairs[i:j].tobytes() for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), None])]
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.nulls(len(held), pa.binary()), pa.array(data, pa.binary())],
                                         names=["bucket", "data", "sizes"])


def _searched(unit: DataFrame, percent: int, partitions: int) -> DataFrame:
    dealt = unit.repartition(partitions, "unit").sortWithinPartitions("unit", "query")
    return arrow_map(dealt, lambda it: _search_units(it, percent), "a long, b long")


def _counted(rows: DataFrame, part, percent: int, partitions: int) -> DataFrame:
    """All blocks of each family searched against each other; a family of one block in itself."""
    columns = ["_class", "n", "tokens", "w"]
    many = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))
    held = rows.withColumn("c", many).select(F.concat_ws(":", "family", part, "c").alias("unit"),
                                             F.lit(False).alias("query"), *columns)
    asked = rows.filter("parts > 1").withColumn("p", many).select(
        F.concat_ws(":", "family", "p", part).alias("unit"), F.lit(True).alias("query"), *columns)
    dealt = held.unionByName(asked).repartition(partitions, "unit").sortWithinPartitions("unit", "query")
    return arrow_map(dealt, lambda it: _count_units(it, percent), "a long, b long, n long")


def _links_across(members: DataFrame, found: DataFrame, percent: int, unit_postings: int,
                  partitions: int) -> DataFrame:
    """Links of large families between their blocks: classes outside the largest group of
    their family are searched in every block of it."""
    groups = connected_components(found).withColumnRenamed("node", "_class")
    rows = stored(members.join(groups, "_class", "left").withColumn("component", F.coalesce("component", "_class")),
                  "large-members")
    sizes = rows.groupBy("family", "component").agg(F.count("*").alias("k"))
    largest = stored(sizes.groupBy("family").agg(F.max(F.struct("k", "component"))["component"].alias("largest")),
                     "largest-groups")
    outside = lookup_join(rows, largest, ["family"], "inner").filter("component <> largest")
    chunks = stored(outside.groupBy("family").agg(
        F.ceil(F.sum(F.octet_length("tokens") / 8) / unit_postings).cast("int").alias("chunks")), "chunks")
    chunk = F.pmod(F.xxhash64("_class", F.lit("chunk")), F.col("chunks"))
    part = F.pmod(F.xxhash64("_class"), F.col("parts"))
    columns = ["_class", "n", "tokens"]
    held = (lookup_join(rows, chunks, ["family"], "inner")
            .withColumn("c", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .select(F.concat_ws(":", "family", part, "c").alias("unit"), F.lit(False).alias("query"), *columns))
    asked = (lookup_join(outside, chunks, ["family"], "inner")
             .withColumn("p", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select(F.concat_ws(":", "family", "p", chunk).alias("unit"), F.lit(True).alias("query"), *columns))
    return stored(_searched(held.unionByName(asked), percent, partitions), "links-across")


def link_groups(df: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, percent: int = PERCENT,
                unit_postings: int = UNIT_POSTINGS, hot_rows: int = HOT_ROWS, count_links: bool = False,
                group: str | None = None) -> DataFrame:
    """One row per row of ``df``: its columns without the text, n_shingles (long) and component_id:
    the smallest ``doc_id`` that its links reach, its own included. ``count_links``: also n_links
    (long), the number of other rows it links to; rows with equal sets link. ``group``: also a column of
    that name, a long equal for rows of one group only (ids may repeat); null for a row that is alone."""
    results = ("n_shingles", "component_id", *(["n_links"] if count_links else []), *([group] if group else []))
    keep = [c for c in df.columns if c not in (text, "_class", *results)]
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep),
                        "n_shingles long", "_class long"])
    rows = stored(arrow_map(df.select(*keep, text), lambda it: _class_rows(it, text, keep, size), schema), "classes",
                  rebalance=True)
    found = links(rows, df, text, size, percent, unit_postings, hot_rows, count_links)
    if count_links:
        counts = found.filter("b IS NULL").groupBy(F.col("a").alias("_class")).agg(F.sum("n").alias("_linked"))
        found = found.filter("b IS NOT NULL").select("a", "b")
    groups = connected_components(found).withColumnRenamed("node", "_class")
    classes = rows.filter("_class IS NOT NULL").groupBy("_class").agg(
        F.min(doc_id).alias("_least"), F.count("*").alias("_rows"))
    classes = classes.join(groups, "_class", "left").filter("_rows > 1 OR component IS NOT NULL")
    classes = classes.withColumn("_group", F.coalesce("component", "_class"))
    least = classes.groupBy("_group").agg(F.min("_least").alias("component_id"))
    shared = classes.join(least, "_group")
    if count_links:
        shared = shared.join(merged(counts), "_class", "left").withColumn(
            "n_links", F.col("_rows") - 1 + F.coalesce("_linked", F.lit(0)))
    if group:
        shared = shared.withColumn(group, F.col("_group"))
    shared = stored(shared.select("_class", *results[1:]), "class-components", rebalance=True)
    # Rows without a class would be one hot null key of the join: they stand aside.
    linked = lookup_join(rows.filter("_class IS NOT NULL"), shared, ["_class"])
    alone = rows.filter("_class IS NULL").withColumn("component_id", F.lit(None).cast(df.schema[doc_id].dataType))
    out = linked.unionByName(alone, allowMissingColumns=True).withColumn(
        "component_id", F.coalesce("component_id", doc_id))
    if count_links:
        out = out.withColumn("n_links", F.coalesce("n_links", F.lit(0).cast("long")))
    return out.select(*keep, *results)
