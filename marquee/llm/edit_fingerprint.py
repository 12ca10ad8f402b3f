"""Document fingerprints: randomised edit embedding, bit sampling, banding, verification.

A pointer walks over the code points of a text. At step j it emits the code point
it stands on and moves on by a random bit that depends only on j and that code
point, so all texts share one random walk: after an insertion or deletion the
walks of the two texts soon stand at the same place again, and their edit distance
shows as the Hamming distance of what they emit. The walk covers the whole text.

The fingerprint samples the emitted string at ``SLOTS`` positions. Slot k takes
the position of lowest priority in k's own random order among the steps walked,
so that texts of about equal length sample the same positions. Each sample is
kept as 4 bits. The likeness of two fingerprints is the share of equal samples,
corrected for chance. Bands of consecutive samples find candidate pairs over all
documents, the likeness verifies every pair of a bucket that is not yet connected by
others, and connected components of the verified pairs are the classes of near copies.
Fingerprints are told apart by 64-bit hashes: of n about n^2 / 2^65 pairs share one.

Defined results: null text counts as empty; an empty text has the all-zero
fingerprint; equal texts have equal fingerprints; repeated rows each get theirs. ``fingerprint``
lets extra columns pass through and replaces one named like its result; ``with_edits`` and ``with_near_classes`` return
their own columns only, so none can clash. Rows of one id (null included) lie in one slice of the order.
"""

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import arrow_map, blocks, lookup_join, merged, stored
from marquee.llm.components import connected_components, tasks_for

SLOTS = 256
BANDS = 32                    # of SLOTS / BANDS samples each
WALK_BITS = 1 << 16           # size of the table of shared random bits
BLOCK_BYTES = 8 << 20         # text walked in step
LONGEST_WALK = 1 << 45        # steps; no text comes near
LOCKSTEP = 32                 # with fewer texts left, each walks on its own
PATIENCE = 32                 # steps between looks for texts that have ended


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Positions:
    """For each slot the steps at which its running minimum priority falls.

    Priorities are independent and uniform, so the falls of a slot can be drawn
    directly: after a minimum m the next lower priority comes a geometric number of
    steps later, and is uniform below m. ``at[j]`` lists the slots whose sample
    moves to step j.
    """

    def __init__(self):
        self.bits = np.random.default_rng(20240601).integers(0, 2, WALK_BITS, dtype=np.int64).astype(np.int8)
        at: dict[int, list[int]] = {}
        for slot in range(SLOTS):
            rng = np.random.default_rng([20240602, slot])
            step, low = 0, rng.random()
            while step < LONGEST_WALK:
                at.setdefault(step, []).append(slot)
                step += int(rng.geometric(low))
                low *= rng.random()
        self.at = {step: np.array(slots) for step, slots in at.items()}
        self.steps = sorted(at)

    def following(self, step: int) -> int:
        """The first sampling step at or after ``step``."""
        i = bisect_left(self.steps, step)
        return self.steps[i] if i < len(self.steps) else LONGEST_WALK


def _sample(step: int, chars: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """4-bit samples: rows are ``slots``, columns the texts."""
    key = (chars.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))[None, :] + _mix(
        np.uint64(step) * np.uint64(SLOTS) + slots.astype(np.uint64))[:, None]
    return (_mix(key) & np.uint64(15)).astype(np.uint8)


def walk(texts: list[str], positions: Positions) -> list[str]:
    """Fingerprint (SLOTS hex digits) of each text."""
    bits = positions.bits
    order = sorted(range(len(texts)), key=lambda i: len(texts[i]))   # the longest last
    flat = np.frombuffer("".join(texts[i] for i in order).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.array([len(texts[i]) for i in order], np.int64)
    end = np.cumsum(size)
    place = end - size
    # A code point's share of the table index: 16 bits, so that sums wrap at the table's end.
    spread = (flat * np.uint32(40503)).astype(np.uint16)
    samples = np.zeros((SLOTS, len(texts)), np.uint8)
    lane = np.flatnonzero(size > 0)                   # texts still walking
    place, end = place[lane], end[lane]
    step = 0
    # A text that has ended is looked for at sampling steps and every PATIENCE steps; until then it walks on harmlessly.
    spread = np.concatenate([spread, np.zeros(PATIENCE + 1, np.uint16)])
    at, move = np.empty(len(lane), np.uint16), np.empty(len(lane), np.int8)
    while True:
        slots = positions.at.get(step)
        if slots is not None or step % PATIENCE == 0:
            going = place < end
            if not going.all():
                lane, place, end = lane[going], place[going], end[going]
                at, move = at[:len(lane)], move[:len(lane)]
            if len(lane) < LOCKSTEP:
                break
            if slots is not None:
                samples[slots[:, None], lane[None, :]] = _sample(step, flat[place], slots)
        spread.take(place, out=at, mode="clip")
        np.add(at, np.uint16(step * 7919 & (WALK_BITS - 1)), out=at)
        bits.take(at, out=move, mode="clip")
        np.add(place, move, out=place)
        step += 1
    table = bits.tolist()
    for k, at, stop in zip(lane.tolist(), place.tolist(), end.tolist()):
        _walk_on(k, at, stop, step, flat, spread, table, samples, positions)
    digits = np.array(list("0123456789abcdef"))
    hexed = digits[samples.T]
    out: list[str] = [""] * len(texts)
    for row, i in enumerate(order):
        out[i] = "".join(hexed[row].tolist())
    return out


def _walk_on(k, at, stop, step, flat, spread, table, samples, positions) -> None:
    """Finish the walk of one text."""
    base = at
    own = spread[base:stop].tolist()
    n, i = len(own), 0
    mask = WALK_BITS - 1
    while i < n:
        # Walk to the next step at which a slot samples.
        nxt = positions.following(step)
        shift = (step * 7919) & mask
        while step < nxt and i < n:
            i += table[(own[i] + shift) & mask]
            shift += 7919
            step += 1
        if i < n and step == nxt and step in positions.at:
            slots = positions.at[step]
            samples[slots, k] = _sample(step, flat[base + i:base + i + 1], slots)[:, 0]
            i += table[(own[i] + shift) & mask]
            step += 1


def likeness_of(a: str, b: str) -> float:
    """Share of equal samples, corrected for the 1 in 16 that are equal by chance; 0 to 1."""
    if not a or not b:
        return 0.0
    same = np.count_nonzero(np.frombuffer(a.encode(), np.uint8) == np.frombuffer(b.encode(), np.uint8)) / len(a)
    return float(max(0.0, (same - 1 / 16) / (15 / 16)))


def edited(text: str, following: str) -> str:
    """The last half of ``text`` replaced by the first as many code points of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _fingerprints(batches: Iterator[pa.RecordBatch], text: str, out: str) -> Iterator[pa.RecordBatch]:
    positions = Positions()
    for block in blocks(batches, text, BLOCK_BYTES):
        texts = [t or "" for t in block.column(block.schema.names.index(text)).to_pylist()]
        yield pa.RecordBatch.from_arrays([*block.columns, pa.array(walk(texts, positions))],
                                         names=[*block.schema.names, out])


def fingerprint(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of ``text``."""
    df = df.drop(out)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.StringType())])
    return arrow_map(df, lambda it: _fingerprints(it, text, out), schema)


# -- neighbours in the order of an id ---------------------------------------------------

EDITED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double, bands_edited int")


def _shared_bands(a: str, b: str) -> int:
    width = SLOTS // BANDS
    return sum(a[i:i + width] == b[i:i + width] for i in range(0, SLOTS, width))


def _edited_rows(rows: list[tuple], positions: Positions) -> tuple[pa.RecordBatch | None, list[tuple]]:
    """Results of all rows but the last of each partition key, which waits for its follower."""
    prints = walk([r[2] for r in rows], positions)
    pairs = [(i, i + 1) for i in range(len(rows) - 1) if rows[i][0] == rows[i + 1][0] and not rows[i][3]]
    texts = [edited(rows[i][2], rows[j][2]) for i, j in pairs]
    changed = walk(texts, positions)
    out = [{"doc_id": rows[i][1], "n_chars": len(rows[i][2]),
            "edited_sha256": hashlib.sha256(t.encode()).hexdigest(), "fingerprint": prints[i],
            "edited_fingerprint": c, "near_edited": likeness_of(prints[i], c),
            "near_next": likeness_of(prints[i], prints[j]), "bands_edited": _shared_bands(prints[i], c)}
           for (i, j), t, c in zip(pairs, texts, changed)]
    batch = pa.RecordBatch.from_pylist(out, schema=_EDITED_ARROW) if out else None
    return batch, rows[-1:]


_EDITED_ARROW = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                           ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                           ("near_edited", pa.float64()), ("near_next", pa.float64()), ("bands_edited", pa.int32())])


def _edited_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (_slice, _guest, doc_id, text) sorted by slice, guest last; see ``with_edits``."""
    positions = Positions()
    rows: list[tuple] = []
    for block in blocks(batches, "text", BLOCK_BYTES):
        d = block.to_pydict()
        rows += [(s, i, t or "", g) for s, i, t, g in zip(d["_slice"], d["doc_id"], d["text"], d["_guest"])]
        batch, rows = _edited_rows(rows, positions)
        if batch is not None:
            yield batch


def with_edits(df: DataFrame, doc_id: str = "doc_id", text: str = "text", slices: int | None = None) -> DataFrame:
    """Fingerprint every text and its edited text (see ``edited``; the follower is the
    row with the next higher id, the first row's after the last).

    Rows are dealt by ranges of the id (bounds from approximate quantiles) and sorted
    inside a range, so a follower stands beside its row; the first row of each range is
    sent as a guest to the range before. Null ids come first; rows with equal ids follow each
    other in the order of their texts. A table of one row follows itself.
    """
    spark = df.sparkSession
    if slices is None:
        slices = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / slices for i in range(1, slices)], 20 * slices)).first()[0]
    cuts = np.unique(np.array(cuts or [], np.int64))
    rows = rows.withColumn("_slice", F.coalesce(_slice_of(cuts)("doc_id"), F.lit(0)))
    first = rows.groupBy("_slice").agg(F.min(F.struct(
        F.col("doc_id").isNotNull().alias("known"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))).alias("r"))
    first = stored(first.select("_slice", "r.doc_id", "r.text"), "slice-firsts")
    held = sorted(r[0] for r in first.select("_slice").collect())       # one number per slice
    sent = spark.createDataFrame([(s, held[i - 1]) for i, s in enumerate(held)], "_slice int, _to int")
    guests = (first.join(F.broadcast(sent), "_slice")
              .select(F.col("_to").alias("_slice"), F.lit(True).alias("_guest"), "doc_id", "text"))
    every = rows.select("_slice", F.lit(False).alias("_guest"), "doc_id", "text").unionByName(guests)
    dealt = (every.repartition(slices, "_slice")
             .sortWithinPartitions("_slice", "_guest", F.col("doc_id").asc_nulls_first(), "text"))
    return arrow_map(dealt, _edited_batches, EDITED)


def _slice_of(cuts: np.ndarray):
    """How many of the sorted ``cuts`` lie below an id."""
    @F.pandas_udf("int")
    def number(ids: pd.Series) -> pd.Series:
        known = ids.notna()
        out = pd.Series(0, index=ids.index, dtype="int32")
        out[known] = np.searchsorted(cuts, ids[known].astype("int64")).astype("int32")
        return out
    return number


# -- near pairs -------------------------------------------------------------------------

def bands(fingerprint: Column) -> Column:
    """array<struct<band, bits>>: the band's number and its samples."""
    width = SLOTS // BANDS
    return F.array(*(F.struct(F.lit(i).alias("band"), F.substring(fingerprint, i * width + 1, width).alias("bits"))
                     for i in range(BANDS)))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples of two fingerprints, corrected for chance."""
    same = F.aggregate(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.when(x == y, 1).otherwise(0)),
                       F.lit(0), lambda s, x: s + x) / F.lit(float(SLOTS))
    return F.greatest(F.lit(0.0), (same - 1 / 16) / (15 / 16))


def _digits(prints: list[bytes]) -> np.ndarray:
    """Samples of packed fingerprints: one row of SLOTS numbers each."""
    packed = np.frombuffer(b"".join(prints), np.uint8).reshape(-1, SLOTS // 2)
    return np.concatenate([packed >> 4, packed & 15], 1)


def _alike(a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """Whether rows of samples have a likeness (see ``likeness_of``) of ``least`` or more."""
    same = np.count_nonzero(a == b, axis=1) / SLOTS
    return np.maximum(0.0, (same - 1 / 16) / (15 / 16)) >= least


def _links_to_heads(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Rows (fid, head, print, head_print) -> verified links (a, b)."""
    for batch in batches:
        ok = pa.array(_alike(_digits(batch.column(2).to_pylist()), _digits(batch.column(3).to_pylist()), least))
        yield pa.RecordBatch.from_arrays([batch.column(i).filter(ok) for i in range(2)], names=["a", "b"])


def _links_in_units(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Rows (unit, query, fid, group, print) sorted by unit, query -> verified links (a, b).

    Every query row is compared with every other row of its unit that is not yet in its group.
    """
    def rows():
        for batch in batches:
            yield from zip(*(batch.column(i).to_pylist() for i in range(5)))

    for _, members in groupby(rows(), key=lambda r: r[0]):
        held, asked = [], []
        for _, query, *row in members:
            (asked if query else held).append(row)
        if not held or not asked:
            continue
        fids = np.array([r[0] for r in held], np.int64)
        label = np.array([r[1] for r in held], np.int64)
        samples = _digits([r[2] for r in held])
        queries = _digits([r[2] for r in asked])
        now: dict[int, int] = {}                      # group -> the group that it went into

        def current(group: int) -> int:
            while group in now:
                group = now[group]
            return group

        links: list[tuple[int, int]] = []
        for (fid, group, _), own in zip(asked, queries):
            group = current(group)
            others = np.flatnonzero(label != group)
            for i in others[_alike(samples[others], own[None, :], least)].tolist():
                other = int(label[i])
                if other != group:                    # else a link of this row has joined it just now
                    links.append((fid, int(fids[i])))
                    label[label == other] = group
                    now[other] = group
        if links:
            a, b = zip(*links)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


UNIT_ROWS = 2000              # fingerprints of one bucket compared with as many in one task


BUCKET_ROWS_A_TASK = 200_000  # rows (bucket, fingerprint) of a task


def _prints(df: DataFrame, doc_id: str, fp: str) -> DataFrame:
    """Distinct fingerprints: (fid, print, least, n_rows): hash, packed samples, least id, rows."""
    rows = df.filter(F.col(fp).isNotNull()).select(
        F.xxhash64(fp).alias("fid"), F.unhex(fp).alias("print"), F.col(doc_id).alias("_id"))
    found = rows.groupBy("fid").agg(F.first("print").alias("print"), F.min("_id").alias("least"), F.count("*").alias("n_rows"))
    return stored(found, "fingerprints", rebalance=True)


def _sized(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in as many tasks as so many rows need (narrow: the stage that makes them has these tasks)."""
    return df.coalesce(tasks_for(rows, df, BUCKET_ROWS_A_TASK))


def _near_groups(prints: DataFrame, least: float, unit_rows: int) -> DataFrame:
    """(node, component) of fingerprints (fid) that chains of verified pairs connect.

    First every member of a band's bucket is compared with one head. Then, in each bucket
    that this leaves in several groups, every member outside the largest group is compared
    with all members of other groups: large buckets in blocks, each pair in one task. What these links connect is
    found between the groups, not between all fingerprints again. Steps over few rows run in few tasks.
    """
    partitions = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = prints.count()
    prints = _sized(prints, BANDS * n)
    keyed = (prints.select("fid", F.explode(bands(F.hex("print"))).alias("b"))
             .select(F.xxhash64("b.band", "b.bits").alias("key"), "fid"))
    heads = keyed.groupBy("key").agg(F.min("fid").alias("head"), F.count("*").alias("n")).filter("n > 1")
    members = stored(_sized(keyed.join(merged(heads), "key"), BANDS * n), "band-members")
    n_members = members.count()
    members = _sized(members, n_members)
    pairs = _sized(members.filter("fid <> head").select("fid", "head"), n_members).distinct()
    own = prints.select("fid", "print")
    pairs = merged(_sized(pairs, n_members), n_members).join(own, "fid")
    pairs = _sized(pairs, n_members).join(own.toDF("head", "head_print"), "head").select(
        "fid", "head", "print", "head_print")
    links = stored(_sized(arrow_map(pairs, lambda it: _links_to_heads(it, least), "a long, b long"), n_members), "head-links")
    groups = stored(connected_components(links, by_size=True).coalesce(tasks_for(n, prints)), "head-groups")
    groups = merged(groups, groups.count())

    # In a bucket of two the head was the only partner.
    rows = (members.filter("n > 2").select("key", "fid")
            .join(groups.withColumnRenamed("node", "fid"), "fid", "left")
            .select("key", "fid", F.coalesce("component", "fid").alias("grp")))
    rows = _sized(stored(_sized(rows, n_members), "band-groups"), n_members)
    split = (rows.groupBy("key", "grp").agg(F.count("*").alias("k"))
             .groupBy("key").agg(F.max(F.struct("k", "grp")).alias("m"), F.sum("k").alias("n"))
             .filter("n > m.k")
             .select("key", F.col("m.grp").alias("largest"), F.ceil(F.col("n") / unit_rows).cast("int").alias("parts"),
                     F.ceil((F.col("n") - F.col("m.k")) / unit_rows).cast("int").alias("chunks")))
    split = stored(_sized(split, n_members), "split-buckets")
    n_split = split.count()
    if not n_split:
        return groups
    open_rows = _sized(rows.join(merged(split, n_split), "key"), n_members)
    open_rows = stored(_sized(open_rows.join(own, "fid"), n_members), "open-members")
    part = F.pmod(F.xxhash64("fid"), F.col("parts"))
    chunk = F.pmod(F.xxhash64("fid", F.lit("chunk")), F.col("chunks"))
    columns = ["fid", "grp", "print"]
    held = (open_rows.withColumn("c", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .select(F.concat_ws(":", "key", part, "c").alias("unit"), F.lit(False).alias("query"), *columns))
    asked = (open_rows.filter("grp <> largest").withColumn("p", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select(F.concat_ws(":", "key", "p", chunk).alias("unit"), F.lit(True).alias("query"), *columns))
    units = held.unionByName(asked).repartition(partitions, "unit").sortWithinPartitions("unit", "query")
    more = stored(arrow_map(units, lambda it: _links_in_units(it, least), "a long, b long"), "unit-links")
    if more.isEmpty():
        return groups
    # The links join whole groups (a fingerprint without a group is its own).
    named = groups.withColumnRenamed("component", "g")
    for end in ("a", "b"):
        more = (_sized(more, n_members).join(named.withColumnRenamed("node", end), end, "left")
                .withColumn(end, F.coalesce("g", end)).drop("g"))
    joined = connected_components(_sized(more, n_members), by_size=True)
    joined = joined.select(F.col("node").alias("g"), F.col("component").alias("whole"))
    known = named.select("node", "g").unionByName(          # groups of one are in no link to a head
        joined.select(F.col("g").alias("node"), "g").join(named, joined["g"] == named["node"], "left_anti"))
    return known.join(joined, "g", "left").select("node", F.coalesce("whole", "g").alias("component"))


def near_copies(df: DataFrame, doc_id: str = "doc_id", fp: str = "fingerprint", least: float = 0.8,
                unit_rows: int = UNIT_ROWS) -> DataFrame:
    """For every distinct fingerprint that has a near copy: (fingerprint, like), ``like`` being the
    smallest fingerprint of its class.

    Near copies share a band and are at least ``least`` alike; a class is what chains of near
    copies connect. No pair of a bucket is left out unless other pairs connect it already.
    """
    prints = _prints(df, doc_id, fp)
    found = _near_groups(prints, least, unit_rows).withColumnRenamed("node", "fid")
    found = found.join(prints.select("fid", F.lower(F.hex("print")).alias("fingerprint")), "fid")
    smallest = found.groupBy("component").agg(F.min("fingerprint").alias("like"))
    return found.join(smallest, "component").select("fingerprint", "like")


def near_classes(df: DataFrame, doc_id: str = "doc_id", fp: str = "fingerprint", least: float = 0.8,
                 unit_rows: int = UNIT_ROWS) -> DataFrame:
    """(fid, near_class) of every fingerprint that several rows or near copies have: its hash
    and the smallest id of its class (see ``near_copies``)."""
    prints = _prints(df, doc_id, fp)
    groups = _near_groups(prints, least, unit_rows).withColumnRenamed("node", "fid")
    rows = (prints.drop("print").join(groups, "fid", "left").filter("n_rows > 1 OR component IS NOT NULL")
            .select("fid", F.coalesce("component", "fid").alias("component"), "least"))
    least_id = rows.groupBy("component").agg(F.min("least").alias("near_class"))
    return stored(rows.join(least_id, "component").select("fid", "near_class"), "near-classes", rebalance=True)


def with_near_classes(df: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = 0.8) -> DataFrame:
    """``with_edits`` plus near_class: the smallest id among the near copies of all rows that
    chains connect to the row, its own included.

    Every text is walked once: the rows with their edits are stored, the classes found from their fingerprints.
    """
    rows = stored(with_edits(df, doc_id, text), "edits")
    classes = near_classes(rows.select("doc_id", "fingerprint"), least=least)
    out = lookup_join(rows.withColumn("fid", F.xxhash64("fingerprint")), classes, ["fid"])
    return out.drop("fid").withColumn("near_class", F.coalesce("near_class", "doc_id"))
