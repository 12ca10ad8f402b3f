"""Alignment of two tokenizers' tokens over a corpus, with inverted pair bitmaps.

Each text is encoded by a byte-level BPE (A, over space + text) and a piece model with byte fallback
(B, which adds the space itself). Byte offsets where tokens of both end cut the text into groups; the two
tokens that end there are linked (tokens are never empty, so an offset ends one token of each).

Documents lie in containers of at most ``CONTAINER_DOCS`` documents and about ``CONTAINER_BYTES`` of
text, each made by one task. For every pair of ids a container holds the compressed bitmap of its
documents (one-document bitmaps OR-merged: sorted positions, or 4096 bits from 256 documents on) and
bit planes of the multiplicities beyond one. Containers hold different documents, so a pair's whole
bitmap is their concatenation: its popcount is the number of documents, and with the planes' popcounts,
weighted by powers of two, the number of links. Per container a pair is one row, so a frequent pair has
as many rows as there are containers, and its sums are pre-aggregated. A pair's score then goes back
along its postings: per container the scores are added up at the documents' positions.

Defined results: null and empty texts, and those whose joined tokens differ from space + text, have
no tokens: zeros and an empty ``groups_sha256``. Repeated rows and ids, null ids included, are documents of their own.
An empty table gives an empty one. Other columns are not returned, so none can clash.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import arrow_map, blocks, stored

CONTAINER_DOCS = 4096
CONTAINER_BYTES = 8 << 20
BLOCK_BYTES = 1 << 19
DENSE = CONTAINER_DOCS // 16     # from so many documents on, 4096 bits are no longer than sorted positions

# Fixed value: how byte-level BPE splits a text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """Byte of each character of byte-level BPE: printable Latin-1 stands for itself, other bytes follow from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Both tokenizers, from the contents of their files, and the bytes of every id."""

    def __init__(self, a_json: str, b_model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        spec = json.loads(a_json)
        byte = byte_alphabet()
        special = {t["content"] for t in spec["added_tokens"]}
        vocab = spec["model"]["vocab"]
        self.a_bytes = [b""] * (max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = token.encode() if token in special else bytes(byte[c] for c in token)
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.quick = self._quick(spec, special)
        a_text, b_text = ([str(i).encode() for i in range(len(x))] for x in (self.a_bytes, self.b_bytes))
        self.marks = np.array([*(t + b"," for t in a_text), *(t + b"|" for t in a_text),
                               *(t + b"," for t in b_text), *(t + b";" for t in b_text)], dtype=object)
        self.a_len, self.b_len = (np.array([len(t) for t in x]) for x in (self.a_bytes, self.b_bytes))

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def _quick(self, spec, special):
        """The same encoding by ``tiktoken``, several times faster, where A's merges are in the order of its ids."""
        import tiktoken

        vocab, pre = spec["model"]["vocab"], spec["pre_tokenizer"] or {}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        ranks = {t: i for t, i in vocab.items() if t not in special}
        in_order = sorted(ranks.values()) == list(range(len(ranks))) and all(
            ranks.get(a + b) == len(ranks) - len(merges) + i for i, (a, b) in enumerate(merges))
        if not in_order or spec["normalizer"] or (pre.get("type"), pre.get("add_prefix_space"), pre.get("use_regex")) != (
                "ByteLevel", False, True):
            return None
        return tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks={self.a_bytes[i]: i for i in ranks.values()},
                                 special_tokens={})

    def encode_a(self, text: str) -> list[int]:
        # The two libraries know different versions of Unicode; on characters as old as 3.2 they agree.
        if self.quick and (text.isascii() or all(unicodedata.ucd_3_2_0.category(c) != "Cn" for c in set(text))):
            return self.quick.encode_ordinary(text)
        return self.a.encode(text, add_special_tokens=False).ids

    def both(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids of A and B; none where they do not give space + text."""
        if not text:
            return [], []
        raw = (" " + text).encode()
        b = self.b.encode(text, num_threads=1)
        if b"".join([self.b_bytes[i] for i in b]) != raw:
            return [], []
        a = self.encode_a(" " + text)
        return (a, b) if b"".join([self.a_bytes[i] for i in a]) == raw else ([], [])


@lru_cache(maxsize=1)
def encoder(a_json: str, b_model: bytes) -> Encoder:
    return Encoder(a_json, b_model)


def align(enc: Encoder, texts: list[str | None]):
    """Per text: numbers of tokens and groups, digest of the groups; and all links as (text's place, A id, B id)."""
    coded = [enc.both(t) for t in texts]
    n_a, n_b = (np.array([len(c[i]) for c in coded], np.int64) for i in (0, 1))
    a, b = (np.fromiter((i for c in coded for i in c[k]), np.int64, n) for k, n in ((0, n_a.sum()), (1, n_b.sum())))
    if not len(a):
        return n_a, n_b, n_a, [""] * len(texts), (a, a, a)
    a_end, b_end = np.cumsum(enc.a_len[a]), np.cumsum(enc.b_len[b])     # texts with tokens have equal bytes in both
    ends = np.zeros(int(a_end[-1]) + 1, np.int8)
    ends[a_end] = 1
    ends[b_end] += 1
    a_cut, b_cut = ends[a_end] == 2, ends[b_end] == 2
    a_group, b_group = np.cumsum(a_cut) - a_cut, np.cumsum(b_cut) - b_cut
    a_last, b_last = np.flatnonzero(a_cut), np.flatnonzero(b_cut)
    place = np.repeat(np.arange(len(texts)), n_a)[a_last]
    n_groups = np.bincount(place, minlength=len(texts))
    # Tokens of both in the order of the digest: a group's A ids, then its B ids.
    order = np.empty(len(a) + len(b), np.int64)
    b_before = np.concatenate(([0], b_last[:-1] + 1))
    order[np.arange(len(a)) + b_before[a_group]] = a + a_cut * len(enc.a_bytes)
    order[np.arange(len(b)) + a_last[b_group] + 1] = 2 * len(enc.a_bytes) + b + b_cut * len(enc.b_bytes)
    marks = enc.marks[order].tolist()
    stop = np.cumsum(n_a + n_b)
    digests = [hashlib.sha256(b"".join(marks[i - n:i])[:-1]).hexdigest() if n else ""
               for i, n in zip(stop.tolist(), (n_a + n_b).tolist())]
    return n_a, n_b, n_groups, digests, (place, a[a_last], b[b_last])


INDEX = ("container long, pos int, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, "
         "pair long, docs binary, planes array<binary>")
_ARROW = pa.schema([("container", pa.int64()), ("pos", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()),
                    ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups_sha256", pa.string()), ("pair", pa.int64()),
                    ("docs", pa.binary()), ("planes", pa.list_(pa.binary()))])


def bitmaps(slot: np.ndarray, pos: np.ndarray, slots: int) -> pa.BinaryArray:
    """Compressed bitmap of every slot from its sorted positions (both sorted by slot)."""
    count = np.bincount(slot, minlength=slots)
    width = np.where(count >= DENSE, DENSE, count)                       # in 16-bit words
    start = np.concatenate(([0], np.cumsum(width)))
    words = np.zeros(int(start[-1]), np.uint16)
    first = np.concatenate(([0], np.cumsum(count)))[:-1]
    sparse = count[slot] < DENSE
    rank = np.arange(len(slot)) - first[slot]
    words[(start[slot] + rank)[sparse]] = pos[sparse]
    s, p = slot[~sparse], pos[~sparse]
    if len(s):
        at = start[s] + (p >> 4)
        cut = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        words[at[cut]] = np.bitwise_or.reduceat(np.uint16(1) << (p & 15).astype(np.uint16), cut)
    return pa.BinaryArray.from_buffers(pa.binary(), slots, [None, pa.py_buffer((2 * start).astype(np.int32)),
                                                            pa.py_buffer(words)])


def positions(maps: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """(slot, position) of every bit that is set."""
    if not len(maps):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, offsets, data = maps.buffers()
    offsets = np.frombuffer(offsets, np.int32)[maps.offset:maps.offset + len(maps) + 1].astype(np.int64) // 2
    words = np.frombuffer(data, np.uint16, offsets[-1]) if data is not None and offsets[-1] else np.zeros(0, np.uint16)
    words = words[offsets[0]:]
    width = np.diff(offsets)
    slot = np.repeat(np.arange(len(maps)), width)
    dense = width[slot] == DENSE
    base = (np.arange(len(slot)) - (offsets[:-1] - offsets[0])[slot])[dense]
    word, bit = np.nonzero(np.unpackbits(words[dense].view(np.uint8).reshape(-1, 2), axis=1, bitorder="little"))
    return (np.concatenate((slot[~dense], slot[dense][word])),
            np.concatenate((words[~dense].astype(np.int64), base[word] * 16 + bit)))


def postings(keys: np.ndarray, at: np.ndarray):
    """(pairs, document bitmaps, planes) of a container from the pair and the position of every link."""
    both, m = np.unique(keys * CONTAINER_DOCS + at, return_counts=True)
    pos = both % CONTAINER_DOCS
    pairs, slot = np.unique(both // CONTAINER_DOCS, return_inverse=True)
    docs = bitmaps(slot, pos, len(pairs))
    more = m - 1
    most = np.zeros(len(pairs), np.int64)
    np.maximum.at(most, slot, more)
    depth = np.ceil(np.log2(most + 1)).astype(np.int64)                  # planes of a pair
    start = np.concatenate(([0], np.cumsum(depth)))
    plane_slot, plane_pos = [], []
    for k in range(int(depth.max(initial=0))):
        on = np.flatnonzero(more >> k & 1)
        plane_slot.append(start[slot[on]] + k)
        plane_pos.append(pos[on])
    if plane_slot:
        plane_slot, plane_pos = np.concatenate(plane_slot), np.concatenate(plane_pos)
        order = np.argsort(plane_slot, kind="stable")
        planes = bitmaps(plane_slot[order], plane_pos[order], int(start[-1]))
    else:
        planes = pa.array([], pa.binary())
    return pairs, docs, pa.ListArray.from_arrays(pa.array(start.astype(np.int32)), planes)


def pair_index(docs: DataFrame, a_json: str, b_model: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of documents (``pair`` null) and of the pairs' postings by container (``pos`` null). Store it
    before use: containers are numbered by task."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def run(batches):
        enc = encoder(a_json, b_model)
        number = TaskContext.get().partitionId() << 32
        rows, links, size = 0, [], 0
        for batch in blocks(batches, "text", BLOCK_BYTES):
            while batch.num_rows:
                part = batch.slice(0, CONTAINER_DOCS - rows)
                batch = batch.slice(part.num_rows)
                texts = part.column(1).to_pylist()
                n_a, n_b, n_groups, digests, (place, a, b) = align(enc, texts)
                links.append((a * len(enc.b_bytes) + b, place + rows))
                n = part.num_rows
                none = {"pair": pa.nulls(n, pa.int64()), "docs": pa.nulls(n, pa.binary()), "planes": pa.nulls(n, _ARROW.field("planes").type)}
                yield _batch(container=np.full(n, number), pos=np.arange(rows, rows + n, dtype=np.int32), doc_id=part.column(0),
                             n_a=n_a, n_b=n_b, n_groups=n_groups, groups_sha256=digests, **none)
                rows, size = rows + n, size + sum(map(len, (t for t in texts if t)))
                if rows == CONTAINER_DOCS or size >= CONTAINER_BYTES:
                    yield from _posted(number, links)
                    number, rows, links, size = number + 1, 0, [], 0
        if rows:
            yield from _posted(number, links)

    return arrow_map(docs, run, INDEX)


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], pa.Array)
                                       else columns[f.name] for f in _ARROW], schema=_ARROW)


def _posted(number: int, links):
    pairs, docs, planes = postings(*(np.concatenate(x) for x in zip(*links)))
    for i in range(0, len(pairs), 1 << 16):
        n = len(pairs[i:i + (1 << 16)])
        yield _batch(container=np.full(n, number), pair=pairs[i:i + n], docs=docs.slice(i, n), planes=planes.slice(i, n),
                     **{f.name: pa.nulls(n, f.type) for f in _ARROW if f.name not in ("container", "pair", "docs", "planes")})


# Popcount of a compressed bitmap.
_COUNT = f"IF(octet_length({{0}}) = {2 * DENSE}, bitmap_count({{0}}), octet_length({{0}}) DIV 2)"


def pair_counts(index: DataFrame, b_ids: int) -> DataFrame:
    """(pair, a, b, n_docs, n_links, best): corpus-wide counts; best: the B id's highest number of links, ties included."""
    links = (f"{_COUNT.format('docs')} + aggregate(transform(planes, (p, k) -> shiftleft({_COUNT.format('p')}, k)), "
             "0L, (s, x) -> s + x)")
    counts = index.filter("pair IS NOT NULL").selectExpr("pair", f"{_COUNT.format('docs')} AS n_docs", f"{links} AS n_links")
    counts = counts.groupBy("pair").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links"))
    counts = counts.withColumns({"a": F.expr(f"pair DIV {b_ids}"), "b": F.col("pair") % b_ids})
    counts = stored(counts, "pairs", rebalance=True)
    highest = counts.groupBy("b").agg(F.max("n_links").alias("highest"))
    return counts.join(highest, "b").select("pair", "a", "b", "n_docs", "n_links", (F.col("n_links") == F.col("highest")).alias("best"))


RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def document_scores(index: DataFrame, counts: DataFrame) -> DataFrame:
    """Documents with the sums that the postings return: links, links of the highest count of their B id, and counts."""
    scored = index.filter("pair IS NOT NULL").select("container", "pair", "docs", "planes").join(
        counts.select("pair", F.col("n_links").alias("score"), "best"), "pair").drop("pair")
    docs = index.filter("pair IS NULL").drop("pair", "docs", "planes")
    rows = docs.unionByName(scored, allowMissingColumns=True).repartition("container").sortWithinPartitions(
        "container", F.col("pos").asc_nulls_last())

    def run(batches):
        now, held, sums = None, [], None
        for batch in batches:
            number = batch.column("container").to_numpy()
            cut = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1], [True]))) if len(number) else []
            for i, j in zip(cut[:-1], cut[1:]):
                if now != number[i]:
                    if held:
                        yield _summed(held, sums)
                    now, held, sums = number[i], [], np.zeros((3, CONTAINER_DOCS), np.int64)
                part = batch.slice(i, j - i)
                n = len(part) - part.column("pos").null_count               # documents come first
                if n:
                    held.append(part.slice(0, n))
                if n < len(part):
                    _add(sums, part.slice(n))
        if held:
            yield _summed(held, sums)

    return arrow_map(rows, run, RESULT)


def _add(sums: np.ndarray, part: pa.RecordBatch) -> None:
    """Adds the scores of a container's pairs at the positions of their documents, once per link."""
    score = part.column("score").to_numpy()
    best = part.column("best").to_numpy(zero_copy_only=False).astype(np.int64)
    planes = part.column("planes")
    depth = np.diff(planes.offsets.to_numpy())
    owner = np.repeat(np.arange(len(part)), depth)
    power = np.arange(len(owner)) - (np.cumsum(depth) - depth)[owner]
    for maps, of, weight in ((part.column("docs"), np.arange(len(part)), np.ones(len(part), np.int64)),
                             (planes.flatten(), owner, np.int64(1) << power)):
        slot, pos = positions(maps)
        weight = weight[slot]
        for row, value in enumerate((1, best, score)):
            np.add.at(sums[row], pos, weight * (value if row == 0 else value[of[slot]]))


def _summed(held: list[pa.RecordBatch], sums: np.ndarray) -> pa.RecordBatch:
    docs = pa.concat_batches(held)
    at = docs.column("pos").to_numpy()
    extra = {"n_links": sums[0][at], "n_best": sums[1][at], "count_sum": sums[2][at]}
    names = [c.split()[0] for c in RESULT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(extra[c]) if c in extra else docs.column(c) for c in names], names)


def link_scores(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its tokens, groups, links and their corpus-wide counts."""
    with open(a_path, encoding="utf-8") as f:
        a_json = f.read()
    with open(b_path, "rb") as f:
        b_model = f.read()
    index = stored(pair_index(docs, a_json, b_model, doc_id, text), "pair-index")
    return document_scores(index, pair_counts(index, len(encoder(a_json, b_model).b_bytes)))
