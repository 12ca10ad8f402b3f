"""Byte-level BPE: encode and decode with the merge ranks of a vocabulary file.

Encoding replays merges over a whole block of text at once. The distinct
pre-token words of a block are laid out as linked lists of tokens in flat
arrays; an inverted index maps the rank of each mergeable pair to the word
positions where that pair stands; ranks are applied in ascending order, each
application touching only the pair's positions and their two neighbours. The
result of a word does not depend on the block it is in, so nothing is shuffled:
every task replays the merges of its own blocks and remembers a bounded number
of words already encoded.

Defined results: null text counts as empty (no ids, empty decoding); repeated
rows each get their result; extra columns pass through; an existing column
named like a result is replaced.
"""

from __future__ import annotations

import base64
from collections import defaultdict
from collections.abc import Iterator, Sequence
from heapq import heappop, heappush
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import arrow_map, blocks

BLOCK_BYTES = 3 << 20       # text whose merges are replayed together
CACHE_WORDS = 200_000        # words a task remembers before it starts afresh
RANK_BAND = 1024             # ranks whose index entries are sorted together


def load_ranks(path: str) -> dict[bytes, int]:
    """Rank of every token in a ``.tiktoken`` file (base64 token, space, rank)."""
    with open(path, "rb") as f:
        pairs = (line.split() for line in f if line.strip())
        return {base64.b64decode(tok): int(rank) for tok, rank in pairs}


class MergeReplay:
    """Replays the merges of a vocabulary over many words at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.base = max(ranks.values()) + 2
        self.none = self.base - 1            # stands beside a word's first and last token
        # Every way to make a token from two tokens.
        pairs = sorted((ranks[t[:i]] * self.base + ranks[t[i:]], r) for t, r in ranks.items()
                       for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks)
        self.pairs = np.array([k for k, _ in pairs] + [self.base * self.base], np.int64)
        self.made = np.array([r for _, r in pairs] + [-1], np.int32)

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that each two tokens make, -1 where they make none."""
        key = left.astype(np.int64) * self.base + right
        at = np.searchsorted(self.pairs, key)
        return np.where(self.pairs[at] == key, self.made[at], np.int32(-1))

    def encode(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and the number of ids of each.

        A word that is itself a token is that token.
        """
        whole = np.array([self.ranks.get(w, -1) for w in words], np.int64)
        size = np.array([len(w) for w in words], np.int64)
        raw = np.frombuffer(b"".join(words), np.uint8)
        # All positions and ranks fit 32 bits: a block is far below 2 GB.
        word = np.repeat(np.arange(len(words), dtype=np.int32), size)
        tok = np.append(self.byte[raw], np.int32(self.none))     # the last position is nobody's neighbour
        n = len(raw)
        first = np.diff(word, prepend=np.int32(-1)) != 0
        nxt = np.arange(1, n + 2, dtype=np.int32)
        nxt[:-1][np.append(first[1:], True)[:n]] = n
        nxt[-1] = n
        prv = np.arange(-1, n, dtype=np.int32)
        prv[:-1][first] = n
        prv[-1] = n
        known = np.repeat(whole >= 0, size)
        place = np.flatnonzero(~known)
        rank_at = np.full(n + 1, -1, np.int32)           # rank of the pair that begins at a position
        rank_at[place] = self.pair_rank(tok[place], tok[nxt[place]])
        place = place[rank_at[place] >= 0]
        self._merge(word, tok, nxt, prv, rank_at, place)
        head = first & known                             # a known word keeps one position
        tok[:n][head] = whole[word[head]]
        tok[:n][known & ~first] = -1
        live = tok[:n] >= 0
        return tok[:n][live].astype(np.int32), np.bincount(word[live], minlength=len(words))

    def _merge(self, word, tok, nxt, prv, rank_at, place) -> None:
        """Apply every merge in rank order. Entries of later ranks wait in bands."""
        bands = [[] for _ in range(self.base // RANK_BAND + 1)]
        self._post(bands, rank_at[place], place)
        for b in range(len(bands)):
            if not bands[b]:
                continue
            end = (b + 1) * RANK_BAND
            index = self._index(bands[b])
            bands[b] = []
            heap = sorted(index)
            later: list[tuple[np.ndarray, np.ndarray]] = []
            while heap:
                rank = heappop(heap)
                at = np.concatenate(index.pop(rank))
                at = np.sort(at[rank_at[at] == rank])
                if not len(at):
                    continue
                at = at[np.diff(at, prepend=-1) != 0]
                right = nxt[at]
                after, before = nxt[right], prv[at]
                if len(at) > 1:
                    same = np.full(len(at), rank, np.int32)
                    made = self.pair_rank(np.append(same, tok[before]), np.append(tok[after], same))
                    if (right[:-1] == at[1:]).any() or ((made >= 0) & (made <= rank)).any():
                        # Order matters inside a word: merge its leftmost place only.
                        lead = np.diff(word[at], prepend=-1) != 0
                        if not lead.all():
                            index[rank] = [at[~lead]]
                            heappush(heap, rank)
                            at, right, after, before = at[lead], right[lead], after[lead], before[lead]
                tok[at], tok[right], rank_at[right] = rank, -1, -1
                nxt[at] = after
                prv[after] = at
                prv[-1] = nxt[-1] = len(tok) - 1
                rank_at[at] = self.pair_rank(tok[at], tok[after])
                rank_at[before] = self.pair_rank(tok[before], tok[at])
                rank_at[-1] = -1
                touched = np.append(at, before)
                made = rank_at[touched]
                soon = (made >= 0) & (made < end)
                if soon.any():
                    for r, p in zip(made[soon].tolist(), touched[soon]):
                        if r in index:
                            index[r].append(p[None])
                        else:
                            index[r] = [p[None]]
                            heappush(heap, r)
                wait = made >= end
                later.append((made[wait], touched[wait]))
            if later:
                self._post(bands, *(np.concatenate(x) for x in zip(*later)))

    @staticmethod
    def _post(bands: list, rank: np.ndarray, place: np.ndarray) -> None:
        order = np.argsort(rank, kind="stable")
        rank, place = rank[order], place[order]
        cuts = np.searchsorted(rank, np.arange(len(bands) + 1) * RANK_BAND).tolist()
        for band, i, j in zip(bands, cuts, cuts[1:]):
            if j > i:
                band.append((rank[i:j], place[i:j]))

    @staticmethod
    def _index(entries: list) -> dict[int, list[np.ndarray]]:
        rank, place = (np.concatenate(x) for x in zip(*entries))
        order = np.argsort(rank, kind="stable")
        rank, place = rank[order], place[order]
        cuts = np.flatnonzero(np.diff(rank, prepend=-1)).tolist()
        return {int(rank[i]): [place[i:j]] for i, j in zip(cuts, [*cuts[1:], None])}


def _gather(stock: np.ndarray, start: np.ndarray, size: np.ndarray, step: int = 1 << 17) -> np.ndarray:
    """The runs ``stock[start[i] : start[i] + size[i]]``, one after the other, ``step`` runs at a time."""
    out = [stock[:0]]
    for i in range(0, len(start), step):
        n = size[i:i + step]
        end = np.cumsum(n)
        out.append(stock[np.repeat(start[i:i + step] - end + n, n) + np.arange(end[-1])])
    return np.concatenate(out)


def _encoded(batches: Iterator[pa.RecordBatch], ranks, pattern: str, text: str, ids: str,
             keep: list[str]) -> Iterator[pa.RecordBatch]:
    import regex

    find = regex.compile(pattern).findall
    replay = MergeReplay(ranks.value)
    number: dict[str, int] = defaultdict(count().__next__)     # word -> its place in ``stock``
    stock, size = np.empty(0, np.int32), np.empty(0, np.int64)
    for block in blocks(batches, text, BLOCK_BYTES):
        if len(number) > CACHE_WORDS:
            number = defaultdict(count().__next__)
            stock, size = stock[:0], size[:0]
        seen = len(number)
        rows = [np.fromiter(map(number.__getitem__, find(t)), np.int32) if t else np.empty(0, np.int32)
                for t in block.column(block.schema.names.index(text)).to_pylist()]
        ids_new, size_new = replay.encode([w.encode() for w in list(number)[seen:]])
        stock, size = np.append(stock, ids_new), np.append(size, size_new)
        start = np.cumsum(size) - size
        words = np.concatenate(rows)
        n = size[words]
        tokens = _gather(stock, start[words], n)
        ends = np.append(0, np.cumsum(n))[np.cumsum([0, *map(len, rows)])]
        column = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(tokens))
        yield pa.RecordBatch.from_arrays([*(block.column(c) for c in keep), column], names=[*keep, ids])


def _decoded(batches: Iterator[pa.RecordBatch], ranks, ids: str, out: str) -> Iterator[pa.RecordBatch]:
    tokens = sorted((r, t) for t, r in ranks.value.items())
    size = np.zeros(tokens[-1][0] + 1, np.int64)
    size[[r for r, _ in tokens]] = [len(t) for _, t in tokens]
    start = np.cumsum(size) - size
    stock = np.frombuffer(b"".join(t for _, t in tokens), np.uint8)
    for batch in batches:
        rows = batch.column(batch.schema.names.index(ids))
        flat = rows.flatten().to_numpy(zero_copy_only=False)
        count_ids = pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False)
        raw = _gather(stock, start[flat], size[flat]).tobytes()
        ends = np.append(0, np.cumsum(size[flat]))[np.append(0, np.cumsum(count_ids))].tolist()
        decoded = pa.array([raw[a:b] for a, b in zip(ends, ends[1:])], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns, decoded], names=[*batch.schema.names, out])


def _with(df: DataFrame, keep: list[str], *added: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([*(df.schema[c] for c in keep), *(T.StructField(n, t) for n, t in added)])


def _keep(df: DataFrame, keep: list[str] | None, *added: str) -> list[str]:
    return [c for c in (df.columns if keep is None else keep) if c not in added]


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text",
           ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all by default) plus ``ids`` array<int>: the BPE ids of
    ``text``, each match of ``pattern`` encoded separately, no special tokens."""
    keep = _keep(df, keep, ids)
    shared = df.sparkSession.sparkContext.broadcast(ranks)  # bounded: one vocabulary
    return arrow_map(df.select(*{*keep, text}), lambda it: _encoded(it, shared, pattern, text, ids, keep),
        _with(df, keep, (ids, T.ArrayType(T.IntegerType()))))


def decode(df: DataFrame, ranks: dict[bytes, int], ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``decoded`` binary: the bytes that ``ids`` stand for (null ids: empty)."""
    df = df.drop(out)
    shared = df.sparkSession.sparkContext.broadcast(ranks)
    return arrow_map(df, lambda it: _decoded(it, shared, ids, out),
                         _with(df, df.columns, (out, T.BinaryType())))


def round_trip(df: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text",
               ids: str = "ids", out: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """``encode`` and then ``decode`` in one pass over the batches."""
    keep = _keep(df, keep, ids, out)
    shared = df.sparkSession.sparkContext.broadcast(ranks)
    return arrow_map(df.select(*{*keep, text}), lambda it: _decoded(_encoded(it, shared, pattern, text, ids, keep), shared, ids, out),
        _with(df, keep, (ids, T.ArrayType(T.IntegerType())), (out, T.BinaryType())))


def digests(df: DataFrame, keep: list[str], ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``keep`` columns plus n_tokens, SHA-256 of the ids joined by commas, SHA-256 of the bytes."""
    return df.select(
        *keep, F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col(ids).cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col(decoded), 256).alias("decoded_sha256"))
