"""SimHash near-duplicates against brute force over all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from marquee.llm import simhash as S

SF = "/root/testdata/sf0.001"


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def brute(rows):
    prints = [brute_print(t) for _, t in rows]
    roots = brute_components(prints)
    least = {}
    for (d, _), r in zip(rows, roots):
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return [(d, f"{p:016x}", least.get(r)) for (d, _), p, r in zip(rows, prints, roots)]


def check(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in S.near_groups(df, **kw).collect()]
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)


def test_table_equals_brute_force(spark):
    check(spark, [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()])


def test_odd_texts_and_ids(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(90)}" for _ in range(400)]
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One"), (4, "one"), (None, "one"), (None, "only null here"), (5, "a\x0bb"),
            (6, "a b"), (7, "É Ünï ok"), (8, "é ünï ok"), (9, "x " * 50_000), (None, None)]
    for i in range(40):
        own = list(base)
        own[rng.randrange(400)] = f"x{i % 13}"
        rows.append((100 + i, "  ".join(own)))
    check(spark, rows)


def test_empty_table_and_clashing_columns(spark):
    assert S.near_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    df = spark.createDataFrame([(3, "a b c d", 1, "k", 5), (2, "A b  c d", 2, "l", 6)],
                               "doc_id int, text string, fp int, key string, component_id int")
    assert {(r.doc_id, r.component_id) for r in S.near_groups(df).collect()} == {(3, 2), (2, 2)}


def clustered(rng, n):
    """Fingerprints in tight clusters: chains, shared halves, many near ones."""
    out = set()
    while len(out) < n:
        centre = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 60)):
            out.add(centre)
            if rng.random() < 0.5:
                centre ^= sum({1 << rng.randrange(64) for _ in range(rng.randrange(1, 5))})
            else:
                out.add(centre ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(1, 5))}))
    return sorted(out)


def components(spark, prints, **kw):
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    pairs = {(r.a % (1 << 64), r.b % (1 << 64)) for r in S.near_pairs(df, **kw).collect()}
    assert all((a ^ b).bit_count() <= 3 and a != b for a, b in pairs)
    at = {p: i for i, p in enumerate(prints)}
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        root[find(at[a])] = find(at[b])
    return [find(i) for i in range(len(prints))]


def same(x, y):
    return len(set(zip(x, y))) == len(set(x)) == len(set(y))


@pytest.mark.parametrize("bucket,lags", [(S.BUCKET, S.LAGS), (S.BUCKET, 2), (6, S.LAGS), (6, 2)])
def test_pairs_connect_what_brute_force_connects(spark, bucket, lags):
    rng = random.Random(5)
    prints = clustered(rng, 700)
    base = rng.getrandbits(64)
    prints = sorted({*prints, *(base ^ rng.getrandbits(9) << 20 for _ in range(300))})
    assert same(components(spark, prints, bucket=bucket, lags=lags), brute_components(prints))


def test_search_by_flips_equals_search_by_comparison():
    rng = np.random.default_rng(7)
    base = np.uint64(0x123456789ABCDEF0)
    for n, bits in ((300, 9), (800, 12), (1500, 18)):
        fp = np.unique(base ^ (rng.integers(0, 1 << bits, n).astype(np.uint64) << np.uint64(11)))
        want = [tuple(sorted(x)) for x in _parts(fp, *S._by_search(S.DEEP, fp))]
        free = int(np.bitwise_or.reduce(fp ^ fp[0]))
        got = S._by_flips(fp, S._flips(tuple(i for i in range(64) if free >> i & 1)))
        assert sorted(want) == sorted(tuple(sorted(x)) for x in _parts(fp, *got))


def _parts(fp, a, b):
    part = {int(x): {int(x)} for x in fp}
    for x, y in zip(a.tolist(), b.tolist()):
        if part[x] is not part[y]:
            part[x] |= part[y]
            for z in part[y]:
                part[z] = part[x]
    return {id(s): s for s in part.values()}.values()


def test_level_two_holds_few_fingerprints(spark):
    fp = 0x0F0F1234ABCD5678
    got = S.deeper(S.variants(spark.createDataFrame([(fp,)], "fp long"))).groupBy("key").count().collect()
    assert len(got) == 64 * 32 and all(r["count"] == 1 for r in got)
