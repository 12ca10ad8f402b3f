"""Cross-tokenizer alignment against a plain count over all links."""

import hashlib
import random
import sys
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from marquee.llm import cross_tokens as C

SF = "/root/testdata/sf0.001"
A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def enc():
    return C.Encoder(open(A_PATH, encoding="utf-8").read(), open(B_PATH, "rb").read())


def plain(a, b, text, byte):
    """Tokens as (id, bytes) of both, or none."""
    if not text:
        return [], []
    x = a.encode(" " + text, add_special_tokens=False)
    y = b.encode(text)
    ta = [(i, bytes(byte[c] for c in t)) for i, t in zip(x.ids, x.tokens)]
    tb = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
          for i in y]
    raw = (" " + text).encode()
    same = b"".join(t for _, t in ta) == raw == b"".join(t for _, t in tb)
    return (ta, tb) if same else ([], [])


def brute(rows):
    a, b = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    a.encode_special_tokens = True
    byte = C.byte_alphabet()
    found = []
    for _, text in rows:
        ta, tb = plain(a, b, text, byte)
        ends = [Counter(), Counter()]
        for side, tokens in enumerate((ta, tb)):
            at = 0
            for i, t in tokens:
                at += len(t)
                ends[side][at] = i
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups, left = [], [sorted(e, reverse=True) for e in ends]
        for cut in cuts:
            sides = []
            for e, rest in zip(ends, left):
                ids = []
                while rest and rest[-1] <= cut:
                    ids.append(str(e[rest.pop()]))
                sides.append(",".join(ids))
            groups.append("|".join(sides))
        found.append((len(ta), len(tb), [(ends[0][c], ends[1][c]) for c in cuts], ";".join(groups)))
    count = Counter(link for f in found for link in f[2])
    top = {}
    for (_, y), n in count.items():
        top[y] = max(n, top.get(y, 0))
    return [(d, na, nb, len(links), len(links), sum(count[k] == top[k[1]] for k in links), sum(count[k] for k in links),
             hashlib.sha256(text.encode()).hexdigest() if na else "") for (d, _), (na, nb, links, text) in zip(rows, found)]


def check(spark, rows, parts=3):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    got = [tuple(r) for r in C.link_scores(df, A_PATH, B_PATH).collect()]
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)


def test_table_equals_brute_force(spark):
    check(spark, [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()])


def test_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, " "), (4, "a"), (4, "a"), (None, "a"), (5, "<|endoftext|> <s>x</s><unk>"), (6, "x▁y"),
            (7, "é中😀\x00\n\n\t  end "), (8, "ab " * 30_000), (9, "\U0001FAE8 new Ᲊ"), (10, "fiﬁ  Å Å")]
    check(spark, rows, parts=2)


def test_small_containers(spark, monkeypatch):
    monkeypatch.setattr(C, "CONTAINER_BYTES", 2000)
    monkeypatch.setattr(C, "BLOCK_BYTES", 700)
    rng = random.Random(1)
    check(spark, [(i, " ".join(rng.choice(["the", "cat", "Sat", "on", "matting", "7.5"]) for _ in range(rng.randrange(60))))
                  for i in range(120)])


def test_empty_table_and_clashing_columns(spark):
    assert C.link_scores(spark.createDataFrame([], "doc_id long, text string"), A_PATH, B_PATH).count() == 0
    df = spark.createDataFrame([(1, "hello there", 3, "x")], "doc_id int, text string, pair int, pos string")
    want = [(1, "hello there")]
    assert [tuple(r) for r in C.link_scores(df, A_PATH, B_PATH).collect()] == brute(want)


def test_bitmaps_round_trip():
    rng = np.random.default_rng(3)
    slots = 60
    sets = [np.sort(rng.choice(C.CONTAINER_DOCS, n, replace=False)) for n in rng.choice([0, 1, 5, 255, 256, 4000, 4096], slots)]
    maps = C.bitmaps(np.repeat(np.arange(slots), [len(s) for s in sets]), np.concatenate(sets), slots)
    for part, chosen in ((maps, sets), (maps.slice(7, 20), sets[7:27])):
        slot, pos = C.positions(part)
        got = [np.sort(pos[slot == i]) for i in range(len(part))]
        assert all((x == y).all() and len(x) == len(y) for x, y in zip(got, chosen))


def test_index_counts_documents_and_links(spark, enc, monkeypatch):
    monkeypatch.setattr(C, "CONTAINER_BYTES", 4000)
    texts = ["of the of the of", "of the", "the cat of the", "", "dog " * 700] + ["of the end"] * 400
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    index = C.stored(C.pair_index(df, open(A_PATH, encoding="utf-8").read(), open(B_PATH, "rb").read()), "t")
    links, docs = Counter(), Counter()
    for t in texts:
        *_, (_, a, b) = C.align(enc, [t])
        links.update(zip(a.tolist(), b.tolist()))
        docs.update(set(zip(a.tolist(), b.tolist())))
    got = C.pair_counts(index, len(enc.b_bytes)).collect()
    assert {(r.a, r.b): (r.n_docs, r.n_links) for r in got} == {k: (docs[k], links[k]) for k in links}


def test_both_libraries_agree_on_old_characters(enc):
    import unicodedata

    old = [chr(c) for c in range(sys.maxunicode + 1) if unicodedata.ucd_3_2_0.category(chr(c)) not in ("Cn", "Cs", "Co")]
    assert enc.quick is not None
    texts = [f"a{c}b {c} 1{c}{c}" for c in old]
    for i in range(0, len(texts), 2000):
        joined = texts[i:i + 2000]
        want = [e.ids for e in enc.a.encode_batch(joined, add_special_tokens=False)]
        assert [enc.quick.encode_ordinary(t) for t in joined] == want
