"""Merge replay against the tiktoken library, and exact round trips."""

import random

import public_tokenizers
import pytest
import tiktoken

from marquee.llm import bpe

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def tokenizer(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    rng = random.Random(6)
    texts = [None, "", " ", "\n\n  x", "a" * 3001, "abab" * 400, "👩‍👩‍👧 ß é 中文 русский", "it's we'll I'D", "\x00\x7f", "<|endoftext|>"]
    texts += ["".join(rng.choice("eéthrn \n'0") for _ in range(rng.randrange(200))) for _ in range(300)]
    return texts


def test_equals_tiktoken_and_round_trips(spark, ranks):
    rows = [(i, t, "old") for i, t in enumerate(odd_texts())]
    rows += [(10_000 + r.doc_id, r.text, "old") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    df = spark.createDataFrame(rows + rows[:5], "doc_id long, text string, ids string")
    enc = tokenizer(ranks)
    got = bpe.round_trip(df, ranks, public_tokenizers.PATTERN).collect()
    assert len(got) == len(rows) + 5
    for r in got:
        assert r.ids == enc.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()


def test_encode_then_decode_and_empty_table(spark, ranks):
    df = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    coded = bpe.encode(df, ranks, public_tokenizers.PATTERN)
    assert coded.columns == ["doc_id", "text", "ids"]
    assert {r.doc_id: bytes(r.decoded) for r in bpe.decode(coded, ranks).collect()} == {1: b"some text", 2: b""}
    assert bpe.round_trip(df.limit(0), ranks, public_tokenizers.PATTERN).count() == 0
    nulls = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [bytes(r.decoded) for r in bpe.decode(nulls, ranks).collect()] == [b"", b""]


def test_vocabulary_in_which_a_merge_makes_an_earlier_pair():
    # "abc" ranks before "ab": after a + b comes ab + c, before any other a + b.
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"ab": 257, b"ca": 258, b"abca": 259, b"bb": 260}
    enc = tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 25))) for _ in range(2000)]
    ids, size = bpe.MergeReplay(ranks).encode([w.encode() for w in words])
    at = 0
    for w, n in zip(words, size.tolist()):
        assert ids[at:at + n].tolist() == enc.encode_ordinary(w), w
        at += n
