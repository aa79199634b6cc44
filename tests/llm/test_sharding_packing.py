"""Histogram sort and best-fit packing."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from odd import words
from pyspark.sql import functions as F

from shotmarts.llm import packing, sharding

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def test_shards_are_even_and_slots_gapless(spark):
    rng = random.Random(3)
    hot = "copy " * 40
    rows = [(i, hot if i % 3 == 0 else " ".join(words(rng, rng.randrange(1, 90)))) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sharding.shard(docs, 7, range_bytes=20_000, probe_bits=4).collect()
    assert sorted((r.doc_id, r.text) for r in got) == rows
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in got:
        assert r.shard_size == len(r.text.encode()) + 1
        sizes[r.shard] += r.shard_size
        slots[r.shard].append((r.slot, r.shard_key))
    ideal, largest = sum(sizes.values()) / 7, max(r.shard_size for r in got)
    assert sorted(sizes) == list(range(7))
    assert max(abs(s - ideal) for s in sizes.values()) <= max(largest, 0.001 * ideal) + 1
    for mine in slots.values():
        assert [s for s, _ in sorted(mine)] == list(range(len(mine)))
    # Shards and slots follow the order of the key.
    assert sorted(got, key=lambda r: (r.shard, r.slot)) == sorted(got, key=lambda r: (r.shard_key, r.slot))


def test_shard_odd_rows(odd_docs, no_docs):
    got = sharding.shard(odd_docs, 4)
    assert sorted(got.select("text", F.col("kept")).collect(), key=str) == sorted(
        odd_docs.select("text", "kept").collect(), key=str
    )
    assert got.where("doc_id = 0").first().shard_size == 1
    assert sharding.shard(no_docs, 4).count() == 0


def pieces_by_tokenizer(text, size):
    from tokenizers import Tokenizer

    ids = Tokenizer.from_file(TOKENIZER).encode(text or "", add_special_tokens=False).ids + [0]
    for n, start in enumerate(range(0, len(ids), size)):
        part = ids[start : start + size]
        yield n, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())


@pytest.mark.parametrize("size", [64, 2048])
def test_packing_odd_rows(odd_docs, size):
    got = packing.pack(odd_docs, TOKENIZER, size, with_ids=True).collect()
    expected = sorted(
        ((r.doc_id, *p) for r in odd_docs.collect() for p in pieces_by_tokenizer(r.text, size)), key=str
    )
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == expected
    assert all(len(r.ids) == r.length for r in got)
    assert_packed(got, size)


def assert_packed(got, size):
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for mine in bins.values():
        at = 0
        for offset, length in sorted(mine):
            assert offset == at
            at += length
        assert at <= size
    return len(bins)


def test_packing_rounds_come_near_the_bound(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(words(rng, rng.randrange(1, 60)))) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    got = packing.pack(docs, TOKENIZER, 128, slack=0, block=100, fan_in=2).collect()
    n = assert_packed(got, 128)
    assert n <= 1.02 * sum(r.length for r in got) / 128 + 1


def test_packing_what_cannot_merge_ends(spark):
    docs = spark.range(300).selectExpr("id as doc_id", "repeat('a ', 70) as text").repartition(6)
    assert assert_packed(packing.pack(docs, TOKENIZER, 128, block=20, fan_in=2).collect(), 128) == 300


def test_packing_nothing(no_docs):
    assert packing.pack(no_docs, TOKENIZER).count() == 0


def test_parts_and_whole_texts_give_equal_ids():
    texts = ["it's İstanbul ÀÉ é  x 12 ½ don't 'T I'S", "ſ's K", "<|endoftext|> hi", " a​b \x00 ﬁ ẞ ΑΣ 'ſ",
             "x\x1cy\x85z", "á ́b ΟΔΟΣ ΟΔΟΣ.  　x᠎y", "", "  "]
    encoder = packing.token_bytes(TOKENIZER)
    assert encoder.of_texts(texts) == [encoder.encode(t) for t in texts]
