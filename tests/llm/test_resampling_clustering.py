"""Importance resampling and lookup-table k-means against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from odd import words

from pyspark.sql import functions as F

from shotmarts.llm import clustering, resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def feats(text):
    return WORD.findall((text or "").translate(LOWER))


def brute_resample(docs, target, percent=10, least=20):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(zlib.crc32(f.encode()) % 10000 for f in feats(text))
    for text in target:
        t.update(zlib.crc32(f.encode()) % 10000 for f in feats(text))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log(((t[b] + 1) * (big_s + 10000)) / ((s[b] + 1) * (big_t + 10000))))
        for b in range(10000)
    ]
    rows = []
    for doc_id, text in docs:
        fs = feats(text)
        weight = sum(gain[zlib.crc32(f.encode()) % 10000] for f in fs)
        score = None
        if doc_id is not None:
            h = int(hashlib.sha256(f"2024:{doc_id}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(fs), weight, score, None])
    eligible = sorted((r for r in rows if r[0] is not None and r[1] >= least), key=lambda r: (-r[3], r[0]))
    for i, r in enumerate(eligible[: percent * len(eligible) // 100]):
        r[4] = i + 1
    return rows


def key(row):
    return tuple((x is None, x) for x in row)


def test_bit_planes_sum_exactly():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 3000, (7, 10000)) * (rng.random((7, 10000)) < 0.01)
    counts[0, :] = 0
    counts[1, 5] = 1 << 40
    gain = rng.integers(-40000, 40000, 10000)
    planes = (resampling.planes(np.maximum(gain, 0)[None])[0], resampling.planes(np.maximum(-gain, 0)[None])[0])
    assert resampling.sliced_weights(counts, planes).tolist() == (counts @ gain).tolist()


def test_resample_against_brute_force(spark, odd_docs):
    rng = random.Random(4)
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    rows += [(200 + i, " ".join(words(rng, rng.randrange(0, 60), 50))) for i in range(150)]
    rows += [(999, "Zebra ZEBRA zebra, 42 x" * 10)] * 3
    target = ["w1 w2 w3 zebra", None, "", "W7 w7 w8 ü"]
    docs = spark.createDataFrame(
        [(d, t, t, 1.0) for d, t in rows], "doc_id long, text string, weight string, rank double"
    ).repartition(5)
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = resampling.resample(docs, bench).collect()
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, brute_resample(rows, target)), key=key)
    assert sum(r.rank is not None for r in got) > 0


def test_resample_empty(spark, no_docs):
    bench = no_docs.select(no_docs.doc_id.alias("item_id"), "text")
    assert resampling.resample(no_docs, bench).collect() == []


def brute_kmeans(rows, k=40, rounds=5, dims=64):
    kept = [
        (i, r, [math.floor(256 * float(x)) for x in v])
        for i, (r, v) in enumerate(rows)
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    seeds = sorted(
        (hashlib.sha256(f"2:{r}".encode()).hexdigest(), ",".join(map(str, x)), x) for _, r, x in kept if r is not None
    )[:k]
    out = [(r, None, None, None, None, None) for r, v in rows]
    if not seeds:
        return out
    c = np.array([s[2] for s in seeds], np.int64)
    x = np.array([v for _, _, v in kept], np.int64).reshape(-1, dims)
    for _ in range(rounds):
        a = ((x[:, None] - c[None]) ** 2).sum(-1).argmin(1)
        for j in range(len(c)):
            if (a == j).any():
                c[j] = np.floor_divide(x[a == j].sum(0), (a == j).sum())
    d = ((x[:, None] - c[None]) ** 2).sum(-1)
    a = d.argmin(1)
    dist = d[np.arange(len(x)), a]
    for n, (i, r, _) in enumerate(kept):
        j = int(a[n])
        sha = hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()
        out[i] = (r, j, int(dist[n]), int(dist[a == j].sum()), int(dist.sum()), sha)
    return out


@pytest.mark.parametrize("most_values", [4096, 3])
def test_kmeans_against_brute_force(spark, most_values):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1) for _ in range(64)]) for i in range(300)]
    rows += [(5, rows[5][1]), (None, rows[6][1]), (7, None), (8, [1.0] * 63), (9, [float("nan")] + [0.0] * 63)]
    rows += [(10, [None] + [0.0] * 63), (11, [float("inf")] * 64), (12, [1e6] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cluster", F.lit("clash"))
    got = clustering.cluster(df.repartition(4), most_values=most_values).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute_kmeans(rows), key=key)


def test_kmeans_few_and_none(spark):
    rows = [(1, [0.5] * 64), (2, [-0.5] * 64), (None, [0.1] * 64), (3, [0.2] * 10)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = clustering.cluster(df).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute_kmeans(rows), key=key)
    assert clustering.cluster(df.where("vec_id = 3")).collect()[0].cluster is None
    assert clustering.cluster(df.where("vec_id > 99")).collect() == []


def exact_kmeans(rows, k=40, rounds=5):
    """The contract in whole numbers of any size; rows of (vec_id, vector), all kept, ids distinct."""
    ids = [r for r, _ in rows]
    x = [[math.floor(256 * Fraction(float(y))) for y in v] for _, v in rows]
    order = sorted(range(len(x)), key=lambda i: hashlib.sha256(f"2:{ids[i]}".encode()).hexdigest())
    c = [x[i] for i in order[:k]]

    def place():
        return [min((sum((a - b) ** 2 for a, b in zip(v, m, strict=True)), j) for j, m in enumerate(c)) for v in x]

    for _ in range(rounds):
        found = place()
        for j in range(len(c)):
            mine = [v for v, (_, at) in zip(x, found, strict=True) if at == j]
            if mine:
                c[j] = [sum(column) // len(mine) for column in zip(*mine, strict=True)]
    found = place()
    inertia = [sum(d for d, at in found if at == j) for j in range(len(c))]

    def long(n):
        return n if n < 2**63 else None

    return [
        (r, j, long(d), long(inertia[j]), long(sum(inertia)), hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest())
        for r, (d, j) in zip(ids, found, strict=True)
    ]


@pytest.mark.parametrize("scales", [[1.0, 3e6], [1.0, 1e8, -1e8], [1.0, 1e17, 1e300]])
def test_kmeans_of_large_components(spark, scales):
    """Differences whose squares pass 64 bits, and components that pass them themselves."""
    rng = random.Random(11)
    rows = [(i, [s * (1 + rng.randrange(-8, 8) / (abs(s) * 16)) for _ in range(64)]) for i, s in enumerate(scales * 60)]
    rows += [(1000 + i, [-y for y in v]) for i, v in rows[:20]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = clustering.cluster(df.repartition(4)).collect()
    assert sorted(map(tuple, got), key=key) == sorted(exact_kmeans(rows), key=key)
