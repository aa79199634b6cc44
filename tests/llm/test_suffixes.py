"""Suffix-array substring dedup against plain Python, and its pieces."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from odd import words

from shotmarts.llm import suffixes


def brute(rows, length):
    counts = {}
    for _, text in rows:
        b = (text or "").encode()
        for i in range(len(b) - length + 1):
            counts[b[i : i + length]] = counts.get(b[i : i + length], 0) + 1
    out = []
    for doc_id, text in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if counts[b[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((doc_id, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def key(row):
    return tuple((x is None, x) for x in row)


def test_window_min():
    rng = np.random.default_rng(1)
    v = rng.integers(0, 50, 1000).astype(np.uint64)
    for w in (1, 2, 7, 169):
        expected = [v[i : i + w].min() for i in range(len(v) - w + 1)]
        assert suffixes.window_min(v, w).tolist() == expected


def test_slices_hold_every_window():
    for n in (0, 5, 199, 200, 1000, 1234):
        cut = list(suffixes.slices(n, 200, 300))
        for s in range(n - 199):
            assert any(lo <= s and s + 200 <= hi for lo, hi in cut)


@pytest.mark.parametrize("length, k, most_slice, parts", [(40, 8, 1 << 20, 3), (40, 16, 97, 29), (24, 8, 64, 7)])
def test_remove_against_brute_force(spark, odd_docs, length, k, most_slice, parts):
    rng = random.Random(length + k)
    shared = " ".join(words(rng, 30, 20))
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    rows += [(300 + i, " ".join(words(rng, rng.randrange(0, 40), 30)) + (shared if i % 4 == 0 else "")) for i in range(60)]
    rows += [(400, "ab" * 300), (401, "x" * (length - 1)), (402, "é漢" * 40), (403, None)]
    rows += [(500 + i, shared + " tail") for i in range(5)] + [(600, "y" * (length - 1))] * 3
    docs = spark.createDataFrame([(d, t, "clash") for d, t in rows], "doc_id long, text string, kept_sha256 string")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        texts, spans, copied = suffixes.find_spans(docs.repartition(4), length, k, most_slice)
        got = suffixes.common.map_rows(
            suffixes.joined_spans(texts, spans, copied, length),
            "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string",
            suffixes._kept,
        ).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows, length), key=key)


def test_remove_defaults_and_empty(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = suffixes.remove(odd_docs).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows, 200), key=key)
    assert suffixes.remove(no_docs).collect() == []


@pytest.mark.parametrize("hot, unfolded", [(1, 50), (5, 2_000_000), (50_000, 300)])
def test_repeats_without_records_of_windows_or_stored_texts(spark, monkeypatch, hot, unfolded):
    rng = random.Random(hot)
    line = " ".join(words(rng, 60, 10**6))
    family = line.split()
    rows = [(i, f"{' '.join(words(rng, 20, 10**6))} {line} {' '.join(words(rng, 20, 10**6))}") for i in range(40)]
    for i in range(40):  # near copies, some of which share an edit
        edited = list(family)
        edited[rng.randrange(60)] = f"edit{rng.randrange(4)}"
        rows.append((100 + i, " ".join(edited)))
    rows += [(200 + i, " ".join(words(rng, 100, 10**6))) for i in range(20)] + [(300, f"{line} # {line}")] + rows[:3]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    monkeypatch.setattr(suffixes.common.Workspace, "store", None)
    monkeypatch.setattr(suffixes, "UNFOLDED", unfolded)
    got = suffixes.remove(docs, hot=hot).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows, 200), key=key)


def test_repeats_of_a_batch_in_parts():
    rng = np.random.default_rng(4)
    base = rng.integers(97, 99, 400).astype(np.uint8).tobytes()
    cut = [(0, 40, base[0:240]), (0, 40, base[0:120] + b"x" + base[121:240]), (0, 30, base[10:230]), (1, 5, base[50:252])]
    h, d, stretches = (list(x) for x in zip(*cut))
    for unfolded in (1, 7, 10**6):
        suffixes.UNFOLDED, whole = unfolded, suffixes.UNFOLDED
        try:
            marks = suffixes._repeated(np.array(h), np.array(d), stretches, 200)
        finally:
            suffixes.UNFOLDED = whole
        # Windows 10 to 30 of the first stretch are those of the third; the others are alone.
        assert np.flatnonzero(marks).tolist() == [*range(10, 31), *range(82, 103)]
