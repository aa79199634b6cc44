"""The similarity join against comparing all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest

from shotmarts.llm import common, ngram_join
from shotmarts.llm.ngram_join import (
    Join, _close, _copies, _packed, _unpacked, one_line, one_of_each, shingle_sets, similarity_components,
)
from odd import words


def brute(rows):
    def shingles(text):
        w = [x.lower() for x in (text or "").encode().split()]
        if not w:
            return frozenset()
        return frozenset([tuple(w)] if len(w) < 5 else (tuple(w[i : i + 5]) for i in range(len(w) - 4)))

    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return sorted(
        ((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))),
        key=str,
    )


def edited(rng, text, share):
    return " ".join(w if rng.random() > share else f"x{rng.randrange(10**6)}" for w in text.split())


def corpus(seed):
    rng = random.Random(seed)
    common = [" ".join(words(rng, 14, 10**6)) for _ in range(5)]
    bases = [" ".join(words(rng, n, 10**5)) for n in (8, 30, 120, 300)]
    texts = [edited(rng, b, rng.choice([0.0, 0.01, 0.02, 0.03])) for b in bases for _ in range(25)]
    for _ in range(120):  # unlike each other but for common lines
        own = words(rng, rng.choice([3, 10, 40, 250]), 10**6)
        texts.append("\n".join([" ".join(own), *rng.sample(common, rng.randrange(1, 5))]))
    texts += ["\n".join(rng.sample(common, 3)) for _ in range(30)]
    rng.shuffle(texts)
    return list(enumerate(texts)) + [(None, texts[0]), (7, texts[7])]


@pytest.mark.parametrize(
    "join", [Join(), Join(hot=3, whole=10)], ids=str
)
def test_like_comparing_all_pairs(spark, join):
    rows = corpus(1)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, similarity_components(docs, join).collect()), key=str)
    assert got == brute(rows)


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = sorted(map(tuple, similarity_components(odd_docs).collect()), key=str)
    assert got == brute(rows)
    assert similarity_components(no_docs).count() == 0


def test_shingles_of_a_batch_do_not_mix():
    texts = ["a b c d e f", None, "a b", "A  b\tC d e f ", " x y", "é " * 9]
    many = shingle_sets(texts, 5)
    assert [len(s) for s in many] == [2, 0, 1, 2, 1, 1]
    assert (many[0] == many[3]).all()
    assert [s.tolist() for s in many] == [shingle_sets([t], 5)[0].tolist() for t in texts]


def test_one_row_of_each_component(spark):
    rng = random.Random(4)
    near, other, alone = words(rng, 80), words(rng, 80), words(rng, 80)
    text = lambda w, *last: " ".join([*w, *last])
    rows = [
        (1, text(near), 0), (None, text(near, "x"), 1), (None, text(near, "y"), 2),
        (5, text(near, "z"), 3), (5, text(alone), 4),
        (None, text(other), 5), (None, text(other, "x"), 6), (None, None, 7), (7, "", 8),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, place int").coalesce(1)
    got = one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted(r.place for r in got.collect()) == [0, 4, 5, 7, 8]


def test_a_family_that_does_not_link_is_not_paired(spark, monkeypatch):
    rng = random.Random(11)
    base = " ".join(words(rng, 400, 10**6))
    rows = [(i, edited(rng, base, 0.07)) for i in range(200)]
    made = {}
    store = common.Workspace.store

    def counted(ws, df, name):
        stored = store(ws, df, name)
        if name.endswith("-pairs"):
            made[name] = stored.count()
        return stored

    monkeypatch.setattr(common.Workspace, "store", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, similarity_components(docs).collect()), key=str)
    assert got == brute(rows)
    assert made and sum(made.values()) < 5 * len(rows)


def test_packed_columns():
    rng = random.Random(12)
    for n in (1, 2, 700):
        s = np.sort(np.array([rng.randrange(1 << 64) for _ in range(n)], np.uint64))
        place, often = (np.array([rng.randrange(1 << 32) for _ in range(n)]) for _ in range(2))
        got = _unpacked(_packed(s, place, often), n)
        assert [x.tolist() for x in got] == [s.tolist(), place.tolist(), often.tolist()]


def test_one_of_rows_equal_in_all_columns(spark):
    rng = random.Random(13)
    near, alone = (" ".join(words(rng, 60)) for _ in range(2))
    rows = [(1, near, None, 0), (1, near, None, 0), (1, near, 0, None), (2, near, None, 0), (3, alone, 1, 1)]
    rows += [(3, alone, 1, 1), (4, None, 2, 2), (4, None, 2, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, x int, y int").coalesce(1)
    got = sorted((r.doc_id, r.x, r.y) for r in one_of_each(docs).collect())
    assert got == [(1, None, 0), (3, 1, 1), (4, 2, 2), (4, 2, 2)]


def copied(spark, copies=4):
    """Unlike texts and a family, again and again in partitions of their own, and their docs."""
    rng = random.Random(14)
    texts = [" ".join(words(rng, 60, 10**6)) for _ in range(50)]
    texts += [edited(rng, texts[0], 0.01) for _ in range(3)]
    also = (str, str.upper, lambda t: f" {t}\n", lambda t: t.replace(" ", "\t  "))
    parts = [[(1000 * k + i, also[k % 4](t)) for i, t in enumerate(texts)] for k in range(copies)]
    docs = [spark.createDataFrame(p, "doc_id long, text string").coalesce(1) for p in parts]
    whole = docs[0]
    for more in docs[1:]:
        whole = whole.unionByName(more)
    return [r for p in parts for r in p], whole


def test_columns_of_copies_are_counted_once(spark, monkeypatch):
    rows, docs = copied(spark)
    made = {}
    store = common.Workspace.store

    def counted(ws, df, name):
        stored = store(ws, df, name)
        made[name] = stored.count()
        return stored

    monkeypatch.setattr(common.Workspace, "store", counted)
    got = sorted(map(tuple, similarity_components(docs).collect()), key=str)
    assert got == brute(rows)
    assert made["rows"] <= 4  # the family; 49 texts are unlike all others


def test_blocks_that_change_send_all_documents(spark, monkeypatch):
    rows, docs = copied(spark)
    found = _copies(docs, common.Workspace(spark, "test-copies"))
    places = sum(int(np.unpackbits(np.frombuffer(bits, np.uint8)).sum()) for _, bits in found.values())
    assert places == len(rows) - len({one_line(t) for _, t in rows})
    other = {block: (content + 1, bits) for block, (content, bits) in found.items()}
    monkeypatch.setattr(ngram_join, "_copies", lambda docs, ws: other)
    got = sorted(map(tuple, similarity_components(docs).collect()), key=str)
    assert got == brute(rows)


def test_words_on_one_line():
    assert one_line(" A\tb\r\n\x0b C\x1cÉ \f") == "a b c\x1cÉ".encode()
    assert one_line(None) == one_line(" \n ") == b""


def test_close_pairs_like_comparing_all_rows_of_a_column():
    rng = np.random.default_rng(15)
    for most in (1, 5, 60):
        n = 150
        s = np.sort(rng.integers(0, most, n))
        vids, comps, sizes = rng.integers(-(10**18), 10**18, n), rng.integers(0, 6, n), rng.integers(1, 60, n)
        left = np.minimum(sizes, -(-75 * sizes // 100) + rng.integers(0, 15, n))
        starts = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1], [True]]))
        pairs = [p for x in _close([s, vids, comps, sizes, left], starts, 75) for p in x.tolist()]
        expected = []
        for i in range(n):
            for j in range(i):
                near = 100 * min(sizes[i], sizes[j]) >= 75 * max(sizes[i], sizes[j])
                needed = -(-75 * (sizes[i] + sizes[j]) // 175)
                if s[i] == s[j] and comps[i] != comps[j] and near and min(left[i], left[j]) >= needed:
                    expected.append((min(vids[i], vids[j]), max(vids[i], vids[j])))
        assert sorted(pairs) == sorted(expected)
