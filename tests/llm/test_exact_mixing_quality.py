"""Exact dedup, curriculum mix and quality rules against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from odd import words

from shotmarts.llm import exact, mixing, quality

SPACE = re.compile(r"[\x20\x09-\x0D]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def norm(text):
    return SPACE.sub("", text or "")


@pytest.mark.parametrize("bits, capacity", [(64, 250_000), (64, 3), (3, 2)])
def test_exact_classes(spark, odd_docs, bits, capacity):
    rng = random.Random(1)
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    rows += [(100 + i, " ".join(words(rng, 3, 4))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[norm(text)].append((-len(text or ""), doc_id is None, doc_id))
    expected = []
    for text, members in groups.items():
        best, seen = min(members), False
        for m in sorted(members):
            kept = m[2] == best[2] and not seen
            seen |= kept
            sha = hashlib.sha256(text.encode()).hexdigest()
            expected.append((m[2], best[2], len(members), kept, sha))
    got = exact.classes(docs, capacity, bits).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got), key=str) == sorted(
        expected, key=str
    )
    if bits == 3:
        assert max(r.chain for r in got) > 1


def test_deduplicate_keeps_whole_rows(odd_docs, no_docs):
    got = exact.deduplicate(odd_docs)
    assert got.columns == odd_docs.columns
    texts = [norm(r.text) for r in got.collect()]
    assert len(texts) == len(set(texts)) == len({norm(r.text) for r in odd_docs.collect()})
    assert exact.deduplicate(no_docs).count() == exact.classes(no_docs).count() == 0


def shares(sizes, weights, most):
    """Targets by sharing the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, target, fixed = sum(sizes.values()), {}, set()
    while True:
        rest = total - sum(target[s] for s in fixed)
        free = [s for s in names if s not in fixed]
        for s in free:
            target[s] = rest * weight[s] / sum(weight[x] for x in free)
        over = [s for s in free if target[s] > most * sizes[s]]
        if not over:
            return target
        for s in over:
            target[s] = most * sizes[s]
            fixed.add(s)


def test_mix_meets_targets(spark):
    rng = random.Random(2)
    amount = {"a": 3, "b": 400, "c": 30, "d": 50, "e": 900, None: 40, "é": 10}
    rows = [
        (i, s, " ".join(words(rng, rng.randrange(0, 30))))
        for i, s in enumerate(s for s, n in amount.items() for _ in range(n))
    ]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    got = {r.doc_id: r for r in mixing.mix(docs).collect()}
    again = {r.doc_id: r for r in mixing.mix(docs.repartition(3)).collect()}
    sizes, taken, largest = Counter(), Counter(), Counter()
    for doc_id, source, text in rows:
        r = got[doc_id]
        assert r.size == len(WORD.findall(text)) and r.taken == r.passes * r.size and 0 <= r.passes <= 3
        assert (r.taken, r.positions) == (again[doc_id].taken, again[doc_id].positions)
        assert r.positions == sorted(r.positions) and all(0 <= p <= 1 for p in r.positions)
        sizes[source] += r.size
        taken[source] += r.taken
        largest[source] = max(largest[source], r.size)
    target = shares(sizes, mixing.WEIGHTS, 3)
    for doc_id, source, _ in rows:
        assert got[doc_id].source_size == sizes[source]
        assert got[doc_id].target == pytest.approx(target[source])
    for source in sizes:
        assert abs(taken[source] - target[source]) <= largest[source]
    stream = mixing.stream(docs).collect()
    assert Counter(r.doc_id for r in stream) == Counter({d: r.passes for d, r in got.items() if r.passes})


def test_schedule_is_inverted(spark):
    for ramp in (*mixing.SCHEDULES, mixing.Ramp(0.9), mixing.Ramp(-0.9)):
        steps = spark.range(11).selectExpr("id / 10 as share")
        for share, t in steps.select("share", ramp.position(steps.share)).collect():
            assert (1 + ramp.tilt) * t - ramp.tilt * t * t == pytest.approx(share)


def test_mix_odd_rows(odd_docs, no_docs):
    assert mixing.mix(odd_docs).count() == odd_docs.count()
    assert mixing.stream(odd_docs).columns == odd_docs.columns
    assert mixing.mix(no_docs).count() == mixing.stream(no_docs).count() == 0


def test_stream_keeps_copies_apart_and_stores_no_text(spark, monkeypatch):
    rng = random.Random(9)
    plain = [(i, rng.choice(["a", "b", None]), " ".join(words(rng, 20)), i % 2) for i in range(30)]
    rows = plain + plain[:7] * 3 + [(i, s, t, None) for i, s, t, _ in plain[5:9]] + [(None, None, None, None)] * 2
    schema = "doc_id long, source string, text string, key_a int"
    docs = spark.createDataFrame(rows, schema).repartition(4)
    passes = Counter()
    for r in mixing.mix(docs.drop("key_a")).collect():
        passes[r.doc_id] += r.passes
    stored, store = [], mixing.common.Workspace.store

    def noted(ws, df, name):
        stored.append(df.columns)
        return store(ws, df, name)

    monkeypatch.setattr(mixing.common.Workspace, "store", noted)
    got = mixing.stream(docs).collect()
    assert Counter(r.doc_id for r in got) == +passes and set(map(tuple, got)) <= set(rows)
    assert stored and not any({"row", "text"} & set(columns) for columns in stored)


def base(text):
    text = text or ""
    found = WORD.findall(text)
    windows = Counter(zip(found, found[1:], found[2:]))
    covered = {i + k for i in range(len(found) - 2) if windows[tuple(found[i : i + 3])] > 1 for k in range(3)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    return (
        len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), repeated, len(covered),
        len(found) < 50 or 100 * len(covered) > 50 * len(found),
    )


def test_quality(spark, odd_docs):
    rng = random.Random(4)
    menu = [" ".join(words(rng, 12)) for _ in range(4)]
    rows = [(r.doc_id, r.source, r.text) for r in odd_docs.collect()]
    for i in range(60):  # host with boilerplate: some texts have little else
        own = " ".join(words(rng, 60 if i % 2 else 4, 10**6))
        rows.append((100 + i, "host", "\n".join([*rng.sample(menu, 4), own])))
    copied = " ".join(words(rng, 80, 10**6))
    rows += [(300 + i, "host", copied) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4)
    got = quality.judge(docs).collect()
    key = lambda r: str((r[0], r[1:]))
    assert sorted(
        ((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got),
        key=key,
    ) == sorted(((d, *base(t)) for d, _, t in rows), key=key)
    kept = {r.doc_id: r.kept for r in got}
    assert all(kept[100 + i] == bool(i % 2) for i in range(60))
    assert all(kept[300 + i] for i in range(40))  # copies do not make a text boilerplate
    assert not any(r.kept for r in got if r.base_failed)


def test_quality_keeps_whole_rows(odd_docs, no_docs):
    got = quality.keep_good(odd_docs)
    assert got.columns == odd_docs.columns and got.count() == sum(not base(r.text)[-1] for r in odd_docs.collect())
    assert quality.judge(no_docs).count() == quality.keep_good(no_docs).count() == 0
