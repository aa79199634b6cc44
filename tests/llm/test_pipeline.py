"""The pipeline, stage by stage, against plain Python."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import corpus_pipeline
from odd import odd_texts, words
from test_exact_mixing_quality import base, norm, shares
from test_ngram_join import brute, edited
from test_sharding_packing import assert_packed, pieces_by_tokenizer

from shotmarts.llm import mixing

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    rng = random.Random(12)
    good = [" ".join(words(rng, rng.randrange(60, 200), 10**5)) for _ in range(40)]
    texts = good + good[:6] + [f" {t}\n" for t in good[3:8]] + [edited(rng, t, 0.01) for t in good[8:16]]
    texts += odd_texts(rng) + ["too short"] * 5
    return [(i, t, "en", rng.choice(["a", "b", "c", "d", None]), len(t or "")) for i, t in enumerate(texts)]


def one_of_each(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[norm(r[1])].append((-len(r[1] or ""), r[0], r))
    return [min(g)[2] for g in groups.values()]


def mixed(rows):
    size = {r[0]: len((r[1] or "").encode().split()) for r in rows}
    total = Counter()
    for r in rows:
        total[r[3]] += size[r[0]]
    target, before, out = shares(total, mixing.WEIGHTS, 3), Counter(), []
    for r in sorted(rows, key=lambda r: hashlib.md5(str(r[0]).encode()).hexdigest()):
        whole = int(target[r[3]] // total[r[3]])
        rest = target[r[3]] - whole * total[r[3]]
        more = whole < 3 and 0 < rest and before[r[3]] + size[r[0]] / 2 <= rest
        before[r[3]] += size[r[0]]
        out += [r] * (whole + more)
    return out


def test_stages(spark, tmp_path):
    rows = corpus()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    expected = rows
    assert [len(corpus_pipeline.STAGES), corpus_pipeline.ORACLE_SQL] == [5, None]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == COLUMNS
        docs.write.parquet(str(tmp_path / f"stage-{k}"))
        docs = spark.read.parquet(str(tmp_path / f"stage-{k}"))
        if k == 0:
            expected = [r for r in rows if not base(r[1])[-1]]
        elif k == 1:
            expected = one_of_each(expected)
        elif k == 2:
            first = {d: c for d, _, c in brute([(r[0], r[1]) for r in expected])}
            expected = [r for r in expected if first[r[0]] == r[0]]
        else:
            expected = mixed(expected)
        assert sorted(map(tuple, docs.collect()), key=str) == sorted(expected, key=str)
    assert 20 < len(set(expected)) < len(expected)
    got = corpus_pipeline.STAGES[4][1](spark, docs, str(tmp_path)).collect()
    wanted = [(r[0], *p) for r in expected for p in pieces_by_tokenizer(r[1], corpus_pipeline.SIZE)]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(wanted)
    assert_packed(got, corpus_pipeline.SIZE)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(wanted)
