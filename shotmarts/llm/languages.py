"""Language identification with language-bitmask n-gram filters.

A bit-sliced Bloom filter holds the n-grams of all languages at once: each slot is a mask with a bit
per language, and the AND of an n-gram's slots gives every language that contains it. For a text the
hits of each language are counted over all its n-grams and corrected for the filter's false
positives. The language with the greatest corrected share is chosen.

Fitting reads a bounded sample: about ``sample`` labelled documents of each language, drawn by hash,
with their whole texts. An n-gram is learned for a language when enough of its sampled documents
hold it, and not far fewer, by share, than of any other language. That leaves out n-grams of quoted
foreign lines.

Defined cases: a text that is NULL or has no letter is ``und`` with score 0; a text that fits no
language gets the most common one with score 0; rows are judged one by one, so repeats agree; a
table without labels gives ``und`` throughout. Other columns of the input are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shotmarts.llm import common

#: Letters of an n-gram, with one blank for a border between words.
SIZE = 4
SLOTS = 1 << 20
PROBES = 3
#: Code points of a text that are looked at in one go.
STEP = 1 << 20
UNKNOWN = "und"


@functools.cache
def letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def gram_hashes(text: str) -> Iterator[np.ndarray]:
    """64-bit hashes of all n-grams that have a letter everywhere but at their ends."""
    for at in range(0, max(1, len(text)), STEP):
        part = text[max(0, at - SIZE) : at + STEP].lower()
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.concatenate([[0], codes, [0]]).astype(np.uint64)
        letter = letters()[codes.astype(np.int64)]
        codes[~letter] = 0
        n = len(codes) - SIZE + 1
        inside = np.ones(max(n, 0), bool)
        grams = np.zeros(max(n, 0), np.uint64)
        for k in range(SIZE):
            if n > 0:
                grams = grams * np.uint64(0x110001) + codes[k : k + n]
                if 0 < k < SIZE - 1:
                    inside &= letter[k : k + n]
        mixed = grams[inside]
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        yield mixed ^ (mixed >> np.uint64(32))


def slots(hashes: np.ndarray) -> list[np.ndarray]:
    step = (hashes >> np.uint64(40)) | np.uint64(1)
    return [((hashes + np.uint64(k) * step) % np.uint64(SLOTS)).astype(np.int64) for k in range(PROBES)]


@dataclass
class Model:
    """``names`` in order of their bits; ``masks`` by slot, one row for every 8 languages."""

    names: list[str]
    masks: np.ndarray
    #: Language for texts that fit none.
    common: str
    #: Chance that the filter claims an n-gram for a language that lacks it.
    false: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float]:
        hits, total = np.zeros(len(self.names)), 0
        for hashes in gram_hashes(text or ""):
            total += len(hashes)
            at = slots(hashes)
            for byte, masks in enumerate(self.masks):
                both = masks[at[0]]
                for more in at[1:]:
                    both = both & masks[more]
                counts = np.bincount(both, minlength=256)
                for bit in range(min(8, len(self.names) - 8 * byte)):
                    hits[8 * byte + bit] += counts[(np.arange(256) >> bit) & 1 == 1].sum()
        if not any(c.isalpha() for c in text or "") or not self.names:
            return UNKNOWN, 0.0
        share = np.clip((hits / max(total, 1) - self.false) / (1 - self.false), 0, 1)
        if not share.any():
            return self.common, 0.0
        best = int(share.argmax())
        return self.names[best], float(share[best] / share.sum())


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(
    labelled: DataFrame, sample: int = 2000, min_docs: int = 3, least_ratio: float = 0.2
) -> Model:
    """``labelled`` has ``doc_id``, ``text`` and ``lang``. Rows without text or language are left
    out. Languages number in the tens or hundreds; their names and the filter go to the driver."""
    known = labelled.select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    known = known.where("text is not null and lang is not null")
    amounts = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}
    names = sorted(amounts)
    if not names:
        return Model([], np.zeros((0, SLOTS), np.uint8), UNKNOWN, np.zeros(0))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000))
    wanted = F.create_map(
        *(F.lit(x) for name in names for x in (name, 1 + int(1e6 * min(1.0, sample / amounts[name]))))
    )
    drawn = known.where(draw < wanted[F.col("lang")])

    def grams(rows: list[dict]) -> Iterator[tuple]:
        by_lang: dict[str, list[np.ndarray]] = {}
        docs: dict[str, int] = {}
        for row in rows:
            found = np.unique(np.concatenate(list(gram_hashes(row["text"]))))
            by_lang.setdefault(row["lang"], []).append(found)
            docs[row["lang"]] = docs.get(row["lang"], 0) + 1
        for lang, arrays in by_lang.items():
            values, counts = np.unique(np.concatenate(arrays), return_counts=True)
            yield from ((lang, int(v) - (1 << 63), int(c)) for v, c in zip(values, counts, strict=True))
            yield (lang, None, docs[lang])

    counted = common.map_rows(drawn, "lang string, gram long, docs long", grams)
    ws = common.Workspace(labelled.sparkSession, "languages")
    counted = ws.store(counted.groupBy("lang", "gram").agg(F.sum("docs").alias("docs")), "grams")
    sampled = {r.lang: r.docs for r in counted.where("gram is null").collect()}
    rate = F.col("docs") / F.create_map(
        *(F.lit(x) for name in names for x in (name, max(1, sampled.get(name, 0))))
    )[F.col("lang")]
    shares = counted.where(f"gram is not null and docs >= {min_docs}").withColumn("rate", rate)
    bit = F.create_map(*(F.lit(x) for i, name in enumerate(names) for x in (name, i)))[F.col("lang")]
    most = shares.groupBy("gram").agg(F.max("rate").alias("most"))
    chosen = shares.join(most, "gram").where(f"rate >= {least_ratio} * most")
    per_byte = chosen.select((F.floor(bit / 8)).cast("int").alias("byte"), (bit % 8).alias("bit"), "gram")

    def bits(rows: list[dict]) -> Iterator[tuple]:
        hashes = np.array([r["gram"] + (1 << 63) for r in rows], np.uint64)
        for at in slots(hashes):
            yield from ((r["byte"], s, 1 << r["bit"]) for r, s in zip(rows, at.tolist(), strict=True))

    filled = common.map_rows(per_byte, "byte int, slot long, mask int", bits)
    filled = filled.groupBy("byte", "slot").agg(F.bit_or("mask").alias("mask")).toPandas()
    ws.drop("grams")
    masks = np.zeros(((len(names) + 7) // 8, SLOTS), np.uint8)
    masks[filled["byte"].to_numpy(), filled["slot"].to_numpy()] = filled["mask"].to_numpy()
    fill = np.array([((masks[i // 8] >> (i % 8)) & 1).mean() for i in range(len(names))])
    return Model(names, masks, max(names, key=lambda n: amounts[n]), fill**PROBES)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    types = dict(docs.dtypes)

    def work(rows: list[dict]) -> Iterator[tuple]:
        known = shared.value
        for row in rows:
            yield (row["doc_id"], *known.predict(row["text"]))

    schema = f"doc_id {types['doc_id']}, lang_pred string, score double"
    return common.map_rows(docs.select("doc_id", "text"), schema, work)
