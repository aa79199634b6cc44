"""Importance resampling towards a target distribution, with weights summed over bit planes.

Features are the words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text after A-Z is lower-cased
(n-grams of 1 to ``n`` words, joined by one space, repeats counted). Each feature falls in bucket
``crc32(utf8) % 10000``. Over all documents there are S features, s in a bucket; over the target
texts T and t. A bucket's gain is ``floor(1000 * ln((t+1)(S+10000) / ((s+1)(T+10000))))``.

How the weights are summed (the method): a document's bucket counts ``c`` are cut into bit planes,
``C_i = {b : bit i of c_b is 1}``, each a 10000-bit set. Gains are split by sign and cut the same
way, ``G+_j`` and ``G-_j``. Then exactly

    weight = sum_ij 2^(i+j) * (popcount(C_i & G+_j) - popcount(C_i & G-_j)).

Texts are tokenised once, in Python over UTF-8 bytes, into sparse bucket counts per document, which
are stored; the corpus counts are a JVM aggregate over them (combined before the shuffle, at most
10000 rows leave a task). The gain planes are 10000 bits each, fixed in size whatever the input, and
go to every task with the Python function; the planes of a batch of documents are NumPy arrays.

Drawing: ``score = weight + floor(-1000 * ln(-ln((h + 0.5) / 2^32)))`` where ``h`` is the first 8 hex
digits of ``sha256("2024:<doc_id>")`` (Gumbel top-k, so drawing the k highest scores samples without
replacement in proportion to ``exp(weight / 1000)``). Of the N documents with at least ``least_words``
words, the ``floor(percent * N / 100)`` highest scores are drawn, ties to the smaller ``doc_id``. The rank is
a global order: rows are range-partitioned by score (Spark samples the splitters), sorted in each
partition, and numbered by adding the counts of the partitions before; no task holds more than its
range, no window runs over all rows.

Odd rows:

* NULL text: no features, weight 0. NULL target text: no features.
* NULL ``doc_id``: counted in S and s, weight as any other; score and rank NULL, not among the N.
* Repeated rows (same ``doc_id`` and text): each is its own document, equal scores, ranks apart.
* Empty tables: S = 0 or T = 0 work through the formula; nothing drawn from no documents.
* Other columns of the input, also ones named like the output, are not read and not returned.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shotmarts.llm import common

# Fixed values of the contract: the word pattern, the number of buckets, the salt of the draw.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
SALT = "2024"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


#: Words on UTF-8 bytes: every byte of a multi-byte character is at least 0x80, so this is the
#: pattern above on code points.
_WORD_BYTES = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def features(text: bytes | None, n: int = 1) -> tuple[int, list[bytes]]:
    """(number of words, all runs of 1 to ``n`` consecutive words joined by one space)."""
    words = _WORD_BYTES.findall((text or b"").translate(_LOWER))
    runs = list(words)
    for k in range(2, n + 1):
        runs += [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)]
    return len(words), runs


def counted(texts: DataFrame, n: int = 1) -> DataFrame:
    """Per row of (row_id, doc_id, text): n_words, n_features and the sparse bucket counts
    (``buckets`` ascending, ``counts``). Texts are tokenised once, here."""

    def work(rows: list[dict]) -> Iterator[tuple]:
        for row in rows:
            n_words, found = features(row["t"], n)
            b = np.fromiter((zlib.crc32(f) % BUCKETS for f in found), np.int32, len(found))
            at, c = np.unique(b, return_counts=True)
            yield row["row_id"], row["doc_id"], n_words, len(found), at.tolist(), c.tolist()

    prepared = texts.select("row_id", "doc_id", F.col("text").cast("binary").alias("t"))
    schema = "row_id long, doc_id long, n_words long, n_features long, buckets array<int>, counts array<int>"
    return common.map_rows(prepared, schema, work, rows=2_000)


def bucket_counts(counts: DataFrame) -> DataFrame:
    """(bucket, count) over all rows of sparse counts; combined in each task, at most 10000 rows."""
    pairs = counts.select(F.explode(F.arrays_zip("buckets", "counts")).alias("p"))
    return pairs.groupBy(F.col("p.buckets").alias("bucket")).agg(F.sum("p.counts").alias("count"))


def gains(docs: DataFrame, target: DataFrame) -> np.ndarray:
    """Gain of every bucket, as int64, from sparse counts of documents and target texts. The table
    is 10000 rows, whatever the input."""
    totals = [
        {r.bucket: r["count"] for r in bucket_counts(side).collect()} for side in (docs, target)
    ]
    s = np.array([totals[0].get(b, 0) for b in range(BUCKETS)], np.float64)
    t = np.array([totals[1].get(b, 0) for b in range(BUCKETS)], np.float64)
    ratio = ((t + 1.0) * (s.sum() + 10000.0)) / ((s + 1.0) * (t.sum() + 10000.0))
    return np.floor(1000.0 * np.log(ratio)).astype(np.int64)


def planes(values: np.ndarray) -> np.ndarray:
    """Bit planes of non-negative integers over the last axis: shape (..., bits, words of 64 bits)."""
    bits = max(int(values.max(initial=0)).bit_length(), 1)
    width = -(-values.shape[-1] // 64) * 64
    padded = np.zeros((*values.shape[:-1], width), np.int64)
    padded[..., : values.shape[-1]] = values
    out = []
    for i in range(bits):
        packed = np.packbits(((padded >> i) & 1).astype(np.uint8), axis=-1, bitorder="little")
        out.append(packed.view(np.uint64))
    return np.stack(out, axis=-2)


def sliced_weights(counts: np.ndarray, gain_planes: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """sum_b counts[d, b] * gain[b] per row d, by popcounts of ANDed bit planes, exactly."""
    doc_planes = planes(counts)  # (docs, i, words)
    total = np.zeros(counts.shape[0], np.int64)
    for sign, g in zip((1, -1), gain_planes, strict=True):
        for j in range(g.shape[0]):
            pop = np.bitwise_count(doc_planes & g[j]).sum(axis=-1, dtype=np.int64)  # (docs, i)
            scale = np.left_shift(np.int64(1), np.arange(doc_planes.shape[1], dtype=np.int64) + j)
            total += sign * (pop * scale).sum(axis=-1)
    return total


def weigh(counts: DataFrame, gain: np.ndarray, batch: int = 256) -> DataFrame:
    """(row_id, doc_id, n_words, n_features, weight) from sparse counts; NumPy sums bit planes."""
    gain_planes = (planes(np.maximum(gain, 0)[None])[0], planes(np.maximum(-gain, 0)[None])[0])

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in source:
            for start in range(0, whole.num_rows, batch):
                part = whole.slice(start, batch)
                at, c = part.column("buckets"), part.column("counts")
                sizes = np.diff(at.offsets.to_numpy())
                owner = np.repeat(np.arange(len(sizes)), sizes)
                dense = np.zeros(len(sizes) * BUCKETS, np.int64)
                dense[owner * BUCKETS + at.flatten().to_numpy(zero_copy_only=False)] = (
                    c.flatten().to_numpy(zero_copy_only=False)
                )
                weights = sliced_weights(dense.reshape(len(sizes), BUCKETS), gain_planes)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row_id"), part.column("doc_id"), part.column("n_words"),
                     part.column("n_features"), pa.array(weights, pa.int64())],
                    names=["row_id", "doc_id", "n_words", "n_features", "weight"],
                )

    common.ship(counts.sparkSession)
    return counts.mapInArrow(batches, "row_id long, doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column | str = "doc_id") -> Column:
    """floor(-1000 ln(-ln((h + 0.5) / 2^32))), h the first 8 hex digits of sha256("2024:<doc_id>")."""
    key = F.concat(F.lit(SALT + ":"), F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string"))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    n: int = 1,
    percent: int = 10,
    least_words: int = 20,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_features, weight, score, rank (long; NULL where not drawn)."""
    spark = docs.sparkSession
    ws = common.Workspace(spark, "resampling")
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "text")
    counts = ws.store(counted(rows, n), "counts")
    aims = counted(target.select(F.lit(0).cast("long").alias("row_id"), F.lit(None).cast("long").alias("doc_id"), "text"), n)
    gain = gains(counts, aims)
    weighed = weigh(counts, gain)
    eligible = F.col("doc_id").isNotNull() & (F.col("n_words") >= least_words)
    scored = weighed.select(
            "row_id", "doc_id", "n_features", "weight",
            F.when(F.col("doc_id").isNotNull(), (F.col("weight") + noise()).cast("long")).alias("score"),
            eligible.alias("eligible"),
    )
    # Range partitions by (score desc, doc_id, row_id): Spark samples the splitters; the row_id
    # splits even rows that agree in all else.
    order = [F.col("eligible").desc(), F.col("score").desc_nulls_last(), F.col("doc_id").asc_nulls_last(), "row_id"]
    scored = ws.store(scored, "scored")
    ws.drop("counts")
    ordered = (
        scored.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("at", F.monotonically_increasing_id())
    )
    stored = ws.store(ordered, "ordered")
    ws.drop("scored")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = stored.where("eligible").groupBy(part.alias("part")).count().collect()
    total = sum(r["count"] for r in sizes)
    drawn = percent * total // 100
    before, running = {}, 0
    for r in sorted(sizes, key=lambda r: r.part):
        before[r.part], running = running, running + r["count"]
    starts = F.create_map(*[x for p, b in before.items() for x in (F.lit(p), F.lit(b))]) if before else None
    rank = place + 1 + (F.element_at(starts, part) if starts is not None else F.lit(0))
    return stored.select(
        "doc_id", "n_features", "weight", "score",
        F.when(F.col("eligible") & (rank <= drawn), rank).cast("long").alias("rank"),
    )
