"""Exact deduplication with an extendible-hash index on shared files.

Texts are equal when they are identical without white space ``[\\x20\\x09-\\x0D]``. Grouping by hash
and text compares the bytes; it combines copies before they are shuffled, so a large group of
copies travels as one row per task. Each different text becomes an index entry. The directory starts
with about enough buckets and doubles where one is overfull: its entries go by more bits of the
hash. Entries are written in bucket order, each file holding a range of keys, with different texts
of one hash chained. Documents then find their entry by bucket, hash and digest.

Of equal texts the row with the most code points stays, then the one with the smallest ``doc_id``
(NULL last). Defined cases: a NULL text is empty; of rows repeated with their ``doc_id`` one stays;
an empty table gives an empty result. Other columns of the input are not read.

DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shotmarts.llm import common

WIDE = "decimal(38,0)"
#: Ranks of ``doc_id`` lie below this. A better document has a greater code points x RANKS + rank.
RANKS = f"cast({1 << 65} as {WIDE})"


def normalized(text: str = "text") -> Column:
    return F.regexp_replace(common.whole_text(text), r"[\x20\x09-\x0D]+", "")


def _score() -> Column:
    rank = f"coalesce(cast({1 << 63} as {WIDE}) - cast(doc_id as {WIDE}), cast(0 as {WIDE}))"
    return F.expr(f"cast(cast(chars as decimal(10,0)) * cast({1 << 65} as decimal(20,0)) + {rank} as {WIDE})")


def _best_id() -> Column:
    rank = f"(best % {RANKS})"
    return F.expr(f"case when {rank} > 0 then cast({1 << 63} - {rank} as bigint) end")


def _prefix(h: Column, depth: int) -> Column:
    """The first ``depth`` bits of a hash in place, and the depth in the last bits."""
    if depth == 0:
        return F.lit(0).cast("long")
    mask = -(1 << (64 - depth))
    return h.bitwiseAND(F.lit(mask).cast("long")).bitwiseOR(F.lit(min(depth, 63)).cast("long"))


class Directory:
    """Which bucket a hash belongs to. ``split`` holds, for each depth, the buckets that were
    overfull there: hash values are even, so they are few however large the table is."""

    def __init__(self, depth: int) -> None:
        self.depth = depth
        self.split: list[list[int]] = []

    def bucket(self, h: Column) -> Column:
        bucket = _prefix(h, self.depth)
        for more, overfull in enumerate(self.split, 1):
            finer = _prefix(h, self.depth + more)
            bucket = F.when(bucket.isin(overfull), finer).otherwise(bucket)
        return bucket


def build_directory(entries: DataFrame, capacity: int, most_depth: int = 60) -> Directory:
    """Doubles until no bucket holds more than ``capacity`` entries of different hashes."""
    n = entries.count()
    directory = Directory(max(0, math.ceil(math.log2(max(1, n) / capacity))))
    h = F.col("h")
    while directory.depth + len(directory.split) < most_depth:
        filled = entries if not directory.split else entries.where(
            _below(directory, h).isin(directory.split[-1])
        )
        counts = filled.groupBy(directory.bucket(h).alias("bucket")).agg(
            F.count("*").alias("n"), (F.min("h") < F.max("h")).alias("many")
        )
        overfull = [r.bucket for r in counts.where(f"n > {capacity} and many").collect()]
        if not overfull:
            break
        directory.split.append(overfull)
    return directory


def _below(directory: Directory, h: Column) -> Column:
    """The bucket before the last doubling."""
    before = Directory(directory.depth)
    before.split = directory.split[:-1]
    return before.bucket(h)


def classes(docs: DataFrame, capacity: int = 250_000, hash_bits: int = 64) -> DataFrame:
    """One row per document: ``row_id``, ``doc_id``, ``keep_id``, ``group_size``, ``kept``,
    ``text_sha256`` and the entry's place in its ``chain``.

    ``hash_bits`` below 64 makes hashes collide, for tests. ``docs`` may bring a ``row_id``.
    """
    ws = common.Workspace(docs.sparkSession, "exact")
    own = F.col("row_id") if "row_id" in docs.columns else F.monotonically_increasing_id()
    rows = docs.select(
        own.alias("row_id"), "doc_id", normalized().alias("norm"),
        F.length(common.whole_text()).alias("chars"),
    )
    h = F.xxhash64("norm")
    if hash_bits < 64:
        h = h.bitwiseAND(F.lit(-(1 << (64 - hash_bits))).cast("long"))
    rows = rows.withColumn("h", h)
    grouped = rows.groupBy("h", "norm").agg(
        F.count("*").alias("group_size"), F.max(_score()).alias("best")
    )
    entries = ws.store(
        grouped.select("h", F.sha2("norm", 256).alias("sha"), "group_size", _best_id().alias("keep_id")),
        "entries",
    )
    directory = build_directory(entries, capacity)
    chained = Window.partitionBy("bucket", "h").orderBy("sha")
    index = ws.store(
        entries.withColumn("bucket", directory.bucket(F.col("h")))
        .repartitionByRange("bucket", "h")
        .withColumn("chain", F.row_number().over(chained))
        .sortWithinPartitions("bucket", "h", "chain"),
        "index",
    )
    ws.drop("entries")

    looked_up = rows.select(
        "row_id", "doc_id", "h", directory.bucket(F.col("h")).alias("bucket"),
        F.sha2("norm", 256).alias("sha"),
    ).join(index, ["bucket", "h", "sha"])
    # Rows repeated with their doc_id: one of them stays. The others are dealt out by doc_id.
    best = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    apart = F.when(~best, F.xxhash64("doc_id", "row_id"))
    first = F.row_number().over(Window.partitionBy("sha", apart).orderBy("row_id")) == 1
    return looked_up.select(
        "row_id", "doc_id", "keep_id", "group_size", (best & first).alias("kept"),
        F.col("sha").alias("text_sha256"), "chain",
    )


def deduplicate(docs: DataFrame, capacity: int = 250_000) -> DataFrame:
    """The whole rows that stay, in the input's columns."""
    ws = common.Workspace(docs.sparkSession, "unique")
    row_id = F.monotonically_increasing_id().alias("row_id")
    stored = ws.store(docs.select(row_id, F.struct(*docs.columns).alias("row")), "rows")
    found = classes(stored.select("row_id", "row.doc_id", "row.text"), capacity)
    return stored.join(found.where("kept"), "row_id", "left_semi").select("row.*")
