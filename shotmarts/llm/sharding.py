"""Sharding by histogram sort.

Rows are sorted by a 64-bit key and cut into shards of near equal bytes. The exact bytes and rows
of key ranges are counted across all partitions. Ranges that a shard boundary cuts, beyond the
tolerance, and ranges too large for one task are counted again at finer boundaries, until the
splitters hold. Only then are rows exchanged, once, by the range they belong to.

The upper half of a key comes from the text, so equal texts lie side by side; the lower half comes
from ``doc_id``, so a large group of copies can be cut anywhere. The counting rounds read only keys
and sizes, which are written once.

Defined cases: a NULL text has no bytes and counts 1; a NULL ``doc_id`` is a value like others;
rows equal in ``doc_id`` and text share a key and stay in one range; an empty table gives an empty
result. Other columns are carried along.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shotmarts.llm import common

#: A table is cut into at most about this many ranges, which bounds what the driver holds.
MOST_RANGES = 65_536


@dataclass
class Cells:
    """Counts of key ranges, side by side in key order: first key, bits, bytes, rows."""

    first: np.ndarray
    bits: np.ndarray
    size: np.ndarray
    rows: np.ndarray


def key_of(text: str = "text") -> Column:
    upper = F.xxhash64(common.whole_text(text)).bitwiseAND(F.lit(-(1 << 32)).cast("long"))
    return upper.bitwiseOR(F.xxhash64("doc_id", F.lit("row")).bitwiseAND(F.lit((1 << 32) - 1)))


def size_of(text: str = "text") -> Column:
    return F.octet_length(common.whole_text(text)).cast("long") + 1


def _counted(keys: DataFrame, within: Cells | None, bits: int) -> Cells:
    """Counts of all ranges of ``bits`` bits, or of those inside the ranges ``within``."""
    if within is not None:
        known = int(within.bits[0])
        inside = [int(x) for x in within.first >> (64 - known)]
        keys = keys.where(F.shiftright("key", 64 - known).isin(inside))
    counts = keys.groupBy(F.shiftright("key", 64 - bits).alias("cell")).agg(
        F.sum("size").alias("size"), F.count("*").alias("rows")
    )
    found = counts.toPandas().sort_values("cell")
    first = found["cell"].to_numpy(np.int64) << (64 - bits)
    return Cells(
        first, np.full(len(first), bits), found["size"].to_numpy(np.int64), found["rows"].to_numpy(np.int64)
    )


def find_ranges(
    keys: DataFrame, n_shards: int, tolerance: float, range_bytes: int, probe_bits: int
) -> tuple[Cells, np.ndarray]:
    """Ranges in key order and the shard of each."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    range_bytes = max(range_bytes, total // MOST_RANGES)
    bits = max(probe_bits, (8 * total // range_bytes).bit_length())
    cells = _counted(keys, None, bits)
    while True:
        upto = np.cumsum(cells.size)
        ideal = max(1.0, total / n_shards)
        cut = (upto - 1) // ideal != (upto - cells.size) // ideal
        off = np.minimum((upto - cells.size) % ideal, ideal - (upto - cells.size) % ideal)
        far = np.minimum(upto % ideal, ideal - upto % ideal)
        open_cut = cut & (np.minimum(off, far) > tolerance * ideal)
        again = (open_cut | (cells.size > range_bytes)) & (cells.rows > 1) & (cells.bits < 64)
        if not again.any():
            break
        parts = [Cells(*(a[~again] for a in (cells.first, cells.bits, cells.size, cells.rows)))]
        for known in np.unique(cells.bits[again]):
            some = again & (cells.bits == known)
            one = Cells(*(a[some] for a in (cells.first, cells.bits, cells.size, cells.rows)))
            parts.append(_counted(keys, one, min(64, int(known) + probe_bits)))
        joined = [np.concatenate(x) for x in zip(*((p.first, p.bits, p.size, p.rows) for p in parts))]
        order = np.argsort(joined[0], kind="stable")
        cells = Cells(*(a[order] for a in joined))
    middle = np.cumsum(cells.size) - cells.size / 2
    shard = np.minimum((middle // max(1.0, total / n_shards)).astype(np.int64), n_shards - 1)
    # Neighbours of one shard become one range as long as it is small.
    group, fill, last = np.zeros(len(shard), np.int64), 0, None
    number = -1
    for i in range(len(shard)):
        if shard[i] != last or fill + cells.size[i] > range_bytes:
            number, fill, last = number + 1, 0, shard[i]
        group[i], fill = number, fill + cells.size[i]
    starts = np.flatnonzero(np.diff(group, prepend=-1))
    sums = [np.add.reduceat(a, starts) if len(a) else a for a in (cells.size, cells.rows)]
    return Cells(cells.first[starts], cells.bits[starts], *sums), shard[starts]


def shard(
    docs: DataFrame,
    n_shards: int = 16,
    tolerance: float = 0.0005,
    range_bytes: int = 32 << 20,
    probe_bits: int = 12,
) -> DataFrame:
    """The rows with ``shard_key``, ``shard_size``, ``shard`` and ``slot``, gapless from 0 in each
    shard in the order of the key. Such columns of the input are replaced."""
    ws = common.Workspace(docs.sparkSession, "sharding")
    keys = ws.store(docs.select(key_of().alias("key"), size_of().alias("size")), "keys")
    ranges, shards = find_ranges(keys, n_shards, tolerance, range_bytes, probe_bits)
    ws.drop("keys")
    slots = np.cumsum(ranges.rows) - ranges.rows
    firsts = np.searchsorted(shards, shards, side="left")
    slots = slots - slots[firsts] if len(slots) else slots
    lower, shards, slots = ranges.first, shards.astype(np.int32), slots

    common.ship(docs.sparkSession)

    @F.pandas_udf("range int, shard int, slot long")
    def place(keys: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(lower, keys.to_numpy(), side="right") - 1
        return pd.DataFrame({"range": at, "shard": shards[at], "slot": slots[at]})

    mine = {"shard_key", "shard_size", "shard", "slot"}
    carried = [c for c in docs.columns if c.lower() not in mine]
    row = F.struct(*carried).alias("row")
    placed = docs.select(row, key_of().alias("key"), size_of().alias("size"))
    placed = placed.withColumn("place", place("key")).select(
        "row", "key", "size", "place.range", "place.shard", "place.slot"
    )
    # One partition per range, each of at most ``range_bytes``: the range's id is its partition, so
    # a task holds one range whatever the input, and rows are numbered by their place in it.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.repartitionById(max(len(lower), 1), "range")
        .sortWithinPartitions("key", "size")
        .withColumn("slot", F.col("slot") + place)
        .select(
            "row.*", F.col("key").alias("shard_key"), F.col("size").alias("shard_size"), "shard", "slot"
        )
    )
