"""Incremental loads as plans over existing and new rows. Ids are compared by joins, never by
a set held in the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unseen(new: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New rows whose key is not among the existing rows."""
    return new.join(existing.select(*keys), list(keys), "left_anti")


def append_new(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing rows as they are, plus the unseen ones."""
    return existing.unionByName(unseen(new, existing, keys))


def unprocessed_games(completed: DataFrame, events: DataFrame) -> DataFrame:
    """Completed games with no event yet. Event ids are made distinct first, so the join sees
    one row per game and not one per shot."""
    return unseen(completed, events.select("game_id").distinct(), ["game_id"])


def newest_per_key(batch: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """First row of each key in the given order (the limit of one is applied before the shuffle)."""
    place = Window.partitionBy(*keys).orderBy(*order_by)
    return batch.withColumn("_place", F.row_number().over(place)).where("_place = 1").drop("_place")


def newest_documents(docs: DataFrame, key: str) -> DataFrame:
    """All documents of a key that carry its newest stamp: the pages of one answer. Only keys and
    stamps are shuffled."""
    stamps = docs.groupBy(F.col(key).alias("_key")).agg(F.max("doc_ts").alias("_newest"))
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col("doc_ts").eqNullSafe(F.col("_newest"))
    return docs.join(stamps, same).drop("_key", "_newest")


def upsert(
    existing: DataFrame, batch: DataFrame, keys: Sequence[str], order_by: Sequence[Column]
) -> DataFrame:
    """Rows of the batch replace those of equal key; the other rows stay untouched."""
    winners = newest_per_key(batch, keys, order_by)
    return unseen(existing, winners, keys).unionByName(winners)


def replace_partition(existing: DataFrame, batch: DataFrame, column: str, values: Sequence) -> DataFrame:
    """The slices named by ``values`` come from the batch, the rest stays."""
    in_slice = F.col(column).isin(*values)
    kept = existing.where(~F.coalesce(in_slice, F.lit(False)))
    return kept.unionByName(batch.where(in_slice))


def seasons_to_refresh(events: DataFrame, stats: DataFrame, year: int) -> DataFrame:
    """Seasons with events, less the finished ones that are already loaded."""
    loaded = stats.groupBy(F.col("season_id").alias("season")).agg(F.count("*").alias("rows"))
    finished = loaded.where((F.col("season") % 10000 < year) & (F.col("rows") > 0))
    return events.select("season").distinct().join(finished, "season", "left_anti")
