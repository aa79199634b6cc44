"""Ranks within a group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shotmarts.functions.numeric import round_half_up, to_fixed_point
from shotmarts.operators.joins import join_null_safe
from shotmarts.operators.windows import BLOCK_SPAN, sum_before
from shotmarts.sources.tables import staged


class Metric(NamedTuple):
    """Column to rank by, the digits it is rounded to, and the direction."""

    column: str
    digits: int
    descending: bool = False


def percent_ranks(
    df: DataFrame,
    by: str,
    metrics: Mapping[str, Metric],
    digits: int = 3,
    span: int = BLOCK_SPAN,
) -> DataFrame:
    """``percent_rank`` of several metrics within each group; a NULL metric ranks highest.

    Sorting a whole group in one task would not survive a large group, and each metric would sort
    it anew. As the metrics are rounded, their values lie on a grid: rows are counted per grid
    value with map-side combining, the counts are added up in blocks of grid values, and each row
    looks its rank up. Only distinct values are ever sorted.
    """
    rows = staged(df, "ranked-rows")
    own = F.struct(*df.columns)
    # One row per metric; the first also carries the ranked row itself, so one join serves all.
    cells = [
        F.struct(
            F.lit(name).alias("metric"),
            _grid(metric).alias("grid"),
            F.when(F.lit(i == 0), own).alias("row"),
        )
        for i, (name, metric) in enumerate(metrics.items())
    ]
    ranks = _rank_table(rows, by, metrics, digits, span)
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    spread = numbered.select("_row", by, F.inline(F.array(*cells)))
    ranked = join_null_safe(spread, ranks, [by, "metric", "grid"], "left")
    columns = [
        F.max(F.when(F.col("metric") == name, F.col("pct_rank"))).alias(name) for name in metrics
    ]
    gathered = ranked.groupBy("_row").agg(F.first("row", ignorenulls=True).alias("row"), *columns)
    return gathered.select("row.*", *metrics)


def _grid(metric: Metric) -> Column:
    value = to_fixed_point(F.col(metric.column), metric.digits)
    return -value if metric.descending else value


def _rank_table(
    df: DataFrame, by: str, metrics: Mapping[str, Metric], digits: int, span: int
) -> DataFrame:
    """Percent rank of each distinct (group, metric, grid value)."""
    pairs = [
        F.struct(F.lit(name).alias("metric"), _grid(metric).alias("grid"))
        for name, metric in metrics.items()
    ]
    counts = (
        df.select(by, F.inline(F.array(*pairs)))
        .groupBy(by, "metric", "grid")
        .agg(F.count("*").alias("rows"))
        .withColumn("block", F.floor(F.col("grid") / F.lit(span)).cast("bigint"))
    )
    group = Window.partitionBy(by, "metric")
    blocks = counts.groupBy(by, "metric", "block").agg(F.sum("rows").alias("block_rows"))
    blocks = blocks.select(
        by,
        "metric",
        "block",
        sum_before("block_rows", group.orderBy(F.col("block").asc_nulls_last())).alias("offset"),
        F.sum("block_rows").over(group).alias("group_rows"),
    )
    within = Window.partitionBy(by, "metric", "block").orderBy(F.col("grid").asc_nulls_last())
    placed = counts.withColumn("before", sum_before("rows", within))
    joined = join_null_safe(placed, blocks, [by, "metric", "block"], "inner")
    ahead = (F.col("before") + F.col("offset")).cast("double")
    share = F.coalesce(ahead / F.nullif(F.col("group_rows") - 1, F.lit(0)), F.lit(0.0))
    return joined.select(by, "metric", "grid", round_half_up(share, digits).alias("pct_rank"))


def league_rank(column: str, by: Sequence[str], ascending: bool = False) -> Column:
    """Rank with ties on the lowest place; a row without a value is unranked.

    For tables of clubs, of which a season has a few dozen whatever the size of the shot data.
    """
    c = F.col(column)
    order = c.asc_nulls_last() if ascending else c.desc_nulls_last()
    rank = F.rank().over(Window.partitionBy(*by).orderBy(order))
    return F.when(c.isNotNull(), rank.cast("bigint"))
