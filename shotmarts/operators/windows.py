"""Windows whose tasks stay small however many rows one key holds.

A plain window brings all rows of a key into one task. The operators here cut each key into
blocks of the order column that can hold only a known number of rows, work within the blocks, and
carry between blocks only what the next one needs: a count, or the last few rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from shotmarts.functions.numeric import safe_div, to_fixed_point
from shotmarts.operators.joins import join_null_safe

BLOCK_SPAN = 4096  # order values per block


def _block(order: str, span: int) -> Column:
    return F.floor(F.col(order) / F.lit(span)).cast("bigint")


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    name: str,
    tiebreak: Sequence[str] = (),
    span: int = BLOCK_SPAN,
) -> DataFrame:
    """``row_number`` of each key by a whole-number order column (then ``tiebreak``).

    A block covers ``span`` consecutive order values, so it holds at most ``span`` rows times the
    ties on one value. The second pass over ``df`` reads only the keys and the order column.
    """
    cut = [*keys, "_block"]
    blocked = df.withColumn("_block", _block(order, span))
    within = Window.partitionBy(*cut).orderBy(*[F.col(c).asc_nulls_last() for c in (order, *tiebreak)])
    earlier = Window.partitionBy(*keys).orderBy(F.col("_block").asc_nulls_last())
    offsets = (
        blocked.groupBy(*cut)
        .agg(F.count("*").alias("_rows"))
        .select(*cut, sum_before("_rows", earlier).alias("_before"))
    )
    numbered = blocked.withColumn("_place", F.row_number().over(within))
    joined = join_null_safe(numbered, offsets, cut, "inner")
    return joined.withColumn(name, F.col("_place") + F.col("_before")).drop(
        "_block", "_place", "_before"
    )


def number_few(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """``row_number`` of each key in one sort, for keys that have few rows by nature, such as the
    games of one player or club in a season."""
    within = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.withColumn(name, F.row_number().over(within).cast("bigint"))


def sum_before(column: str, ordered: WindowSpec) -> Column:
    """Sum over the rows ahead of the current one; 0 for the first."""
    preceding = ordered.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(preceding), F.lit(0).cast("bigint"))


def rolling_mean(
    df: DataFrame,
    keys: Sequence[str],
    number: str,
    value: str,
    name: str,
    rows: int,
    digits: int = 8,
    span: int = BLOCK_SPAN,
) -> DataFrame:
    """Mean of the last ``rows`` rows, the current one included; NULLs are skipped.

    ``number`` is the 1-based row number within the key. The last ``rows - 1`` rows of a block are
    copied into the next one, where they only feed the frames of its first rows. Values are added
    as fixed-point numbers of ``digits`` digits.
    """
    own = F.floor((F.col(number) - 1) / F.lit(span)).cast("bigint")
    feeds_next = (F.col(number) - 1) % span >= span - (rows - 1)
    blocks = F.when(feeds_next, F.array(own, own + 1)).otherwise(F.array(own))
    spread = df.withColumn("_own", own).withColumn("_block", F.explode(blocks))
    frame = Window.partitionBy(*keys, "_block").orderBy(number).rowsBetween(-(rows - 1), 0)
    total = F.sum(to_fixed_point(F.col(value), digits)).over(frame)
    mean = safe_div(total.cast("double") / F.lit(10.0**digits), F.count(value).over(frame))
    kept = spread.withColumn(name, mean).where(F.col("_block") == F.col("_own"))
    return kept.drop("_own", "_block")


def last_n(
    df: DataFrame, keys: Sequence[str], order: str, n: int, name: str = "recency"
) -> DataFrame:
    """The ``n`` rows of each key with the highest order value, numbered from the newest.

    The limit is applied within each input partition before the shuffle: a task receives at most
    ``n`` rows of a key from each of them.
    """
    newest = Window.partitionBy(*keys).orderBy(F.col(order).desc_nulls_last())
    return df.withColumn(name, F.row_number().over(newest)).where(F.col(name) <= n).withColumn(
        name, F.col(name).cast("bigint")
    )


def top_n(
    df: DataFrame, column: str, n: int, by: Sequence[str] = (), tiebreak: Sequence[str] = ()
) -> DataFrame:
    """The ``n`` highest rows: of the whole frame, or of each group."""
    order = [F.col(column).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tiebreak]]
    if not by:
        return df.orderBy(*order).limit(n)
    place = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(place)).where(F.col("_place") <= n).drop("_place")


def share_of_total(part: Column, by: Sequence[str]) -> Column:
    """Share of a grouped value in its group total, in percent.

    For rows that are already aggregated, a handful per group.
    """
    return part.cast("double") / F.sum(part).over(Window.partitionBy(*by)) * 100
