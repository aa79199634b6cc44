"""Join shapes used by several plans.

No join here carries a broadcast hint: games and players grow with the data. Spark broadcasts a
side below its size threshold by itself, and splits skewed partitions of the others at run time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which NULL keys match each other; the keys appear once, from the left."""
    renamed = right.withColumnsRenamed({key: f"_{key}" for key in keys})
    matches = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys]
    joined = left.join(renamed, reduce(Column.__and__, matches), how)
    return joined.drop(*[f"_{key}" for key in keys])


def lookup(df: DataFrame, dim: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Attach ``dim.value`` by key as ``name``; a key without an entry stands for itself."""
    entries = dim.select(F.col(key), F.col(value).alias("_found"))
    joined = df.join(entries, key, "left")
    return joined.withColumn(name, F.coalesce("_found", F.col(key).cast("string"))).drop("_found")


def narrow(df: DataFrame, **equals) -> DataFrame:
    """Keep rows with the given column values; None leaves a column free."""
    for column, value in equals.items():
        if value is not None:
            df = df.where(F.col(column) == F.lit(value))
    return df
