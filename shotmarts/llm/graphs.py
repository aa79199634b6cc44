"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shotmarts.llm import common


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Links each neighbour of a vertex to the least of vertex and neighbours: the larger
    neighbours for large stars, the smaller ones and the vertex itself for small ones."""
    back = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    both = edges.unionByName(back)
    if not large:
        both = both.where("b < a")
    least = both.groupBy("a").agg(F.min("b").alias("least")).withColumn("m", F.least("a", "least"))
    met = both.join(least.select("a", "m"), "a")
    if large:
        linked = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        own = least.select("a", F.col("m").alias("b"))
        linked = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(own)
    return linked.where("a != b").distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``vertex`` and ``component``, its least vertex, for every vertex of the links ``a``, ``b``."""
    ws = common.Workspace(edges.sparkSession, "components")
    links = ws.store(edges.where("a != b").select("a", "b").distinct(), "round-0")
    mark = None
    for number in range(1, most_rounds + 1):
        links = ws.store(_stars(_stars(links, large=True), large=False), f"round-{number}")
        ws.drop(f"round-{number - 1}")
        now = links.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")
        ).first()
        if now == mark:
            return links.select(F.col("a").alias("vertex"), F.col("b").alias("component")).unionByName(
                links.select(F.col("b").alias("vertex"), F.col("b").alias("component")).distinct()
            )
        mark = now
    raise RuntimeError(f"links did not contract in {most_rounds} rounds")
