"""Mixing sources to target weights by a time-varying curriculum.

A source's target is its share of all words by weight, at most ``most_passes`` times its size; what
is above that is shared again by weight among the others. A source is taken whole as often as its
target allows, and once more for the documents that come first in an order drawn by hash, up to the
target.

Each source also has a weight schedule over training time 0 to 1. The integral of the schedule up
to t is the share of the source's words wanted by then. Inverting it at the running word count of a
document gives the document's training position. Passes follow each other, so repeats of a document
lie far apart. The stream is range-sorted by position.

The running count of a source is not one window over its documents: these are cut into blocks by
the first digits of their hash, with blocks summed up first. Blocks grow as the root of the table.

Defined cases: a NULL text has no words and is taken with its neighbours; a NULL source is a source
of its own and comes last; rows repeated with their ``doc_id`` follow each other; an empty table
gives an empty result. ``mix`` does not read other columns of the input.

DataFrame functions only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shotmarts.llm import common


@dataclass(frozen=True)
class Ramp:
    """A weight that goes from ``1 + tilt`` at time 0 to ``1 - tilt`` at time 1, -1 < tilt < 1."""

    tilt: float

    def position(self, share: Column) -> Column:
        """The time by which ``share`` of the words are wanted: its integral, inverted."""
        if self.tilt == 0:
            return share
        a = 1 + self.tilt
        return (a - F.sqrt(a * a - 4 * (a - 1) * share)) / (2 * (a - 1))


#: Columns that name a row by what it holds, where a caller needs them.
OWN = ("key_a", "key_b")
#: Weights repeat over the sources in order of their names.
WEIGHTS = (5, 2, 1)
#: Heavy sources early, light ones late.
SCHEDULES = (Ramp(0.5), Ramp(0.0), Ramp(-0.5))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_passes: int = 3) -> DataFrame:
    """``source``, ``source_size``, ``weight``, ``kind`` and ``target`` for a row per source.

    In order of size by weight, sources are at their cap up to some place; the first place at
    which the rest can be shared by weight without passing a cap is the one.
    """
    names = Window.orderBy(F.col("source").asc_nulls_last())
    kind = (F.row_number().over(names) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("kind") + 1)
    everything = Window.partitionBy()
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_cap.rowsBetween(0, Window.unboundedFollowing)
    shared = (
        sizes.withColumn("kind", kind)
        .withColumn("weight", weight)
        .withColumn("cap", most_passes * F.col("source_size"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("rest", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("level", F.col("rest") / F.sum("weight").over(onward))
        .withColumn("free", F.col("level") * F.col("weight") <= F.col("cap"))
        .withColumn("common", F.max(F.when(F.col("free"), F.col("level"))).over(everything))
    )
    target = F.least(F.col("cap").cast("double"), F.col("common") * F.col("weight"))
    return shared.select("source", "source_size", "weight", "kind", F.coalesce(target, F.lit(0.0)).alias("target"))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    schedules: tuple[Ramp, ...] = SCHEDULES,
    most_passes: int = 3,
) -> DataFrame:
    """One row per document: ``row_id``, ``doc_id``, ``size``, ``source_size``, ``target``,
    ``passes``, ``taken`` and ``positions``, one for each pass. Columns ``OWN`` that ``docs`` brings
    are kept."""
    ws = common.Workspace(docs.sparkSession, "mixing")
    kept = [c for c in OWN if c in docs.columns]
    own = F.col("row_id") if "row_id" in docs.columns else F.monotonically_increasing_id()
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    sized = ws.store(
        docs.select(
            own.alias("row_id"), *kept, "doc_id", "source", common.word_count().alias("size"),
            order.alias("draw"),
        ),
        "sized",
    )
    digits = max(1, math.ceil(math.log(max(2, sized.count()), 16) / 2))
    sized = sized.withColumn("block", F.substring("draw", 1, digits))
    blocks = ws.store(
        sized.groupBy("source", "block").agg(F.sum("size").alias("block_size")), "blocks"
    )
    goals = targets(blocks.groupBy("source").agg(F.sum("block_size").alias("source_size")), weights, most_passes)
    earlier = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begun = blocks.withColumn("begin", F.coalesce(F.sum("block_size").over(earlier), F.lit(0)))
    begun = begun.alias("b").join(goals.alias("g"), F.expr("b.source <=> g.source")).select(
        F.col("b.source").alias("source"), "block", "begin", "source_size", "target", "kind"
    )
    within = Window.partitionBy("d.source", "d.block").orderBy("draw", "doc_id", "size", "row_id")
    running = within.rowsBetween(Window.unboundedPreceding, 0)
    drawn = sized.alias("d").join(
        begun.alias("b"), F.expr("d.source <=> b.source and d.block = b.block")
    ).select(
        "row_id", *kept, "doc_id", F.col("d.source").alias("source"), "size", "source_size", "target", "kind",
        (F.col("begin") + F.sum("size").over(running) - F.col("size")).alias("before"),
    )
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    # Taken once more if at least half of it lies below the target.
    more = (F.col("before") + F.col("size") / 2 <= F.col("rest")) & (F.col("rest") > 0)
    counted = drawn.withColumn("whole", whole.cast("long")).withColumn("rest", rest).withColumn(
        "passes", F.col("whole") + (more & (F.col("whole") < most_passes)).cast("long")
    )
    share = lambda k: F.least(
        F.lit(1.0),
        (k * F.col("source_size") + F.col("before") + F.col("size") / 2)
        / F.greatest(F.col("target"), F.lit(1.0)),
    )

    def positions(k: Column) -> Column:
        at = schedules[0].position(share(k))
        for kind, ramp in enumerate(schedules[1:], 1):
            at = F.when(F.col("kind") == kind, ramp.position(share(k))).otherwise(at)
        return at

    passes = F.slice(F.array(*[F.lit(k) for k in range(most_passes)]), F.lit(1), F.col("passes").cast("int"))
    return counted.select(
        "row_id", *kept, "doc_id", "size", "source_size", "target", "passes",
        (F.col("passes") * F.col("size")).alias("taken"),
        F.transform(passes, positions).alias("positions"),
    )


def stream(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix in order of training position, each as often as it is taken, in the
    input's columns. ``docs`` is read twice and must give the same rows, in any order; they are known
    again by 128 bits of all their columns. Rows equal in all columns travel as one."""
    told = [c for name in docs.columns for c in (F.col(name), F.col(name).isNull())]
    keyed = docs.select(F.struct(*docs.columns).alias("row"), *(F.xxhash64(F.lit(k), *told).alias(k) for k in OWN))
    mixed = mix(keyed.select(*OWN, "row.doc_id", "row.source", "row.text"), **options)
    placed = mixed.select(*OWN, "row_id", F.explode("positions").alias("position"))
    whole = keyed.groupBy(*OWN).agg(F.first("row").alias("row"))
    return whole.join(placed, list(OWN)).orderBy("position", "row_id").select("row.*")
