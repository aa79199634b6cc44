"""Windows and ranks against plain windows on small frames, with blocks small enough to be crossed."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shotmarts.operators.joins import join_null_safe, lookup, narrow
from shotmarts.operators.ranks import Metric, league_rank, percent_ranks
from shotmarts.operators.windows import last_n, number_rows, rolling_mean, share_of_total, top_n


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


@pytest.fixture(scope="module")
def log(spark):
    """One key with most of the rows, some small ones, one NULL key, and gaps in the order."""
    key = F.when(F.col("id") % 3 != 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 4).cast("string"))
    )
    return spark.range(0, 400).select(
        key.alias("key"),
        (F.col("id") * F.col("id") % 1009).alias("pos"),
        F.col("id").alias("tie"),
        F.when(F.col("id") % 5 != 0, F.col("id") / 8).alias("value"),
    )


@pytest.mark.parametrize("span", [1, 10, 64, 5000])
def test_number_rows_matches_row_number(log, span):
    got = number_rows(log, ["key"], "pos", "n", tiebreak=["tie"], span=span)
    plain = F.row_number().over(Window.partitionBy("key").orderBy("pos", "tie"))
    wanted = log.withColumn("n", plain.cast("bigint"))
    assert rows(got.select("key", "pos", "tie", "n"), "tie") == rows(
        wanted.select("key", "pos", "tie", "n"), "tie"
    )


@pytest.mark.parametrize("span", [5, 16, 5000])
def test_rolling_mean_matches_plain_frame(log, span):
    place = Window.partitionBy("key").orderBy("pos", "tie")
    numbered = log.withColumn("n", F.row_number().over(place).cast("bigint"))
    got = rolling_mean(numbered, ["key"], "n", "value", "mean", 5, span=span)
    wanted = numbered.withColumn("mean", F.avg("value").over(place.rowsBetween(-4, 0)))
    assert got.count() == 400
    pairs = got.select("tie", "mean").join(
        wanted.select("tie", F.col("mean").alias("plain")), "tie"
    )
    off = F.abs(F.col("mean") - F.col("plain")) > 1e-9
    assert pairs.where(off | (F.col("mean").isNull() != F.col("plain").isNull())).count() == 0


def test_rolling_mean_skips_nulls(spark):
    df = spark.createDataFrame([("a", 1, 0.2), ("a", 2, None), ("a", 3, 0.4)], "k string, n bigint, x double")
    got = rolling_mean(df, ["k"], "n", "x", "m", 5, digits=3)
    assert [r[0] for r in rows(got.select("m", "n"), "n")] == [0.2, 0.2, 0.3]


@pytest.mark.parametrize("span", [3, 4096])
def test_percent_ranks_match_plain_windows(spark, span):
    df = spark.range(0, 300).select(
        (F.col("id") % 3).cast("int").alias("season"),
        "id",
        F.when(F.col("id") % 11 != 0, (F.col("id") % 40) / 10).alias("a"),
        F.when(F.col("id") % 2 == 0, 0.0).otherwise(-(F.col("id") % 17) / 100).alias("b"),
    )
    got = percent_ranks(df, "season", {"pa": Metric("a", 1), "pb": Metric("b", 2, True)}, span=span)
    season = Window.partitionBy("season")
    up = F.percent_rank().over(season.orderBy(F.col("a").asc_nulls_last()))
    down = F.percent_rank().over(season.orderBy(F.col("b").desc_nulls_last()))
    wanted = df.withColumns({"pa": F.round(up, 3), "pb": F.round(down, 3)})
    assert rows(got.select("id", "pa", "pb"), "id") == rows(wanted.select("id", "pa", "pb"), "id")


def test_percent_rank_of_null_and_of_a_lone_row(spark):
    df = spark.createDataFrame(
        [(1, 0.1), (1, 0.2), (1, 0.2), (1, None), (2, 5.0)], "season int, m double"
    )
    got = percent_ranks(df, "season", {"p": Metric("m", 1)})
    assert sorted(r["p"] for r in got.where("season = 1").collect()) == [0.0, 0.333, 0.333, 1.0]
    assert [r["p"] for r in got.where("season = 2").collect()] == [0.0]


def test_league_rank_leaves_null_unranked(spark):
    df = spark.createDataFrame([(3.1,), (3.1,), (2.0,), (None,)], "x double").withColumn("s", F.lit(1))
    ranked = df.select("x", league_rank("x", ["s"]).alias("r"))
    assert sorted((r["r"] or 99) for r in ranked.collect()) == [1, 1, 3, 99]
    upward = df.select("x", league_rank("x", ["s"], ascending=True).alias("r"))
    assert sorted((r["r"] or 99) for r in upward.collect()) == [1, 2, 2, 99]


def test_last_n_and_top_n(spark):
    df = spark.createDataFrame(
        [("a", i, float(i % 4)) for i in range(12)] + [("b", 1, None)], "k string, n int, x double"
    )
    got = last_n(df, ["k"], "n", 3)
    assert rows(got.select("k", "n", "recency"), "k", "recency") == [
        ("a", 11, 1), ("a", 10, 2), ("a", 9, 3), ("b", 1, 1),
    ]
    assert [r["n"] for r in top_n(df, "x", 2, tiebreak=["n"]).collect()] == [3, 7]
    assert rows(top_n(df, "x", 1, by=["k"], tiebreak=["n"]).select("k", "n"), "k") == [("a", 3), ("b", 1)]


def test_joins(spark):
    left = spark.createDataFrame([(1, "x"), (None, "y")], "k int, a string")
    right = spark.createDataFrame([(None, "n"), (2, "z")], "k int, b string")
    assert rows(join_null_safe(left, right, ["k"], "left"), "a") == [(1, "x", None), (None, "y", "n")]
    names = spark.createDataFrame([("BOS", "Boston Bruins")], "team string, name string")
    teams = spark.createDataFrame([("BOS",), ("T01",)], "team string")
    found = lookup(teams, names, "team", "name", "full")
    assert rows(found, "team") == [("BOS", "Boston Bruins"), ("T01", "T01")]
    assert narrow(left, k=1, a=None).count() == 1


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 5)], "k string, n bigint")
    shares = df.select("k", "n", share_of_total(F.col("n"), ["k"]).alias("s"))
    assert rows(shares, "k", "n") == [("a", 1, 25.0), ("a", 3, 75.0), ("b", 5, 100.0)]
