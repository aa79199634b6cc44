"""Column expressions on hand-computed values."""

import datetime

import pytest
from pyspark.sql import functions as F

from shotmarts.functions import labels as lb
from shotmarts.functions import numeric as num
from shotmarts.functions import shots as fn


def evaluate(spark, column, **values):
    """Value of a column over one row of literals."""
    schema = ", ".join(f"{name} {kind}" for name, (kind, _) in values.items()) or "one int"
    row = tuple(v for _, v in values.values()) or (1,)
    return spark.createDataFrame([row], schema).select(column.alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("value", "digits", "expected"),
    [(1.005, 2, 1.0), (0.285, 2, 0.28), (0.125, 2, 0.13), (-0.25, 1, -0.3), (2.5, 0, 3.0),
     (3.5, 0, 4.0), (-2.5, 0, -3.0), (0.49999999999999994, 0, 0.0), (None, 1, None)],
)
def test_round_half_up(spark, value, digits, expected):
    assert evaluate(spark, num.round_half_up(F.col("x"), digits), x=("double", value)) == expected


def test_round_half_up_unsigned_agrees(spark):
    df = spark.range(0, 100_000).select((F.col("id") / 777.7).alias("x"))
    signed, unsigned = (num.round_half_up(F.col("x"), 2, signed=s) for s in (True, False))
    assert df.where(signed != unsigned).count() == 0


def test_rounding_leaves_no_negative_zero(spark):
    text = num.round_half_up(F.col("x"), 2).cast("string")
    assert evaluate(spark, text, x=("double", -0.001)) == "0.0"


@pytest.mark.parametrize(("value", "expected"), [(2.25, 2.2), (2.35, 2.4), (56.25, 56.2)])
def test_round_half_even(spark, value, expected):
    assert evaluate(spark, num.round_half_even(F.col("x"), 1), x=("double", value)) == expected


def test_safe_div(spark):
    ratio = num.safe_div(F.col("a"), F.col("b"))
    assert evaluate(spark, ratio, a=("int", 1), b=("int", 0)) is None
    assert evaluate(spark, ratio, a=("int", 1), b=("int", 4)) == 0.25


def test_exact_sum_does_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, 0.7, 1e-8] * 40
    frames = [
        spark.createDataFrame([(v,) for v in ordered], "x double").repartition(n)
        for ordered, n in ((values, 1), (values[::-1], 7))
    ]
    sums = {f.agg(num.exact_sum(F.col("x")).alias("s")).first()["s"] for f in frames}
    assert sums == {52.0000004}


def test_sums_of_nothing_are_null(spark):
    df = spark.createDataFrame([(None,)], "x double")
    row = df.agg(num.exact_sum(F.col("x")).alias("s"), num.exact_avg(F.col("x")).alias("a")).first()
    assert row["s"] is None and row["a"] is None


@pytest.mark.parametrize(("xg", "shown"), [(None, 0.0), (-0.1, 0.0), (0.3, 0.3), (0.9, 0.5)])
def test_display_xg(spark, xg, shown):
    assert evaluate(spark, fn.display_xg(F.col("x")), x=("double", xg)) == shown


def test_situation_digits(spark):
    digits = fn.parse_situation(F.col("c"))
    df = spark.createDataFrame([("0651",)], "c string").select(*[v.alias(k) for k, v in digits.items()])
    assert df.first().asDict() == {
        "away_goalie": 0, "away_skaters": 6, "home_skaters": 5, "home_goalie": 1,
    }


def test_short_situation_code(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        evaluate(spark, fn.parse_situation(F.col("c"))["home_goalie"], c=("string", "15"))
    safe = fn.parse_situation(F.col("c"), strict=False)["home_goalie"]
    assert evaluate(spark, safe, c=("string", "15")) is None


def test_clock(spark):
    assert evaluate(spark, fn.clock_seconds(F.col("c")), c=("string", "19:59")) == 1199
    assert evaluate(spark, fn.clock_seconds(F.col("c"), strict=False), c=("string", "x:59")) is None


@pytest.mark.parametrize(
    ("team", "home", "away", "side", "x", "expected"),
    [(1, 1, 2, "left", -5.0, 89.0), (1, 1, 2, "right", 5.0, -89.0), (2, 1, 2, "left", 5.0, -89.0),
     (2, 1, 2, "right", -5.0, 89.0), (1, 1, 2, None, 0.0, 89.0), (1, 1, 2, None, -1.0, -89.0),
     (3, 1, 2, "left", 4.0, 89.0), (None, 1, 2, "left", -4.0, -89.0), (2, None, 2, "right", -1.0, 89.0),
     (1, 1, 2, "", -1.0, -89.0)],
)
def test_target_net(spark, team, home, away, side, x, expected):
    net = fn.net_x(*[F.col(c) for c in ("t", "h", "a", "s", "x")])
    got = evaluate(
        spark, net, t=("bigint", team), h=("bigint", home), a=("bigint", away), s=("string", side),
        x=("double", x),
    )
    assert got == expected


@pytest.mark.parametrize(
    ("x", "y", "net", "distance", "angle"),
    [(80.0, 6.0, 89.0, 10.82, 33.69), (-80.0, -6.0, 89.0, 169.11, 2.03), (89.0, 0.0, 89.0, 0.0, 0.0)],
)
def test_geometry(spark, x, y, net, distance, angle):
    values = {"x": ("double", x), "y": ("double", y), "n": ("double", net)}
    columns = F.col("x"), F.col("y"), F.col("n")
    assert evaluate(spark, fn.shot_distance(*columns), **values) == distance
    assert evaluate(spark, fn.shot_angle(*columns), **values) == angle


@pytest.mark.parametrize(
    ("code", "team", "label", "empty"),
    [("0651", 1, "EN", True), ("0651", 2, "PP/SH", False), ("1551", 1, "5v5", False),
     ("1441", 1, "4v4", False), ("1331", 1, "3v3", False), ("1661", 1, "other", False),
     (None, 1, "other", False), ("1010", 2, "EN", True), ("1010", 1, "PP/SH", False)],
)
def test_strength(spark, code, team, label, empty):
    digits = fn.parse_situation(F.col("c"))
    flag = fn.is_empty_net(
        F.col("t"), F.lit(1), F.lit(2), digits["home_goalie"], digits["away_goalie"]
    )
    values = {"c": ("string", code), "t": ("bigint", team)}
    assert evaluate(spark, flag, **values) is empty
    strength = fn.strength(flag, digits["home_skaters"], digits["away_skaters"])
    assert evaluate(spark, strength, **values) == label


@pytest.mark.parametrize(
    ("event", "kind"),
    [("goal", "goal"), ("blocked-shot", "blocked"), ("missed-shot", "other"), (None, "other")],
)
def test_shot_class(spark, event, kind):
    assert evaluate(spark, fn.shot_class(F.col("e")), e=("string", event)) == kind


def test_game_number(spark):
    assert evaluate(spark, fn.game_number(F.col("g")), g=("bigint", 2025020001)) == 20001


def test_surrogate_key_tells_null_from_empty(spark):
    key = lb.surrogate_key(F.col("a"), F.col("b"))
    assert evaluate(spark, key, a=("int", 1), b=("int", 23)) == evaluate(spark, F.md5(F.lit("1-23")))
    null_key = evaluate(spark, key, a=("int", 1), b=("int", None))
    assert null_key == evaluate(spark, F.md5(F.lit("1-_dbt_utils_surrogate_key_null_")))


@pytest.mark.parametrize(
    ("text", "day"),
    [("n/a", None), ("1999", None), ("2020-13-01", None), (None, None), ("1997-01-13", datetime.date(1997, 1, 13))],
)
def test_birth_dates(spark, text, day):
    assert evaluate(spark, lb.safe_date(F.col("d")), d=("string", text)) == day


def test_labels(spark):
    assert evaluate(spark, lb.season_label(F.col("s")), s=("int", 20242025)) == "2024-2025"
    assert evaluate(spark, lb.height_label(F.col("h")), h=("int", 74)) == "6'2\""
    assert evaluate(spark, lb.short_date(F.col("d")), d=("date", datetime.date(2024, 1, 5))) == "Jan 05"
    assert evaluate(spark, lb.short_date(F.col("d")), d=("date", None)) == "—"
    clip = lb.clip_content_id(F.col("u"))
    assert evaluate(spark, clip, u=("string", "https://h/a-b-636123/")) == "636123"


@pytest.mark.parametrize(
    ("home", "opponent", "label"),
    [(True, "BOS", "vs BOS"), (False, "BOS", "at BOS"), (None, None, "vs —")],
)
def test_opponent_label(spark, home, opponent, label):
    column = lb.opponent_label(F.col("h"), F.col("o"))
    assert evaluate(spark, column, h=("boolean", home), o=("string", opponent)) == label


@pytest.mark.parametrize(
    ("percentile", "score", "tier"),
    [(None, 0, "low"), (0.345, 34, "medium"), (0.67, 67, "high"), (0.335, 34, "medium"), (0.33, 33, "low")],
)
def test_scores(spark, percentile, score, tier):
    column = lb.percentile_score(F.col("p"))
    assert evaluate(spark, column, p=("double", percentile)) == score
    assert evaluate(spark, lb.score_tier(column), p=("double", percentile)) == tier


@pytest.mark.parametrize(
    ("rank", "place", "tier"),
    [(1, "1st", "top"), (2, "2nd", "top"), (11, "11th", "middle"), (13, "13th", "middle"),
     (22, "22nd", "bottom"), (23, "23rd", "bottom"), (None, "—", None)],
)
def test_places(spark, rank, place, tier):
    assert evaluate(spark, lb.ordinal(F.col("r")), r=("bigint", rank)) == place
    assert evaluate(spark, lb.rank_tier(F.col("r"), F.lit(32)), r=("bigint", rank)) == tier


def test_team_names_are_complete():
    assert len(lb.TEAM_NAMES) == 32
