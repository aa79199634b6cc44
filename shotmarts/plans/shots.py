"""Shot events: parsing, enrichment with expected goals, geometry, strength."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shotmarts.functions import shots as fn
from shotmarts.functions.labels import surrogate_key

XG_VALUES = ("x_goal", "is_rush", "is_rebound")
XG_KEYS = ("mp_game_id", "shooter_id", "period", "seconds_elapsed")


def parse_plays(plays: DataFrame, strict: bool = True) -> DataFrame:
    """Plays with coordinates, plus the situation digits and the clock in seconds."""
    located = plays.where(F.col("x_coord").isNotNull() & F.col("y_coord").isNotNull())
    return located.withColumns(
        {
            **fn.parse_situation(F.col("situation_code"), strict),
            "seconds_in_period": fn.clock_seconds(F.col("time_in_period"), strict),
        }
    )


def attach_game(plays: DataFrame, games: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Left join of game columns on the game id.

    Grouping the games by their key changes no row, and uses the partitioning the join needs. It
    tells Spark that the join cannot multiply shots, so a query that uses no game column skips the
    join and its shuffle of all shots.
    """
    facts = games.groupBy("game_id").agg(*[F.any_value(c).alias(c) for c in columns])
    return plays.join(facts, "game_id", "left")


def attach_game_by_number(plays: DataFrame, games: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same by a join on the game number ``mp_game_id`` alone, which stays in the result.

    The rows then lie by game number, the first key of the join in ``attach_xg``: where joins may share
    a shuffle on part of their keys (``tables.materialise``), the wide shots are shuffled once for both.
    A number has one game a season, kept in a map.
    """
    facts = games.where("game_id is not null").groupBy("game_id").agg(
        *[F.any_value(c).alias(c) for c in columns]
    )
    entry = F.struct(F.col("game_id"), F.struct(*columns))
    numbered = facts.groupBy(fn.game_number(F.col("game_id"), strict=False).alias("mp_game_id")).agg(
        F.map_from_entries(F.collect_list(entry)).alias("_games")
    )
    joined = plays.withColumn("mp_game_id", fn.game_number(F.col("game_id"))).join(numbered, "mp_game_id", "left")
    game = F.try_element_at("_games", F.col("game_id"))
    return joined.withColumns({c: game[c] for c in columns}).drop("_games")


def attach_game_teams(plays: DataFrame, games: DataFrame) -> DataFrame:
    return attach_game(plays, games, ["home_team_id", "away_team_id"])


def attach_game_date(shots: DataFrame, games: DataFrame) -> DataFrame:
    return attach_game(shots, games, ["game_date"])


def dedupe_max(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row per key with the highest of each value; a flag is true if it is in any row."""
    return df.groupBy(*keys).agg(*[F.max(c).alias(c) for c in values])


def dedupe_xg(xg: DataFrame, match_season: bool = False) -> DataFrame:
    keys = [*XG_KEYS, "mp_season"] if match_season else XG_KEYS
    return dedupe_max(xg, keys, XG_VALUES)


def attach_xg(shots: DataFrame, xg: DataFrame, match_season: bool = False) -> DataFrame:
    """Left join of expected goals on game number, shooter, period and elapsed seconds.

    The expected-goals rows are reduced to one per key first, so no shot is multiplied. Game
    numbers repeat every season; ``match_season`` also compares the season, which the default
    leaves out to give the same results as before. Shots that carry ``mp_game_id`` keep it as a key,
    so that Spark can see how they lie.
    """
    keys = {
        "mp_game_id": F.col("mp_game_id") if "mp_game_id" in shots.columns else fn.game_number(F.col("game_id")),
        "seconds_elapsed": fn.elapsed_seconds(F.col("period"), F.col("seconds_in_period")),
    }
    on = list(XG_KEYS)
    if match_season:
        keys["mp_season"] = ((F.col("season") - F.col("season") % 10000) / 10000).cast("int")
        on.append("mp_season")
    return (
        shots.withColumns(keys).join(dedupe_xg(xg, match_season), on, "left").drop(*keys)
    )


def add_geometry(shots: DataFrame) -> DataFrame:
    """Target net, then distance and angle to it."""
    x, y = F.col("x_coord"), F.col("y_coord")
    net = fn.net_x(
        F.col("team_id"),
        F.col("home_team_id"),
        F.col("away_team_id"),
        F.col("home_defending_side"),
        x,
    )
    return shots.withColumn("net_x", net).withColumns(
        {
            "shot_distance": fn.shot_distance(x, y, F.col("net_x")),
            "shot_angle": fn.shot_angle(x, y, F.col("net_x")),
        }
    )


def add_strength(shots: DataFrame) -> DataFrame:
    """Empty-net flag and strength label."""
    empty = fn.is_empty_net(
        F.col("team_id"),
        F.col("home_team_id"),
        F.col("away_team_id"),
        F.col("home_goalie"),
        F.col("away_goalie"),
    )
    label = fn.strength(F.col("is_empty_net"), F.col("home_skaters"), F.col("away_skaters"))
    return shots.withColumn("is_empty_net", empty).withColumn("strength", label)


INT_COLUMNS = (
    "game_id", "event_id", "season", "period", "time_in_period", "seconds_in_period",
    "event_type", "x_coord", "y_coord", "shot_type", "shooter_id", "goalie_id", "team_id",
    "situation_code", "away_skaters", "home_skaters", "away_goalie", "home_goalie",
    "home_defending_side", "away_score", "home_score", "highlight_clip_url", "raw", "net_x",
    "shot_distance", "shot_angle", "is_empty_net", "strength", *XG_VALUES,
)

MART_COLUMNS = (
    "event_id_pk", "game_id", "event_id", "season", "shooter_id", "goalie_id", "team_id",
    "game_date", "period", "time_in_period", "seconds_in_period", "away_score", "home_score",
    "strength", "home_defending_side", "event_type", "shot_type", "x_coord", "y_coord", "net_x",
    "shot_distance", "shot_angle", "is_empty_net", *XG_VALUES, "highlight_clip_url",
)


def _enriched(
    plays: DataFrame, games: DataFrame, xg: DataFrame, match_season: bool, strict: bool
) -> DataFrame:
    """Shots with everything the two shot tables need. Teams and date come from one join with
    games by game number, so the wide shot rows are shuffled for the games only once."""
    parsed = parse_plays(plays, strict)
    with_game = attach_game_by_number(parsed, games, ["home_team_id", "away_team_id", "game_date"])
    located = add_strength(add_geometry(with_game))
    return attach_xg(located, xg, match_season)


def int_shot_events(
    plays: DataFrame,
    games: DataFrame,
    xg: DataFrame,
    match_season: bool = False,
    strict: bool = True,
) -> DataFrame:
    """Enriched shots, one row per play with coordinates."""
    return _enriched(plays, games, xg, match_season, strict).select(*INT_COLUMNS)


def shot_events(
    plays: DataFrame,
    games: DataFrame,
    xg: DataFrame,
    match_season: bool = False,
    strict: bool = True,
) -> DataFrame:
    """The shot mart: enriched shots with key and game date."""
    shots = _enriched(plays, games, xg, match_season, strict)
    key = surrogate_key(F.col("game_id"), F.col("event_id"))
    return shots.withColumn("event_id_pk", key).select(*MART_COLUMNS)
