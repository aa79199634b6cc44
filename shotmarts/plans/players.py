"""Player marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shotmarts.functions.numeric import exact_avg, exact_sum, round_half_up, safe_div
from shotmarts.functions.shots import is_goal, is_on_goal
from shotmarts.operators.ranks import Metric, percent_ranks

# First period left out of season totals, attempts needed to be ranked.
FIRST_EXCLUDED_PERIOD = 5
MIN_ATTEMPTS = 50

# Ranked metrics with the digits their columns are rounded to.
PERCENTILES = {
    "goals_per_game_pctile": Metric("goals_per_game", 3),
    "sh_pct_pctile": Metric("sh_pct", 1),
    "avg_xg_per_shot_pctile": Metric("avg_xg_per_shot", 4),
    "xg_per_game_pctile": Metric("xg_per_game", 3),
    "rebound_shot_pct_pctile": Metric("rebound_shot_pct", 1),
    "shot_distance_pctile": Metric("avg_shot_distance", 1, descending=True),
    "goals_above_expected_pctile": Metric("goals_above_expected", 2),
}

SEASON_STATS = ("assists", "points", "plus_minus", "pp_points", "toi_per_game_min")

PLAYER_COLUMNS = (
    "player_id", "first_name", "last_name", "full_name", "position", "shoots_catches", "team_id",
    "team_abbrev", "team_logo_url", "sweater_number", "height_in", "weight_lbs", "birth_date",
    "birth_city", "birth_country", "headshot_url", "is_active",
)


def in_scope(shots: DataFrame) -> DataFrame:
    """Shots that count towards season totals: no shoot-outs or later overtimes."""
    return shots.where(F.col("period") < FIRST_EXCLUDED_PERIOD)


def player_season(shots: DataFrame) -> DataFrame:
    """Shooting profile per player and season."""
    event, xg = F.col("event_type"), F.col("x_goal")
    totals = (
        in_scope(shots)
        .where(F.col("shooter_id").isNotNull())
        .groupBy("shooter_id", "season")
        .agg(
            F.count_distinct("game_id").alias("games_played"),
            F.count("*").alias("shot_attempts"),
            F.count_if(is_on_goal(event)).alias("shots_on_goal"),
            F.count_if(is_goal(event)).alias("goals"),
            exact_sum(xg).alias("xg"),
            exact_avg(xg).alias("xg_mean"),
            exact_avg(F.col("shot_distance"), 2).alias("distance_mean"),
            exact_avg(F.col("shot_angle"), 2).alias("angle_mean"),
            F.count_if(F.col("is_rush")).alias("rushes"),
            F.count_if(F.col("is_rebound")).alias("rebounds"),
        )
    )
    games, attempts, goals = F.col("games_played"), F.col("shot_attempts"), F.col("goals")

    def percent(part, whole):
        return round_half_up(safe_div(100.0 * part, whole), 1)

    return totals.select(
        "shooter_id",
        "season",
        "games_played",
        "shot_attempts",
        "shots_on_goal",
        "goals",
        round_half_up(F.col("xg"), 3).alias("total_xg"),
        round_half_up(F.col("xg_mean"), 4).alias("avg_xg_per_shot"),
        round_half_up(F.col("distance_mean"), 1).alias("avg_shot_distance"),
        round_half_up(F.col("angle_mean"), 1).alias("avg_shot_angle"),
        percent(F.col("rushes"), attempts).alias("rush_shot_pct"),
        percent(F.col("rebounds"), attempts).alias("rebound_shot_pct"),
        round_half_up(safe_div(goals, games), 3).alias("goals_per_game"),
        round_half_up(safe_div(F.col("xg"), games), 3).alias("xg_per_game"),
        percent(goals, F.col("shots_on_goal")).alias("sh_pct"),
        round_half_up(goals - F.col("xg"), 2).alias("goals_above_expected"),
    )


def qualified(seasons: DataFrame, min_attempts: int = MIN_ATTEMPTS) -> DataFrame:
    return seasons.where(F.col("shot_attempts") >= min_attempts)


def attach_season_stats(seasons: DataFrame, stats: DataFrame) -> DataFrame:
    """Left join of assists, points and ice time on player and season."""
    lines = stats.select(F.col("player_id").alias("shooter_id"), "season", *SEASON_STATS)
    return seasons.join(lines, ["shooter_id", "season"], "left")


def player_shooting(
    shots: DataFrame, stats: DataFrame, min_attempts: int = MIN_ATTEMPTS
) -> DataFrame:
    """The player mart: profiles of players with enough attempts, ranked within their season."""
    profiles = qualified(player_season(shots), min_attempts)
    return attach_season_stats(percent_ranks(profiles, "season", PERCENTILES), stats)


def mart_players(stg: DataFrame) -> DataFrame:
    """The player dimension."""
    return stg.select(*PLAYER_COLUMNS)
