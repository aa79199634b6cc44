"""Raw tables to staging frames: lazy projections that fold into whatever reads them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shotmarts.functions.labels import safe_date, team_logo_url
from shotmarts.functions.numeric import round_half_up

# Labels of the period a game ended in.
OUTCOMES = {"REG": "Regulation", "OT": "Overtime", "SO": "Shootout"}


def stg_games(raw: DataFrame) -> DataFrame:
    last = F.col("last_period_type")
    outcome = F.lit(None).cast("string")
    for code, label in OUTCOMES.items():
        outcome = F.when(last == code, label).otherwise(outcome)
    return raw.select(
        "game_id",
        "season",
        "game_type",
        F.col("game_date").cast("date").alias("game_date"),
        F.col("start_time_utc").cast("timestamp").alias("start_time_utc"),
        "venue",
        "home_team_id",
        "home_team_abbrev",
        "home_score",
        "away_team_id",
        "away_team_abbrev",
        "away_score",
        "last_period_type",
        outcome.alias("game_outcome"),
        (F.col("home_score") > F.col("away_score")).alias("home_win"),
        "ingested_at",
    )


def stg_plays(raw: DataFrame) -> DataFrame:
    return raw.drop("ingested_at")


def stg_xg(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("game_id").alias("mp_game_id"),
        F.col("shooterPlayerId").cast("bigint").alias("shooter_id"),
        F.col("shooterName").alias("shooter_name"),
        F.col("season").alias("mp_season"),
        F.col("team").alias("team_location"),
        "period",
        F.col("time").alias("seconds_elapsed"),
        F.col("xCordAdjusted").alias("x_coord"),
        F.col("yCordAdjusted").alias("y_coord"),
        F.col("shotType").alias("shot_type"),
        F.col("event").alias("event_type"),
        F.col("shotRush").cast("boolean").alias("is_rush"),
        F.col("shotRebound").cast("boolean").alias("is_rebound"),
        F.col("isPlayoffGame").cast("boolean").alias("is_playoff"),
        F.col("xGoal").alias("x_goal"),
    )


def stg_players(raw: DataFrame) -> DataFrame:
    return raw.select(
        "player_id",
        "first_name",
        "last_name",
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        "position",
        "headshot_url",
        "team_id",
        "team_abbrev",
        team_logo_url(F.col("team_abbrev")).alias("team_logo_url"),
        "is_active",
        "sweater_number",
        "height_in",
        "weight_lbs",
        safe_date(F.col("birth_date")).alias("birth_date"),
        "birth_city",
        "birth_country",
        "shoots_catches",
        "ingested_at",
    )


def stg_player_stats(raw: DataFrame) -> DataFrame:
    return raw.select(
        "player_id",
        F.col("season_id").alias("season"),
        "team_abbrev",
        "position",
        "games_played",
        "goals",
        "assists",
        "points",
        "plus_minus",
        "pp_goals",
        "pp_points",
        "sh_goals",
        "sh_points",
        "shots",
        round_half_up(F.col("shooting_pct") * 100, 1).alias("shooting_pct"),
        round_half_up(F.col("toi_per_game") / 60.0, 2).alias("toi_per_game_min"),
    )
