"""Team marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shotmarts.functions.numeric import exact_sum, round_half_up, safe_div
from shotmarts.functions.shots import is_on_goal, is_unblocked
from shotmarts.plans.players import in_scope

# Code of the regular season, label of regulation time.
REGULAR_SEASON = 2
REGULATION = "REG"

SHOT_STATS = (
    "shot_attempts_for", "sog_for", "xg_for", "shot_attempts_against", "sog_against", "xg_against",
)


def team_perspective(games: DataFrame) -> DataFrame:
    """Each game seen by its two teams, in one pass over the games."""

    def seen_by(team: str, other: str, won: Column) -> Column:
        return F.struct(
            F.col(f"{team}_team_abbrev").alias("team_abbrev"),
            F.col(f"{team}_team_id").alias("team_id"),
            F.col(f"{other}_team_abbrev").alias("opponent_abbrev"),
            F.col(f"{other}_team_id").alias("opponent_id"),
            F.lit(team == "home").alias("is_home"),
            F.col(f"{team}_score").alias("gf"),
            F.col(f"{other}_score").alias("ga"),
            won.alias("won"),
        )

    home_win = F.col("home_win")
    sides = F.array(seen_by("home", "away", home_win), seen_by("away", "home", ~home_win))
    game = ["season", "game_id", "game_type", "game_date", "last_period_type"]
    return games.select(*game, F.inline(sides))


def shots_by_team(shots: DataFrame) -> DataFrame:
    """Shots of each team in each game; expected goals leave out blocked shots."""
    event = F.col("event_type")
    unblocked_xg = F.when(is_unblocked(event), F.coalesce("x_goal", F.lit(0.0)))
    return (
        in_scope(shots)
        .where(F.col("team_id").isNotNull())
        .groupBy("game_id", F.col("team_id").alias("shot_team_id"))
        .agg(
            F.count("*").alias("attempts"),
            F.count_if(is_on_goal(event)).alias("sog"),
            exact_sum(unblocked_xg).alias("xg"),
        )
    )


def team_shot_stats(team_games: DataFrame, shots: DataFrame) -> DataFrame:
    """Team games with their shots for and against.

    Shots are added up per game and team before they meet the games, so the join sees two rows
    per game and side instead of every shot twice, and both the join and the aggregation after
    it use one partitioning by game.
    """
    joined = team_games.join(shots_by_team(shots), "game_id", "left")
    own = F.col("shot_team_id") == F.col("team_id")
    other = F.col("shot_team_id") != F.col("team_id")

    def count_of(side: Column, column: str) -> Column:
        return F.coalesce(F.sum(F.when(side, F.col(column))), F.lit(0).cast("bigint"))

    def xg_of(side: Column) -> Column:
        return round_half_up(exact_sum(F.when(side, F.col("xg"))), 3)

    return joined.groupBy("game_id", *[c for c in team_games.columns if c != "game_id"]).agg(
        count_of(own, "attempts").alias("shot_attempts_for"),
        count_of(own, "sog").alias("sog_for"),
        xg_of(own).alias("xg_for"),
        count_of(other, "attempts").alias("shot_attempts_against"),
        count_of(other, "sog").alias("sog_against"),
        xg_of(other).alias("xg_against"),
    )


def result_label() -> Column:
    """W, OTL or L. An unknown score or period type falls through to L."""
    lost_late = (
        ~F.col("won")
        & (F.col("last_period_type") != REGULATION)
        & (F.col("game_type") == REGULAR_SEASON)
    )
    return F.when(F.col("won"), "W").when(lost_late, "OTL").otherwise("L")


def team_games(games: DataFrame, shots: DataFrame) -> DataFrame:
    """The team-game mart: two rows per game."""
    stats = team_shot_stats(team_perspective(games), shots)
    return stats.select(
        "season", "game_id", "game_type", "game_date", "team_abbrev", "team_id", "is_home",
        "opponent_abbrev", "opponent_id", "gf", "ga", "won", "last_period_type",
        result_label().alias("result"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in SHOT_STATS],
    )


def team_season(team_games: DataFrame, game_type: int | None = REGULAR_SEASON) -> DataFrame:
    """The team-season mart: record, totals, rates. ``game_type`` None takes all games."""
    games = team_games
    if game_type is not None:
        games = games.where(F.col("game_type") == game_type)
    result = F.col("result")
    totals = games.groupBy("season", "team_abbrev", "team_id").agg(
        F.count("*").alias("n"),
        F.count_if(result == "W").alias("w"),
        F.count_if(result == "L").alias("l"),
        F.count_if(result == "OTL").alias("o"),
        F.sum("gf").alias("gf"),
        F.sum("ga").alias("ga"),
        exact_sum(F.col("xg_for"), 3).alias("xgf"),
        exact_sum(F.col("xg_against"), 3).alias("xga"),
        F.sum("shot_attempts_for").alias("attempts_for"),
        F.sum("sog_for").alias("sog_f"),
        F.sum("shot_attempts_against").alias("attempts_against"),
        F.sum("sog_against").alias("sog_a"),
    )
    n, gf, ga, xgf, xga = (F.col(c) for c in ("n", "gf", "ga", "xgf", "xga"))
    save_share = F.lit(1.0) - safe_div(ga, F.col("sog_a"))
    return totals.select(
        "season",
        "team_abbrev",
        "team_id",
        n.alias("games_played"),
        F.col("w").alias("wins"),
        F.col("l").alias("losses"),
        F.col("o").alias("otl"),
        (2 * F.col("w") + F.col("o")).alias("points"),
        gf.alias("goals_for"),
        round_half_up(xgf, 1).alias("xg_for"),
        F.col("attempts_for").alias("shot_attempts_for"),
        F.col("sog_f").alias("sog_for"),
        ga.alias("goals_against"),
        round_half_up(xga, 1).alias("xg_against"),
        F.col("attempts_against").alias("shot_attempts_against"),
        F.col("sog_a").alias("sog_against"),
        round_half_up(safe_div(gf, n), 2).alias("gf_per_game"),
        round_half_up(safe_div(ga, n), 2).alias("ga_per_game"),
        round_half_up(safe_div(xgf, n), 3).alias("xg_for_per_game"),
        round_half_up(safe_div(xga, n), 3).alias("xg_against_per_game"),
        round_half_up(safe_div(xgf - xga, n), 3).alias("xg_diff_per_game"),
        round_half_up(xgf - xga, 1).alias("xg_differential"),
        round_half_up(safe_div(gf * 100.0, F.col("attempts_for")), 1).alias("sh_pct"),
        round_half_up(safe_div(gf * 100.0, F.col("sog_f")), 1).alias("sh_pct_sog"),
        round_half_up(save_share * 100, 1).alias("sv_pct"),
    )
