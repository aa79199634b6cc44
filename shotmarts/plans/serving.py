"""Serving queries over the marts.

Every query runs for one key (``player=``, ``team=``, ``season=``) or, with keys left out, for all
keys at once. Results narrowed to one key come in display order. Results for all keys come
unordered: a global sort of everything is the caller's choice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shotmarts.functions import labels as lb
from shotmarts.functions.numeric import (
    exact_avg,
    exact_sum,
    round_half_even,
    round_half_up,
    safe_div,
)
from shotmarts.functions.shots import (
    display_xg,
    has_clip,
    is_goal,
    is_unblocked,
    mirrored,
    shot_class,
)
from shotmarts.operators.joins import join_null_safe, lookup, narrow
from shotmarts.operators.ranks import league_rank
from shotmarts.operators.windows import (
    last_n,
    number_few,
    rolling_mean,
    share_of_total,
    top_n,
)
from shotmarts.plans.players import PERCENTILES, in_scope

# List and window lengths, neutral share, sortable roster columns (text ascending).
LEADERBOARD_SIZE = 20
ROLLING_XG_GAMES = 5
ROLLING_SHARE_GAMES = 10
RECENT_GAMES = 10
EVEN_SHARE = 50.0
ROSTER_SORTS = {"points": False, "goals": False, "total_xg": False, "position": True, "last_name": True}

PLAYER_SEASON = ("shooter_id", "season")
TEAM_SEASON = ("team_abbrev", "season")


def _ordered(df: DataFrame, when: bool, *order: Column) -> DataFrame:
    return df.orderBy(*order) if when else df


def _display_xg_columns() -> list[Column]:
    return [
        round_half_up(F.col("total_xg"), 1).alias("total_xg"),
        round_half_up(F.col("xg_per_game"), 3).alias("xg_per_game"),
    ]


def with_player_dim(seasons: DataFrame, players: DataFrame) -> DataFrame:
    """Player seasons whose player is in the dimension, with its columns."""
    return seasons.withColumnRenamed("shooter_id", "player_id").join(players, "player_id")


# --- players ---------------------------------------------------------------------------------


def league_stats(seasons: DataFrame, shots: DataFrame, season: int | None = None) -> DataFrame:
    """Per season: games in the shot table and league averages over the ranked players."""
    games = (
        narrow(shots, season=season)
        .groupBy("season")
        .agg(F.count_distinct("game_id").alias("games_played"))
    )
    averages = (
        narrow(seasons, season=season)
        .groupBy("season")
        .agg(
            round_half_up(exact_avg(F.col("goals_per_game"), 3) * 2, 2).alias("avg_goals_per_game"),
            round_half_up(exact_avg(F.col("xg_per_game"), 3) * 2, 3).alias("avg_xg_per_game"),
            round_half_up(exact_avg(F.col("sh_pct"), 1), 1).alias("league_sh_pct"),
        )
    )
    return averages.join(games, "season", "left")


def leaderboard(
    seasons: DataFrame,
    players: DataFrame,
    season: int | None = None,
    n: int = LEADERBOARD_SIZE,
) -> DataFrame:
    """The n players with most expected goals: of one season, or of each season."""
    joined = with_player_dim(narrow(seasons, season=season), players)
    by = () if season is not None else ("season",)
    return top_n(joined, "total_xg", n, by=by, tiebreak=("player_id",)).select(
        "season", "player_id", "full_name", "position", "team_abbrev", "headshot_url",
        "team_logo_url", "games_played", "goals", "shots_on_goal", "sh_pct",
        *_display_xg_columns(), "xg_per_game_pctile",
    )


def player_card(
    seasons: DataFrame, players: DataFrame, player: int | None = None, season: int | None = None
) -> DataFrame:
    """Header figures, percentiles and bio of a player season."""
    chosen = narrow(seasons, shooter_id=player, season=season)
    return with_player_dim(chosen, players).select(
        "player_id", "season", "full_name", "position", "team_abbrev", "headshot_url",
        "team_logo_url", "games_played", "goals", "shots_on_goal", "sh_pct",
        *_display_xg_columns(), "goals_per_game_pctile", "sh_pct_pctile",
        "avg_xg_per_shot_pctile", "xg_per_game_pctile", "rebound_shot_pct_pctile",
        "shot_distance_pctile", "goals_above_expected", "goals_above_expected_pctile",
        "sweater_number", "height_in", "weight_lbs", "birth_country", "shoots_catches",
        "birth_date",
    )


def percentile_scores(seasons: DataFrame) -> DataFrame:
    """Percentiles as whole scores out of 100, each with its tier."""
    names = {name: name.removesuffix("_pctile") for name in PERCENTILES}
    scored = seasons.withColumns(
        {f"{name}_score": lb.percentile_score(F.col(source)) for source, name in names.items()}
    )
    tiers = {f"{name}_tier": lb.score_tier(F.col(f"{name}_score")) for name in names.values()}
    kept = [f"{name}_{part}" for name in names.values() for part in ("score", "tier")]
    return scored.withColumns(tiers).select(*PLAYER_SEASON, *kept)


def player_bio(players: DataFrame) -> DataFrame:
    """Height label and the one-line description of a player; missing parts are left out."""
    number, weight = F.col("sweater_number"), F.col("weight_lbs")
    hand = F.nullif("shoots_catches", F.lit(""))
    height = lb.height_label(F.col("height_in"))
    parts = [
        F.when(number != 0, F.concat(F.lit("#"), number.cast("string"))),
        height,
        F.when(weight != 0, F.concat(weight.cast("string"), F.lit(" lbs"))),
        F.concat(F.lit("DOB: "), F.date_format("birth_date", "MM/dd/yyyy")),
        F.concat(F.lit("Shoots "), hand),
    ]
    return players.select(
        "player_id",
        "full_name",
        height.alias("height_label"),
        F.concat_ws(" · ", *parts).alias("bio_text"),
    )


def player_shots(
    shots: DataFrame, player: int | None = None, season: int | None = None
) -> DataFrame:
    """Located shots of a player season, shoot-outs and later overtimes left out."""
    chosen = in_scope(narrow(shots, shooter_id=player, season=season))
    return chosen.where(
        F.col("shooter_id").isNotNull() & F.col("x_coord").isNotNull() & F.col("y_coord").isNotNull()
    ).select(
        *PLAYER_SEASON, "game_id", "team_id", "game_date", "event_type", "shot_type", "x_coord",
        "y_coord", "net_x", "shot_distance", "shot_angle", "x_goal", "strength", "period", "time_in_period",
        "is_rush", "is_rebound", "highlight_clip_url",
    )


def player_games(shots: DataFrame) -> DataFrame:
    """Shots, goals and expected goals of a player per game and team. Expected goals are NULL if
    every shot was blocked."""
    event = F.col("event_type")
    unblocked_xg = F.when(is_unblocked(event), F.coalesce("x_goal", F.lit(0.0)))
    return (
        in_scope(shots)
        .where(F.col("shooter_id").isNotNull())
        .groupBy(*PLAYER_SEASON, "game_id", "team_id")
        .agg(
            F.count("*").alias("shots"),
            F.count_if(is_goal(event)).alias("goals"),
            round_half_up(exact_sum(unblocked_xg), 3).alias("xg"),
        )
    )


def with_opponent(games: DataFrame, team_games: DataFrame) -> DataFrame:
    """Inner join of opponent, venue and date on game and team."""
    facing = team_games.select(
        "game_id", "team_id", F.col("opponent_abbrev").alias("opponent"), "is_home", "game_date"
    )
    return games.join(facing, ["game_id", "team_id"])


def player_game_log(
    shots: DataFrame,
    team_games: DataFrame,
    player: int | None = None,
    season: int | None = None,
) -> DataFrame:
    """Numbered games of a player season."""
    chosen = narrow(shots, shooter_id=player, season=season)
    log = with_opponent(player_games(chosen), narrow(team_games, season=season))
    numbered = number_few(log, PLAYER_SEASON, ["game_id", "team_id"], "game_num")
    return _ordered(
        numbered.select(
            *PLAYER_SEASON, "game_id", "team_id", "game_num", "shots", "goals", "xg", "opponent",
            "is_home", "game_date",
        ),
        player is not None,
        F.col("season"),
        F.col("game_num"),
    )


def player_rolling_xg(log: DataFrame, games: int = ROLLING_XG_GAMES) -> DataFrame:
    """Mean expected goals of a player's last games, game by game."""
    rolled = rolling_mean(log, PLAYER_SEASON, "game_num", "xg", "rolling_xg", games, digits=3)
    return rolled.select(*PLAYER_SEASON, "game_id", "team_id", "game_num", "xg", "rolling_xg")


def goal_games(log: DataFrame) -> DataFrame:
    """Games in which the player scored."""
    return log.where(F.col("goals") > 0)


def season_players(
    seasons: DataFrame, players: DataFrame, season: int | None = None
) -> DataFrame:
    """Ranked players of a season by last name."""
    joined = with_player_dim(narrow(seasons, season=season), players)
    by_name = _ordered(joined, season is not None, F.col("last_name").asc_nulls_last(), F.col("player_id"))
    return by_name.select("season", "player_id", "full_name", "position", "team_abbrev")


def teams_in_season(
    seasons: DataFrame, players: DataFrame, season: int | None = None
) -> DataFrame:
    """Clubs with a ranked player in a season."""
    joined = with_player_dim(narrow(seasons, season=season), players)
    clubs = joined.where(F.col("team_abbrev").isNotNull()).select("season", "team_abbrev").distinct()
    return clubs.orderBy("season", "team_abbrev")


def player_season_log(seasons: DataFrame, player: int | None = None) -> DataFrame:
    """Career table: one line per season."""
    lines = narrow(seasons, shooter_id=player).select(
        *PLAYER_SEASON, "games_played", "goals", "shots_on_goal", "sh_pct",
        *_display_xg_columns(), "goals_above_expected",
    )
    return _ordered(lines, player is not None, F.col("season"))


def available_seasons(seasons: DataFrame) -> DataFrame:
    """Seasons with data, newest first."""
    found = seasons.select("season").distinct()
    return found.select("season", lb.season_label(F.col("season")).alias("season_label")).orderBy(
        F.col("season").desc()
    )


# --- shots on the map ------------------------------------------------------------------------


def filter_shots(
    shots: DataFrame,
    strength: Sequence[str] = (),
    period: Sequence[int] = (),
    event: Sequence[str] = (),
) -> DataFrame:
    """Multi-select filter; an empty selection takes every value but NULL."""
    for column, chosen in (("strength", strength), ("period", period), ("event_type", event)):
        c = F.col(column)
        shots = shots.where(c.isin(*chosen) if chosen else c.isNotNull())
    return shots


def filter_shot_type(shots: DataFrame, shot_type: str | None = None) -> DataFrame:
    return narrow(shots, shot_type=shot_type)


def filter_options(
    shots: DataFrame, columns: Sequence[str] = ("strength", "period", "event_type")
) -> DataFrame:
    """Values on offer in each filter."""
    offers = [F.struct(F.lit(c).alias("option"), F.col(c).cast("string").alias("value")) for c in columns]
    pairs = shots.select(F.inline(F.array(*offers))).where(F.col("value").isNotNull())
    return pairs.distinct().orderBy("option", "value")


def normalise_side(shots: DataFrame) -> DataFrame:
    """Shots turned so that all go towards the positive end."""
    net = F.col("net_x")
    return shots.withColumns({c: mirrored(F.col(c), net) for c in ("x_coord", "y_coord")})


def with_shot_class(shots: DataFrame) -> DataFrame:
    return shots.withColumn("shot_class", shot_class(F.col("event_type")))


def with_display_xg(shots: DataFrame) -> DataFrame:
    return shots.withColumn("xg_display", display_xg(F.col("x_goal")))


def attach_log(shots: DataFrame, log: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Left join of game-log columns on player, season, game and team: one row per shot."""
    on = [*PLAYER_SEASON, "game_id", "team_id"]
    return shots.join(log.select(*on, *columns), on, "left")


def shot_labels(shots: DataFrame, log: DataFrame) -> DataFrame:
    """Shots with date and opponent labels."""
    joined = attach_log(shots, log, ["opponent", "is_home"])
    return joined.withColumns(
        {
            "date_label": lb.short_date(F.col("game_date")),
            "opponent_label": lb.opponent_label(F.col("is_home"), F.col("opponent")),
        }
    )


def shots_in_games(shots: DataFrame, games: DataFrame) -> DataFrame:
    """A player's shots of the games chosen from that player's log."""
    on = [*PLAYER_SEASON, "game_id"]
    return shots.join(games.select(*on), on, "left_semi")


def shot_type_breakdown(
    shots: DataFrame, by: Sequence[str] = PLAYER_SEASON, ordered: bool = False
) -> DataFrame:
    """Volume, goals and share per shot type within each ``by`` group."""
    event = F.col("event_type")
    counted = (
        shots.where(F.col("shot_type").isNotNull())
        .groupBy(*by, "shot_type")
        .agg(F.count(event).alias("shots"), F.count_if(is_goal(event)).alias("goals"))
    )
    n = F.col("shots")
    parts = counted.withColumn("volume_pct", round_half_even(share_of_total(n, by), 1))
    breakdown = parts.select(
        *by,
        "shot_type",
        "shots",
        "goals",
        round_half_even(safe_div(F.col("goals"), n) * 100, 1).alias("sh_pct"),
        "volume_pct",
    )
    return _ordered(breakdown, ordered, F.col("shots"))


def goal_clips(shots: DataFrame, log: DataFrame, ordered: bool = False) -> DataFrame:
    """Goals with a clip, with game number and opponent."""
    clips = shots.where(is_goal(F.col("event_type")) & has_clip(F.col("highlight_clip_url")))
    joined = attach_log(clips, log, ["game_num", "opponent", "is_home"])
    order = [F.col(c).asc_nulls_last() for c in ("game_num", "period", "time_in_period")]
    return _ordered(joined, ordered, *order)


def first_goal_clip(shots: DataFrame) -> DataFrame:
    """Earliest goal clip of a player in a game."""
    clips = shots.where(is_goal(F.col("event_type")) & has_clip(F.col("highlight_clip_url")))
    when = F.struct("period", "time_in_period", "highlight_clip_url")
    return clips.groupBy(*PLAYER_SEASON, "game_id").agg(
        F.min_by("highlight_clip_url", when).alias("clip_url")
    )


def clip_ids(shots: DataFrame) -> DataFrame:
    """Content ids of the clips."""
    url = F.col("highlight_clip_url")
    return shots.where(has_clip(url)).select(
        "game_id", "event_id", "highlight_clip_url", lb.clip_content_id(url).alias("content_id")
    )


# --- teams -----------------------------------------------------------------------------------


def team_card(
    team_seasons: DataFrame, team: str | None = None, season: int | None = None
) -> DataFrame:
    """Header figures of a team season."""
    return narrow(team_seasons, team_abbrev=team, season=season).select(
        *TEAM_SEASON, "games_played", "wins", "losses", "otl", "points", "goals_for", "xg_for",
        "sh_pct", "goals_against", "xg_against", "xg_differential", "sh_pct_sog", "sv_pct",
    )


def team_game_log(
    team_games: DataFrame, team: str | None = None, season: int | None = None
) -> DataFrame:
    """Numbered games of a team season, all game types."""
    chosen = narrow(team_games, team_abbrev=team, season=season)
    numbered = number_few(chosen, TEAM_SEASON, ["game_id"], "game_num")
    log = numbered.select(
        *TEAM_SEASON, "game_id", "game_num", "game_date",
        F.col("opponent_abbrev").alias("opponent"), "is_home", "gf", "ga",
        round_half_up(F.col("xg_for"), 2).alias("xg_for"),
        round_half_up(F.col("xg_against"), 2).alias("xg_against"), "result",
    )
    return _ordered(log, team is not None, F.col("season"), F.col("game_num"))


def last_10_games(log: DataFrame, n: int = RECENT_GAMES) -> DataFrame:
    """Newest games of each team season, newest first."""
    return last_n(log, TEAM_SEASON, "game_id", n)


def split_records(team_games: DataFrame, n: int = RECENT_GAMES) -> DataFrame:
    """Wins, losses and overtime losses at home, away and over the last games."""
    home = F.coalesce("is_home", F.lit(False))

    def records(prefix: str, scope: Column) -> list[Column]:
        return [
            F.count_if(scope & (F.col("result") == result)).alias(f"{prefix}_{result.lower()}")
            for result in ("W", "L", "OTL")
        ]

    venues = team_games.groupBy(*TEAM_SEASON).agg(*records("home", home), *records("away", ~home))
    recent = last_n(team_games.select(*TEAM_SEASON, "game_id", "result"), TEAM_SEASON, "game_id", n)
    lately = recent.groupBy(*TEAM_SEASON).agg(*records("last", F.lit(True)))
    # A club or season may be NULL: such rows are a group of their own, as in the grouping.
    return join_null_safe(venues, lately, list(TEAM_SEASON), "inner")


def team_rolling_xg_pct(log: DataFrame, games: int = ROLLING_SHARE_GAMES) -> DataFrame:
    """Rolling share of expected goals, with the parts above and below an even share."""
    share = safe_div(F.col("xg_for"), F.col("xg_for") + F.col("xg_against")) * 100
    shared = log.withColumn("xg_pct", F.coalesce(share, F.lit(EVEN_SHARE)))
    rolled = rolling_mean(shared, TEAM_SEASON, "game_num", "xg_pct", "mean_pct", games)
    rolling = round_half_even(F.col("mean_pct"), 1)
    return rolled.select(
        *TEAM_SEASON,
        "game_id",
        "game_num",
        rolling.alias("rolling_xg_pct"),
        F.greatest(rolling, F.lit(EVEN_SHARE)).alias("above_even"),
        F.least(rolling, F.lit(EVEN_SHARE)).alias("below_even"),
    )


def league_table(team_seasons: DataFrame, season: int | None = None) -> DataFrame:
    """Team rates of a season by expected goals."""
    table = narrow(team_seasons, season=season).select(
        *TEAM_SEASON, "games_played", "gf_per_game", "ga_per_game", "xg_for_per_game",
        "xg_against_per_game", "xg_diff_per_game", "sh_pct", "sh_pct_sog", "sv_pct",
    )
    return _ordered(table, season is not None, F.col("xg_for_per_game").desc_nulls_last())


def league_ranks(team_seasons: DataFrame) -> DataFrame:
    """League place of each team in four rates, with ordinal and third of the table."""
    ranked = team_seasons.select(*TEAM_SEASON, "gf_per_game", "ga_per_game", "xg_diff_per_game", "sh_pct_sog")
    places = {
        "n_teams": F.count("*").over(Window.partitionBy("season")),
        "gf_rank": league_rank("gf_per_game", ["season"]),
        "ga_rank": league_rank("ga_per_game", ["season"], ascending=True),
        "xg_diff_rank": league_rank("xg_diff_per_game", ["season"]),
        "sh_pct_rank": league_rank("sh_pct_sog", ["season"]),
    }
    placed = ranked.withColumns(places)
    extras = {}
    for name in [name for name in places if name.endswith("_rank")]:
        stem = name.removesuffix("_rank")
        extras[f"{stem}_place"] = lb.ordinal(F.col(name))
        extras[f"{stem}_tier"] = lb.rank_tier(F.col(name), F.col("n_teams"))
    return placed.withColumns(extras).select(*TEAM_SEASON, *places, *extras)


def sort_roster(roster: DataFrame, by: str = "points") -> DataFrame:
    """Roster by one of the offered columns: text upwards, figures downwards."""
    if by not in ROSTER_SORTS:
        raise ValueError(f"cannot sort a roster by {by!r}; choose from {sorted(ROSTER_SORTS)}")
    c = F.col(by)
    return roster.orderBy(c.asc_nulls_last() if ROSTER_SORTS[by] else c.desc_nulls_last(), "player_id")


def team_roster(
    seasons: DataFrame, players: DataFrame, team: str | None = None, season: int | None = None
) -> DataFrame:
    """Ranked players of a team with their season figures."""
    chosen = with_player_dim(
        narrow(seasons, season=season), narrow(players, team_abbrev=team)
    ).where(F.col("team_abbrev").isNotNull())
    by_xg = _ordered(chosen, team is not None, F.col("total_xg").desc_nulls_last(), F.col("player_id"))
    return by_xg.select(
        *TEAM_SEASON, "player_id", "full_name", "last_name", "position", "headshot_url",
        "team_logo_url", "games_played", "goals",
        F.coalesce("assists", F.lit(0)).alias("assists"),
        F.coalesce("points", F.lit(0)).alias("points"),
        "shots_on_goal", "sh_pct", *_display_xg_columns(),
        F.col("goals_above_expected").alias("gax"),
    )


def team_names(team_seasons: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Teams with their full name, or the abbreviation where none is known. Without ``names``, the
    fixed names of the league's clubs."""
    if names is None:
        names = lb.club_names(team_seasons.sparkSession)
    return lookup(team_seasons.select(*TEAM_SEASON), names, "team_abbrev", "name", "team_name")
