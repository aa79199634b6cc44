"""Landed documents made from the trial tables: the raw rows nested back into JSON text.

Each source row becomes its own small documents, so making them needs no grouping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shotmarts.sources.documents import FINISHED
from shotmarts.sources.trial_tables import TrialTables


def _text(c: Column | str) -> Column:
    return F.struct((F.col(c) if isinstance(c, str) else c).alias("default"))


def _at(day: str) -> Column:
    return F.lit(f"{day}T00:00:00Z").alias("doc_ts")


def _json(df: DataFrame, *fields: Column) -> DataFrame:
    return df.select(F.to_json(F.struct(*fields)).alias("text"))


def schedule_documents(trial: TrialTables) -> DataFrame:
    """Two listings per game: before it was played, and its outcome. Games without a home score
    are still live in the later one."""
    games = trial.raw_games()

    def team(side: str, score: Column) -> Column:
        return F.struct(
            F.col(f"{side}_team_id").alias("id"),
            F.col(f"{side}_team_abbrev").alias("abbrev"),
            score.alias("score"),
        )

    def listing(day: str, state: Column, played: bool) -> Column:
        def score(side: str) -> Column:
            return F.col(f"{side}_score") if played else F.lit(None).cast("int")

        game = F.struct(
            F.col("game_id").alias("id"),
            "season",
            F.col("game_type").alias("gameType"),
            state.alias("gameState"),
            F.concat(F.col("game_date").cast("string"), F.lit("T23:00:00Z")).alias("startTimeUTC"),
            _text("venue").alias("venue"),
            team("home", score("home")).alias("homeTeam"),
            team("away", score("away")).alias("awayTeam"),
            F.struct(F.col("last_period_type").alias("lastPeriodType")).alias("gameOutcome"),
        )
        week = F.array(F.struct(F.array(game).alias("games")))
        return F.struct(_at(day), F.col("game_date").alias("schedule_date"), week.alias("gameWeek"))

    played = F.when(F.col("home_score").isNull(), "LIVE").otherwise(FINISHED)
    listings = F.array(
        listing("2026-06-01", F.lit("FUT"), played=False),
        listing("2026-06-02", played, played=True),
    )
    return games.select(F.explode(listings).alias("doc")).select(F.to_json("doc").alias("text"))


def play_documents(trial: TrialTables) -> DataFrame:
    """Each shot beside a play of another kind. Only goals name a scorer."""
    scored = F.col("event_type") == "goal"

    def play(kind: Column) -> Column:
        details = F.struct(
            F.when(scored, F.col("shooter_id")).otherwise(0).alias("scoringPlayerId"),
            F.when(~scored, F.col("shooter_id")).alias("shootingPlayerId"),
            F.col("x_coord").alias("xCoord"),
            F.col("y_coord").alias("yCoord"),
            F.col("shot_type").alias("shotType"),
            F.col("goalie_id").alias("goalieInNetId"),
            F.col("team_id").alias("eventOwnerTeamId"),
            F.col("away_score").alias("awayScore"),
            F.col("home_score").alias("homeScore"),
            F.col("highlight_clip_url").alias("highlightClipSharingUrl"),
        )
        return F.struct(
            F.col("event_id").alias("eventId"),
            F.struct(F.col("period").alias("number")).alias("periodDescriptor"),
            F.col("time_in_period").alias("timeInPeriod"),
            kind.alias("typeDescKey"),
            F.col("situation_code").alias("situationCode"),
            F.col("home_defending_side").alias("homeTeamDefendingSide"),
            details.alias("details"),
        )

    plays = F.array(play(F.lit("hit")), play(F.col("event_type")))
    return _json(
        trial.raw_plays(), _at("2026-06-02"), F.col("game_id").alias("id"), F.col("season"),
        plays.alias("plays"),
    )


def standings_documents(trial: TrialTables) -> DataFrame:
    """The clubs that play at home, each listed in a document of its own."""
    clubs = trial.raw_games().select(F.col("home_team_abbrev").alias("club")).distinct()
    entry = F.struct(_text("club").alias("teamAbbrev"))
    return _json(clubs, _at("2026-06-02"), F.array(entry).alias("standings"))


def roster_documents(trial: TrialTables) -> DataFrame:
    """One player per document, in the group of the position; the other groups are missing."""
    player = F.struct(
        F.col("player_id").alias("id"),
        _text("first_name").alias("firstName"),
        _text("last_name").alias("lastName"),
        F.col("position").alias("positionCode"),
        F.col("headshot_url").alias("headshot"),
        F.col("sweater_number").alias("sweaterNumber"),
        F.col("height_in").alias("heightInInches"),
        F.col("weight_lbs").alias("weightInPounds"),
        F.col("birth_date").alias("birthDate"),
        _text("birth_city").alias("birthCity"),
        F.col("birth_country").alias("birthCountry"),
        F.col("shoots_catches").alias("shootsCatches"),
    )

    def group(name: str, *positions: str) -> Column:
        return F.when(F.col("position").isin(*positions), F.array(player)).alias(name)

    return _json(
        trial.raw_players(), _at("2026-06-02"), F.col("team_abbrev"),
        group("forwards", "C", "L", "R"), group("defensemen", "D"), group("goalies", "G"),
    )


def skater_documents(trial: TrialTables) -> DataFrame:
    """Season lines; a zero is left out of the document, as is a team without a name."""
    numbers = {
        "gamesPlayed": "games_played", "goals": "goals", "assists": "assists", "points": "points",
        "plusMinus": "plus_minus", "ppGoals": "pp_goals", "ppPoints": "pp_points",
        "shGoals": "sh_goals", "shPoints": "sh_points", "shots": "shots",
    }
    line = F.struct(
        F.col("player_id").alias("playerId"),
        F.col("team_abbrev").alias("teamAbbrevs"),
        F.col("position").alias("positionCode"),
        *[F.nullif(F.col(c), F.lit(0)).alias(field) for field, c in numbers.items()],
        F.nullif("shooting_pct", F.lit(0.0)).alias("shootingPct"),
        F.col("toi_per_game").alias("timeOnIcePerGame"),
    )
    return _json(
        trial.raw_player_stats(), _at("2026-06-02"), F.col("season_id"),
        F.array(line).alias("data"),
    )
