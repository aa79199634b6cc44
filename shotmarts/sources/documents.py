"""Landed JSON documents to raw tables. Every flattening is one pass without a shuffle, unless
the newest of several documents has to win.

Arrays are unnested with the outer form and missing elements filtered afterwards: for the inner
form Spark adds a test on the array below it, which parses the document once more.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from shotmarts.functions.shots import SHOT_EVENTS
from shotmarts.sources import schemas

# State of a finished game, roster groups, look-back in days.
FINISHED = "OFF"
ROSTER_GROUPS = ("forwards", "defensemen", "goalies")
LOOKBACK_DAYS = 3

STRICT = {"mode": "FAILFAST"}


def read_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Landed documents, one JSON object per line, read with a fixed schema. A malformed one ends
    the load: read on as NULLs, it would be taken for a document without games or players."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def parse_documents(texts: DataFrame, column: str, schema: str) -> DataFrame:
    """Documents held as text in a column, parsed with a fixed schema."""
    return texts.select(F.from_json(column, schema, STRICT).alias("doc")).select("doc.*")


def parse_play_documents(texts: DataFrame, column: str, payload: bool = True) -> DataFrame:
    """Play-by-play documents held as text. With ``payload`` the plays stay text, else each play (an
    object) is parsed with its document in one pass. The stamp is left out: flattening does not read
    it, and a time stamp is dear to parse."""
    return parse_documents(texts, column, schemas.PAYLOADS_DOC if payload else schemas.PARSED_PLAYS_DOC)


def read_xg(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """The 15 expected-goals columns in use, by name; the file's other columns are pruned."""
    source = spark.read.option("header", True).csv(path) if fmt == "csv" else spark.read.parquet(path)
    fields = [line.strip().split(" ") for line in schemas.RAW_XG_SHOTS.split(",")]
    return source.select(*[F.col(name).cast(kind).alias(name) for name, kind in fields])


def with_ingested_at(df: DataFrame) -> DataFrame:
    return df.withColumn("ingested_at", F.current_timestamp())


def _required(c: Column, what: str) -> Column:
    return F.coalesce(c, F.raise_error(F.lit(f"document without {what}")))


def _scheduled_games(docs: DataFrame) -> DataFrame:
    """One row per listed game; ``seen`` orders the listings of a game, newest last."""
    weeks = docs.select("doc_ts", F.posexplode_outer("gameWeek").alias("week_pos", "week"))
    games = weeks.select("doc_ts", "week_pos", F.posexplode_outer("week.games").alias("game_pos", "game"))
    listed = games.where(F.col("game").isNotNull())
    return listed.select("game", F.struct("doc_ts", "week_pos", "game_pos").alias("seen"))


def flatten_schedule(docs: DataFrame) -> DataFrame:
    """Finished games, one row per id, as its newest listing describes it.

    The state is tested on the newest listing, so a game first listed unplayed is not lost.
    """
    listed = _scheduled_games(docs).where((F.col("game.id").isNotNull()) & (F.col("game.id") != 0))
    newest = listed.groupBy(F.col("game.id").alias("game_id")).agg(
        F.max_by("game", "seen").alias("game")
    )
    finished = newest.where(F.col("game.gameState") == FINISHED)
    start = F.col("game.startTimeUTC")
    return with_ingested_at(
        finished.select(
            "game_id",
            F.col("game.season").alias("season"),
            F.col("game.gameType").alias("game_type"),
            F.substring(start, 1, 10).cast("date").alias("game_date"),
            start.cast("timestamp").alias("start_time_utc"),
            F.col("game.venue.default").alias("venue"),
            F.col("game.homeTeam.id").alias("home_team_id"),
            F.col("game.homeTeam.abbrev").alias("home_team_abbrev"),
            F.col("game.homeTeam.score").alias("home_score"),
            F.col("game.awayTeam.id").alias("away_team_id"),
            F.col("game.awayTeam.abbrev").alias("away_team_abbrev"),
            F.col("game.awayTeam.score").alias("away_score"),
            F.col("game.gameOutcome.lastPeriodType").alias("last_period_type"),
        )
    )


def completed_games(
    docs: DataFrame, as_of: datetime.date, lookback_days: int = LOOKBACK_DAYS
) -> DataFrame:
    """Finished games of the look-back: one season per id.

    A document lists a week of games, so it is the game's own day that counts. Documents asked for
    more than a week before the look-back cannot list such a game and are left out at the scan.
    """
    since = as_of - datetime.timedelta(days=lookback_days)
    week = since - datetime.timedelta(days=7)
    near = docs.where(F.coalesce(F.col("schedule_date") >= F.lit(week), F.lit(True)))
    day = F.substring("game.startTimeUTC", 1, 10).cast("date")
    finished = _scheduled_games(near).where(
        (F.col("game.gameState") == FINISHED) & day.between(F.lit(since), F.lit(as_of))
    )
    return finished.groupBy(_required(F.col("game.id"), "game id").alias("game_id")).agg(
        F.max_by("game.season", "seen").alias("season")
    )


def flatten_plays(docs: DataFrame) -> DataFrame:
    """Shot events of play-by-play documents, each with its own payload kept as text; without it where
    the plays come parsed.

    Plays that are still text are parsed inside the array: outside, Spark would test the event type
    below the projection and parse every shot twice.
    """
    if isinstance(docs.schema["plays"].dataType.elementType, StringType):
        def parsed(raw: Column) -> Column:
            return F.struct(F.from_json(raw, schemas.PLAY, STRICT).alias("play"), raw.alias("raw"))

        slots = docs.select("id", "season", F.explode_outer(F.transform("plays", parsed)).alias("slot"))
        plays = slots.select("id", "season", "slot.*")
    else:
        plays = docs.select("id", "season", F.explode_outer("plays").alias("play"))
    shots = plays.where(F.col("play.typeDescKey").isin(*SHOT_EVENTS))
    details = F.col("play.details")
    scorer = F.nullif(details["scoringPlayerId"], F.lit(0))
    return with_ingested_at(
        shots.select(
            F.col("id").alias("game_id"),
            F.col("play.eventId").alias("event_id"),
            "season",
            F.col("play.periodDescriptor.number").alias("period"),
            F.col("play.timeInPeriod").alias("time_in_period"),
            F.col("play.typeDescKey").alias("event_type"),
            details["xCoord"].alias("x_coord"),
            details["yCoord"].alias("y_coord"),
            details["shotType"].alias("shot_type"),
            F.coalesce(scorer, details["shootingPlayerId"]).alias("shooter_id"),
            details["goalieInNetId"].alias("goalie_id"),
            details["eventOwnerTeamId"].alias("team_id"),
            F.col("play.situationCode").alias("situation_code"),
            F.col("play.homeTeamDefendingSide").alias("home_defending_side"),
            details["awayScore"].alias("away_score"),
            details["homeScore"].alias("home_score"),
            details["highlightClipSharingUrl"].alias("highlight_clip_url"),
            *[c for c in ("raw",) if c in shots.columns],
        )
    )


def current_teams(docs: DataFrame) -> DataFrame:
    """Distinct clubs of the standings."""
    entries = docs.select(F.explode_outer("standings").alias("entry"))
    clubs = entries.where(F.col("entry").isNotNull())
    return clubs.select(
        _required(F.col("entry.teamAbbrev.default"), "team").alias("team_abbrev")
    ).distinct()


def flatten_roster(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Players of roster documents: forwards, defence and goalies as one row set. ``carry`` names
    envelope columns to keep."""
    groups = [F.coalesce(F.col(group), F.array()) for group in ROSTER_GROUPS]
    slots = docs.select(
        "team_abbrev", *carry, F.explode_outer(F.concat(*groups)).alias("p")
    )
    players = slots.where(F.col("p").isNotNull())
    return with_ingested_at(
        players.select(
            _required(F.col("p.id"), "player id").alias("player_id"),
            F.col("p.firstName.default").alias("first_name"),
            F.col("p.lastName.default").alias("last_name"),
            F.col("p.positionCode").alias("position"),
            F.col("p.headshot").alias("headshot_url"),
            F.lit(None).cast("bigint").alias("team_id"),
            "team_abbrev",
            F.lit(True).alias("is_active"),
            F.col("p.sweaterNumber").alias("sweater_number"),
            F.col("p.heightInInches").alias("height_in"),
            F.col("p.weightInPounds").alias("weight_lbs"),
            F.col("p.birthDate").alias("birth_date"),
            F.col("p.birthCity.default").alias("birth_city"),
            F.col("p.birthCountry").alias("birth_country"),
            F.col("p.shootsCatches").alias("shoots_catches"),
            *carry,
        )
    )


def flatten_skater_stats(docs: DataFrame, season: int | None = None) -> DataFrame:
    """Season lines of skaters. Missing text is empty and missing counts are 0; the shooting
    percentage and the time on ice stay NULL. ``season`` stands in for the envelope's."""
    season_id = F.col("season_id") if season is None else F.lit(season)
    slots = docs.select(season_id.alias("season_id"), F.explode_outer("data").alias("s"))
    lines = slots.where(F.col("s").isNotNull())

    def text(field: str, name: str) -> Column:
        return F.coalesce(F.col(f"s.{field}"), F.lit("")).alias(name)

    def number(field: str, name: str) -> Column:
        return F.coalesce(F.col(f"s.{field}"), F.lit(0)).alias(name)

    return with_ingested_at(
        lines.select(
            _required(F.col("s.playerId"), "player id").alias("player_id"),
            "season_id",
            text("teamAbbrevs", "team_abbrev"),
            text("positionCode", "position"),
            number("gamesPlayed", "games_played"),
            number("goals", "goals"),
            number("assists", "assists"),
            number("points", "points"),
            number("plusMinus", "plus_minus"),
            number("ppGoals", "pp_goals"),
            number("ppPoints", "pp_points"),
            number("shGoals", "sh_goals"),
            number("shPoints", "sh_points"),
            number("shots", "shots"),
            F.col("s.shootingPct").alias("shooting_pct"),
            F.col("s.timeOnIcePerGame").alias("toi_per_game"),
        )
    )
