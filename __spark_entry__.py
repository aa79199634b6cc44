"""Entry points: flagship query, registered queries, and the SQL each of them must agree with.

Every query runs over whole trial tables as one lazy plan from the source files; queries for one
player or team narrow that plan. The exceptions are named in their docstrings.
"""

from __future__ import annotations

import datetime
import sys
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle.queries import statements  # noqa: E402
from shotmarts.functions import labels as lb  # noqa: E402
from shotmarts.functions import shots as fn  # noqa: E402
from shotmarts.plans import players, quality, serving, shots, teams  # noqa: E402
from shotmarts.plans.marts import Marts  # noqa: E402
from shotmarts.plans.refresh import EVEN, LAYOUT  # noqa: E402
from shotmarts.session import tune  # noqa: E402
from shotmarts.sources import documents, increments, schemas, tables  # noqa: E402
from shotmarts.sources import trial_documents as td  # noqa: E402
from shotmarts.sources import trial_tables as tt  # noqa: E402

try:  # the text operators may be left out of an installation, together with their pipeline
    import corpus_pipeline
    from shotmarts.llm import queries as text_queries
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "shotmarts.llm"):
        raise
    corpus_pipeline = text_queries = None

AS_OF = datetime.date(2023, 10, 20)
STATS_YEAR = 2025
NEWEST_SEASON = 20252026
REPLACED_SEASON = 20242025

# The player, team and season of queries for one key.
ONE_PLAYER = 8470249
ONE_TEAM = "T02"
ONE_SEASON = 20242025

Query = Callable[[SparkSession, str], DataFrame]


def _trial(run: Callable[[tt.TrialTables], DataFrame]) -> Query:
    return lambda spark, folder: run(tt.TrialTables(tune(spark), folder))


def _lazy(run: Callable[[Marts], DataFrame]) -> Query:
    return _trial(lambda tables: run(Marts(tables)))


# --- loads: documents are made as text, then parsed and flattened --------------------------------


def _docs(texts: DataFrame, schema: str) -> DataFrame:
    return documents.parse_documents(texts, "text", schema)


def _schedule(t: tt.TrialTables) -> DataFrame:
    return _docs(td.schedule_documents(t), schemas.SCHEDULE_DOC)


def _ingest_games(t: tt.TrialTables) -> DataFrame:
    return documents.flatten_schedule(_schedule(t)).select(*tt.GAME_COLUMNS)


def _append_new_games(t: tt.TrialTables) -> DataFrame:
    games = t.raw_games().select(*tt.GAME_COLUMNS)
    stored = games.where(F.col("season") < NEWEST_SEASON).withColumn("origin", F.lit("stored"))
    return increments.append_new(stored, games.withColumn("origin", F.lit("new")), ["game_id"])


def _flat_plays(t: tt.TrialTables, payload: bool = True) -> DataFrame:
    docs = documents.parse_play_documents(td.play_documents(t), "text", payload)
    return documents.flatten_plays(docs)


def _plays_from_payload(t: tt.TrialTables) -> DataFrame:
    """Fields read back from the payload text kept with each play."""
    kept = _flat_plays(t).select("game_id", F.from_json("raw", schemas.PLAY).alias("p"))
    details = F.col("p.details")
    shooter = F.coalesce(F.nullif(details["scoringPlayerId"], F.lit(0)), details["shootingPlayerId"])
    return kept.select(
        "game_id",
        F.col("p.eventId").alias("event_id"),
        F.col("p.typeDescKey").alias("event_type"),
        details["xCoord"].alias("x_coord"),
        F.col("p.periodDescriptor.number").alias("period"),
        shooter.alias("shooter_id"),
        details["highlightClipSharingUrl"].alias("highlight_clip_url"),
    )


def _unprocessed_games(t: tt.TrialTables) -> DataFrame:
    completed = t.raw_games().where("home_score is not null").select("game_id", "season")
    return increments.unprocessed_games(
        completed, t.raw_plays().where(F.col("season") < NEWEST_SEASON)
    )


def _upsert_players(t: tt.TrialTables) -> DataFrame:
    """Skaters are stored; rosters then bring every player of a club twice, the later one wins."""
    people = t.raw_players().select(*tt.PLAYER_COLUMNS)
    stored = people.where(F.col("position") != "G").withColumn("version", F.lit(0))
    versions = F.explode(F.array(F.lit(1), F.lit(2)))
    batch = people.where(F.col("team_abbrev").isNotNull()).withColumn("version", versions)
    batch = batch.withColumn("sweater_number", F.col("sweater_number") + F.col("version"))
    return increments.upsert(stored, batch, ["player_id"], [F.col("version").desc()]).drop("version")


def _replace_season(t: tt.TrialTables) -> DataFrame:
    lines = t.raw_player_stats().select(*tt.STATS_COLUMNS)
    fresh = lines.withColumn("goals", F.col("goals") + 1)
    return increments.replace_partition(lines, fresh, "season_id", [REPLACED_SEASON])


def _stored_path(t: tt.TrialTables, name: str) -> str:
    return f"{tables.staging_folder(t.spark)}/{name}-{uuid.uuid4().hex}"


def _landed_xg(t: tt.TrialTables) -> DataFrame:
    """Expected goals written as the file they come in, with a column nobody asked for, and read."""
    path = _stored_path(t, "xg")
    t.raw_xg_shots().withColumn("arenaAdjusted", F.lit(1)).write.option("header", True).csv(path)
    return documents.read_xg(t.spark, path)


def _written_games(t: tt.TrialTables) -> DataFrame:
    """Games of all but the newest season are published, then all games once more."""
    path, plays = _stored_path(t, "plays"), t.raw_plays().drop("raw", "ingested_at")
    tables.write_games(plays.where(F.col("season") < NEWEST_SEASON), path)
    tables.write_games(plays, path)
    return tables.read_table(t.spark, path).select(*tt.PLAY_COLUMNS)


def _materialised(m: Marts) -> DataFrame:
    """The shot mart stored in its layout and read back."""
    path = _stored_path(m.raw, "mart")
    layout, even = LAYOUT["mart_shot_events"], "mart_shot_events" in EVEN
    return tables.materialise(m.shot_events, path, *layout, even=even)


def _current_teams(t: tt.TrialTables) -> DataFrame:
    return documents.current_teams(_docs(td.standings_documents(t), schemas.STANDINGS_DOC))


def _shown(df: DataFrame) -> DataFrame:
    """A short result in display order, with each row's place in it."""
    return df.withColumn("place", F.row_number().over(Window.orderBy(F.monotonically_increasing_id())))


# --- scalar expressions over the shots ------------------------------------------------------------

KEY = ("game_id", "event_id")


def _parsed(m: Marts) -> DataFrame:
    return shots.parse_plays(m.stg_plays)


def _located(m: Marts) -> DataFrame:
    return shots.add_geometry(shots.attach_game_teams(_parsed(m), m.stg_games))


def _clock(m: Marts) -> DataFrame:
    elapsed = fn.elapsed_seconds(F.col("period"), F.col("seconds_in_period"))
    return _parsed(m).select(
        *KEY, "time_in_period", "seconds_in_period", elapsed.alias("elapsed_seconds")
    )


def _strength(m: Marts) -> DataFrame:
    return shots.add_strength(shots.attach_game_teams(_parsed(m), m.stg_games)).select(
        *KEY, "is_empty_net", "strength"
    )


def _enriched(match_season: bool) -> Query:
    return _lazy(
        lambda m: shots.attach_xg(_parsed(m), m.stg_xg, match_season).select(*KEY, *shots.XG_VALUES)
    )


def _team_names(m: Marts) -> DataFrame:
    """Names are known for clubs with an even number."""
    number = F.substring("team_abbrev", 2, 2)
    known = (
        m.stg_games.select(F.col("home_team_abbrev").alias("team_abbrev"))
        .distinct()
        .where(number.cast("int") % 2 == 0)
        .withColumn("name", F.concat(F.lit("Team "), number))
    )
    return serving.team_names(m.team_season, known)


def _log(m: Marts) -> DataFrame:
    """The log needs opponent, venue and date of a team game, which its two sides have without any
    shots being added up."""
    return serving.player_game_log(m.shot_events, teams.team_perspective(m.stg_games))


def _map(m: Marts) -> DataFrame:
    return serving.player_shots(m.shot_events)


def _team_log(m: Marts) -> DataFrame:
    return serving.team_game_log(m.team_games)


def _checks(kind: str) -> Query:
    return _lazy(lambda m: quality.run_checks(m, quality.of_kind(kind)))


def _text_queries() -> dict[str, Query]:
    if text_queries is None:
        return {}
    return text_queries.queries() | {"pipeline": corpus_pipeline.run}


def _text_sql() -> dict[str, str]:
    if text_queries is None:
        return {}
    sql = {"pipeline": corpus_pipeline.ORACLE_SQL} | text_queries.oracle_sql()
    return {name: text for name, text in sql.items() if text is not None}


def queries() -> dict[str, Query]:
    return _text_queries() | shot_queries()


def shot_queries() -> dict[str, Query]:
    return {
        # loads
        "ingest_games": _trial(_ingest_games),
        "append_new_games": _trial(_append_new_games),
        "ingest_plays": _trial(lambda t: _flat_plays(t, payload=False).select(*tt.PLAY_COLUMNS)),
        "ingest_plays_raw_json": _trial(_plays_from_payload),
        "completed_games": _trial(lambda t: documents.completed_games(_schedule(t), AS_OF)),
        "unprocessed_games": _trial(_unprocessed_games),
        "ingest_roster": _trial(
            lambda t: documents.flatten_roster(
                _docs(td.roster_documents(t), schemas.ROSTER_DOC)
            ).select(*tt.PLAYER_COLUMNS)
        ),
        "current_teams": _trial(_current_teams),
        "upsert_players": _trial(_upsert_players),
        "ingest_skater_stats": _trial(
            lambda t: documents.flatten_skater_stats(
                _docs(td.skater_documents(t), schemas.SKATER_STATS_DOC)
            ).select(*tt.STATS_COLUMNS)
        ),
        "replace_season": _trial(_replace_season),
        "seasons_to_refresh": _trial(
            lambda t: increments.seasons_to_refresh(
                t.raw_plays(), t.raw_player_stats(), STATS_YEAR
            )
        ),
        "ingest_xg": _trial(_landed_xg),
        "write_games": _trial(_written_games),
        "materialise": _lazy(_materialised),
        # staging and scalar expressions
        "stg_games": _lazy(lambda m: m.stg_games.drop("start_time_utc", "ingested_at")),
        "stg_plays": _lazy(lambda m: m.stg_plays.drop("raw")),
        "stg_xg": _lazy(lambda m: m.stg_xg),
        "stg_players": _lazy(lambda m: m.stg_players.drop("ingested_at")),
        "stg_player_stats": _lazy(lambda m: m.stg_player_stats),
        "parse_situation": _lazy(
            lambda m: _parsed(m).select(*KEY, "situation_code", *fn.SITUATION_SLOTS)
        ),
        "clock_seconds": _lazy(_clock),
        "net_x": _lazy(lambda m: _located(m).select(*KEY, "net_x")),
        "shot_geometry": _lazy(
            lambda m: _located(m).select(*KEY, "net_x", "shot_distance", "shot_angle")
        ),
        "strength_state": _lazy(_strength),
        "surrogate_key": _lazy(
            lambda m: m.stg_plays.select(
                *KEY, lb.surrogate_key(F.col("game_id"), F.col("event_id")).alias("event_id_pk")
            )
        ),
        "season_label": _lazy(
            lambda m: m.stg_games.select(
                "game_id", lb.season_label(F.col("season")).alias("season_label")
            )
        ),
        "clip_content_id": _lazy(lambda m: serving.clip_ids(m.shot_events)),
        "player_bio": _lazy(lambda m: serving.player_bio(m.players)),
        # marts
        "xg_dedupe": _lazy(lambda m: shots.dedupe_xg(m.stg_xg)),
        "xg_enrich": _enriched(match_season=False),
        "xg_enrich_season": _enriched(match_season=True),
        "int_shot_events": _lazy(lambda m: m.int_shot_events.drop("raw")),
        "shot_events": _lazy(lambda m: m.shot_events),
        "player_season": _lazy(lambda m: players.player_season(m.shot_events)),
        "player_shooting": _lazy(lambda m: m.player_shooting),
        "mart_players": _lazy(lambda m: m.players),
        "team_perspective": _lazy(lambda m: teams.team_perspective(m.stg_games)),
        "team_shot_stats": _lazy(
            lambda m: teams.team_shot_stats(
                teams.team_perspective(m.stg_games).select("game_id", "team_id"), m.shot_events
            )
        ),
        "team_games": _lazy(lambda m: m.team_games),
        "team_season": _lazy(lambda m: m.team_season),
        # players
        "league_stats": _lazy(lambda m: serving.league_stats(m.player_shooting, m.shot_events)),
        "leaderboard": _lazy(lambda m: serving.leaderboard(m.player_shooting, m.players)),
        "player_card": _lazy(lambda m: serving.player_card(m.player_shooting, m.players)),
        "percentile_scores": _lazy(lambda m: serving.percentile_scores(m.player_shooting)),
        "player_shots": _lazy(_map),
        "player_game_log": _lazy(_log),
        "player_rolling_xg": _lazy(lambda m: serving.player_rolling_xg(_log(m))),
        "goal_games": _lazy(lambda m: serving.goal_games(_log(m))),
        "season_players": _lazy(lambda m: serving.season_players(m.player_shooting, m.players)),
        "teams_in_season": _lazy(lambda m: serving.teams_in_season(m.player_shooting, m.players)),
        "player_season_log": _lazy(lambda m: serving.player_season_log(m.player_shooting)),
        "available_seasons": _lazy(lambda m: serving.available_seasons(m.player_shooting)),
        # one player
        "player_card_one": _lazy(
            lambda m: serving.player_card(m.player_shooting, m.players, ONE_PLAYER, ONE_SEASON)
        ),
        "player_shots_one": _lazy(
            lambda m: serving.player_shots(m.shot_events, ONE_PLAYER, ONE_SEASON)
        ),
        "player_game_log_one": _lazy(
            lambda m: _shown(
                serving.player_game_log(
                    m.shot_events, teams.team_perspective(m.stg_games), ONE_PLAYER, ONE_SEASON
                )
            )
        ),
        "leaderboard_one": _lazy(
            lambda m: _shown(serving.leaderboard(m.player_shooting, m.players, ONE_SEASON))
        ),
        # shots on the map
        "filter_options": _lazy(lambda m: serving.filter_options(_map(m))),
        "shots_filtered": _lazy(
            lambda m: serving.filter_shots(
                _map(m), strength=["5v5", "PP/SH"], event=["goal", "shot-on-goal"]
            )
        ),
        "shots_normalised": _lazy(lambda m: serving.normalise_side(_map(m))),
        "shot_class": _lazy(
            lambda m: serving.with_shot_class(_map(m)).select(
                "game_id", "shooter_id", "event_type", "shot_class"
            )
        ),
        "shots_by_type": _lazy(lambda m: serving.filter_shot_type(_map(m), "wrist")),
        "xg_clipped": _lazy(
            lambda m: serving.with_display_xg(_map(m)).select(
                "game_id", "shooter_id", "x_goal", "xg_display"
            )
        ),
        "shot_labels": _lazy(
            lambda m: serving.shot_labels(_map(m), _log(m)).select(
                "game_id", "shooter_id", "season", "period", "time_in_period", "opponent",
                "is_home", "date_label", "opponent_label",
            )
        ),
        "shots_selected_games": _lazy(
            lambda m: serving.shots_in_games(_map(m), _log(m).where(F.col("goals") >= 2))
        ),
        "shot_type_breakdown": _lazy(lambda m: serving.shot_type_breakdown(_map(m))),
        "goal_clips": _lazy(
            lambda m: serving.goal_clips(_map(m), _log(m)).select(
                "shooter_id", "season", "game_id", "period", "time_in_period",
                "highlight_clip_url", "game_num", "opponent", "is_home",
            )
        ),
        "first_goal_clip": _lazy(lambda m: serving.first_goal_clip(_map(m))),
        # teams
        "team_card": _lazy(lambda m: serving.team_card(m.team_season)),
        "team_game_log": _lazy(_team_log),
        "last_10_games": _lazy(lambda m: serving.last_10_games(_team_log(m))),
        "team_game_log_one": _lazy(
            lambda m: _shown(serving.team_game_log(m.team_games, ONE_TEAM, ONE_SEASON))
        ),
        "team_roster_sorted": _lazy(
            lambda m: _shown(
                serving.sort_roster(
                    serving.team_roster(m.player_shooting, m.players, ONE_TEAM, ONE_SEASON), "goals"
                )
            )
        ),
        "split_records": _lazy(lambda m: serving.split_records(m.team_games)),
        "team_rolling_xg_pct": _lazy(lambda m: serving.team_rolling_xg_pct(_team_log(m))),
        "league_table": _lazy(lambda m: serving.league_table(m.team_season)),
        "league_ranks": _lazy(lambda m: serving.league_ranks(m.team_season)),
        "team_roster": _lazy(lambda m: serving.team_roster(m.player_shooting, m.players)),
        "team_names": _lazy(_team_names),
        # checks
        "dq_not_null": _checks(quality.NOT_NULL),
        "dq_unique": _checks(quality.UNIQUE),
        "dq_unique_combo": _checks(quality.UNIQUE_COMBO),
        "dq_accepted": _checks(quality.ACCEPTED),
        "dq_expression": _checks(quality.EXPRESSION),
    }


def oracle_sql() -> dict[str, str]:
    return _text_sql() | shot_sql()


def shot_sql() -> dict[str, str]:
    return statements(AS_OF, STATS_YEAR)


def entry(spark: SparkSession) -> DataFrame:
    """The player mart at the smallest scale."""
    return queries()["player_shooting"](spark, "/root/testdata/sf0.001")
