"""Mart semantics: hand-made edge cases, and invariants over the smallest trial tables."""

import datetime

import pytest
from pyspark.sql import functions as F

from shotmarts.plans import players, serving, shots, staging, teams
from shotmarts.plans.marts import Marts
from shotmarts.sources import schemas
from shotmarts.sources.trial_tables import TrialTables

GAME = 2025020001


def frame(spark, schema, *rows):
    """Rows given as dictionaries; what is left out is NULL."""
    names = [f.name for f in spark.createDataFrame([], schema).schema]
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], schema)


def games(spark, *rows):
    base = {
        "game_id": GAME, "season": 20252026, "game_type": 2, "game_date": datetime.date(2025, 10, 7),
        "home_team_id": 1, "home_team_abbrev": "AAA", "away_team_id": 2, "away_team_abbrev": "BBB",
        "home_score": 3, "away_score": 2, "last_period_type": "REG",
    }
    return staging.stg_games(frame(spark, schemas.RAW_GAMES, *[{**base, **row} for row in rows]))


def plays(spark, *rows):
    base = {
        "game_id": GAME, "season": 20252026, "period": 1, "time_in_period": "01:05", "team_id": 1,
        "event_type": "shot-on-goal", "x_coord": 80.0, "y_coord": 6.0, "shooter_id": 9,
        "situation_code": "1551", "home_defending_side": "left",
    }
    numbered = [{"event_id": i, **base, **row} for i, row in enumerate(rows)]
    return staging.stg_plays(frame(spark, schemas.RAW_PLAYS, *numbered))


def xg(spark, *rows):
    base = {
        "game_id": 20001, "shooterPlayerId": 9.0, "season": 2025, "period": 1, "time": 65,
        "shotRush": 0, "shotRebound": 0, "xGoal": 0.1,
    }
    return staging.stg_xg(frame(spark, schemas.RAW_XG_SHOTS, *[{**base, **row} for row in rows]))


def by_event(df):
    return {r["event_id"]: r for r in df.collect()}


def test_expected_goals_are_deduplicated_by_maximum(spark):
    repeated = xg(spark, {"xGoal": 0.1, "shotRush": 1}, {"xGoal": 0.3, "shotRush": None})
    row = shots.dedupe_xg(repeated).first()
    assert (row["x_goal"], row["is_rush"], row["is_rebound"]) == (0.3, True, False)


def test_enrichment(spark):
    events = plays(spark, {}, {"shooter_id": None}, {"period": 2, "time_in_period": "00:00"},
                   {"x_coord": None}, {"game_id": 2024020001})
    rows = xg(spark, {}, {"period": 2, "time": 1200, "season": 2019, "xGoal": 0.7})
    got = by_event(shots.shot_events(events, games(spark, {}), rows))
    assert sorted(got) == [0, 1, 2, 4]
    assert [got[e]["x_goal"] for e in (0, 1, 2, 4)] == [0.1, None, 0.7, 0.1]
    assert got[0]["game_date"] == datetime.date(2025, 10, 7)
    assert (got[4]["game_date"], got[4]["net_x"]) == (None, 89.0)
    strict = by_event(shots.shot_events(events, games(spark, {}), rows, match_season=True))
    assert [strict[e]["x_goal"] for e in (0, 1, 2, 4)] == [0.1, None, None, 0.1]


def test_both_shot_tables_agree_with_the_separate_joins(spark):
    m = Marts(TrialTables(spark, "/root/testdata/sf0.001"))
    parsed = shots.attach_game_teams(shots.parse_plays(m.stg_plays), m.stg_games)
    steps = shots.attach_xg(shots.add_strength(shots.add_geometry(parsed)), m.stg_xg)
    assert steps.select(*shots.INT_COLUMNS).exceptAll(m.int_shot_events).count() == 0
    dated = shots.attach_game_date(m.int_shot_events, m.stg_games)
    columns = [c for c in shots.MART_COLUMNS if c != "event_id_pk"]
    assert dated.select(*columns).exceptAll(m.shot_events.select(*columns)).count() == 0


@pytest.mark.parametrize(
    ("game", "home", "away"),
    [({}, "W", "L"), ({"last_period_type": "OT"}, "W", "OTL"),  # home wins but for the last two
     ({"last_period_type": "OT", "game_type": 3}, "W", "L"), ({"last_period_type": None}, "W", "L"),
     ({"home_score": None}, "L", "L"), ({"home_score": 2, "last_period_type": "SO"}, "OTL", "W")],
)
def test_results(spark, game, home, away):
    no_shots = shots.shot_events(plays(spark), games(spark), xg(spark))
    got = teams.team_games(games(spark, game), no_shots).collect()
    results = {r["is_home"]: r["result"] for r in got}
    assert results == {True: home, False: away}
    assert all(r["shot_attempts_for"] == 0 and r["xg_against"] == 0.0 for r in got)


def test_shots_for_and_against(spark):
    events = plays(
        spark, {}, {"event_type": "blocked-shot"}, {"team_id": 2, "event_type": "goal", "time_in_period": "09:00"},
        {"team_id": None}, {"period": 5}, {"team_id": 7, "event_type": "missed-shot", "time_in_period": "09:00"},
    )
    mart = shots.shot_events(events, games(spark, {}), xg(spark, {}))
    got = {r["is_home"]: r for r in teams.team_games(games(spark, {}), mart).collect()}
    home, away = got[True], got[False]
    assert (home["shot_attempts_for"], home["sog_for"], home["xg_for"]) == (2, 1, 0.1)
    assert (home["shot_attempts_against"], home["sog_against"], home["xg_against"]) == (2, 1, 0.0)
    assert (away["shot_attempts_for"], away["shot_attempts_against"], away["xg_against"]) == (1, 3, 0.1)
    stats = teams.team_shot_stats(
        teams.team_perspective(games(spark, {})).select("game_id", "team_id"),
        mart.where("event_type = 'blocked-shot'"),
    )
    only_blocked = {r["team_id"]: r for r in stats.collect()}
    assert only_blocked[1]["shot_attempts_for"] == 1 and only_blocked[1]["xg_for"] is None


def test_season_points(spark):
    rows = [("W", 2), ("OTL", 2), ("L", 2), ("W", 1)]
    tg = spark.createDataFrame(
        [(20252026, "AAA", 1, t, r, 1, 2, 0.5, 0.25, 10, 5, 0, 0) for r, t in rows],
        "season int, team_abbrev string, team_id bigint, game_type int, result string, gf int, ga int,"
        " xg_for double, xg_against double, shot_attempts_for bigint, sog_for bigint,"
        " shot_attempts_against bigint, sog_against bigint",
    )
    row = teams.team_season(tg).first()
    assert (row["games_played"], row["points"], row["wins"], row["otl"]) == (3, 3, 1, 1)
    assert (row["xg_for"], row["sh_pct"], row["sh_pct_sog"], row["sv_pct"]) == (1.5, 10.0, 20.0, None)
    assert teams.team_season(tg, game_type=None).first()["games_played"] == 4


def test_game_log_of_blocked_shots(spark):
    events = plays(spark, {"event_type": "blocked-shot"})
    mart = shots.shot_events(events, games(spark, {}), xg(spark))
    row = serving.player_game_log(mart, teams.team_games(games(spark, {}), mart)).first()
    assert (row["shots"], row["xg"], row["opponent"], row["game_num"]) == (1, None, "BBB", 1)


def test_player_names(spark):
    people = frame(
        spark, schemas.RAW_PLAYERS, {"player_id": 1, "first_name": None, "last_name": "B"},
        {"player_id": 2, "first_name": "A", "last_name": "B", "team_abbrev": "BOS", "birth_date": "n/a"},
    )
    got = {r["player_id"]: r for r in players.mart_players(staging.stg_players(people)).collect()}
    assert got[1]["full_name"] is None and got[1]["team_logo_url"] is None
    assert got[2]["full_name"] == "A B" and got[2]["team_logo_url"].endswith("/BOS_light.svg")
    assert got[2]["birth_date"] is None


def test_season_line_rounding(spark):
    line = {"player_id": 1, "season_id": 20252026, "shooting_pct": 0.1234, "toi_per_game": 1115.0}
    row = staging.stg_player_stats(frame(spark, schemas.RAW_PLAYER_STATS, line)).first()
    assert (row["shooting_pct"], row["toi_per_game_min"]) == (12.3, 18.58)


def test_rolling_share(spark):
    log = spark.createDataFrame(
        [("AAA", 1, 1, 1, 0.0, 0.0), ("AAA", 1, 2, 2, 3.0, 1.0), ("BBB", 1, 2, 1, 3.0, 1.0)],
        "team_abbrev string, season int, game_id bigint, game_num bigint, xg_for double, xg_against double",
    )
    got = serving.team_rolling_xg_pct(log).orderBy("team_abbrev", "game_num").collect()
    assert [r["rolling_xg_pct"] for r in got] == [50.0, 62.5, 75.0]
    assert [(r["above_even"], r["below_even"]) for r in got][1] == (62.5, 50.0)


def test_empty_selection_drops_null(spark):
    mart = spark.createDataFrame([("5v5", 1, "goal"), (None, 1, "goal")], "strength string, period int, event_type string")
    assert serving.filter_shots(mart).count() == 1
    assert serving.filter_shots(mart, strength=["EN"]).count() == 0


def test_roster_sort(spark):
    roster = spark.createDataFrame([(1, 5, "B"), (2, 9, "A")], "player_id int, points int, last_name string")
    assert [r["player_id"] for r in serving.sort_roster(roster).collect()] == [2, 1]
    assert [r["player_id"] for r in serving.sort_roster(roster, "last_name").collect()] == [2, 1]
    with pytest.raises(ValueError, match="cannot sort"):
        serving.sort_roster(roster, "weight")


@pytest.fixture(scope="module")
def stored(spark):
    return Marts.stored(TrialTables(spark, "/root/testdata/sf0.001"))


def test_each_game_balances(stored):
    tg = stored.team_games
    per_game = tg.groupBy("game_id").agg(
        F.count("*").alias("n"),
        (F.sum("shot_attempts_for") - F.sum("shot_attempts_against")).alias("balance"),
    )
    assert per_game.where("n <> 2 or balance <> 0").count() == 0
    ts = stored.team_season
    assert ts.where("wins + losses + otl <> games_played").count() == 0


def test_percentiles_and_classes(stored):
    names = list(players.PERCENTILES)
    outside = " or ".join(f"not ({n} between 0 and 1)" for n in names)
    assert stored.player_shooting.where(outside).count() == 0
    shown = serving.player_shots(stored.shot_events)
    counts = serving.with_shot_class(shown).groupBy().pivot("shot_class", ["goal", "blocked", "other"]).count()
    assert sum(counts.first()) == shown.count()
    turned = serving.normalise_side(shown)
    distance = "sqrt(pow(x_coord - abs(net_x), 2) + pow(y_coord, 2)) - shot_distance"
    assert turned.where(f"abs({distance}) > 0.0051").count() == 0


def test_one_key_equals_its_part_of_all_keys(stored):
    mart, tg = stored.shot_events, stored.team_games
    everyone = serving.player_game_log(mart, tg)
    player, season = everyone.groupBy("shooter_id", "season").count().orderBy(F.desc("count")).first()[:2]
    one = serving.player_game_log(mart, tg, player=player, season=season)
    part = everyone.where((F.col("shooter_id") == player) & (F.col("season") == season))
    assert one.exceptAll(part).count() == 0 and one.count() == part.count()
    assert [r["game_num"] for r in one.collect()] == list(range(1, one.count() + 1))
    board = serving.leaderboard(stored.player_shooting, stored.players, season=season, n=5)
    whole = serving.leaderboard(stored.player_shooting, stored.players, n=5)
    assert board.exceptAll(whole).count() == 0
    log = serving.team_game_log(tg, team="T01", season=20232024)
    assert log.select("game_num").collect() == log.orderBy("game_id").select("game_num").collect()
