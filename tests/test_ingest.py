"""Flattening of hand-written documents and incremental loads."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from shotmarts.sources import documents as docs
from shotmarts.sources import increments, schemas, tables


def landed(spark, tmp_path, schema, *bodies):
    path = tmp_path / "landed.json"
    path.write_text("\n".join(json.dumps(body) for body in bodies))
    return docs.read_documents(spark, str(path), schema)


def game(number, state, **fields):
    return {"id": number, "gameState": state, "season": 20242025, "gameType": 2, **fields}


def schedule(stamp, *games, day="2025-01-10"):
    return {"doc_ts": f"{stamp}T00:00:00Z", "schedule_date": day, "gameWeek": [{"games": list(games)}]}


def test_schedule(spark, tmp_path):
    full = game(
        1, "OFF", startTimeUTC="2025-01-11T00:30:00Z", venue={"default": "Rink"},
        homeTeam={"id": 6, "abbrev": "BOS", "score": 3}, awayTeam={"id": 10, "abbrev": "TOR", "score": 2},
        gameOutcome={"lastPeriodType": "OT"},
    )
    frame = landed(
        spark, tmp_path, schemas.SCHEDULE_DOC,
        schedule("2025-01-11", full, full, game(2, "FUT"), game(3, "FUT")),
        schedule("2025-01-12", game(3, "OFF"), {"gameState": "OFF"}, game(0, "OFF")),
        {"doc_ts": "2025-01-13T00:00:00Z"}, schedule("2025-01-13"),
    )
    got = {r["game_id"]: r for r in docs.flatten_schedule(frame).collect()}
    assert sorted(got) == [1, 3]
    first = got[1]
    assert first["game_date"] == datetime.date(2025, 1, 11)
    assert (first["home_team_abbrev"], first["away_score"], first["last_period_type"]) == ("BOS", 2, "OT")
    assert first["venue"] == "Rink" and first["ingested_at"] is not None
    assert got[3]["game_date"] is None and got[3]["home_team_id"] is None


def test_completed_games_look_back(spark, tmp_path):
    frame = landed(
        spark, tmp_path, schemas.SCHEDULE_DOC,
        schedule("2025-01-11", played(1, "08"), game(2, "LIVE", startTimeUTC="2025-01-09T00:00:00Z")),
        schedule("2025-01-12", played(1, "08", season=20252026), played(3, "11"), game(5, "OFF")),
        schedule("2025-01-12", played(4, "06"), played(6, "07"), day="2025-01-06"),
        # A week's document asked for long before the game it lists.
        schedule("2025-01-09", played(7, "09"), day="2025-01-04"),
    )
    got = docs.completed_games(frame, datetime.date(2025, 1, 10)).collect()
    assert sorted(tuple(r) for r in got) == [(1, 20252026), (6, 20242025), (7, 20242025)]


def played(number, day, **fields):
    return game(number, "OFF", **{"startTimeUTC": f"2025-01-{day}T23:00:00Z", **fields})


@pytest.mark.parametrize("text", ['{"doc_ts": "2025-01-10T00:00:00Z", "gameWeek": [', '{\n  "gameWeek": []\n}', "oops"])
def test_malformed_documents_end_the_load(spark, tmp_path, text):
    path = tmp_path / "landed.json"
    path.write_text(json.dumps(schedule("2025-01-10", played(1, "09"))) + "\n" + text)
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        docs.flatten_schedule(docs.read_documents(spark, str(path), schemas.SCHEDULE_DOC)).collect()


def test_malformed_plays_end_the_load(spark):
    plays = spark.createDataFrame([(1, 20242025, ['{"eventId": 1}', '{"eventId": '])], "id long, season int, plays array<string>")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        docs.flatten_plays(plays).collect()


def test_all_pages_of_the_newest_answer_count(spark):
    rows = [("2025-01-02", 1, "a"), ("2025-01-02", 1, "b"), ("2025-01-01", 1, "old"), (None, 2, "c")]
    pages = spark.createDataFrame(rows, "doc_ts string, season_id int, page string")
    got = increments.newest_documents(pages, "season_id")
    assert sorted(r.page for r in got.collect()) == ["a", "b", "c"] and got.columns == pages.columns


def test_plays(spark, tmp_path):
    def play(event, kind, **details):
        return {"eventId": event, "typeDescKey": kind, "details": details}

    body = {
        "id": 7, "season": 20242025, "doc_ts": "2025-01-11T00:00:00Z",
        "plays": [
            play(1, "shot-on-goal", scoringPlayerId=0, shootingPlayerId=5, xCoord=1, yCoord=-2),
            play(2, "hit", shootingPlayerId=5), play(3, "goal", scoringPlayerId=9, shootingPlayerId=5),
            {"eventId": 4, "typeDescKey": "blocked-shot", "unlisted": {"kept": [1, 2]}},
        ],
    }
    empty = [{"id": 8, "season": 1, "plays": []}, {"id": 9, "season": 1}]
    got = docs.flatten_plays(landed(spark, tmp_path, schemas.PLAYS_DOC, body, *empty))
    by_event = {r["event_id"]: r for r in got.collect()}
    assert sorted(by_event) == [1, 3, 4]
    assert [by_event[e]["shooter_id"] for e in (1, 3, 4)] == [5, 9, None]
    assert by_event[1]["x_coord"] == 1.0 and by_event[1]["season"] == 20242025
    # The payload keeps fields nothing here knows of.
    assert json.loads(by_event[4]["raw"]) == body["plays"][3]


def test_rosters(spark, tmp_path):
    body = {
        "team_abbrev": "BOS",
        "forwards": [{"id": 1, "firstName": {"default": "A"}, "heightInInches": 74}],
        "goalies": [{"id": 2, "birthCity": None}],
    }
    got = docs.flatten_roster(landed(spark, tmp_path, schemas.ROSTER_DOC, body, {"team_abbrev": "TOR"}))
    by_id = {r["player_id"]: r for r in got.collect()}
    assert sorted(by_id) == [1, 2]
    assert by_id[1]["first_name"] == "A" and by_id[1]["last_name"] is None
    assert by_id[2]["team_abbrev"] == "BOS" and by_id[2]["is_active"] and by_id[2]["team_id"] is None


def test_a_player_without_id_stops_the_load(spark, tmp_path):
    body = {"team_abbrev": "BOS", "forwards": [{"firstName": {"default": "A"}}]}
    with pytest.raises(Exception, match="without player id"):
        docs.flatten_roster(landed(spark, tmp_path, schemas.ROSTER_DOC, body)).collect()


def test_current_teams(spark, tmp_path):
    entries = [{"teamAbbrev": {"default": t}} for t in ("BOS", "TOR", "BOS")]
    frame = landed(spark, tmp_path, schemas.STANDINGS_DOC, {"standings": entries})
    assert sorted(r[0] for r in docs.current_teams(frame).collect()) == ["BOS", "TOR"]


def test_skater_stats(spark, tmp_path):
    body = {"season_id": 20242025, "data": [{"playerId": 1, "goals": 3}]}
    row = docs.flatten_skater_stats(landed(spark, tmp_path, schemas.SKATER_STATS_DOC, body)).first()
    assert (row["goals"], row["assists"], row["team_abbrev"], row["shooting_pct"]) == (3, 0, "", None)
    assert row["toi_per_game"] is None and row["season_id"] == 20242025


def test_expected_goals_file_is_read_by_name(spark, tmp_path):
    path = tmp_path / "xg.csv"
    header = "xGoal,unused,game_id,shooterPlayerId,shooterName,season,team,period,time,xCordAdjusted"
    header += ",yCordAdjusted,shotType,event,shotRush,shotRebound,isPlayoffGame"
    path.write_text(header + "\n0.25,9,20001,8470001.0,A,2024,HOME,1,65,80.0,-3.0,WRIST,SHOT,1,0,0\n")
    row = docs.read_xg(spark, str(path)).first()
    assert (row["game_id"], row["xGoal"], row["time"], row["shotRush"]) == (20001, 0.25, 65, 1)


def ids(df):
    return sorted(tuple(r) for r in df.collect())


def test_append_new_keeps_stored_rows(spark):
    stored = spark.createDataFrame([(1, "old")], "id int, v string")
    new = spark.createDataFrame([(1, "new"), (2, "new")], "id int, v string")
    once = increments.append_new(stored, new, ["id"])
    assert ids(once) == [(1, "old"), (2, "new")]
    assert ids(increments.append_new(once, new, ["id"])) == ids(once)


def test_upsert(spark):
    stored = spark.createDataFrame([(2, "old", 0), (3, "old", 0)], "id int, v string, n int")
    batch = spark.createDataFrame([(1, "new", 1), (2, "stale", 1), (2, "new", 2)], "id int, v string, n int")
    got = increments.upsert(stored, batch, ["id"], [F.col("n").desc()])
    assert ids(got.select("id", "v")) == [(1, "new"), (2, "new"), (3, "old")]


def test_replace_partition(spark):
    stored = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "v int, s int")
    batch = spark.createDataFrame([(9, 10), (9, 20)], "v int, s int")
    got = increments.replace_partition(stored, batch, "s", [10])
    assert {tuple(r) for r in got.collect()} == {(9, 10), (2, 20), (3, None)}


def test_unprocessed_games(spark):
    completed = spark.createDataFrame([(1, 1), (2, 1)], "game_id int, season int")
    events = spark.createDataFrame([(1, 1), (1, 2)], "game_id int, event_id int")
    assert ids(increments.unprocessed_games(completed, events)) == [(2, 1)]


def test_seasons_to_refresh(spark):
    events = spark.createDataFrame([(20242025,), (20252026,), (20252026,)], "season int")
    stats = spark.createDataFrame([(20242025, 1), (20252026, 1)], "season_id int, player_id int")
    assert ids(increments.seasons_to_refresh(events, stats, 2026)) == [(20252026,)]
    assert len(ids(increments.seasons_to_refresh(events, stats.where("false"), 2026))) == 2


def test_write_games_is_repeatable(spark, tmp_path):
    path = str(tmp_path / "plays")
    events = spark.createDataFrame(
        [(g, e, 20242025) for g in (1, 2) for e in range(3)], "game_id bigint, event_id bigint, season int"
    )
    tables.write_games(events.where("game_id = 1"), path)
    for _ in range(2):
        tables.write_games(events, path)
    assert ids(spark.read.parquet(path).select("game_id", "event_id", "season")) == ids(events)


def test_partition_overwrite_and_snapshots(spark, tmp_path):
    path = str(tmp_path / "stats")
    first = spark.createDataFrame([(1, 10), (2, 20)], "v int, s int")
    tables.overwrite_partitions(first, path, ["s"])
    tables.overwrite_partitions(first.where("s = 10").withColumn("v", F.lit(9)), path, ["s"])
    assert ids(spark.read.parquet(path).select("v", "s")) == [(2, 20), (9, 10)]
    path = str(tmp_path / "people")
    empty, version = tables.read_snapshot(spark, path, "v int")
    assert (empty.count(), version) == (0, 0)
    for version in (1, 2):
        tables.write_snapshot(spark.createDataFrame([(version,)], "v int"), path, version)
    newest, version = tables.read_snapshot(spark, path, "v int")
    assert (ids(newest), version) == ([(2,)], 2)


def test_plays_are_parsed_with_their_documents(spark):
    """A document is parsed once, and once more a play where the plays stay text."""
    play = {"eventId": 4, "typeDescKey": "goal", "x": [1, {"y": "ü"}], "details": {"scoringPlayerId": 7, "xCoord": 1.5}}
    hit = {"eventId": 5, "typeDescKey": "hit", "details": None}
    bodies = [
        {"doc_ts": "2025-01-11T00:00:00Z", "id": 1, "season": 20242025, "plays": [hit, None, play, {}, {**play, "eventId": 6}]},
        {"id": 2, "plays": []}, {"id": 3},
    ]
    texts = spark.createDataFrame([(json.dumps(b, ensure_ascii=False),) for b in bodies] + [(None,)], "text string")
    apart = docs.flatten_plays(docs.parse_documents(texts, "text", schemas.PLAYS_DOC)).drop("ingested_at")
    joint = docs.flatten_plays(docs.parse_play_documents(texts, "text")).drop("ingested_at")
    lean = docs.flatten_plays(docs.parse_play_documents(texts, "text", payload=False)).drop("ingested_at")
    assert sorted(r["event_id"] for r in joint.collect()) == [4, 6]
    assert json.loads(joint.where("event_id = 4").first()["raw"]) == play
    assert sorted(joint.collect()) == sorted(apart.collect())
    assert sorted(lean.collect()) == sorted(joint.drop("raw").collect())
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (apart, joint, lean)]
    assert [plan.count("from_json(") for plan in plans] == [2, 2, 1]


@pytest.mark.parametrize("play", ['{"eventId": "x"}', '{"typeDescKey": "hit", "details": {"xCoord": "far"}}', "7"])
@pytest.mark.parametrize("payload", [True, False])
def test_plays_of_other_types_end_the_load(spark, play, payload):
    texts = spark.createDataFrame([(f'{{"id": 1, "plays": [{play}]}}',)], "text string")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        docs.flatten_plays(docs.parse_play_documents(texts, "text", payload)).collect()
