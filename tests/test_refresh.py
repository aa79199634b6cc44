"""The whole batch job over landed files, and a second run over the same files."""

import datetime
import json

import pytest

from shotmarts.plans import quality, refresh
from shotmarts.plans.marts import Marts
from shotmarts.sources import trial_documents as td
from shotmarts.sources.tables import NotPublished
from shotmarts.sources.trial_tables import TrialTables

AS_OF = datetime.date(2026, 6, 30)
ALL_SEASONS = 2000  # days to look back over

# Trial shots include some without a shooter, and players without a club's logo.
KNOWN_BAD = {("int_shot_events", "shooter_id"), ("shot_events", "shooter_id")}


def merged(texts, key, field):
    """Documents of one key merged into one, as they really come."""
    whole = {}
    for row in texts.collect():
        doc = json.loads(row["text"])
        whole.setdefault(doc[key], {**doc, field: []})[field] += doc[field]
    return texts.sparkSession.createDataFrame([(json.dumps(d),) for d in whole.values()], "text string")


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    trial = TrialTables(spark, "/root/testdata/sf0.001")
    for name, texts in {
        "schedule": td.schedule_documents(trial),
        "plays": merged(td.play_documents(trial), "id", "plays"),
        "rosters": td.roster_documents(trial),
        "skaters": merged(td.skater_documents(trial), "season_id", "data"),
    }.items():
        texts.coalesce(1).write.text(str(root / name))
    trial.raw_xg_shots().coalesce(1).write.parquet(str(root / "xg"))
    return refresh.Landing(
        *[str(root / n) for n in ("schedule", "plays", "rosters", "skaters", "xg")], xg_format="parquet"
    )


def test_refresh(spark, landing, tmp_path):
    root = str(tmp_path / "house")
    checks = tuple(c for c in quality.SUITE if (c.table, c.label) not in KNOWN_BAD)

    def run(which):
        return refresh.refresh(spark, root, landing, AS_OF, ALL_SEASONS, which)

    with pytest.raises(refresh.QualityError, match=r"not_null shot_events\(shooter_id\)"):
        run(quality.SUITE)
    house = refresh.Warehouse(spark, root, landing)
    before = {n: getattr(house, n)().count() for n in ("raw_games", "raw_plays", "raw_players", "raw_player_stats")}
    assert before["raw_games"] == 58 and before["raw_players"] == 50 and before["raw_player_stats"] == 126
    stamps = house.raw_plays().agg({"ingested_at": "max"}).first()

    with pytest.raises(NotPublished, match="mart_shot_events"):
        house.mart("mart_shot_events")  # checks failed, nothing is published

    marts = run(checks)
    assert {n: getattr(house, n)().count() for n in before} == before
    assert house.raw_plays().agg({"ingested_at": "max"}).first() == stamps
    assert house.mart("mart_shot_events").count() == marts.shot_events.count()

    stored = house.mart("mart_team_games").count()
    with pytest.raises(refresh.QualityError):
        run(quality.SUITE)
    assert house.mart("mart_team_games").count() == stored > 0
    # No roster landed after the first run, so the player table was written once.
    assert [p.name for p in (tmp_path / "house" / "raw_players").glob("v=*")] == ["v=1"]

    trial = Marts(TrialTables(spark, "/root/testdata/sf0.001"))
    known = trial.shot_events.join(house.raw_games().select("game_id"), "game_id", "left_semi")
    columns = ["game_id", "event_id", "x_goal", "shot_distance", "strength", "game_date", "is_rush"]
    assert known.count() == marts.shot_events.count() > 5000
    assert marts.shot_events.select(columns).exceptAll(known.select(columns)).count() == 0


def test_point_filters_reach_the_stored_mart(spark, landing, tmp_path):
    from shotmarts.plans import serving

    house = refresh.Warehouse(spark, str(tmp_path / "house"), landing)
    refresh.load_games(house)
    refresh.load_plays(house, AS_OF, ALL_SEASONS)
    mart = house.marts().shot_events
    plan = serving.player_shots(mart, player=8470001, season=20232024)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(season" in plan and "EqualTo(shooter_id,8470001)" in plan
    assert "event_id_pk" not in plan.split("ReadSchema")[1]


def test_stored_games_come_from_the_manifest(spark, landing, tmp_path):
    from shotmarts.sources.manifest import GameManifest
    from shotmarts.sources.tables import append

    root = tmp_path / "house"
    house = refresh.Warehouse(spark, str(root), landing)
    refresh.load_games(house)
    refresh.load_plays(house, AS_OF, ALL_SEASONS)
    events = house.raw_plays()
    stored = events.count()
    manifest = GameManifest(spark, house.path("raw_plays"))
    games = manifest.games()
    assert games.count() == events.select("game_id").distinct().count() > 0
    # The manifest is hidden from readers of the event table, and its read plan does not scan it.
    assert "game_id" in events.columns and "raw_plays/_games" not in " ".join(events.inputFiles())
    assert all("/_games/" in f for f in games.inputFiles())

    # A crash between the events and the note that they are done: the batch stays pending.
    some = events.select("game_id", "season").distinct().limit(3)
    lost = events.join(some.select("game_id"), "game_id", "left_semi")
    remaining = events.join(some.select("game_id"), "game_id", "left_anti")
    tables_path = str(root / "raw_plays_rebuilt")
    append(remaining, tables_path, ["season"], ["game_id", "event_id"])
    rebuilt = GameManifest(spark, tables_path)
    assert rebuilt.games().count() == games.count() - 3  # built once from the table
    rebuilt._write(some, "pending", "crashed")
    append(lost, tables_path, ["season"], ["game_id", "event_id"])
    assert rebuilt.games().count() == games.count()  # settled: its events had committed
    rebuilt._write(spark.createDataFrame([(99999999, 20232024)], "game_id bigint, season int"), "pending", "empty")
    assert rebuilt.games().count() == games.count()  # nothing committed: dropped, loaded again later
    assert not rebuilt._batches("pending")

    # A second load finds every completed game stored and writes nothing.
    refresh.load_plays(house, AS_OF, ALL_SEASONS)
    assert house.raw_plays().count() == stored


def test_a_rerun_starts_at_the_failed_step(spark, landing, tmp_path, monkeypatch):
    root = str(tmp_path / "house")
    calls = []
    for name in ("load_games", "load_plays", "load_players", "load_skater_stats", "build_marts"):
        original = getattr(refresh, name)

        def counted(*args, _original=original, _name=name, **kwargs):
            calls.append(_name)
            return _original(*args, **kwargs)

        monkeypatch.setattr(refresh, name, counted)
    good = tuple(c for c in quality.SUITE if (c.table, c.label) not in KNOWN_BAD)
    checks = good[:3] + tuple(c for c in good if c.table == "team_games")

    def broken(house):
        raise RuntimeError("killed in step 3")

    with monkeypatch.context() as patched:
        patched.setattr(refresh, "load_players", broken)
        with pytest.raises(RuntimeError, match="step 3"):
            refresh.refresh(spark, root, landing, AS_OF, ALL_SEASONS, checks)
    assert calls == ["load_games", "load_plays"]
    calls.clear()
    marts = refresh.refresh(spark, root, landing, AS_OF, ALL_SEASONS, checks)
    assert calls == ["load_players", "load_skater_stats", "build_marts"]
    house = refresh.Warehouse(spark, root, landing)
    assert house.mart("mart_team_games").count() == marts.team_games.count() > 0
    calls.clear()
    refresh.refresh(spark, root, landing, AS_OF, ALL_SEASONS, checks)
    assert calls == []  # all done: nothing runs again
    # Checks of int_shot_events read the stored shot mart, not the plays again.
    int_checks = tuple(c for c in quality.SUITE if c.table == "int_shot_events")
    built = refresh.RunLog(spark, root, AS_OF.isoformat()).done("build_marts")
    frames = refresh.check_tables(refresh.Warehouse(spark, root, landing).marts(stored=built["versions"]), int_checks)
    # Row checks of the stored marts were observed while they were written.
    marts = {"shot_events", "player_shooting", "players", "team_games", "team_season"}
    assert set(built["observed"]) == {repr(c) for c in checks if c.failing and c.table in marts} != set()
    plan = quality.run_checks(frames, int_checks)._jdf.queryExecution().executedPlan().toString()
    files = frames["int_shot_events"].inputFiles()
    assert files and all("/mart_shot_events/version-1/" in f for f in files)
    assert plan.count("FileScan") == 2  # the stored mart, once per kind of check
    # All marts are named by one pointer; each mart has one version on disk.
    assert len(list((tmp_path / "house" / "_published").glob("*.json"))) == 1
    assert [p.name for p in (tmp_path / "house" / "mart_shot_events").glob("version-*")] == ["version-1"]
