"""Landed files read once by available-now streams, reject tables and consumed batches."""

import json

import pytest

from shotmarts.plans import refresh
from shotmarts.streaming.landing import Inbox, TooManyRejects


def drop(folder, name, *docs, raw=()):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([*(json.dumps(d) for d in docs), *raw]) + "\n")


def roster(team, *ids, stamp="2025-01-01"):
    return {"doc_ts": f"{stamp}T00:00:00Z", "team_abbrev": team, "forwards": [{"id": i} for i in ids]}


def rows_read(progress):
    return sum(p["numInputRows"] for p in progress)


def test_second_run_reads_nothing_and_a_late_file_once(spark, tmp_path):
    source = tmp_path / "rosters"
    drop(source, "a.json", roster("BOS", 1, 2), roster("TOR", 3))
    inbox = Inbox(spark, str(tmp_path / "house"))
    assert rows_read(inbox.land("rosters", str(source))) == 2
    assert rows_read(inbox.land("rosters", str(source))) == 0
    docs, newest = inbox.documents("rosters", inbox.consumed("players"))
    assert docs.count() == 2
    inbox.note("players", newest)
    assert inbox.documents("rosters", inbox.consumed("players"))[0].count() == 0

    drop(source, "b.json", roster("MTL", 4, stamp="2025-01-02"))
    assert rows_read(inbox.land("rosters", str(source))) == 1
    assert rows_read(inbox.land("rosters", str(source))) == 0
    late, newer = inbox.documents("rosters", inbox.consumed("players"))
    assert [r.team_abbrev for r in late.collect()] == ["MTL"] and newer > newest
    assert late.first().source_file.endswith("b.json")


def test_bad_roster_costs_one_club_and_is_kept(spark, tmp_path):
    landing = tmp_path / "landing"
    drop(
        landing / "rosters", "r.json",
        roster("BOS", 1, 2), {"team_abbrev": "TOR", "forwards": [{"firstName": {"default": "A"}}]},
        roster("MTL", 3), raw=['{"team_abbrev": "NYR", "forwards": [ broken'],
    )
    names = {n: str(landing / n) for n in ("schedule", "plays", "rosters", "skaters", "xg")}
    house = refresh.Warehouse(spark, str(tmp_path / "house"), refresh.Landing(*names.values()))
    refresh.load_players(house)
    assert sorted(r.team_abbrev for r in house.raw_players().collect()) == ["BOS", "BOS", "MTL"]
    rejects = {r.reason: r for r in house.inbox.rejects().collect()}
    assert set(rejects) == {"player without id", "malformed document"}
    assert "broken" in rejects["malformed document"].text and '"TOR"' in rejects["player without id"].text
    assert all(r.landing == "rosters" and r.source_file.endswith("r.json") for r in rejects.values())
    # Nothing new: the player table is not written again.
    refresh.load_players(house)
    assert [p.name for p in (tmp_path / "house" / "raw_players").glob("v=*")] == ["v=1"]


def test_too_many_rejects_stop_the_load_until_mended(spark, tmp_path):
    source = tmp_path / "rosters"
    drop(source, "bad.json", roster("BOS", 1), raw=["{nope", "{nor this"])
    inbox = Inbox(spark, str(tmp_path / "house"), max_rejects=1)
    with pytest.raises(Exception, match="2 rejected documents"):
        inbox.land("rosters", str(source))
    assert inbox.documents("rosters")[1] == -1 and inbox.rejects().count() == 2
    # The batch was not committed: with a higher limit the same files are read again, once.
    again = Inbox(spark, str(tmp_path / "house"), max_rejects=5)
    assert rows_read(again.land("rosters", str(source))) == 3
    assert again.documents("rosters")[0].count() == 1 and again.rejects().count() == 2
    assert TooManyRejects.__doc__


def test_upsert_rewrites_only_touched_buckets(spark, tmp_path):
    from pyspark.sql import functions as F

    from shotmarts.sources.buckets import BucketedTable

    schema = "player_id bigint, team_abbrev string"
    table = BucketedTable(spark, str(tmp_path / "players"), schema, "player_id", buckets=8)
    first = spark.createDataFrame([(i, "BOS") for i in range(40)], schema).withColumn("doc_ts", F.lit(1))
    order = [F.col("doc_ts").desc_nulls_last()]
    assert len(table.upsert(first, order, stamp="doc_ts")) == 8
    reader = table.read()  # taken before the next batch
    one = spark.createDataFrame([(3, "TOR"), (100, "MTL")], schema).withColumn("doc_ts", F.lit(2))
    touched = table.upsert(one, order, stamp="doc_ts")
    assert len(touched) <= 2
    written = {p.name for p in (tmp_path / "players" / "v=2").glob("bucket=*")}
    assert written == {f"bucket={b}" for b in touched}
    now = {r.player_id: r.team_abbrev for r in table.read().collect()}
    assert len(now) == 41 and now[3] == "TOR" and now[100] == "MTL" and now[4] == "BOS"
    assert {r.player_id: r.team_abbrev for r in reader.collect()}[3] == "BOS"  # old or new, never both
    table.upsert(one.withColumn("doc_ts", F.lit(3)), order, stamp="doc_ts")
    assert not (tmp_path / "players" / "v=1").exists() or table._read_pointer("_previous")


def test_materialise_runs_the_plan_once_with_bloom_filters(spark, tmp_path):
    import pandas as pd
    from pyspark.sql import functions as F

    from shotmarts.sources.tables import materialise

    seen = spark.sparkContext.accumulator(0)

    @F.pandas_udf("long")
    def counted(ids: pd.Series) -> pd.Series:
        seen.add(len(ids))
        return ids

    df = spark.range(3000).select((F.col("id") % 3).alias("season"), counted("id").alias("shooter_id"))
    out = materialise(df, str(tmp_path / "mart"), ["season"], ["shooter_id"])
    assert seen.value == 3000 and out.count() == 3000  # no sampling pass over the plan
    jvm = spark._jvm
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    file = next((tmp_path / "mart" / "season=1").glob("*.parquet"))
    footer = jvm.org.apache.parquet.hadoop.ParquetFileReader.readFooter(conf, jvm.org.apache.hadoop.fs.Path(str(file)))
    column = footer.getBlocks().get(0).getColumns().get(0)
    assert str(column.getPath()) == "[shooter_id]" and column.getBloomFilterOffset() > 0


def test_even_rows_are_written_without_another_shuffle(spark, tmp_path):
    from pyspark.sql import functions as F

    from shotmarts.sources.tables import SHARED_SHUFFLE, materialise

    df = spark.range(0, 3000, 1, 4).select((F.col("id") % 3).alias("season"), F.col("id").alias("shooter_id"))
    tracker, before = spark.sparkContext.statusTracker(), spark.conf.get(SHARED_SHUFFLE)
    jobs = {}
    for even in (True, False):
        spark.sparkContext.setJobGroup(f"even-{even}", "")
        out = materialise(df, str(tmp_path / f"mart-{even}"), ["season"], ["shooter_id"], even=even)
        jobs[even] = len(tracker.getJobIdsForGroup(f"even-{even}"))
        assert out.count() == 3000
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[True] < jobs[False] and spark.conf.get(SHARED_SHUFFLE) == before


def test_shots_are_shuffled_once_for_games_and_expected_goals(spark):
    import re

    import __spark_entry__ as registry
    from shotmarts.sources.tables import SHARED_SHUFFLE, _setting

    with _setting(spark, SHARED_SHUFFLE, "false"), _setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        mart = registry.shot_queries()["shot_events"](spark, "/root/testdata/sf0.001")
        plan = mart._jdf.queryExecution().executedPlan().toString()
    # The shots and the deduplicated expected goals by number; the latter by all their keys before.
    assert len(re.findall(r"Exchange hashpartitioning\(mp_game_id#\d+L, \d+\)", plan)) == 2
    assert len(re.findall(r"Exchange hashpartitioning\(mp_game_id#\d+L, shooter_id", plan)) == 1
    assert mart.count() > 0
