"""The batch job: land increments, rebuild the marts, run the checks, stop at the first failure."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shotmarts.plans.marts import Marts
from shotmarts.plans.quality import SUITE, Check, failed, observed_results, row_metrics, run_checks
from shotmarts.sources import documents, increments, schemas, tables
from shotmarts.plans.runlog import Publication, RunLog
from shotmarts.sources.buckets import BucketedTable
from shotmarts.sources.manifest import GameManifest
from shotmarts.streaming.landing import Inbox

# How each stored table is split into folders and sorted within files. Serving queries ask for
# one season and one player or team.
LAYOUT = {
    "mart_shot_events": (["season"], ["shooter_id", "game_id", "event_id"]),
    "mart_player_shooting": (["season"], ["shooter_id"]),
    "mart_players": ([], ["player_id"]),
    "mart_team_games": (["season"], ["team_abbrev", "game_id"]),
    "mart_team_season": ([], ["season", "team_abbrev"]),
}

# Marts whose rows come out of joins by game number, which spreads them evenly.
EVEN = {"mart_shot_events"}


class QualityError(Exception):
    """Some checks found failing rows."""


@dataclass(frozen=True)
class Landing:
    """Folders of landed documents, and of the expected-goals file."""

    schedule: str
    plays: str
    rosters: str
    skater_stats: str
    xg: str
    xg_format: str = "csv"
    #: With standings, only the rosters of the clubs in them are loaded.
    standings: str | None = None


class Warehouse:
    """Raw tables and marts under one root folder."""

    def __init__(self, spark: SparkSession, root: str, landing: Landing, max_rejects: int = 100):
        self.spark = spark
        self.root = root
        self.landing = landing
        #: Landed documents, each file parsed once, and what each loader has consumed of them.
        self.inbox = Inbox(spark, root, max_rejects)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _table(self, name: str, schema: str) -> DataFrame:
        found = tables.read_table(self.spark, self.path(name), schema)
        return self.spark.createDataFrame([], schema) if found is None else found

    def raw_games(self) -> DataFrame:
        return self._table("raw_games", schemas.RAW_GAMES)

    def raw_plays(self) -> DataFrame:
        return self._table("raw_plays", schemas.RAW_PLAYS)

    def raw_player_stats(self) -> DataFrame:
        return self._table("raw_player_stats", schemas.RAW_PLAYER_STATS)

    def players_table(self) -> BucketedTable:
        """Players in hash buckets of their id: an upsert rewrites only the buckets it touches."""
        return BucketedTable(self.spark, self.path("raw_players"), schemas.RAW_PLAYERS, "player_id")

    def raw_players(self) -> DataFrame:
        return self.players_table().read()

    def raw_xg_shots(self) -> DataFrame:
        return documents.read_xg(self.spark, self.landing.xg, self.landing.xg_format)

    def mart(self, name: str) -> DataFrame:
        """A mart as last published: all marts change with one pointer."""
        try:
            pointer = Publication(self.spark, self.root).current()
        except tables.NotPublished as error:
            raise tables.NotPublished(f"{name}: {error}") from None
        return self.spark.read.parquet(pointer[name])

    def marts(self, stored: dict[str, str] | None = None, checks: tuple[Check, ...] = ()) -> Marts:
        """Marts built as new versions (``built`` names them), or read from ``stored`` versions.

        The row-wise ``checks`` of a mart are observed while it is written (``observed`` holds
        failures and rows in scope by check), so they need no pass of their own.
        """
        self.built: dict[str, str] = {}
        self.observed: dict[str, list[int]] = {}

        def keep(df: DataFrame, name: str) -> DataFrame:
            if stored is not None:
                return self.spark.read.schema(df.schema).parquet(stored[name])
            partition_by, cluster_by = LAYOUT[name]
            version = tables.next_version(self.spark, self.path(name))
            self.built[name] = version
            mine = [c for c in checks if c.table == name.removeprefix("mart_") and c.failing is not None]
            if not mine:
                return tables.materialise(df, version, partition_by, cluster_by, even=name in EVEN)
            watch = Observation(name)
            out = tables.materialise(
                df, version, partition_by, cluster_by, observe=(watch, row_metrics(mine)), even=name in EVEN
            )
            got = watch.get
            self.observed |= {repr(c): [got[f"f{i}"], got[f"t{i}"]] for i, c in enumerate(mine)}
            return out

        return Marts(self, keep=keep)


def load_games(house: Warehouse) -> None:
    """Finished games of the schedule documents that landed since the last load."""
    inbox = house.inbox
    inbox.land("schedule", house.landing.schedule)
    docs, newest = inbox.documents("schedule", inbox.consumed("games"))
    new = increments.unseen(documents.flatten_schedule(docs), house.raw_games(), ["game_id"])
    tables.append(new, house.path("raw_games"), ["season"], ["game_id"])
    inbox.note("games", newest)


def load_plays(
    house: Warehouse, as_of: datetime.date, lookback_days: int = documents.LOOKBACK_DAYS
) -> None:
    """Shot events of recently completed games that have none yet.

    The schedule is read from the stored documents, which the look-back prunes at the scan. Stored
    games are looked up in the manifest beside the event table, which is not read. Play documents
    of all stored batches are candidates, as a game's may land before it is due; they are Parquet by
    then, parsed once when they landed.
    """
    inbox = house.inbox
    inbox.land("schedule", house.landing.schedule)
    inbox.land("plays", house.landing.plays)
    schedule, _ = inbox.documents("schedule")
    completed = documents.completed_games(schedule, as_of, lookback_days)
    manifest = GameManifest(house.spark, house.path("raw_plays"))
    wanted = increments.unseen(completed, manifest.games(), ["game_id"])
    docs, _ = inbox.documents("plays")
    # The season is the one the schedule gives.
    docs = docs.drop("season", "source_file").join(wanted.withColumnRenamed("game_id", "id"), "id")
    games = wanted.join(docs.select(F.col("id").alias("game_id")), "game_id", "left_semi")
    events = documents.flatten_plays(increments.newest_documents(docs, "id"))
    manifest.write(events.dropDuplicates(["game_id", "event_id"]), games)


def load_players(house: Warehouse) -> None:
    """Upsert of the rosters that landed since the last load, the newest mention of a player wins;
    players who left stay as they were. Only the hash buckets of the batch's players are rewritten;
    without new rosters nothing is."""
    inbox = house.inbox
    inbox.land("rosters", house.landing.rosters)
    done = inbox.consumed("players")
    docs, newest = inbox.documents("rosters", done)
    if newest <= done:
        return
    if house.landing.standings:
        inbox.land("standings", house.landing.standings)
        standings, _ = inbox.documents("standings")
        docs = docs.join(documents.current_teams(standings), "team_abbrev", "left_semi")
    batch = documents.flatten_roster(docs, carry=["doc_ts"])
    order = [F.col("doc_ts").desc_nulls_last(), F.col("team_abbrev").asc_nulls_last()]
    house.players_table().upsert(batch, order, stamp="doc_ts")
    inbox.note("players", newest)


def load_skater_stats(house: Warehouse, year: int) -> None:
    """Season lines of the seasons in play, from the documents that landed since the last load;
    finished seasons already loaded are left alone, and a season without new documents keeps its
    lines."""
    inbox = house.inbox
    inbox.land("skater_stats", house.landing.skater_stats)
    docs, newest = inbox.documents("skater_stats", inbox.consumed("skater_stats"))
    wanted = increments.seasons_to_refresh(house.raw_plays(), house.raw_player_stats(), year)
    chosen = docs.join(wanted.withColumnRenamed("season", "season_id"), "season_id", "left_semi")
    newest_docs = increments.newest_documents(chosen, "season_id")
    lines = documents.flatten_skater_stats(newest_docs).dropDuplicates(["season_id", "player_id"])
    tables.overwrite_partitions(lines, house.path("raw_player_stats"), ["season_id"])
    inbox.note("skater_stats", newest)


def build_marts(house: Warehouse, checks: tuple[Check, ...] = ()) -> Marts:
    """Rebuild and store every mart; each is read back by the ones built on it. Row-wise checks of
    the marts are observed while they are written."""
    marts = house.marts(checks=checks)
    for name in ("shot_events", "players", "player_shooting", "team_games", "team_season"):
        getattr(marts, name)
    return marts


def check_tables(marts: Marts, checks: tuple[Check, ...]) -> dict[str, DataFrame]:
    """The frames the checks read. ``int_shot_events`` has the rows of the stored shot mart (one per
    enriched play) and every column its checks read, so they read the stored mart rather than
    enriching the plays once more."""
    return {c.table: marts.shot_events if c.table == "int_shot_events" else getattr(marts, c.table) for c in checks}


def assert_quality(
    marts: Marts, checks: tuple[Check, ...] = SUITE, observed: dict[str, list[int]] | None = None
) -> None:
    """Raise with the failing checks. Checks observed while the marts were written are taken as
    observed; the others run. Only check results reach the driver: one row per check."""
    observed = observed or {}
    seen = [c for c in checks if repr(c) in observed]
    rest = tuple(c for c in checks if repr(c) not in observed)
    spark = marts.shot_events.sparkSession
    metrics = {k: v for i, c in enumerate(seen) for k, v in ((f"f{i}", observed[repr(c)][0]), (f"t{i}", observed[repr(c)][1]))}
    results = observed_results(spark, seen, metrics)
    if rest:
        results = results.unionByName(run_checks(check_tables(marts, rest), rest))
    bad = failed(results).collect()
    if bad:
        lines = [f"{r.check_name} {r.table_name}({r.column_name}): {r.failures} of {r.total}" for r in bad]
        raise QualityError("; ".join(lines))


def refresh(
    spark: SparkSession,
    root: str,
    landing: Landing,
    as_of: datetime.date,
    lookback_days: int = documents.LOOKBACK_DAYS,
    checks: tuple[Check, ...] = SUITE,
) -> Marts:
    """One daily run. A step that fails ends the run; a rerun for the same day starts at that step.

    Each finished step is logged with its inputs (``plans/runlog.py``): loads once a day, marts once
    per load, checks per set of checks and marts, publishing per set of marts. Marts are built beside
    those in use and published together by one pointer after their checks, so a failed run leaves
    readers the marts they had.
    """
    house = Warehouse(spark, root, landing)
    log = RunLog(spark, root, as_of.isoformat())
    loads = {
        "load_games": lambda: load_games(house),
        "load_plays": lambda: load_plays(house, as_of, lookback_days),
        "load_players": lambda: load_players(house),
        "load_skater_stats": lambda: load_skater_stats(house, as_of.year),
    }
    for step, work in loads.items():
        if log.done(step, lookback_days) is None:
            work()
            log.finish(step, lookback_days)
    built = log.done("build_marts")
    if built is None:
        marts = build_marts(house, checks)
        built = {"versions": dict(house.built), "observed": dict(house.observed)}
        log.finish("build_marts", None, built)
    else:
        marts = house.marts(stored=built["versions"])
    versions = built["versions"]
    names = sorted(repr(c) for c in checks)
    if log.done("checks", [versions, names]) is None:
        assert_quality(marts, checks, built["observed"])
        log.finish("checks", [versions, names])
    if log.done("publish", versions) is None:
        Publication(spark, root).publish(versions)
        log.finish("publish", versions)
    return marts
