"""Which games' events are stored: a manifest kept beside the event table.

The manifest lives in ``<events>/_games``; Spark's readers of the event table pass over folders that
start with ``_``. It holds one row per game (``game_id``, ``season``) and is written per batch:

1. ``pending/batch=<id>``: the games a batch is about to write, before any event is written;
2. the events, appended in one job (all files of the batch commit, or none);
3. ``done/batch=<id>``: the same games, once the events have committed.

Readers take the games of ``done``. A batch left pending by a crash is settled when the manifest is
next read: if any of its games has events (a scan of its seasons' folders for its games only, which
happens after a crash and never otherwise), the events committed and the batch is marked done;
otherwise it is dropped and its games are loaded again. A game without shot events is done too, so
it is not fetched again each day.

Before the first batch, a manifest is built once from the event table, if there is one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shotmarts.sources import tables

GAMES = "game_id bigint, season int"


class GameManifest:
    def __init__(self, spark: SparkSession, events_path: str) -> None:
        self.spark = spark
        self.events_path = events_path
        self.path = f"{events_path}/_games"

    def _fs(self, path: str):
        return tables._file_system(self.spark, path)

    def _batches(self, state: str) -> set[str]:
        where, fs = self._fs(f"{self.path}/{state}")
        if not fs.exists(where):
            return set()
        names = [s.getPath().getName() for s in fs.listStatus(where)]
        return {n.removeprefix("batch=") for n in names if n.startswith("batch=")}

    def _read(self, state: str, batch: str | None = None) -> DataFrame:
        where = f"{self.path}/{state}" + (f"/batch={batch}" if batch else "")
        return self.spark.read.schema(GAMES).parquet(where)

    def _write(self, games: DataFrame, state: str, batch: str) -> None:
        games.select("game_id", "season").write.mode("overwrite").parquet(f"{self.path}/{state}/batch={batch}")

    def _bootstrap(self) -> None:
        """A first manifest of an event table that has none: one scan, once."""
        where, fs = self._fs(self.path)
        if fs.exists(where):
            return
        events = tables.read_table(self.spark, self.events_path)
        if events is not None:
            self._write(events.select("game_id", "season").distinct(), "done", "initial")

    def settle(self) -> None:
        """Marks pending batches whose events committed as done and drops the others."""
        self._bootstrap()
        done = self._batches("done")
        for batch in sorted(self._batches("pending")):
            if batch not in done:
                games = self._read("pending", batch)
                seasons = [r.season for r in games.select("season").distinct().collect()]
                events = tables.read_table(self.spark, self.events_path)
                committed = events is not None and not events.where(F.col("season").isin(seasons)).join(
                    games.select("game_id"), "game_id", "left_semi"
                ).isEmpty()
                if committed:
                    self._write(games, "done", batch)
            where, fs = self._fs(f"{self.path}/pending/batch={batch}")
            fs.delete(where, True)

    def games(self) -> DataFrame:
        """(game_id, season) of every game whose events are stored."""
        self.settle()
        if not self._batches("done"):
            return self.spark.createDataFrame([], GAMES)
        return self._read("done")

    def write(self, events: DataFrame, games: DataFrame) -> None:
        """Appends ``events`` of ``games`` (one row per game, none of them stored yet) as one batch."""
        batch = uuid.uuid4().hex
        self._write(games, "pending", batch)
        tables.append(events, self.events_path, ["season"], ["game_id", "event_id"])
        self._write(self._read("pending", batch), "done", batch)
        where, fs = self._fs(f"{self.path}/pending/batch={batch}")
        fs.delete(where, True)
