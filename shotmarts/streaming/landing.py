"""Landed documents are read once: a file stream per landing folder, run until the folder is caught
up (``Trigger.AvailableNow``), with its checkpoint in the warehouse.

Each micro-batch parses the new files permissively. Documents that parse and pass their landing's
rules are stored as Parquet under ``landed/<name>/batch=<id>``; the others go to the reject table
``rejects/landing=<name>/batch=<id>`` with their source file, the reason and the raw text. A batch
folder is overwritten as a whole, so a batch that Spark repeats after a failure leaves one copy.

More rejects in one batch than ``max_rejects`` stop the load: the stream fails before its
checkpoint commits the batch, the rejects stay visible, and the next run reads the files again.

Loaders (the batch writers of ``plans/refresh.py``) read the stored batches that they have not
consumed yet, and note the newest one after their own write commits (``consumed/<loader>``). A run
that stopped between landing and loading therefore loads the batch on the next run; loaders are
idempotent, so one that stopped after its write but before its note does no harm either. A second
run over an unchanged folder lands no file and hands the loaders no document.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shotmarts.sources import schemas

CORRUPT = "_corrupt_record"
REJECTS = "landing string, batch long, source_file string, reason string, text string, rejected_at timestamp"


def _players_without_id(groups: tuple[str, ...]) -> Column:
    players = F.concat(*[F.coalesce(F.col(g), F.array()) for g in groups])
    return F.exists(players, lambda p: p.isNotNull() & p["id"].isNull())


def _malformed_play() -> Column:
    return F.exists(F.coalesce("plays", F.array()), lambda raw: raw.isNotNull() & F.try_parse_json(raw).isNull())


def _line_without_player() -> Column:
    return F.exists(F.coalesce("data", F.array()), lambda s: s.isNotNull() & s["playerId"].isNull())


@dataclass(frozen=True)
class Kind:
    """A landing: the schema of its documents and the rules a document must pass."""

    schema: str
    rules: tuple[tuple[str, Callable[[], Column]], ...] = ()


# Fixed rules: a reason and the test that finds it.
KINDS = {
    "schedule": Kind(schemas.SCHEDULE_DOC),
    "plays": Kind(schemas.PLAYS_DOC, (("play that does not parse", _malformed_play),)),
    "rosters": Kind(
        schemas.ROSTER_DOC,
        (("player without id", lambda: _players_without_id(("forwards", "defensemen", "goalies"))),),
    ),
    "skater_stats": Kind(schemas.SKATER_STATS_DOC, (("line without player id", _line_without_player),)),
    "standings": Kind(schemas.STANDINGS_DOC),
}


class TooManyRejects(Exception):
    """A batch had more rejected documents than the load accepts."""


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def reason(kind: Kind) -> Column:
    """Why a parsed row is rejected, or NULL."""
    out = F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed document"))
    for why, test in kind.rules:
        out = out.when(F.coalesce(test(), F.lit(False)), F.lit(why))
    return out


class Inbox:
    """Landing folders of one warehouse, streamed into stored batches."""

    def __init__(self, spark: SparkSession, root: str, max_rejects: int = 100, files_per_batch: int = 1000):
        self.spark = spark
        self.root = root
        self.max_rejects = max_rejects
        self.files_per_batch = files_per_batch

    def landed_path(self, name: str) -> str:
        return f"{self.root}/landed/{name}"

    def rejects(self) -> DataFrame:
        """All rejected documents, by landing and batch."""
        try:
            return self.spark.read.schema(f"{REJECTS}").parquet(f"{self.root}/rejects")
        except Exception as error:  # noqa: BLE001 - the folder appears with the first reject
            if "PATH_NOT_FOUND" in str(error):
                return self.spark.createDataFrame([], REJECTS)
            raise

    def land(self, name: str, source: str) -> list[dict]:
        """Reads the files of ``source`` that no earlier run read; returns the progress of each
        micro-batch (``numInputRows`` among them)."""
        kind = KINDS[name]
        stream = (
            self.spark.readStream.schema(f"{kind.schema}, {CORRUPT} string")
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("maxFilesPerTrigger", self.files_per_batch)
            .json(source)
            .select("*", F.col("_metadata.file_path").alias("source_file"))
        )

        def store(batch: DataFrame, batch_id: int) -> None:
            judged = batch.withColumn("_reason", reason(kind)).persist()
            try:
                bad = judged.where(F.col("_reason").isNotNull())
                n_bad = bad.count()
                if n_bad:
                    # landing and batch are the folder levels
                    bad.select(
                        "source_file", F.col("_reason").alias("reason"),
                        F.coalesce(CORRUPT, F.to_json(F.struct(*self._fields(kind)))).alias("text"),
                        F.current_timestamp().alias("rejected_at"),
                    ).write.mode("overwrite").parquet(
                        f"{self.root}/rejects/landing={name}/batch={batch_id}"
                    )
                if n_bad > self.max_rejects:
                    raise TooManyRejects(f"{name}: {n_bad} rejected documents in batch {batch_id}")
                good = judged.where(F.col("_reason").isNull()).drop(CORRUPT, "_reason")
                good.write.mode("overwrite").parquet(f"{self.landed_path(name)}/batch={batch_id}")
            finally:
                judged.unpersist()

        query = (
            stream.writeStream.foreachBatch(store)
            .trigger(availableNow=True)
            .option("checkpointLocation", f"{self.root}/checkpoints/{name}")
            .start()
        )
        query.awaitTermination()
        return [json.loads(p.json) if hasattr(p, "json") else p for p in query.recentProgress]

    @staticmethod
    def _fields(kind: Kind) -> list[str]:
        from pyspark.sql.types import StructType

        return StructType.fromDDL(kind.schema).fieldNames()

    def _batches(self, name: str) -> list[int]:
        where, fs = _fs(self.spark, self.landed_path(name))
        if not fs.exists(where):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(where)]
        return sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))

    def consumed(self, loader: str) -> int:
        """Newest batch that a loader has stored the rows of; -1 before the first."""
        where, fs = _fs(self.spark, f"{self.root}/consumed/{loader}")
        if not fs.exists(where):
            return -1
        stream = fs.open(where)
        try:
            return int(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip())
        finally:
            stream.close()

    def note(self, loader: str, batch: int) -> None:
        """Records that a loader's write of everything up to ``batch`` has committed."""
        if batch < 0:
            return
        where, fs = _fs(self.spark, f"{self.root}/consumed/{loader}")
        temporary, _ = _fs(self.spark, f"{self.root}/consumed/.{loader}.next")
        out = fs.create(temporary, True)
        out.write(str(batch).encode())
        out.close()
        fs.delete(where, False)
        fs.rename(temporary, where)

    def documents(self, name: str, after: int | None = None) -> tuple[DataFrame, int]:
        """Stored documents of batches after ``after`` (all where None), and the newest batch.

        The batch is a folder level, so the scan lists and reads only the batches asked for.
        """
        kind = KINDS[name]
        batches = self._batches(name)
        newest = max(batches, default=-1)
        wanted = [b for b in batches if after is None or b > after]
        if not wanted:
            return self.spark.createDataFrame([], f"{kind.schema}, source_file string"), newest
        docs = (
            self.spark.read.schema(f"{kind.schema}, source_file string, batch long")
            .option("basePath", self.landed_path(name))
            .parquet(*[f"{self.landed_path(name)}/batch={b}" for b in wanted])
        )
        return docs.drop("batch"), newest
