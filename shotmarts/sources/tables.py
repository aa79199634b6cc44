"""Table storage: staged intermediates, materialised marts and safe rewrites on plain Parquet."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def staging_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``; beside the tables where it
    names none."""
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    return spark.conf.get("spark.checkpoint.dir", None) or f"{warehouse}/_staging"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    For results that several branches of one plan need: they are computed once, survive lost
    executors, and are read with column pruning. Their size is then known from the files, so
    that Spark's own broadcast threshold decides on joins with them. They go with the session.
    """
    path = f"{staging_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    where, fs = _file_system(df.sparkSession, path)
    fs.deleteOnExit(where)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


#: By default both sides of a join have to lie by all of its keys.
SHARED_SHUFFLE = "spark.sql.requireAllClusterKeysForCoPartition"


def materialise(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    bloom: Sequence[str] | None = None,
    observe: tuple | None = None,
    even: bool = False,
) -> DataFrame:
    """Overwrite a table and return it as read from storage.

    Rows are rebalanced on the partition columns: at run time AQE splits a partition that one
    season makes large into files of the advisory size, so files stay even without the sampling
    pass of a range partitioning, and the plan of ``df`` runs once. ``even`` says that the rows come
    out of joins on an evenly spread key, which the keys of all these joins hold: they may then share
    one shuffle on it, and the table is written from there, with a file for each partition and
    season, and not shuffled once more. Within files rows are sorted by
    the partition and cluster columns, so min/max statistics of row groups skip most of them on a
    point filter, and Parquet Bloom filters on the ``bloom`` columns (by default the id columns
    among ``cluster_by``) skip row groups whose range holds a key they do not have. ``observe``
    (an ``Observation`` and aggregate columns) collects metrics while the rows are written.
    """
    order = [*partition_by, *cluster_by]
    if order:
        df = (df if even else df.hint("rebalance", *partition_by)).sortWithinPartitions(*order)
    if observe:
        # After the last exchange, in the writing tasks: each row counts once per successful task.
        observation, metrics = observe
        df = df.observe(observation, *metrics)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    for column in [c for c in cluster_by if c.endswith("_id")] if bloom is None else bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    with _setting(df.sparkSession, SHARED_SHUFFLE, "false" if even else None):
        writer.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str | None) -> Iterator[None]:
    """A session setting while a job runs; none if the value is None."""
    before = spark.conf.get(name, None)
    if value is not None:
        spark.conf.set(name, value)
    try:
        yield
    finally:
        if value is not None:
            spark.conf.unset(name) if before is None else spark.conf.set(name, before)


#: Marks a version of a table that readers may see. Spark's readers pass over the file.
PUBLISHED = "_PUBLISHED"


def _versions(spark: SparkSession, path: str) -> dict[int, bool]:
    """Versions of a table, and whether each is published. There are a few at most."""
    where, fs = _file_system(spark, path)
    if not fs.exists(where):
        return {}
    names = [status.getPath().getName() for status in fs.listStatus(where)]
    numbers = [int(name.removeprefix("version-")) for name in names if name.startswith("version-")]
    return {n: fs.exists(_file_system(spark, f"{path}/version-{n}/{PUBLISHED}")[0]) for n in numbers}


def next_version(spark: SparkSession, path: str) -> str:
    """A folder for a new version, beside those that readers use."""
    return f"{path}/version-{max(_versions(spark, path), default=0) + 1}"


def publish(spark: SparkSession, path: str) -> None:
    """Readers see the newest version from now on. The one before it stays for those still reading;
    older ones, and any that never passed their checks, are removed."""
    newest = max(_versions(spark, path))
    marker, fs = _file_system(spark, f"{path}/version-{newest}/{PUBLISHED}")
    fs.create(marker, True).close()
    seen = sorted(n for n, is_published in _versions(spark, path).items() if is_published)[-2:]
    for n in _versions(spark, path).keys() - set(seen):
        fs.delete(_file_system(spark, f"{path}/version-{n}")[0], True)


class NotPublished(Exception):
    """A table has no version that passed its checks."""


def published(spark: SparkSession, path: str) -> DataFrame:
    seen = [n for n, is_published in _versions(spark, path).items() if is_published]
    if not seen:
        raise NotPublished(f"no published version of {path}")
    return spark.read.parquet(f"{path}/version-{max(seen)}")


def append(df: DataFrame, path: str, partition_by: Sequence[str], cluster_by: Sequence[str]) -> None:
    """Add rows in one job: its commit publishes all new rows or none."""
    order = [*partition_by, *cluster_by]
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows.write.mode("append").partitionBy(*partition_by).parquet(path)


def write_games(events: DataFrame, path: str) -> None:
    """Publish the shot events of whole games; games already in the table are left out.

    One job commits a batch of games whole. A retry after a failure writes what is missing. Files
    are split by season only: a folder per game would mean millions of tiny files.
    """
    existing = read_table(events.sparkSession, path)
    if existing is not None:
        events = events.join(existing.select("game_id").distinct(), "game_id", "left_anti")
    append(events, path, ["season"], ["game_id", "event_id"])


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions the frame has rows for; each appears by one rename."""
    df.hint("rebalance", *partition_by).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*partition_by).parquet(path)


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """The table, or None if it does not exist yet."""
    try:
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def write_snapshot(df: DataFrame, path: str, version: int) -> None:
    """Add a whole new version of a table that is being read while it is rewritten. The one before
    stays; the one before that goes."""
    spark = df.sparkSession
    overwrite_partitions(df.withColumn("snapshot", F.lit(version)), path, ["snapshot"])
    outdated, fs = _file_system(spark, f"{path}/snapshot={version - 2}")
    fs.delete(outdated, True)


def read_snapshot(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, int]:
    """Newest version of a table and its number; an empty table with number 0 before the first."""
    versions = read_table(spark, path, f"{schema}, snapshot int")
    if versions is None:
        return spark.createDataFrame([], schema), 0
    newest = versions.agg(F.max("snapshot").alias("newest")).first()["newest"]
    return versions.where(F.col("snapshot") == newest).drop("snapshot"), newest
