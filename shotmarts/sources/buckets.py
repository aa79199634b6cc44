"""A table kept in hash buckets of its key, so that a batch rewrites only the buckets it touches.

Layout: ``<path>/v=<n>/bucket=<b>/`` holds bucket ``b`` as written by version ``n``, and
``<path>/_current`` names, for every bucket, the version that holds it now. A batch writes its
touched buckets as a new version in one job, then replaces ``_current`` by a rename: readers that
took the pointer before see the old buckets, later ones the new, never a mix. Versions that neither
the current nor the previous pointer name are removed, so a reader of the previous one can finish.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shotmarts.sources import increments, tables


class BucketedTable:
    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, buckets: int = 64) -> None:
        self.spark, self.path, self.schema, self.key, self.buckets = spark, path, schema, key, buckets

    def bucket_of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _fs(self, path: str):
        return tables._file_system(self.spark, path)

    def _read_pointer(self, name: str = "_current") -> dict[int, int]:
        where, fs = self._fs(f"{self.path}/{name}")
        if not fs.exists(where):
            return {}
        stream = fs.open(where)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return {int(b): v for b, v in json.loads(text).items()}

    def _write_pointer(self, pointer: dict[int, int]) -> None:
        current, fs = self._fs(f"{self.path}/_current")
        previous, _ = self._fs(f"{self.path}/_previous")
        following, _ = self._fs(f"{self.path}/_next")
        out = fs.create(following, True)
        out.write(json.dumps({str(b): v for b, v in sorted(pointer.items())}).encode())
        out.close()
        if fs.exists(current):
            fs.delete(previous, False)
            fs.rename(current, previous)
        fs.rename(following, current)

    def read(self, only: Sequence[int] | None = None) -> DataFrame:
        """The table as the current pointer names it; ``only`` some buckets of it."""
        pointer = self._read_pointer()
        paths = [
            f"{self.path}/v={v}/bucket={b}" for b, v in sorted(pointer.items()) if only is None or b in only
        ]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def upsert(self, batch: DataFrame, order_by: Sequence[Column], stamp: str | None = None) -> list[int]:
        """Rows of the batch replace those of equal key (the first in ``order_by`` wins); returns the
        buckets rewritten. Stored rows order as if ``stamp`` were NULL for them."""
        touched = sorted(r.b for r in batch.select(self.bucket_of(F.col(self.key)).alias("b")).distinct().collect())
        if not touched:
            return []
        existing = self.read(touched)
        if stamp:
            existing = existing.withColumn(stamp, F.lit(None).cast(batch.schema[stamp].dataType))
        merged = increments.upsert(existing, batch, [self.key], order_by)
        if stamp:
            merged = merged.drop(stamp)
        pointer = self._read_pointer()
        version = max([*pointer.values(), *self._read_pointer("_previous").values(), 0]) + 1
        columns = StructType.fromDDL(self.schema).fieldNames()
        # A version left by a crash before its pointer is named by no pointer: it is overwritten.
        rows = merged.select(*columns, self.bucket_of(F.col(self.key)).alias("bucket")).repartition("bucket")
        rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/v={version}")
        self._write_pointer(pointer | {b: version for b in touched})
        self._clean({*pointer.values(), version})
        return touched

    def _clean(self, keep: set[int]) -> None:
        where, fs = self._fs(self.path)
        for status in fs.listStatus(where):
            name = status.getPath().getName()
            if name.startswith("v=") and int(name.removeprefix("v=")) not in keep:
                fs.delete(status.getPath(), True)
