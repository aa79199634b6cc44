"""Helpers that the text operators share: input tables, stored intermediates, row-wise Python."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that separate words: [\x20\x09-\x0D]. ``bytes.split()`` separates at the same ones.
SPACES = b" \t\n\x0b\x0c\r"

_own_folder: list[str] = []
_shipped: set[str] = set()


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one where it is unset, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not _own_folder:
        _own_folder.append(tempfile.mkdtemp(prefix="corpus-"))
    return _own_folder[0]


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this subpackage, wherever the driver found it."""
    if spark.sparkContext.applicationId in _shipped:
        return
    here = Path(__file__).resolve().parent
    with tempfile.NamedTemporaryFile(prefix="shotmarts-", suffix=".zip", delete=False) as target:
        with zipfile.ZipFile(target, "w") as archive:
            for file in [here.parent / "__init__.py", *here.glob("*.py")]:
                archive.write(file, file.relative_to(here.parent.parent))
    spark.sparkContext.addPyFile(target.name)
    _shipped.add(spark.sparkContext.applicationId)


class Workspace:
    """Tables written to the shared folder, so that lineage ends there and lost tasks re-read files.

    A table can be dropped when nothing reads it any more. What is left goes when the session ends.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.root = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
        path, fs = self._path("")
        fs.deleteOnExit(path)

    def _path(self, name: str):
        jvm, session = self.spark._jvm, self.spark._jsparkSession
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        return path, path.getFileSystem(session.sessionState().newHadoopConf())

    def store(self, df: DataFrame, name: str) -> DataFrame:
        where = f"{self.root}/{name}"
        df.write.option("compression", "zstd").parquet(where)
        return self.spark.read.schema(df.schema).parquet(where)

    def drop(self, *names: str) -> None:
        for name in names:
            path, fs = self._path(name)
            fs.delete(path, True)


def map_rows(
    df: DataFrame, schema: str, work: Callable[[list[dict]], Iterator[tuple]], rows: int = 20_000
) -> DataFrame:
    """Rows that ``work`` yields for the rows of each batch, as tuples in the order of ``schema``.

    Output goes out every ``rows`` rows, so a batch may yield any number of them.
    """

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            out: list[tuple] = []
            for row in work(batch.to_pylist()):
                out.append(row)
                if len(out) >= rows:
                    yield _batch(out, target)
                    out = []
            if out:
                yield _batch(out, target)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = to_arrow_schema(StructType.fromDDL(schema))
    ship(df.sparkSession)
    return df.mapInArrow(batches, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def chunks(
    rows: list[dict], columns: tuple[str, ...] = ("text",), most: int = 8_000_000
) -> Iterator[list[dict]]:
    """Rows in order, so many at a time that their texts hold about ``most`` characters."""
    held: list[dict] = []
    total = 0
    for row in rows:
        held.append(row)
        total += sum(len(row[c] or "") for c in columns)
        if total >= most:
            yield held
            held, total = [], 0
    if held:
        yield held


def whole_text(text: Column | str = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def word_count(text: Column | str = "text") -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; none for NULL."""
    return F.regexp_count(whole_text(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def split_words(text: str) -> list[bytes]:
    """Words as UTF-8. ``bytes.split`` separates at exactly the white space meant here."""
    return text.encode("utf-8", "surrogatepass").split()
