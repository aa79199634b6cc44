"""A log of the finished steps of a run, so that a rerun starts at the step that failed, and one
pointer that publishes all marts of a run at once.

A step is logged under the run's id with the digest of its inputs (the checks it ran, the mart
versions it published), so a rerun with other inputs does that step again. Entries and pointers are
small JSON files that appear by a rename when complete.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import SparkSession

from shotmarts.sources.tables import NotPublished, _file_system


def _digest(inputs: object) -> str:
    return hashlib.sha256(json.dumps(inputs, sort_keys=True, default=str).encode()).hexdigest()[:16]


class _Files:
    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark

    def read(self, path: str) -> object | None:
        where, fs = _file_system(self.spark, path)
        if not fs.exists(where):
            return None
        stream = fs.open(where)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write(self, path: str, value: object) -> None:
        """Written beside, then renamed into place: readers see the whole file or none."""
        where, fs = _file_system(self.spark, path)
        partial, _ = _file_system(self.spark, f"{path}.partial")
        out = fs.create(partial, True)
        out.write(json.dumps(value, sort_keys=True).encode())
        out.close()
        fs.delete(where, False)
        fs.rename(partial, where)


class RunLog:
    def __init__(self, spark: SparkSession, root: str, run_id: str) -> None:
        self.files = _Files(spark)
        self.folder = f"{root}/_runs/{run_id}"

    def _path(self, step: str, inputs: object) -> str:
        return f"{self.folder}/{step}-{_digest(inputs)}.json"

    def done(self, step: str, inputs: object = None) -> dict | None:
        """What the step recorded when it finished with these inputs, or None."""
        return self.files.read(self._path(step, inputs))

    def finish(self, step: str, inputs: object = None, outcome: dict | None = None) -> None:
        self.files.write(self._path(step, inputs), outcome or {})


class Publication:
    """Numbered pointers ``_published/<n>.json``, each naming a version of every mart; the newest
    one is what readers see. A new pointer appears whole by a rename, so all marts change together."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.files = _Files(spark)
        self.folder = f"{root}/_published"

    def _numbers(self) -> list[int]:
        where, fs = _file_system(self.spark, self.folder)
        if not fs.exists(where):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(where)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())

    def current(self) -> dict[str, str]:
        numbers = self._numbers()
        if not numbers:
            raise NotPublished(f"no marts published under {self.folder}")
        return self.files.read(f"{self.folder}/{numbers[-1]}.json")

    def publish(self, versions: dict[str, str]) -> None:
        """Readers see ``versions`` from now on. Other versions of these marts that neither this
        pointer nor the one before name (older ones, and builds that never passed) are removed."""
        numbers = self._numbers()
        before = self.files.read(f"{self.folder}/{numbers[-1]}.json") if numbers else {}
        self.files.write(f"{self.folder}/{(numbers[-1] if numbers else 0) + 1}.json", versions)
        keep = {*versions.values(), *before.values()}
        for path in versions.values():
            parent, fs = _file_system(self.spark, path.rsplit("/", 1)[0])
            for status in fs.listStatus(parent):
                child = status.getPath()
                if child.getName().startswith("version-") and not any(
                    str(child).rstrip("/").endswith(k.rstrip("/").split("://")[-1]) for k in keep
                ):
                    fs.delete(child, True)
        for n in numbers[:-1]:
            where, fs = _file_system(self.spark, f"{self.folder}/{n}.json")
            fs.delete(where, False)
