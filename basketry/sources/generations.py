"""Tables published together: generations of them, and numbered manifests that say which is current.

A load writes its tables below a folder of their own and then one small manifest. Readers take the
tables that the last manifest names, so they find all old tables or all new ones, whatever happens
while the new ones are written. Older generations stay readable by their version.

    <tables>/_generations/<id>/<table>      the tables of a load
    <tables>/_manifests/<version>.json      one line: the generation and the rows of each table

A manifest is written under another name and renamed to its version, which fails if another load has
taken that version meanwhile.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

GENERATIONS, MANIFESTS, SUFFIX = "_generations", "_manifests", ".json"


@dataclass(frozen=True)
class Manifest:
    """What was published: the version, the folder of the tables, and the rows of each."""

    version: int
    generation: str
    counts: dict[str, int]


class NothingPublished(FileNotFoundError):
    """No version, or not the one that was asked for."""


class Generations:
    """The versions below one folder, on any file system that Spark reads."""

    def __init__(self, spark: SparkSession, tables_dir: str) -> None:
        self.spark, self.folder = spark, tables_dir.rstrip("/")

    def _path(self, *parts: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *parts]))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def location(self, generation: str, table: str) -> str:
        return f"{self.folder}/{GENERATIONS}/{generation}/{table}"

    def begin(self) -> str:
        """The id of a new generation; nothing refers to it until it is published."""
        return uuid.uuid4().hex

    def abandon(self, generation: str) -> None:
        """Remove what was written of a generation that is not published."""
        if any(self.read(version).generation == generation for version in self.versions()):
            raise ValueError(f"generation {generation} is published")
        files, path = self._path(GENERATIONS, generation)
        files.delete(path, True)
        # A folder in which nothing was ever published goes, too.
        for parts in ((GENERATIONS,), ()):
            files, path = self._path(*parts)
            if files.exists(path) and not files.listStatus(path):
                files.delete(path, False)

    def versions(self) -> list[int]:
        """The published versions, ascending."""
        files, path = self._path(MANIFESTS)
        if not files.exists(path):
            return []
        names = [status.getPath().getName() for status in files.listStatus(path)]
        numbers = [name.removesuffix(SUFFIX) for name in names if name.endswith(SUFFIX)]
        return sorted(int(number) for number in numbers if number.isdigit())

    def read(self, version: int | None = None) -> Manifest:
        """A published version, by default the last one."""
        versions = self.versions()
        if not versions or (version is not None and version not in versions):
            wanted = "a version" if version is None else f"version {version}"
            raise NothingPublished(f"{self.folder} holds no {wanted} of the tables")
        version = versions[-1] if version is None else version
        _, path = self._path(MANIFESTS, f"{version:012d}{SUFFIX}")
        [row] = self.spark.read.text(path.toString(), wholetext=True).collect()
        known = json.loads(row.value)
        return Manifest(version, known["generation"], known["rows"])

    def publish(self, generation: str, counts: dict[str, int]) -> Manifest:
        """Make a generation the current one, in one step."""
        versions = self.versions()
        version = versions[-1] + 1 if versions else 1
        files, draft = self._path(MANIFESTS, f".{generation}")
        _, final = self._path(MANIFESTS, f"{version:012d}{SUFFIX}")
        text = json.dumps({"generation": generation, "rows": counts}, sort_keys=True)
        out = files.create(draft, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if files.exists(final) or not files.rename(draft, final):
            files.delete(draft, False)
            raise FileExistsError(f"version {version} was published by another load")
        return Manifest(version, generation, counts)
