"""Several tables published together: versions in one folder, seen as a whole or not at all.

A run writes its tables into a data folder of its own, which nobody reads yet. Its commit is one
small file, ``_versions/<number>``, created where no file of that name may exist, that names the
data folder. Readers take the highest number whose file is complete, and all tables from there,
so they never see tables of two runs, whatever fails or runs at the same time. A run that did
not start from the newest version is refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession


class StaleRun(RuntimeError):
    """Another run was committed since this one began."""


@dataclass(frozen=True)
class Version:
    """A committed version: its tables are folders in ``data``."""

    number: int
    data: str
    facts: Mapping[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class Draft:
    """A run under way, that began at version ``base`` and may become ``number``."""

    base: int
    number: int
    data: str

    def write(self, name: str, df: DataFrame, file_format: str = "parquet") -> None:
        df.write.format(file_format).save(f"{self.data}/{name}")


class VersionedTables:
    """The versions in one folder, of any file system that Spark writes to."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, *parts: str) -> Any:
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *parts]))

    def _files(self) -> Any:
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        """All numbers taken, those of commits that broke off included, ascending."""
        fs, log = self._files(), self._path("_versions")
        if not fs.exists(log):
            return []
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(log) if s.getPath().getName().isdigit())

    def version(self, number: int) -> Version | None:
        """The version of that number; None where there is none or its commit broke off."""
        fs, path = self._files(), self._path("_versions", f"{number:012d}")
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            found = json.loads(text)
        except json.JSONDecodeError:
            return None
        return Version(number, f"{self.folder}/{found['data']}", found["facts"])

    def current(self) -> Version | None:
        for number in reversed(self.numbers()):
            if (found := self.version(number)) is not None:
                return found
        return None

    def begin(self) -> Draft:
        current = self.current()
        taken = self.numbers()
        return Draft(current.number if current else 0, (taken[-1] if taken else 0) + 1, f"{self.folder}/data-{uuid.uuid4().hex}")

    def commit(self, draft: Draft, facts: Mapping[str, Any] | None = None) -> Version:
        """Makes the draft's tables the current ones, or raises ``StaleRun`` and changes nothing."""
        current = self.current()
        if (current.number if current else 0) != draft.base:
            raise StaleRun(f"begun at version {draft.base}, but {current.number if current else 0} is current")
        data = draft.data.rpartition("/")[2]
        text = json.dumps({"data": data, "facts": dict(facts or {})})
        fs, path = self._files(), self._path("_versions", f"{draft.number:012d}")
        try:
            stream = fs.create(path, False)
        except Py4JError as error:
            if not fs.exists(path):
                raise
            raise StaleRun(f"version {draft.number} was committed by another run") from error
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        return Version(draft.number, draft.data, dict(facts or {}))

    def read(self, *names: str, number: int | None = None) -> dict[str, DataFrame]:
        """Tables of one version, by default of the current one."""
        found = self.current() if number is None else self.version(number)
        if found is None:
            raise LookupError(f"no version {'yet' if number is None else number} in {self.folder}")
        return {name: self.spark.read.parquet(f"{found.data}/{name}") for name in names}

    def expire(self, keep: int = 2) -> list[int]:
        """Removes the data of all but the newest ``keep`` versions; their numbers stay taken.
        Data folders that no version names belong to runs under way or failed, and are left."""
        versions = [v for v in map(self.version, self.numbers()) if v is not None]
        gone = versions[:-keep] if keep else versions[:-1]
        for version in gone:
            self._files().delete(self.spark._jvm.org.apache.hadoop.fs.Path(version.data), True)
        return [v.number for v in gone]
