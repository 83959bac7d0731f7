"""Zip archives as a source of Spark: ``spark.read.format("zip_members")`` and ``spark.readStream``.

Options: ``path`` (a folder of archives), ``suffix`` of the members that become rows (".json"), and
``members`` (500), how many of one archive a task reads. A row is archive, member, text.
"""

from __future__ import annotations

import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "archive string, member string, text string"


def _opened(uri: str):
    """The file system of a place that pyarrow reaches, and the path there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}" if uri.startswith("/") else uri.replace("file:/", "file:///", 1))


def archives(folder: str) -> list[tuple[int, str]]:
    """(time of its last change in microseconds, URI) of each archive of a folder, oldest first."""
    from pyarrow import fs

    system, where = _opened(folder)
    root = folder.removesuffix(where).rstrip("/") if folder.endswith(where) else ""
    found = system.get_file_info(fs.FileSelector(where, allow_not_found=True))
    return sorted((int(x.mtime_ns // 1000), f"{root}{x.path}" if root else f"file://{x.path}") for x in found if x.extension == "zip")


@dataclass
class Members(InputPartition):
    """A range of the members of an archive, in the order of its directory."""

    archive: str
    first: int
    last: int


class _Reading:
    def __init__(self, options: dict):
        self.folder, self.suffix, self.members = options["path"], options.get("suffix", ".json"), int(options.get("members", 500))

    def _names(self, z: zipfile.ZipFile) -> list[str]:
        return [x for x in z.namelist() if x.endswith(self.suffix)]

    def _parts(self, found: list[str]) -> list[Members]:
        parts = []
        for archive in found:
            system, where = _opened(archive)
            with zipfile.ZipFile(system.open_input_file(where)) as z:
                n = len(self._names(z))
            parts += [Members(archive, k, min(k + self.members, n)) for k in range(0, n, self.members)]
        return parts

    def read(self, partition: Members | None) -> Iterator[tuple[str, str, str]]:
        """One member after the other; neither the archive nor its members are ever whole in memory together."""
        if partition is None:  # what Spark reads where there are no parts
            return
        system, where = _opened(partition.archive)
        with zipfile.ZipFile(system.open_input_file(where)) as z:
            for name in self._names(z)[partition.first : partition.last]:
                yield partition.archive, name, z.read(name).decode("utf-8", "replace")


class MembersReader(_Reading, DataSourceReader):
    def partitions(self) -> list[Members]:
        return self._parts([uri for _, uri in archives(self.folder)])


class MembersStream(_Reading, DataSourceStreamReader):
    """Archives as they come: an offset is the time of the newest archive that has been read and the names of that time."""

    def initialOffset(self) -> dict:
        return {"time": -1, "names": []}

    def latestOffset(self) -> dict:
        found = archives(self.folder)
        newest = max((t for t, _ in found), default=-1)
        return {"time": newest, "names": [uri for t, uri in found if t == newest]}

    def partitions(self, start: dict, end: dict) -> list[Members]:
        fresh = lambda t, uri: t > start["time"] or t == start["time"] and uri not in start["names"]
        within = lambda t, uri: t < end["time"] or t == end["time"] and uri in end["names"]
        return self._parts([uri for t, uri in archives(self.folder) if fresh(t, uri) and within(t, uri)])

    def commit(self, end: dict) -> None:
        """Nothing is held for what has been read."""


class ZipMembers(DataSource):
    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> MembersReader:  # noqa: ANN001
        return MembersReader(self.options)

    def streamReader(self, schema) -> MembersStream:  # noqa: ANN001, N802
        return MembersStream(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ZipMembers)
