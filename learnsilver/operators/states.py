"""Small state files of tables, one per version, on the storage Spark reads.

A state is a JSON object. Its file is written whole under another name and
then renamed, so a reader sees a version or does not. Only the last few
versions are kept. Reading or writing one is no Spark job.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

# Versions that stay readable after newer ones were published.
KEPT_STATES = 5


class Folder:
    """A folder of any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self.root = root.rstrip("/")
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._path(f"{self.root}/{name}")

    def names(self, name: str = "") -> list[str]:
        """The names in a folder, sorted; none where it is not there."""
        at = self._at(name) if name else self._path(self.root)
        if not self._fs.exists(at):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(at))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """A new file; an error if there is one of this name."""
        hidden = self._at(f"{name.rpartition('/')[0]}/_{uuid.uuid4().hex}")
        stream = self._fs.create(hidden, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self._fs.exists(self._at(name)) or not self._fs.rename(hidden, self._at(name)):
            self._fs.delete(hidden, False)
            raise RuntimeError(f"{name} is there already: the table has another writer")

    def remove(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def stamp(self, name: str) -> tuple[int, int, int]:
        """What tells whether a file or folder has changed: time, bytes, number of files."""
        at = self._at(name)
        if not self._fs.exists(at):
            return (0, 0, 0)
        content = self._fs.getContentSummary(at)
        times = [self._fs.getFileStatus(at).getModificationTime()]
        if self._fs.getFileStatus(at).isDirectory():
            times += [status.getModificationTime() for status in self._fs.listStatus(at)]
        return (max(times), content.getLength(), content.getFileCount())


class States:
    """The published states of the tables under a root."""

    def __init__(self, spark: SparkSession, root: str):
        self.folder = Folder(spark, f"{root.rstrip('/')}/_state")

    def tables(self) -> list[str]:
        return self.folder.names()

    def _files(self, table: str) -> list[str]:
        return [name for name in self.folder.names(table) if name.endswith(".json") and name[0] != "_"]

    def latest(self, table: str) -> dict:
        """The newest state; an empty one with version 0 before the first."""
        files = self._files(table)
        return json.loads(self.folder.read(f"{table}/{files[-1]}")) if files else {"version": 0}

    def kept(self, table: str) -> list[dict]:
        return [json.loads(self.folder.read(f"{table}/{name}")) for name in self._files(table)]

    def publish(self, table: str, state: dict) -> None:
        """Make a state the newest, and forget those that are too old."""
        self.folder.write(f"{table}/{state['version']:012d}.json", json.dumps(state))
        for name in self._files(table)[:-KEPT_STATES]:
            self.folder.remove(f"{table}/{name}")
