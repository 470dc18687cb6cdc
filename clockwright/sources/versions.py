"""Tables as immutable versions under a folder, the newest named by a small manifest.

A table folder holds one data folder per version and ``_manifests`` with one file
per version, named by its number.  A version exists once its manifest does, and a
manifest is only ever created, never changed: of two writers that started from
the same version, one creates the next number and the other fails.  Data is never
moved.  A reader resolves the newest manifest once and stays with that version's
files, which are kept until ``KEEP`` newer versions exist.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import SparkSession

from clockwright.errors import LoadError

_MANIFESTS = "_manifests"
#: versions that stay readable: the newest, and older ones that readers may still be pinned to
KEEP = 3


@dataclass(frozen=True)
class Manifest:
    """One version: its number, where its files are (relative to the table), its rows, its columns as JSON types,
    and further data folders that belong to it."""

    version: int
    data: str
    rows: int
    schema: dict | None = None
    parts: tuple[str, ...] = ()


class Storage:
    """File-system calls on a table folder, whatever storage it is on."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self._fs = self._at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._local = self._fs.getScheme() == "file"

    def _at(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        at = self._at(folder)
        if not self._fs.exists(at):
            return []
        return [status.getPath().getName() for status in self._fs.listStatus(at)]

    def drop(self, path: str) -> None:
        self._fs.delete(self._at(path), True)

    def make(self, folder: str) -> None:
        self._fs.mkdirs(self._at(folder))

    def read(self, path: str) -> str:
        stream = self._fs.open(self._at(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Create a file that must not exist yet; False if it does."""
        if self._local:
            # Hadoop's local file system looks first and creates then; the operating system does both at once
            plain = self._at(path).toUri().getPath()
            try:
                handle = os.open(plain, os.O_WRONLY | os.O_CREAT | os.O_EXCL, 0o644)
            except FileExistsError:
                return False
            with os.fdopen(handle, "w") as out:
                out.write(text)
            return True
        try:
            stream = self._fs.create(self._at(path), False)
            stream.write(bytearray(text.encode()))
            stream.close()
        except Exception:
            if self._fs.exists(self._at(path)):
                return False
            raise
        return True


def _numbers(storage: Storage, path: str) -> list[int]:
    names = storage.names(f"{path}/{_MANIFESTS}")
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def _manifest(storage: Storage, path: str, number: int) -> Manifest | None:
    try:
        fields = json.loads(storage.read(f"{path}/{_MANIFESTS}/{number:020d}.json"))
        return Manifest(**fields | {"parts": tuple(fields["parts"])})
    except ValueError:
        return None         # being written, or given up by its writer


def newest(spark: SparkSession, path: str) -> Manifest | None:
    """The newest whole version; None if the folder holds no versions."""
    path = path.rstrip("/")
    storage = Storage(spark, path)
    for number in reversed(_numbers(storage, path)):
        found = _manifest(storage, path, number)
        if found is not None:
            return found
    return None


def location(path: str, manifest: Manifest) -> str:
    return f"{path.rstrip('/')}/{manifest.data}"


class Draft:
    """The next version of a table, from the version that is newest when the draft is made."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = path.rstrip("/")
        self._storage = Storage(spark, self._path)
        numbers = _numbers(self._storage, self._path)
        self._number = (numbers[-1] if numbers else 0) + 1
        whole = newest(spark, self._path)
        self._before = whole.version if whole else 0
        self.name = f"data-{uuid.uuid4().hex}"
        self.data = f"{self._path}/{self.name}"
        self._storage.make(f"{self._path}/{_MANIFESTS}")

    def commit(self, rows: int, schema: dict | None = None, *, data: str | None = None, parts: list[str] | None = None,
               after: int | None = None) -> Manifest:
        """Make the version the newest; an error if another writer was first.

        ``data`` names files elsewhere, ``parts`` further folders; with ``after``
        the version before has to be that one.
        """
        if after is not None and self._before != after:
            raise LoadError(f"{self._path}: version {self._before} was written by someone else meanwhile")
        manifest = Manifest(self._number, data or self.name, rows, schema, tuple(parts or ()))
        if not self._storage.create(f"{self._path}/{_MANIFESTS}/{self._number:020d}.json", json.dumps(asdict(manifest))):
            raise LoadError(f"{self._path}: version {self._number} was written by someone else meanwhile")
        self._expire()
        return manifest

    def abandon(self) -> None:
        self._storage.drop(self.data)

    def _expire(self) -> None:
        """Drop versions that are older than the ``KEEP`` newest, and the data that no kept one names."""
        numbers = _numbers(self._storage, self._path)
        kept = [_manifest(self._storage, self._path, n) for n in numbers[-KEEP:]]
        needed = {folder for m in kept if m for folder in (m.data, *m.parts)}
        for number in numbers[:-KEEP]:
            old = _manifest(self._storage, self._path, number)
            for folder in {old.data, *old.parts} - needed if old else ():
                self._storage.drop(f"{self._path}/{folder}")
            self._storage.drop(f"{self._path}/{_MANIFESTS}/{number:020d}.json")
