"""Sets of tables that are replaced together (SINK3, SINK4).

A set is a folder of tables.  A publication writes each table to a new folder
of its own, ``<root>/<table>/<publication>``, and nothing else: readers go by
the newest *commit*, a small file that names the folder of every table.  So

* readers see all tables of a publication or none of them;
* there is no moment without a table, and no rename (which copies on object stores);
* a publication that fails or is killed leaves the previous set;
* a publication of some tables keeps the others of the set as they are.

Commits are numbered.  A publisher creates the next number exclusively and, if
another publisher has it, reads that commit and tries the one after, so no
commit is lost.  A commit file that is not complete (its writer died) does not
count.  ``expire`` deletes the folders that only old commits name, and folders
of publications that were given up.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: commits whose tables stay readable after a publication: the new one, and the one that running readers may have open
KEEP = 2
#: a folder that no commit names may belong to a running publication until it is this old
GRACE_HOURS = 24.0


class NotPublishedError(LookupError):
    pass


@dataclass(frozen=True)
class Snapshot:
    """One commit: its number, table name -> {"path", "schema"}, and what the publisher noted."""

    version: int
    tables: Mapping[str, dict]
    notes: Mapping[str, object] = field(default_factory=dict)


class _Files:
    """The few file-system calls a set needs, through the session's Hadoop configuration."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._fs = self.path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, p: str):
        return self._jvm.org.apache.hadoop.fs.Path(p)

    def names(self, folder: str) -> list[tuple[str, bool, int]]:
        """(name, is a folder, modification time in ms) of a folder's entries; none if it is missing."""
        p = self.path(folder)
        if not self._fs.exists(p):
            return []
        return [(s.getPath().getName(), s.isDirectory(), s.getModificationTime()) for s in self._fs.listStatus(p)]

    def read(self, file: str) -> str:
        stream = self._fs.open(self.path(file))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, file: str, text: str) -> bool:
        """Write a new file; False if it exists already."""
        try:
            stream = self._fs.create(self.path(file), False)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName() or self._fs.exists(self.path(file)):
                return False
            raise
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        return True

    def delete(self, path: str) -> None:
        self._fs.delete(self.path(path), True)

    def holds(self, path: str) -> bool:
        return self._fs.exists(self.path(path))


class TableSet:
    """The tables under ``root``; ``commits`` is the folder of the commit files (default: ``<root>/_commits``)."""

    def __init__(self, spark: SparkSession, root: str, commits: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.commits = (commits or f"{self.root}/_commits").rstrip("/")
        self.files = _Files(spark, self.root)

    # --- reading

    def versions(self) -> list[int]:
        """Numbers of the commit files, newest first, complete or not."""
        found = [n.split(".")[0] for n, is_dir, _ in self.files.names(self.commits) if n.endswith(".json") and not is_dir]
        return sorted((int(n) for n in found if n.isdigit()), reverse=True)

    def _file(self, version: int) -> str:
        return f"{self.commits}/{version:020d}.json"

    def at(self, version: int) -> Snapshot | None:
        """A commit; None if its file is missing or not complete."""
        if not self.files.holds(self._file(version)):
            return None
        try:
            said = json.loads(self.files.read(self._file(version)))
        except (ValueError, Py4JJavaError):
            return None
        return Snapshot(version, said["tables"], said.get("notes", {})) if said.get("version") == version else None

    def current(self) -> Snapshot | None:
        """The newest complete commit."""
        return next((s for s in map(self.at, self.versions()) if s), None)

    def table_path(self, name: str, version: int | None = None) -> str:
        snapshot = self.current() if version is None else self.at(version)
        if snapshot is None or name not in snapshot.tables:
            raise NotPublishedError(f"{name or 'table'} is not published under {self.root}" + (f" as of {version}" if version is not None else ""))
        return f"{self.root}/{snapshot.tables[name]['path']}"

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """A table of the newest commit (or of ``version``), with the schema it was written with: an empty table has no file to tell."""
        snapshot = self.current() if version is None else self.at(version)
        path = self.table_path(name, snapshot.version if snapshot else version)
        return self.spark.read.schema(StructType.fromJson(json.loads(snapshot.tables[name]["schema"]))).parquet(path)

    # --- writing

    def begin(self) -> "Publication":
        return Publication(self)

    def expire(self, keep: int = KEEP, grace_hours: float = GRACE_HOURS) -> list[str]:
        """Delete commits but the newest ``keep`` complete ones, and table folders that none of those names:
        at once if an expired commit named them, after ``grace_hours`` if none did.  Returns the deleted folders."""
        numbers = self.versions()
        complete = [s for s in map(self.at, numbers) if s]
        kept, old = complete[:keep], complete[keep:]
        if not kept:
            return []
        live = {t["path"] for s in kept for t in s.tables.values()}
        for n in numbers:
            if n < kept[-1].version:
                self.files.delete(self._file(n))
        gone = {t["path"] for s in old for t in s.tables.values()} - live
        now = dt.datetime.now(dt.timezone.utc).timestamp() * 1000
        tables = {p.rpartition("/")[0] for p in live | gone}
        for folder in tables:
            for name, is_dir, changed in self.files.names(f"{self.root}/{folder}" if folder else self.root):
                path = f"{folder}/{name}" if folder else name
                if is_dir and name.startswith(PREFIX) and path not in live and now - changed > grace_hours * 3600_000:
                    gone.add(path)
        for path in sorted(gone):
            self.files.delete(f"{self.root}/{path}")
        return sorted(gone)


PREFIX = "set-"


class Publication:
    """Tables being written.  Used as a context it deletes what it wrote unless ``commit`` was reached."""

    def __init__(self, tables: TableSet):
        self.set = tables
        self.id = f"{PREFIX}{uuid.uuid4().hex}"
        self._written: dict[str, dict] = {}
        self._begun: set[str] = set()
        self._done = False

    def __enter__(self) -> "Publication":
        return self

    def __exit__(self, *_) -> None:
        if not self._done:
            self.abort()

    def _relative(self, name: str) -> str:
        return f"{name}/{self.id}" if name else self.id

    def path(self, name: str) -> str:
        """The new folder of a table."""
        self._begun.add(name)
        return f"{self.set.root}/{self._relative(name)}"

    def wrote(self, name: str, schema: StructType, **more: object) -> None:
        """``path(name)`` holds the table now, with this schema (partition columns last); ``more`` goes into its entry."""
        self._written[name] = {"path": self._relative(name), "schema": schema.json(), **more}

    def keep(self, name: str, entry: Mapping[str, object]) -> None:
        """The table stays as an earlier commit has it."""
        self._written[name] = dict(entry)

    def write(self, df: DataFrame, name: str, partition_by: Sequence[str] = (), sort_within: Sequence = (), files: int | None = None) -> None:
        """One table in full.  ``partition_by`` for large facts (prunes reads by the key), ``sort_within`` for a
        clustered layout inside each file, ``files`` to cap the file count of a small table."""
        if files:
            df = df.coalesce(files)
        elif partition_by:
            # Group rows of a key into few files without a one-task-per-key
            # shuffle: AQE splits a hot key's partition and merges small ones.
            df = df.hint("rebalance", *partition_by)
        if sort_within:
            df = df.sortWithinPartitions(*sort_within)
        w = df.write
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self.path(name))
        fields = {f.name: f for f in df.schema.fields}
        order = [c for c in fields if c not in partition_by] + list(partition_by)
        self.wrote(name, StructType([fields[c] for c in order]))

    def commit(self, whole: bool = False, notes: Mapping[str, object] | None = None) -> Snapshot:
        """Make the written tables current, in one step.

        Tables of the set that were not written stay, unless the publication is
        the ``whole`` set."""
        for _ in range(1000):
            now = self.set.current()
            tables = dict(self._written) if whole or now is None else {**now.tables, **self._written}
            version = max([*self.set.versions(), 0]) + 1
            text = json.dumps({"version": version, "tables": tables, "notes": dict(notes or {})}, indent=1, sort_keys=True)
            if self.set.files.create(self.set._file(version), text):
                self._done = True
                return Snapshot(version, tables, dict(notes or {}))
        raise OSError(f"no free commit number under {self.set.commits}")

    def abort(self) -> None:
        """Delete what was written; the set stays as it is."""
        for name in self._begun:
            self.set.files.delete(f"{self.set.root}/{self._relative(name)}")
        self._done = True
