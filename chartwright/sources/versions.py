"""Tables published together, replaced as one.

Layout of a store::

    root/versions/<version>/<table>/...   Parquet, written once, never changed
    root/commits/<number>                 one small file a version, renamed into place

A version's tables are written first; the commit is the last step and one
rename, so a run that breaks anywhere before it leaves the last commit, and the
tables it names, as they were.  Commits are numbered; a rename never replaces an
existing file, so of two runs that publish at once the second one fails.
Readers take the newest commit and keep reading its version, whatever is
published meanwhile, until it expires.

Renames are atomic on HDFS and local file systems.  On object stores without
atomic rename, put ``root/commits`` on one that has it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from chartwright.plans.session import remove


class PublishConflictError(RuntimeError):
    """Another run committed first."""


@dataclass(frozen=True)
class Commit:
    """One published version."""

    number: int
    version: str
    tables: tuple[str, ...]


class VersionStore:
    """Versions of a set of tables under one folder of any Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(self.root).getFileSystem(self._conf)

    # -- commits -----------------------------------------------------------
    def _folder(self) -> str:
        return f"{self.root}/commits"

    def commits(self) -> list[Commit]:
        """All commits that have not expired, oldest first."""
        folder = self._path(self._folder())
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return [self._read(int(n)) for n in sorted(names) if n.isdigit()]

    def _read(self, number: int) -> Commit:
        jvm = self.spark.sparkContext._jvm
        stream = self._fs.open(self._path(f"{self._folder()}/{number:012d}"))
        try:
            record = json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Commit(number, record["version"], tuple(record["tables"]))

    def current(self) -> Commit | None:
        """The newest commit."""
        folder = self._path(self._folder())
        if not self._fs.exists(folder):
            return None
        names = sorted(s.getPath().getName() for s in self._fs.listStatus(folder))
        numbers = [int(n) for n in names if n.isdigit()]
        return self._read(numbers[-1]) if numbers else None

    # -- tables ------------------------------------------------------------
    def path(self, version: str, table: str) -> str:
        return f"{self.root}/versions/{version}/{table}"

    def read(self, table: str, commit: Commit | None = None) -> DataFrame:
        """A table of a commit (the newest unless given)."""
        commit = commit or self.current()
        if commit is None or table not in commit.tables:
            raise FileNotFoundError(f"no {table} is published under {self.root}")
        return self.spark.read.parquet(self.path(commit.version, table))

    def write(self, table: str, rows: DataFrame, version: str, partition_by: tuple[str, ...] = ()) -> None:
        writer = rows.write.mode("errorifexists")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(self.path(version, table))

    def commit(self, version: str, tables: tuple[str, ...], after: Commit | None) -> Commit:
        """Make the version current; ``after`` is the commit that it was built on."""
        number = after.number + 1 if after else 1
        name = f"{self._folder()}/{number:012d}"
        draft = self._path(f"{self._folder()}/.draft-{version}")
        out = self._fs.create(draft, True)
        try:
            out.write(bytearray(json.dumps({"version": version, "tables": list(tables)}).encode()))
        finally:
            out.close()
        jvm = self.spark.sparkContext._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(self.root).getFileSystem(self._conf).getUri(), self._conf)
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(draft, self._path(name), options)
        except Exception as error:
            self._fs.delete(draft, False)
            if self._fs.exists(self._path(name)):
                raise PublishConflictError(f"{name} is there already") from error
            raise
        return Commit(number, version, tables)

    def publish(self, tables: Mapping[str, DataFrame], partition_by: Mapping[str, tuple[str, ...]] | None = None,
                after: Commit | None = None) -> Commit:
        """Write the tables as a new version and commit it (on top of ``after``, or of the newest commit)."""
        after = after or self.current()
        version = uuid.uuid4().hex
        for name, rows in tables.items():
            self.write(name, rows, version, (partition_by or {}).get(name, ()))
        return self.commit(version, tuple(tables), after)

    def expire(self, keep: int = 2) -> list[str]:
        """Remove all but the newest ``keep`` commits, and versions that no commit names."""
        if keep < 1:
            raise ValueError("keep at least the current version")
        old = self.commits()[:-keep]
        for commit in old:  # first the record, then what it names
            remove(self.spark, f"{self._folder()}/{commit.number:012d}")
        named = {c.version for c in self.commits()}
        folder = self._path(f"{self.root}/versions")
        found = [s.getPath().getName() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        gone = [v for v in found if v not in named]
        for version in gone:
            remove(self.spark, f"{self.root}/versions/{version}")
        return gone
