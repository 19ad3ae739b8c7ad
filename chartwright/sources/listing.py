"""A whole inventory, level by level, by the tasks that reach the folder.

``file_inventory`` asks Spark's file sources, which skip empty folders and
names that begin with ``_`` or ``.``.  Here every folder of a level is one partition of a
Python data source, listed by the task itself; its folders are the next level.
The driver holds the folders of one level (paths only), never the files.
The folder must be mounted on every machine (local disk in tests, NFS and the like).
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from datetime import datetime, timezone
from functools import reduce
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from chartwright.plans.session import materialize

#: Folders that one scan lists; a level of more is several scans.
FOLDERS = 10_000
ENTRIES = "folder string, name string, is_folder boolean, size long, modified_at timestamp"


class _Folder(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, folders: list[str]):
        self.folders = folders

    def partitions(self) -> list[InputPartition]:
        return [_Folder(f) for f in self.folders]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        with os.scandir(partition.path) as entries:
            for entry in entries:
                stat = entry.stat(follow_symlinks=False)
                folder = entry.is_dir(follow_symlinks=False)
                at = datetime.fromtimestamp(stat.st_mtime, timezone.utc)
                yield partition.path, entry.name, folder, None if folder else stat.st_size, at


class FolderListing(DataSource):
    """Entries of the folders in option ``folders`` (a JSON list), a partition each."""

    @classmethod
    def name(cls) -> str:
        return "folder_listing"

    def schema(self) -> str:
        return ENTRIES

    def reader(self, schema) -> DataSourceReader:
        return _Reader(json.loads(self.options["folders"]))


def _mounted(path: str) -> str:
    parts = urlparse(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"{path} is not mounted; file_inventory lists it through Spark's file sources")
    return unquote(parts.path) if parts.scheme else path


def whole_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Rows (path, filename, filesize, modified_at, is_file) of everything below ``root``, hidden names and empty folders too.

    ``path``: the folder, relative to ``root`` (empty for ``root`` itself).  ``is_file``
    is what the file system says; a folder has no size.  Links are listed, not followed.
    """
    base = os.path.abspath(_mounted(root))
    spark.dataSource.register(FolderListing)
    level, found = [base], []
    while level:
        scans = []
        for at in range(0, len(level), FOLDERS):
            listed = spark.read.format("folder_listing").option("folders", json.dumps(level[at : at + FOLDERS])).load()
            scans.append(materialize(listed, "level"))
        found += scans
        level = [
            os.path.join(r["folder"], r["name"])
            for scan in scans for r in scan.filter("is_folder").select("folder", "name").toLocalIterator()]
    rows = reduce(DataFrame.unionByName, found)
    return rows.select(
        F.expr(f"substring(folder, {len(base) + 1})").alias("path"), F.col("name").alias("filename"), F.col("size").alias("filesize"),
        "modified_at", (~F.col("is_folder")).alias("is_file"))
