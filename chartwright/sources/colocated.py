"""Facts and segments stored by the same hash of the consumer, joined where they lie.

A bucketed table is written once and read every day: the daily join of the
facts with the segments, and the sum per consumer below it, then need no shuffle of
either.  Bucket files are named in the catalog, so such a table has a
name there; its files lie under a path of the caller's.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Of the facts and of the segments alike.
CONSUMER_KEY = ("consumer_key", "country_code")


def store_by_key(rows: DataFrame, table: str, path: str, buckets: int, key: Sequence[str] = CONSUMER_KEY,
                 partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``rows`` under ``path`` as table ``table``, bucketed and sorted by ``key``; read it back.

    Rows are dealt by the key first, so each bucket is one file (of each partition) instead of one a task.
    """
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", table):
        raise ValueError(f"not a table name: {table!r}")
    writer = rows.repartition(buckets, *key).write.mode("errorifexists").format("parquet").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.bucketBy(buckets, *key).sortBy(*key).saveAsTable(table)
    return rows.sparkSession.table(table)


def bucket_files(table: DataFrame) -> DataFrame:
    """Files and rows of each bucket, for a look at how evenly the key deals the rows."""
    name = F.regexp_extract(F.col("_metadata.file_name"), r"_(\d+)(?:\.c\d+)?\.", 1).cast("int")
    return table.select(name.alias("bucket"), F.col("_metadata.file_path").alias("_file")).groupBy("bucket").agg(
        F.countDistinct("_file").alias("files"), F.count("*").alias("n_rows"))
