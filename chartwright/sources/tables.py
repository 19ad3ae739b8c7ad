"""Tables and warehouse queries as DataFrames.

``spark.read.parquet`` / ``spark.table`` is the normal source.  A query
against an external warehouse goes through Spark's JDBC source: with a
numeric ``partition_column`` and bounds, the read is split into
``num_partitions`` range queries run by the executors instead of one cursor
fetching every row into one process.  (Not exercised by the tests: no
database server is started here.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table by name, or a Parquet folder by path."""
    if "/" in name_or_path or ":" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def read_warehouse(
    spark: SparkSession,
    url: str,
    query: str | None = None,
    table: str | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
    **options: str,
) -> DataFrame:
    """Rows of a warehouse table or query (credentials in ``options``)."""
    if (query is None) == (table is None):
        raise ValueError("give exactly one of query or table")
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", fetch_size)
    if partition_column is not None:
        if query is not None:
            raise ValueError("partitioned reads need a table (or a subquery given as table)")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", lower_bound)
            .option("upperBound", upper_bound)
            .option("numPartitions", num_partitions)
        )
    reader = reader.option("query", query) if query is not None else reader.option("dbtable", table)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()


def run_statement(spark: SparkSession, statement: str, **args) -> None:
    """A statement without a result (DDL, INSERT ... SELECT), parameters bound by name."""
    spark.sql(statement, args=args or None)
