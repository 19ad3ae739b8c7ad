"""File sources and sinks: CSV feeds, CSV export, tolerant bulk load, file
inventory (C22-C24).

Transport (FTP, SFTP, object-store clients) is not code here: any path a
Hadoop filesystem can read (``file:``, ``hdfs:``, ``s3a:``, ...) works, with
credentials in the Spark configuration.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartwright import defaults as D
from chartwright.plans.session import scratch_path
from chartwright.sources.headers import bind_by_name, header_drift

CORRUPT = "_corrupt_record"

# What the reader takes an unquoted empty field for.  With a mark of its own,
# a quoted empty field (``""``) stays an empty string and an unquoted one is NULL.
_NULL_FIELD = "\u0001NULL\u0001"


class BulkLoadError(RuntimeError):
    """Too many rows could not be parsed."""


def _reader(spark: SparkSession, multi_line: bool):
    """CSV as it is usually written: a quote inside a value is doubled, white space
    belongs to the value.  ``multi_line`` allows line breaks inside quotes; a file
    is then read by one task, so it is for files of moderate size."""
    return (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("nullValue", _NULL_FIELD)
        .option("emptyValue", "")
        .option("multiLine", multi_line)
    )


def read_csv_feed(spark: SparkSession, path: str, schema: T.StructType | None = None,
                  infer_schema: bool = False, multi_line: bool = False) -> DataFrame:
    """CSV with a header line.  A typed schema is the normal form;
    type inference (an extra pass over the data) only on request.  Unlike
    the original, a bad file raises instead of returning nothing.

    With a schema, columns are bound by name, file by file
    (``headers.bind_by_name``): their order does not matter, further columns are
    left out, a missing one is NULL, or an error if the schema's field is not
    nullable.  An unquoted empty field is NULL, a quoted one (``""``) the empty
    string.
    """
    reader = _reader(spark, multi_line).option("mode", "FAILFAST")
    if schema is not None:
        return bind_by_name(spark, path, schema, lambda: _reader(spark, multi_line).option("mode", "FAILFAST"))
    if infer_schema:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def csv_drift(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """How each file of a feed departs from ``schema`` (see ``headers.header_drift``)."""
    return header_drift(spark, path, schema, lambda: _reader(spark, multi_line))


def export_csv(df: DataFrame, path: str, single_file: bool = False, partition_by: Sequence[str] = ()) -> str:
    """Replace ``path`` with a header CSV (a folder of parts).

    Values come back as they were from ``read_csv_feed`` (with ``multi_line``
    where a value holds a line break): quotes are doubled, white space is kept,
    NULL is an empty field and the empty string a quoted one.
    ``single_file`` coalesces to one part, which funnels all rows through one
    task: only for small outputs.  No byte-order mark is written.
    """
    out = df.coalesce(1) if single_file else df
    writer = (
        out.write.mode("overwrite").option("header", True).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .option("nullValue", "").option("emptyValue", '""')
    )
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)
    return path


@dataclass(frozen=True)
class BulkLoad:
    """What a bulk load did."""

    table: DataFrame     # the target after the load
    loaded: int          # rows appended
    rejected: int        # rows that could not be parsed
    rejects: DataFrame   # their raw lines (``line``)


def bulk_load_csv(
    spark: SparkSession,
    source: str,
    target: str,
    schema: T.StructType,
    widths: Mapping[str, int] | None = None,
    max_errors: int = D.BULK_LOAD_MAX_ERRORS,
    invalid_char: str = "?",
    rejects: str | None = None,
    multi_line: bool = False,
) -> BulkLoad:
    """Append a CSV file to a table, tolerating bad input.

    * skip the header line (a BOM before it is ignored by the reader);
    * rows that do not parse (bad number, too few or too many fields) go, as
      raw lines, to the ``rejects`` table (default: beside the stage); when
      their number reaches ``max_errors`` the load fails and nothing is appended;
    * strings longer than their column width are cut to it;
    * invalid UTF-8 bytes become ``invalid_char``.

    One pass over the CSV: rows are parsed once into a staging table in the
    shared scratch folder, the error count is read from it, and only then is
    the target appended, so a failed load leaves the target untouched and
    a lost executor re-reads only its own split.
    """
    parsed = parse_csv(spark, source, schema, max_errors, rejects, multi_line)
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            c = F.translate(c, "\ufffd", invalid_char)
            if widths and f.name in widths:
                c = F.substring(c, 1, widths[f.name])
        cols.append(c.alias(f.name))
    parsed.good.select(*cols).write.mode("append").parquet(target)
    return BulkLoad(spark.read.parquet(target), parsed.loaded, parsed.rejected, spark.read.parquet(parsed.rejects))


@dataclass(frozen=True)
class Parsed:
    """A CSV source, parsed once into a stage."""

    good: DataFrame   # rows that parse
    loaded: int
    rejected: int
    rejects: str      # table of the raw lines (``line``) of the others


def parse_csv(spark: SparkSession, source: str, schema: T.StructType, max_errors: int, rejects: str | None, multi_line: bool) -> Parsed:
    """One pass over a CSV source into the shared scratch folder; fails when ``max_errors`` rows do not parse."""
    staged_path = scratch_path(spark, "bulk-load")
    rejects = rejects or scratch_path(spark, "bulk-load-rejects")
    read_schema = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)])
    raw = (
        _reader(spark, multi_line)
        .schema(read_schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("enforceSchema", True)
        .csv(source)
    )
    # Reference every column so the parser checks all of them.
    raw.select(*[F.col(f.name) for f in read_schema.fields]).write.parquet(staged_path)
    staged = spark.read.parquet(staged_path)
    good, bad = staged.agg(F.count(F.when(F.col(CORRUPT).isNull(), 1)), F.count(CORRUPT)).first()
    staged.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("line")).write.mode("append").parquet(rejects)
    if bad >= max_errors:
        raise BulkLoadError(f"{bad} rows could not be parsed (limit {max_errors}); their lines are in {rejects}")
    return Parsed(staged.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), good, bad, rejects)


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme and authority, as file sources report it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(hadoop).toString().rstrip("/")


def file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Recursive listing of ``root``.

    Rows: ``path`` (folder, relative to ``root``), ``filename``, ``filesize``,
    ``modified_at`` and ``is_file``.  Files come from the ``binaryFile``
    source with the ``content`` column pruned (no file is read); folders are
    the distinct parent paths of the files, with NULL size and time (empty
    folders are not seen).  As in the original, a name is a "file" when it
    contains a dot; any other entry gets NULL size and time.  Names that start
    with ``_`` or ``.`` are not listed: Spark's sources take them for hidden.
    ``root`` may have any scheme or none.
    """
    base = _qualified(spark, root)
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(base)
        .select("path", "length", "modificationTime")
    )
    rel = F.substring(F.col("path"), len(base) + 1, 1 << 30)
    entries = files.select(
        F.regexp_extract(rel, r"^(.*)/[^/]*$", 1).alias("path"),
        F.regexp_extract(rel, r"([^/]*)$", 1).alias("filename"),
        F.col("length").alias("filesize"),
        F.col("modificationTime").alias("modified_at"),
    )
    # Every folder on the way from the root to a file: parent paths split
    # into their prefixes, one row per (parent, name).
    parts = F.split(F.regexp_replace(F.col("path"), r"^/", ""), "/")
    folders = (
        entries.filter(F.col("path") != "")
        .select(F.posexplode(parts).alias("i", "name"), parts.alias("parts"))
        .select(
            F.concat(F.lit("/"), F.array_join(F.slice("parts", 1, F.col("i")), "/")).alias("parent"),
            F.col("name"),
        )
        .distinct()
        .select(
            F.regexp_replace(F.col("parent"), r"^/$", "").alias("path"),
            F.col("name").alias("filename"),
            F.lit(None).cast("bigint").alias("filesize"),
            F.lit(None).cast("timestamp").alias("modified_at"),
        )
    )
    is_file = F.col("filename").contains(".")
    return entries.unionByName(folders).select(
        "path", "filename",
        F.when(is_file, F.col("filesize")).alias("filesize"),
        F.when(is_file, F.col("modified_at")).alias("modified_at"),
        is_file.alias("is_file"),
    )
