"""CSV columns bound by header name, file by file, and a report of drift.

Every file of a feed may order its columns differently, lack some or carry
others.  Each file's header is read once (its first record only); files with
one header are scanned together, so a feed costs as many scans as it has
different headers, and no pass over the data just to learn them.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Different headers that a feed may have; each is a scan of its own.
MAX_HEADERS = 200
#: Headers read at a time.
READERS = 8
_BOM = "﻿"


class HeaderError(ValueError):
    """A required column is missing, a column stands twice, or a feed has too many different headers."""


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """One row (``path``) per file with content under ``path`` (a file, a folder or a pattern)."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).filter("length > 0").select("path")


def _escaped(path: str) -> str:
    """The path with the characters of file patterns taken literally."""
    return "".join(f"\\{c}" if c in "{}[]*?\\" else c for c in path)


def file_headers(spark: SparkSession, path: str, reader) -> dict[tuple[str, ...], list[str]]:
    """Files by header.  ``reader()`` makes a CSV reader with a header line; it opens each file for one record."""

    def names(file: str) -> tuple[str, ...]:
        # without a header line, so that equal names are not renamed
        first = reader().option("header", False).option("nullValue", "\u0001").csv(file).first()
        found = tuple("" if v is None else v for v in first) if first else ()
        return (found[0].removeprefix(_BOM), *found[1:]) if found else ()

    files = sorted(_escaped(_from_uri(r["path"])) for r in data_files(spark, path).toLocalIterator())
    by_header: dict[tuple[str, ...], list[str]] = defaultdict(list)
    with ThreadPoolExecutor(READERS) as pool:
        for file, header in zip(files, pool.map(names, files), strict=True):
            by_header[header].append(file)
    if len(by_header) > MAX_HEADERS:
        raise HeaderError(f"{len(by_header)} different headers under {path} (at most {MAX_HEADERS})")
    for header, where in by_header.items():
        twice = sorted({c for c in header if header.count(c) > 1})
        if twice:
            raise HeaderError(f"columns {twice} stand twice in {where[0]}")
    return dict(by_header)


def _from_uri(path: str) -> str:
    """``binaryFile`` reports paths as they are; kept apart so that a change there is met in one place."""
    return path


def _given_by_folder(file: str) -> set[str]:
    """Columns that come from ``name=value`` folders above the file."""
    return {part.split("=", 1)[0] for part in file.split("/")[:-1] if "=" in part}


def bind_by_name(spark: SparkSession, path: str, schema: T.StructType, reader, source_col: str | None = None) -> DataFrame:
    """The feed's rows under ``schema``, each value from the column of that name.

    A missing column is NULL, or an error where the schema does not allow NULL;
    columns that the schema does not name are left out.  ``source_col``
    adds the file that a row comes from.
    """
    by_header = file_headers(spark, path, reader)
    required = [f.name for f in schema.fields if not f.nullable]
    types = {f.name: f.dataType for f in schema.fields}
    scans = []
    for header, files in sorted(by_header.items()):
        gone = [c for c in required if c not in header and c not in _given_by_folder(files[0])]
        if gone:
            raise HeaderError(f"required columns {gone} are missing in {files[0]}")
        own = T.StructType([T.StructField(f"_{i}" if c not in types else c, types.get(c, T.StringType())) for i, c in enumerate(header)])
        options = reader().schema(own).option("enforceSchema", True)
        given = _given_by_folder(files[0]) & set(types)
        rows = (options.option("basePath", path) if given else options).csv(files)
        columns: list[Column] = [F.col(f"`{c}`").cast(t).alias(c) if c in rows.columns else F.lit(None).cast(t).alias(c) for c, t in types.items()]
        if source_col:
            columns.append(F.col("_metadata.file_path").alias(source_col))
        scans.append(rows.select(*columns))
    if not scans:
        return spark.createDataFrame([], T.StructType([*schema.fields, *([T.StructField(source_col, T.StringType())] if source_col else [])]))
    return reduce(DataFrame.unionByName, scans)


def header_drift(spark: SparkSession, path: str, schema: T.StructType, reader) -> DataFrame:
    """Rows (file, column, change, n): how each file departs from ``schema``.

    ``missing``: the schema's column is not there; ``extra``: the schema does
    not name it; ``moved``: not where the schema has it among their common
    columns; ``retyped``: ``n`` values that are no value of the column's type.
    ``n`` is NULL for the others.
    """
    by_header = file_headers(spark, path, reader)
    names = [f.name for f in schema.fields]

    def changes(header: tuple[str, ...]) -> Iterator[tuple[str, str]]:
        yield from ((c, "missing") for c in names if c not in header)
        yield from ((c, "extra") for c in header if c not in names)
        common = [c for c in names if c in header]
        yield from ((c, "moved") for c, d in zip([c for c in header if c in names], common, strict=True) if c != d)

    shape = T.StructType([T.StructField(c, T.StringType()) for c in ("file", "column", "change")] + [T.StructField("n", T.LongType())])
    found = spark.createDataFrame([(_plain(f), c, w, None) for h, files in by_header.items() for f in files for c, w in changes(h)], shape)
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    typed = [f for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    if not typed or not by_header:
        return found
    rows = bind_by_name(spark, path, texts, reader, "_file")
    wrong = [F.count(F.when(F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull(), 1)).alias(f.name) for f in typed]
    per_file = rows.groupBy(F.col("_file").alias("file")).agg(*wrong)
    cells = F.explode(F.array(*[F.struct(F.lit(f.name).alias("column"), F.col(f"`{f.name}`").alias("n")) for f in typed])).alias("c")
    retyped = per_file.select("file", cells).select("file", "c.column", F.lit("retyped").alias("change"), "c.n").filter("n > 0")
    return found.unionByName(retyped)


def _plain(path: str) -> str:
    return path.replace("\\", "")
