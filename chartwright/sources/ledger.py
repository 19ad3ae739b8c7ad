"""Loads that count once, however often they are run.

Layout of a loaded table::

    root/data/load=<load>/...   the rows of one load, Parquet
    root/ledger/<load>          one row: load id, fingerprint, rows; written last

A load writes its rows under its own folder (replacing what a broken run of
the same load left there) and then enters the ledger.  Readers join the rows with the
ledger, so rows of a load that did not finish are not part of the table.  A load
that is in the ledger adds nothing; if its source has changed since, that is an error.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartwright import defaults as D
from chartwright.sources.files import parse_csv

LEDGER = "load string, fingerprint string, n_rows long"
_REPLACEMENT = "�"


class LoadConflictError(RuntimeError):
    """A load id stands for another source already."""


@dataclass(frozen=True)
class Load:
    """What a load did."""

    table: DataFrame   # the whole table after the load
    load: str
    fingerprint: str
    n_rows: int        # rows of this load
    added: bool        # False: it was in the ledger already


def cut_bytes(text: Column, width: int) -> Column:
    """The longest beginning of the text of at most ``width`` UTF-8 bytes that ends between characters."""
    head = F.decode(F.substring(text.cast("binary"), 1, width), "ISO-8859-1")  # a byte a character
    begun = F.length(F.regexp_replace(head, "[\u0080-\u00bf]", ""))  # characters that begin there; the last may not end there
    upto = F.substring(text, F.lit(1), begun)
    return F.when(F.octet_length(upto) <= width, upto).otherwise(F.substring(text, F.lit(1), begun - 1))


def fingerprint(rows: DataFrame) -> tuple[str, int]:
    """A print of the rows whatever their order and files, and their number."""
    h = F.xxhash64(*rows.columns)
    other = F.xxhash64(F.lit("second"), *rows.columns)
    n, x, y, total = rows.agg(
        F.count("*"), F.coalesce(F.bit_xor(h), F.lit(0)), F.coalesce(F.bit_xor(other), F.lit(0)),
        F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))).first()
    return f"{n}:{x & (1 << 64) - 1:016x}:{y & (1 << 64) - 1:016x}:{int(total) & (1 << 64) - 1:016x}", n


def _name(load: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9._-]+", load) or load.startswith((".", "_")):
        raise ValueError(f"a load id is letters, digits, '.', '_' and '-', not {load!r}")
    return load


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """Rows (load, fingerprint, n_rows) of the loads that are part of the table."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/ledger")
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(f"{root}/ledger/*")


def loaded(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The table: the rows of every load of the ledger."""
    done = ledger(spark, root).select("load")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/data")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    shape = T.StructType([*schema.fields, T.StructField("load", T.StringType())])
    rows = spark.read.schema(shape).parquet(f"{root}/data")
    return rows.join(done, "load", "left_semi").select(*schema.fieldNames())  # prunes folders at run time


def load_once(
    spark: SparkSession,
    source: str,
    root: str,
    schema: T.StructType,
    load: str,
    byte_widths: Mapping[str, int] | None = None,
    max_errors: int = D.BULK_LOAD_MAX_ERRORS,
    invalid_char: str = "?",
    multi_line: bool = False,
) -> Load:
    """Append a CSV source to the table under ``root``, once for each load id.

    Bad rows are counted and kept as by ``bulk_load_csv``.  ``byte_widths``:
    the most bytes of a column's texts, which are cut between characters.
    """
    load = _name(load)
    parsed = parse_csv(spark, source, schema, max_errors, None, multi_line)
    columns = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            c = F.translate(c, _REPLACEMENT, invalid_char)
            if byte_widths and f.name in byte_widths:
                c = cut_bytes(c, byte_widths[f.name])
        columns.append(c.alias(f.name))
    clean = parsed.good.select(*columns)
    mark, n = fingerprint(clean)
    known = ledger(spark, root).filter(F.col("load") == load).collect()  # one row, or none
    if known and known[0]["fingerprint"] != mark:
        raise LoadConflictError(f"load {load} was {known[0]['fingerprint']}, its source is now {mark}")
    if not known:
        clean.write.mode("overwrite").parquet(f"{root}/data/load={load}")
        entry = spark.createDataFrame([(load, mark, n)], LEDGER).coalesce(1)
        entry.write.mode("overwrite").parquet(f"{root}/ledger/{load}")
    return Load(loaded(spark, root, schema), load, mark, n, not known)
