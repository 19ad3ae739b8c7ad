"""CSV round trip, tolerant bulk load, file inventory."""

import os

import pytest
from pyspark.sql import types as T

from chartwright.sources import files as FS

SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("n", T.LongType()),
])


def _write(path, data: bytes):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def _local(p):
    return p.split(":", 1)[1] if p.startswith("file:") else p


def test_bulk_load_tolerates_bad_rows(spark, tmp_scratch):
    src = _local(tmp_scratch("csv")) + "/in.csv"
    body = (
        "﻿id,name,n\n"                      # BOM before the header
        "1,short,10\n"
        "x,bad integer,1\n"                     # bad integer -> corrupt
        "3,a very long name indeed,30\n"        # cut to width 6
        "4,only two\n"                          # too few fields -> corrupt
    ).encode("utf-8") + b"5,caf\xe9,50\n"        # invalid UTF-8 byte
    _write(src, body)
    target = tmp_scratch("table")
    load = FS.bulk_load_csv(spark, src, target, SCHEMA, widths={"name": 6}, max_errors=3)
    out = load.table
    rows = sorted(tuple(r) for r in out.collect())
    assert rows == [(1, "short", 10), (3, "a very", 30), (5, "caf?", 50)]
    assert (load.loaded, load.rejected) == (3, 2)
    assert {r["line"] for r in load.rejects.collect()} == {"x,bad integer,1", "4,only two"}
    # appending again adds rows (COPY appends)
    FS.bulk_load_csv(spark, src, target, SCHEMA, widths={"name": 6}, max_errors=3)
    assert spark.read.parquet(target).count() == 6


def test_bulk_load_fails_at_cap(spark, tmp_scratch):
    src = _local(tmp_scratch("csv")) + "/in.csv"
    _write(src, b"id,name,n\n1,a,1\nx,b,2\ny,c,3\n")
    target = tmp_scratch("table")
    with pytest.raises(FS.BulkLoadError):
        FS.bulk_load_csv(spark, src, target, SCHEMA, max_errors=2)     # 2 bad rows: at the cap
    assert not os.path.exists(_local(target))                         # nothing appended
    out = FS.bulk_load_csv(spark, src, target, SCHEMA, max_errors=3)   # below the cap
    assert out.table.count() == 1


VALUES = [
    (1, "Łódź, \"quoted\"", 5), (2, None, None), (3, "", 0), (4, " lead", 1), (5, "trail ", 1), (6, "two\nlines", 1),
    (7, "He said \"hi\", ok", 1), (8, " ", 1), (9, "a,b;c\t", 1), (10, "back\\slash", 1), (11, '"', 1), (12, "cr\r\nlf", 1),
]


def test_csv_roundtrip(spark, tmp_scratch):
    df = spark.createDataFrame(VALUES, SCHEMA)
    path = FS.export_csv(df, tmp_scratch("out"))
    back = FS.read_csv_feed(spark, path, SCHEMA, multi_line=True)
    assert sorted(map(tuple, back.collect())) == sorted(VALUES)


def test_bulk_load_keeps_quotes_and_line_breaks(spark, tmp_scratch):
    src = _local(tmp_scratch("csv")) + "/in.csv"
    _write(src, b'id,name,n\n1,"He said ""hi"", ok",1\n2,"two\nlines",2\n3, padded ,3\n4,"",4\n5,,5\n')
    load = FS.bulk_load_csv(spark, src, tmp_scratch("table"), SCHEMA, multi_line=True)
    rows = sorted(map(tuple, load.table.collect()))
    assert rows == [(1, 'He said "hi", ok', 1), (2, "two\nlines", 2), (3, " padded ", 3), (4, "", 4), (5, None, 5)]
    assert load.rejected == 0


def test_file_inventory(spark, tmp_scratch):
    root = _local(tmp_scratch("tree"))
    _write(f"{root}/top.csv", b"a")
    _write(f"{root}/sub/deeper/x.parquet", b"abc")
    _write(f"{root}/sub/README", b"no dot")
    os.makedirs(f"{root}/empty")
    rows = {(r["path"], r["filename"], r["filesize"], r["is_file"]) for r in FS.file_inventory(spark, root).collect()}
    assert ("", "top.csv", 1, True) in rows
    assert ("/sub/deeper", "x.parquet", 3, True) in rows
    assert ("/sub", "README", None, False) in rows       # no dot: taken for a folder, as in the original
    assert ("", "sub", None, False) in rows and ("/sub", "deeper", None, False) in rows
    assert not any(r[1] == "empty" for r in rows)        # empty folders are not seen
    for form in (f"file:{root}", f"file://{root}", f"{root}/"):
        again = {(r["path"], r["filename"], r["filesize"], r["is_file"]) for r in FS.file_inventory(spark, form).collect()}
        assert again == rows, form
