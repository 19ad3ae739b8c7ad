"""C1-C10 on hand-made rows (FIXTURES.md section 4)."""

import datetime as dt

import pytest

from chartwright.operators import charts as C
from chartwright.streaming.watermark import WatermarkError, load_watermark, resolve_watermark

TRACK_COLS = ("market string, track_isrc string, segment_name string, _track_uri string, _track_artist string, "
              "_track_name string, _primary_genre string, segment_streams long, total_streams long, feed string")


def _tracks(spark, rows):
    full = [(m, i, s, f"uri:{i}:{f}", f"art {i} {f}", f"name {i}", "g", n, t, f) for m, i, s, n, t, f in rows]
    return spark.createDataFrame(full, TRACK_COLS)


def test_segment_shares_edges(spark):
    tracks = _tracks(spark, [
        ("M", "nulls_only", None, 5, 5, "SME"),
        ("M", "zero", "rap", 0, 0, "SME"), ("M", "zero", None, 0, 0, "SME"),
        ("M", "unpinned", "rap", 30, 100, "SME"), ("M", "unpinned", "other", 70, 100, "SME"),
        ("M", "both", "rap", 10, 40, "SME"), ("M", "both", "rap", 10, 40, "ORCHARD"),
        ("M", "both", "edm", 20, 40, "ORCHARD"), ("M", "both", None, 40, 40, "ORCHARD"),
    ])
    got = {r["track_isrc"]: r for r in C.segment_shares(tracks, ["edm", "rap"]).collect()}
    assert got["nulls_only"]["rap"] is None and got["nulls_only"]["edm"] is None
    assert got["nulls_only"]["share_of_none_values"] == 1.0
    assert got["zero"]["rap"] is None and got["zero"]["share_of_none_values"] is None
    assert got["unpinned"]["rap"] == 30.0 and got["unpinned"]["edm"] == 0.0
    assert got["both"]["rap"] == 50.0 and got["both"]["edm"] == 50.0
    assert got["both"]["share_of_none_values"] == 0.5


def test_feed_priority(spark):
    tracks = _tracks(spark, [
        ("M", "X", "rap", 1, 10, "SME"), ("M", "X", "edm", 2, 10, "SME"),
        ("M", "X", "rap", 5, 99, "ORCHARD"),
        ("M", "Y", "rap", 5, 7, "ORCHARD"),
    ])
    got = {r["track_isrc"]: r for r in C.track_metadata(tracks).collect()}
    assert got["X"]["feed"] == "SME" and got["X"]["total_streams"] == 10 and got["X"]["_track_uri"] == "uri:X:SME"
    assert got["Y"]["feed"] == "ORCHARD" and got["Y"]["total_streams"] == 7


FACT = ("partner_info_key long, consumer_key long, num_streams long, report_date date, "
        "country_code_stream string, country_code string, source_type_key int")
DIM = ("partner_info_key long, product_key long, track_isrc string, track_uri string, "
       "track_artists string, track_name string")
D1 = dt.date(2024, 1, 7)


def test_best_cover_ties_nulls_and_fallback(spark):
    dim = spark.createDataFrame([
        (1, 1, "T", "u:b", "a", "n"), (2, 2, "T", "u:a", "a", "n"),     # tie -> smaller URI
        (3, 3, "N", "u:z", "a", "n"), (4, 4, "N", "u:y", "a", "n"),     # NULL sum ranks first
        (5, 5, "O", "u:o", "a", "n"),                                   # no stream in window
    ], DIM)
    fact = spark.createDataFrame([
        (1, 1, 5, D1, "PL", "PL", 487), (2, 1, 5, D1, "PL", "PL", 416),
        (3, 1, None, D1, "PL", "PL", 487), (4, 1, 100, D1, "PL", "PL", 487),
        (5, 1, 100, D1, "PL", "PL", 1),              # source type not counted
        (5, 1, 100, D1, "PL", "CZ", 487),            # other consumer country
        (5, 1, 100, dt.date(2023, 1, 1), "PL", "PL", 487),  # outside the window
    ], FACT)
    covers = {r["track_isrc"]: r["track_uri_fs"] for r in C.best_cover(fact, dim, "2024-01-10").collect()}
    assert covers == {"T": "u:a", "N": "u:z"}
    seg = spark.createDataFrame([("M", "O", None, "u:top", "a", "n", "g", 1, 1)],
                                "market string, track_isrc string, segment_name string, _track_uri string, "
                                "_track_artist string, _track_name string, _primary_genre string, "
                                "segment_streams long, total_streams long")
    (row,) = C.feed_tracks(seg, C.best_cover(fact, dim, "2024-01-10"), "SME").collect()
    assert row["_track_uri"] == "u:top"


def test_top_k_ties_and_null_isrc(spark):
    dim = spark.createDataFrame([
        (1, 1, "B", "u1", "a", "n"), (2, 2, "A", "u2", "a", "n"), (3, 3, None, "u3", "a", "n"),
        (4, 4, "C", "u4", "a", "n"),
    ], DIM)
    fact = spark.createDataFrame([
        (1, 10, 5, D1, "M", "M", 1), (2, 11, 5, D1, "M", "M", 1), (3, 12, 50, D1, "M", "M", 1),
        (4, 13, 1, D1, "M", "M", 1),
    ], FACT)
    top = C.top_tracks(C.track_streams(fact, D1, ["M"]), dim, 3)
    got = [(r["top_rank"], r["track_isrc"]) for r in top.orderBy("top_rank").collect()]
    assert got == [(1, None), (2, "A"), (3, "B")]          # NULL ISRC ranks, tie -> A before B
    segs = spark.createDataFrame([(10, "M", "rap")], "consumer_key long, country_code string, segment_name string")
    seg = C.segment_streams(fact, D1, ["M"], dim, top, segs).collect()
    assert sorted((r["track_isrc"], r["segment_name"]) for r in seg) == [("A", None), ("B", "rap")]


def test_genre_fan_out_counts_twice(spark):
    dim = spark.createDataFrame([(1, 1, "G", "u1", "a", "n")], DIM)
    genre = spark.createDataFrame([(1, "pop"), (1, "rock")], "product_key long, primary_genre string")
    fact = spark.createDataFrame([(1, 10, 5, D1, "M", "M", 1)], FACT)
    (row,) = C.top_tracks(C.track_streams(fact, D1, ["M"]), dim, 10, genre).collect()
    assert row["total_streams"] == 10 and row["_primary_genre"] == "pop"


STATUS = "country_code string, fact_table string, max_report_date date"


def test_watermark(spark):
    status = spark.createDataFrame([
        ("M1", "a", dt.date(2024, 1, 7)), ("M1", "b", dt.date(2024, 1, 5)),   # one table behind
        ("M2", "a", dt.date(2024, 1, 7)),                                      # one table without a row
    ], STATUS)
    wm = {r["market"]: r["watermark"] for r in load_watermark(status, ["a", "b"], ["M1", "M2", "M3"]).collect()}
    assert wm == {"M1": dt.date(2024, 1, 5), "M2": dt.date(2024, 1, 7)}
    strict = {r["market"]: r["watermark"] for r in
              load_watermark(status, ["a", "b"], ["M1", "M2"], strict=True).collect()}
    assert strict == {"M1": dt.date(2024, 1, 5), "M2": None}
    assert resolve_watermark(load_watermark(status, ["a", "b"], ["M1"]), ["M1"]) == {"M1": dt.date(2024, 1, 5)}
    with pytest.raises(WatermarkError):
        resolve_watermark(load_watermark(status, ["a", "b"], ["M3"]), ["M3"])  # no row at all


def test_two_level_top_n_equals_one_level(spark):
    from pyspark.sql import functions as F

    # one hot market with most rows, ties on the value, NULL keys
    rows = [("HOT", f"k{i % 997}" if i % 50 else None, i % 7) for i in range(3000)] + \
           [("COLD", f"c{i}", i) for i in range(20)]
    df = spark.createDataFrame(rows, "market string, key string, v int").groupBy("market", "key").agg(
        F.sum("v").alias("v"))
    order = [F.desc_nulls_last("v"), F.asc_nulls_last("key")]
    for n in (1, 5, 40, 5000):
        one = C.top_n(df, ["market"], order, n, "r").collect()
        two = C.top_n(df, ["market"], order, n, "r", split_by=["key"], buckets=8).collect()
        assert sorted(map(tuple, one), key=repr) == sorted(map(tuple, two), key=repr)
