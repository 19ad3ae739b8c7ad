"""Batches, snapshot overwrite, diff."""

import os

from pyspark.sql import functions as F

from chartwright.operators.playlists import playlist_batches
from chartwright.sources import playlist_store as PS

LIST = "market string, playlist string, position int, _track_uri string"


def _list(spark, market, playlist, n, prefix="u"):
    return spark.createDataFrame([(market, playlist, i, f"{prefix}{i}") for i in range(1, n + 1)], LIST)


def test_batches_sizes(spark):
    for n, sizes in ((0, []), (1, [1]), (100, [100]), (101, [100, 1]), (150, [100, 50])):
        rows = playlist_batches(_list(spark, "M", "L", n), "2024-01-07").orderBy("batch_no").collect()
        assert [r["n_uris"] for r in rows] == sizes
        uris = [u for r in rows for u in r["uris"]]
        assert uris == [f"u{i}" for i in range(1, n + 1)]            # batches concatenate back
        assert [r["send_order"] for r in rows] == list(range(len(rows)))[::-1]  # last batch first
        assert all(r["description"] == "Dane na dzien 2024-01-07" for r in rows)


def test_snapshot_overwrite(spark, tmp_scratch):
    path, manifest = tmp_scratch("pl"), tmp_scratch("mf")
    exp = PS.expected_lists(spark, ["M1", "M2"], ["top", "rap"])
    first = _list(spark, "M1", "top", 5).unionByName(_list(spark, "M1", "rap", 3)) \
        .unionByName(_list(spark, "M2", "top", 4)).unionByName(_list(spark, "M2", "rap", 2))
    PS.write_playlists(first, exp, path, manifest, "2024-01-07")
    # next run: M1 top shrinks, M1 rap becomes empty; M2 is not part of this run
    exp1 = PS.expected_lists(spark, ["M1"], ["top", "rap"])
    mf = PS.write_playlists(_list(spark, "M1", "top", 2, "v"), exp1, path, manifest, "2024-01-08")
    got = {}
    for r in PS.read_playlists(spark, path).orderBy("market", "playlist", "position").collect():
        got.setdefault((r["market"], r["playlist"]), []).append(r["track_uri"])
    assert got == {("M1", "top"): ["v1", "v2"], ("M2", "top"): ["u1", "u2", "u3", "u4"], ("M2", "rap"): ["u1", "u2"]}
    counts = {(r["market"], r["playlist"]): r["n_tracks"] for r in spark.read.parquet(manifest).collect()}
    assert counts == {("M1", "top"): 2, ("M1", "rap"): 0, ("M2", "top"): 4, ("M2", "rap"): 2}
    assert {r["description"] for r in mf.collect()} == {"Dane na dzien 2024-01-08"}


def test_empty_list_can_be_refused(spark, tmp_scratch):
    import pytest

    exp = PS.expected_lists(spark, ["M1"], ["top"])
    empty = _list(spark, "M1", "top", 0)
    with pytest.raises(PS.EmptyPlaylistError):
        PS.write_playlists(empty, exp, tmp_scratch("pl"), tmp_scratch("mf"), "2024-01-07", allow_empty=False)


def test_unexpected_list_is_refused_before_anything_is_written(spark, tmp_scratch):
    import pytest

    exp = PS.expected_lists(spark, ["M1"], ["top"])
    lists = _list(spark, "M1", "top", 2).unionByName(_list(spark, "M1", "extra", 2))
    path, manifest = tmp_scratch("pl"), tmp_scratch("mf")
    with pytest.raises(PS.UnexpectedPlaylistError):
        PS.write_playlists(lists, exp, path, manifest, "2024-01-07")
    assert not os.path.exists(path.removeprefix("file:")) and not os.path.exists(manifest.removeprefix("file:"))


def test_batches_of_a_list_that_becomes_empty_are_gone(spark, tmp_scratch):
    path = tmp_scratch("batches")
    exp = PS.expected_lists(spark, ["M1"], {"M1": ["top", "rap"]})
    both = _list(spark, "M1", "top", 3).unionByName(_list(spark, "M1", "rap", 2))
    for lists, day in ((both, "2024-01-07"), (_list(spark, "M1", "top", 2), "2024-01-08")):
        PS.write_batches(playlist_batches(lists, day), PS.playlist_manifest(lists, exp, day), path)
    (row,) = PS.read_batches(spark, path).collect()
    assert (row["playlist"], row["n_uris"], row["description"]) == ("top", 2, "Dane na dzien 2024-01-08")


def test_diff(spark):
    old = _list(spark, "M", "top", 3).withColumnRenamed("_track_uri", "track_uri")
    new = _list(spark, "M", "top", 4).filter(F.col("position") != 1).withColumnRenamed("_track_uri", "track_uri")
    got = {(r["track_uri"], r["change"]) for r in PS.playlist_diff(old, new).collect()}
    assert got == {("u4", "added"), ("u1", "removed")}


def test_run_daily_all_markets_on_watermarks(spark, tmp_scratch):
    from dataclasses import replace

    import __spark_entry__ as E
    from chartwright.plans.daily import ALL_MARKETS, FIXTURE_PARAMS, ChartJob, run_daily
    from conftest import SF_SMALL

    params = replace(FIXTURE_PARAMS, markets=ALL_MARKETS, day=None, short_video_day=None)
    out = tmp_scratch("daily")
    manifest = run_daily(ChartJob(E.inputs(spark, SF_SMALL), params), out).collect()
    assert len(manifest) == len(ALL_MARKETS) * 6
    wm = {r["market"]: r["watermark"] for r in E.q_load_watermark(spark, SF_SMALL).collect()}
    for r in manifest:
        assert r["as_of"] == wm[r["market"]]
        assert r["description"] == "Dane na dzien " + wm[r["market"]].isoformat()
    lists = PS.published(spark, out)
    per_list = {(r["market"], r["playlist"]): r["count"] for r in lists.groupBy("market", "playlist").count().collect()}
    assert per_list == {(r["market"], r["playlist"]): r["n_tracks"] for r in manifest if r["n_tracks"] > 0}
    batches = PS.published(spark, out, "batches")
    assert batches.agg({"n_uris": "sum"}).collect()[0][0] == sum(r["n_tracks"] for r in manifest)


def test_items_from_json(spark):
    body = '{"items": [{"track": {"uri": "u:1"}}, {"track": {"uri": "u:2"}}]}'
    df = spark.createDataFrame([("M", "top", body)], "market string, playlist string, body string")
    got = [(r["position"], r["track_uri"]) for r in PS.playlist_items_from_json(df).orderBy("position").collect()]
    assert got == [(1, "u:1"), (2, "u:2")]


def test_run_daily_fails_for_market_without_watermark(spark, tmp_scratch):
    from dataclasses import replace

    import pytest

    import __spark_entry__ as E
    from chartwright.plans.daily import FIXTURE_PARAMS, ChartJob, run_daily
    from chartwright.streaming.watermark import WatermarkError
    from conftest import SF_SMALL

    params = replace(FIXTURE_PARAMS, markets=("EUROPE", "NOWHERE"), day=None, short_video_day=None)
    out = tmp_scratch("daily")
    with pytest.raises(WatermarkError):
        run_daily(ChartJob(E.inputs(spark, SF_SMALL), params), out)
    assert not os.path.exists(out.split(":", 1)[-1] + "/commits")   # nothing published
