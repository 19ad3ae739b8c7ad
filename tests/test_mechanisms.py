"""Headers by name, edit scripts, paged lists, versions, loads that count once, rolling windows, co-located joins, found columns."""

from __future__ import annotations

import itertools
import json
import os
import random
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartwright.operators import charts as C
from chartwright.operators import edits as ED
from chartwright.operators.playlists import playlist_batches
from chartwright.sources import colocated as CO
from chartwright.sources import files as FS
from chartwright.sources import headers as HD
from chartwright.sources import ledger as LD
from chartwright.sources import playlist_store as PS
from chartwright.sources.versions import PublishConflictError, VersionStore
from chartwright.streaming.rolling import CoverWindow, WindowStateError

LIST = "market string, playlist string, position int, track_uri string"
SCHEMA = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("artist", T.StringType()), T.StructField("name", T.StringType())])


def local(path):
    return path.split(":", 1)[1] if path.startswith("file:") else path


def folder(tmp_scratch, files):
    root = local(tmp_scratch("csv"))
    for name, body in files.items():
        os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
        with open(f"{root}/{name}", "wb") as f:
            f.write(body.encode() if isinstance(body, str) else body)
    return root


# -- headers -----------------------------------------------------------------
def test_columns_are_bound_by_name(spark, tmp_scratch):
    root = folder(tmp_scratch, {
        "a.csv": "id,artist,name\n1,Singer,Song\n",
        "b.csv": "﻿name,id,artist\nSong,2,Singer\n",
        "sub/c.csv": 'extra,name,id\nx,"So,ng",3\n',
        "d.csv": "id,name,artist\n",
        "e [1].csv": "artist,id\nSinger,5\n",
        "empty.csv": "",
    })
    got = sorted(tuple(r) for r in FS.read_csv_feed(spark, root, SCHEMA).collect())
    assert got == [(1, "Singer", "Song"), (2, "Singer", "Song"), (3, None, "So,ng"), (5, "Singer", None)]


def test_header_faults(spark, tmp_scratch):
    with pytest.raises(HD.HeaderError, match="required columns \\['id'\\]"):
        FS.read_csv_feed(spark, folder(tmp_scratch, {"a.csv": "id,name\n1,x\n", "b.csv": "name\nx\n"}), SCHEMA)
    with pytest.raises(HD.HeaderError, match="twice"):
        FS.read_csv_feed(spark, folder(tmp_scratch, {"a.csv": "id,name,name\n1,x,y\n"}), SCHEMA)
    bad = FS.read_csv_feed(spark, folder(tmp_scratch, {"a.csv": "name,id\nx,none\n"}), SCHEMA)
    with pytest.raises(Exception, match="MALFORMED"):
        bad.collect()


def test_drift_report(spark, tmp_scratch):
    root = folder(tmp_scratch, {
        "good.csv": "id,artist,name\n1,a,b\n", "turned.csv": "artist,id,name\na,1,b\n",
        "odd.csv": "id,name,more\nx,b,c\n2,b,c\n,b,c\ny,b,c\n"})
    got = {(r["file"].rsplit("/", 1)[1], r["column"], r["change"], r["n"]) for r in FS.csv_drift(spark, root, SCHEMA).collect()}
    assert got == {
        ("turned.csv", "artist", "moved", None), ("turned.csv", "id", "moved", None), ("odd.csv", "artist", "missing", None),
        ("odd.csv", "more", "extra", None), ("odd.csv", "id", "retyped", 2)}


# -- edit scripts --------------------------------------------------------------
def fewest_moves(old, new):
    common = [old.index(x) for x in new if x in old]
    for k in range(len(common), 0, -1):
        if any(list(c) == sorted(c) for c in itertools.combinations(common, k)):
            return len(common) - k
    return 0


def test_scripts_replay_with_the_fewest_moves():
    rng = random.Random(7)
    for _ in range(400):
        names = [f"u{i}" for i in range(9)]
        old, new = (rng.sample(names, rng.randrange(0, 9)) for _ in range(2))
        steps = ED.script(old, new)
        assert ED.replay(old, steps) == new
        assert sum(s[0] == "move" for s in steps) == fewest_moves(old, new)
        assert sum(s[0] == "add" for s in steps) == len(set(new) - set(old))
        assert sum(s[0] == "remove" for s in steps) == len(set(old) - set(new))
    for _ in range(200):  # a track may stand in a list more than once
        old, new = ([rng.choice("abcd") for _ in range(rng.randrange(0, 10))] for _ in range(2))
        assert ED.replay(old, ED.script(old, new)) == new


def test_script_of_tables(spark):
    rows = lambda m, p, uris: [(m, p, i, u) for i, u in enumerate(uris, 1)]
    old = spark.createDataFrame(rows("M", "top", "abcdef") + rows("M", "gone", "xy"), LIST)
    new = spark.createDataFrame(rows("M", "top", "fabdg") + rows("N", "new", "pq"), LIST)
    steps = ED.playlist_edit_script(old, new)
    ops = sorted((r["market"], r["playlist"], r["step"], r["op"], r["track_uri"], r["from_position"], r["to_position"]) for r in steps.collect())
    assert [o[3:] for o in ops if o[1] == "top"] == [("remove", "e", 5, None), ("remove", "c", 3, None), ("move", "f", 4, 1), ("add", "g", None, 5)]
    assert sorted(tuple(r) for r in ED.replay_script(old, steps).collect()) == sorted(tuple(r) for r in new.collect())
    with pytest.raises(Exception, match="is not at position"):
        ED.replay_script(new, steps).collect()


def test_batches_rebuild_their_list(spark):
    rows = [("M", p, i, f"{p}{i}") for p, n in (("a", 150), ("b", 1), ("c", 100), ("d", 301)) for i in range(1, n + 1)]
    lists = spark.createDataFrame(rows, LIST)
    batches = playlist_batches(lists, "2024-01-07", uri_col="track_uri")
    assert sorted(tuple(r) for r in ED.replay_batches(batches).collect()) == sorted(rows)
    with pytest.raises(ED.ScriptError):
        ED.replay_batches(batches.withColumn("insert_at", F.lit(3)))


# -- pages -----------------------------------------------------------------------
def pages(spark, *bodies):
    return spark.createDataFrame([("M", "top", json.dumps(b)) for b in bodies], "market string, playlist string, body string")


def body(offset, uris, total):
    return {"offset": offset, "total": total, "items": [{"track": {"uri": u} if u else None} for u in uris]}


def test_pages_are_stitched(spark):
    found = PS.stitch_pages(pages(spark, body(2, "cd", 5), body(0, "abc", 5), body(4, "e", 5), body(2, "cd", 5), body(5, "", 5)))
    assert [r["track_uri"] for r in found.orderBy("position").collect()] == list("abcde")
    gone = PS.stitch_pages(pages(spark, body(0, ["a", None], 2)))  # an item whose track is gone keeps its place
    assert [(r["position"], r["track_uri"]) for r in gone.orderBy("position").collect()] == [(1, "a"), (2, None)]
    assert PS.stitch_pages(pages(spark, body(0, "", 0))).count() == 0


@pytest.mark.parametrize(("bodies", "fault"), [
    ([body(0, "ab", 5), body(3, "de", 5)], "no page covers"), ([body(0, "ab", 3)], "no page covers"), ([body(0, "ab", 3), body(1, "cd", 3)], "different items"),
    ([body(0, "ab", 2), body(0, "ab", 3)], "different totals"), ([body(0, "abc", 2)], "beyond the total"), ([{"items": []}], "without offset")])
def test_pages_that_make_no_list(spark, bodies, fault):
    with pytest.raises(PS.PageError, match=fault):
        PS.stitch_pages(pages(spark, *bodies))


@pytest.mark.parametrize(("size", "overlap"), [(1, 0), (4, 0), (4, 3), (7, 2), (100, 10)])
def test_pages_round_trip(spark, size, overlap):
    rows = [("M", p, i, f"{p}{i}") for p, n in (("a", 1), ("b", 23), ("c", 8)) for i in range(1, n + 1)]
    cut = PS.list_pages(spark.createDataFrame(rows, LIST), size, overlap, "track_uri")
    assert max(len(json.loads(r["body"])["items"]) for r in cut.collect()) <= size
    assert sorted(tuple(r) for r in PS.stitch_pages(cut).collect()) == sorted(rows)


# -- versions --------------------------------------------------------------------
def publish(spark, root, rows, day, names=("top", "rap")):
    lists = spark.createDataFrame(rows, LIST)
    manifest = PS.playlist_manifest(lists, PS.expected_lists(spark, ["M"], list(names)), day)
    return PS.publish_playlists(lists, playlist_batches(lists, day, uri_col="track_uri"), manifest, root, "track_uri")


def snapshot(spark, root):
    return sorted(tuple(r) for r in PS.published(spark, root).collect())


FIRST = [("M", "top", 1, "a"), ("M", "top", 2, "b"), ("M", "rap", 1, "c")]


def test_versions_replace_lists_together(spark, tmp_scratch):
    root = tmp_scratch("store")
    publish(spark, root, FIRST, "2024-01-07")
    publish(spark, root, [("M", "top", 1, "z")], "2024-01-08", ["top"])
    assert snapshot(spark, root) == [("M", "rap", 1, "c"), ("M", "top", 1, "z")]
    assert {(r["playlist"], str(r["as_of"])) for r in PS.published(spark, root, "manifest").collect()} == {("top", "2024-01-08"), ("rap", "2024-01-07")}
    publish(spark, root, [], "2024-01-09")
    assert snapshot(spark, root) == [] and PS.published(spark, root, "batches").count() == 0
    assert {r["n_tracks"] for r in PS.published(spark, root, "manifest").collect()} == {0}


@pytest.mark.parametrize("step", ["playlists", "batches", "manifest", "commit"])
def test_a_run_that_breaks_leaves_the_old_version(spark, tmp_scratch, monkeypatch, step):
    root = tmp_scratch("store")
    publish(spark, root, FIRST, "2024-01-07")
    write, commit = VersionStore.write, VersionStore.commit

    def broken(self, name, *rest):
        if name == step:
            raise OSError("lost")
        return write(self, name, *rest)

    def no_commit(self, *rest):
        if step == "commit":
            raise OSError("lost")
        return commit(self, *rest)

    monkeypatch.setattr(VersionStore, "write", broken)
    monkeypatch.setattr(VersionStore, "commit", no_commit)
    with pytest.raises(OSError, match="lost"):
        publish(spark, root, [("M", "top", 1, "new")], "2024-01-08")
    monkeypatch.undo()
    assert snapshot(spark, root) == sorted(FIRST)
    assert len(VersionStore(spark, root).expire(keep=1)) == (step != "playlists")  # what the broken run left
    publish(spark, root, [("M", "top", 1, "new")], "2024-01-08")
    assert snapshot(spark, root) == [("M", "top", 1, "new")]


def test_one_of_two_runs_commits(spark, tmp_scratch):
    store = VersionStore(spark, tmp_scratch("store"))
    rows = spark.range(3)
    base = store.publish({"t": rows})
    store.publish({"t": rows}, after=base)
    with pytest.raises(PublishConflictError):
        store.publish({"t": rows}, after=base)
    assert [c.number for c in store.commits()] == [1, 2]


def test_old_versions_expire(spark, tmp_scratch):
    store = VersionStore(spark, tmp_scratch("store"))
    made = [store.publish({"t": spark.range(n)}) for n in (1, 2, 3)]
    held = store.read("t", made[1])
    assert store.expire(keep=2) == [made[0].version]
    assert held.count() == 2 and store.read("t").count() == 3
    with pytest.raises(FileNotFoundError):
        store.read("other")


# -- loads that count once ---------------------------------------------------------
ROWS = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def test_a_load_counts_once(spark, tmp_scratch, monkeypatch):
    root = tmp_scratch("loads")
    one = folder(tmp_scratch, {"a.csv": "id,name\n1,x\n2,y\n", "b.csv": "id,name\n3,z\n"})
    two = folder(tmp_scratch, {"a.csv": "id,name\n2,y\n"})
    done = LD.load_once(spark, one, root, ROWS, "day-1")
    assert done.added and done.n_rows == 3
    same = folder(tmp_scratch, {"all.csv": "id,name\n3,z\n2,y\n1,x\n"})  # the same rows in one file
    again = LD.load_once(spark, same, root, ROWS, "day-1")
    assert not again.added and again.table.count() == 3
    with pytest.raises(LD.LoadConflictError):
        LD.load_once(spark, two, root, ROWS, "day-1")
    assert LD.load_once(spark, two, root, ROWS, "day-2").table.count() == 4
    real = LD.ledger
    monkeypatch.setattr(LD, "ledger", lambda *a: (_ for _ in ()).throw(OSError("lost")) if os.path.exists(local(f"{root}/data/load=day-3")) else real(*a))
    with pytest.raises(OSError, match="lost"):  # broken after the rows, before the ledger
        LD.load_once(spark, one, root, ROWS, "day-3")
        LD.ledger(spark, root)
    monkeypatch.undo()
    ledger_file = local(f"{root}/ledger/day-3")
    if os.path.exists(ledger_file):  # as a run that never came to its ledger entry
        os.rename(ledger_file, local(tmp_scratch("aside")))
    assert LD.loaded(spark, root, ROWS).count() == 4
    assert LD.load_once(spark, one, root, ROWS, "day-3").table.count() == 7
    with pytest.raises(ValueError, match="load id"):
        LD.load_once(spark, one, root, ROWS, "../x")


def test_byte_widths_end_between_characters(spark):
    texts = ["", "plain text", "Żółć", "日本語テキスト", "a😀b😀c", "�a�", "é" * 7, "x�", "́a", "naïve �� end"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for width in range(0, 13):
        got = [r[0] for r in df.select(LD.cut_bytes(F.col("t"), width)).collect()]
        want = []
        for t in texts:
            n = 0
            while n < len(t) and len(t[: n + 1].encode()) <= width:
                n += 1
            want.append(t[:n])
        assert got == want, width


# -- rolling window ------------------------------------------------------------------
FACTS = "partner_info_key long, num_streams long, report_date date, country_code string, source_type_key int"
DIM = "partner_info_key long, track_isrc string, track_uri string"


def test_window_equals_a_rescan_on_every_day(spark):
    rng = random.Random(2)
    start = date(2024, 1, 1)
    rows = [(rng.randrange(12), rng.choice([None, 1, 2, 5]), start + timedelta(days=rng.randrange(30)), rng.choice(["PL", "CZ"]), rng.choice([1, 2])) for _ in range(500)]
    streams = spark.createDataFrame(rows, FACTS).cache()
    dim = spark.createDataFrame([(k, f"i{k % 4}", f"u{k}") for k in range(12)], DIM)
    window = CoverWindow("PL", (1,), 5)
    dates = [start + timedelta(days=d) for d in (0, 1, 2, 3, 4, 5, 6, 9, 9, 20, 21, 40)]
    got = {}
    for r in window.backfill(streams, dim, dates).collect():
        got.setdefault(r["run_date"], set()).add(tuple(r)[1:])
    for day in set(dates):
        want = {tuple(r) for r in C.best_cover(streams, dim, day.isoformat(), "PL", (1,), 5).collect()}
        assert got.get(day, set()) == want, day
    with pytest.raises(WindowStateError):
        window.advance(streams, streams, start, start - timedelta(days=1))


def test_a_day_reads_two_days_and_the_state(spark, tmp_scratch):
    path = tmp_scratch("facts")
    spark.range(400).select(
        (F.col("id") % 7).alias("partner_info_key"), F.lit(1).cast("long").alias("num_streams"), F.lit("PL").alias("country_code"),
        F.lit(1).alias("source_type_key"), F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 40).cast("int")).alias("report_date"),
    ).write.partitionBy("report_date").parquet(path)
    facts = spark.read.parquet(path)
    window = CoverWindow("PL", (1,), 14)
    old = date(2024, 1, 20)
    from chartwright.plans.session import materialize

    state = materialize(window.start(facts, old), "state")
    moved = window.advance(state, facts, old, old + timedelta(days=1))
    plan = moved._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(report_date") == 2, plan
    read = moved.select("partner_info_key", "n_rows")
    numbers = [m for m in re.findall(r"report_date#\d+ (?:>=|<=) ([\d-]+)", read._jdf.queryExecution().executedPlan().toString())]
    assert {n for n in numbers} == {str(old + timedelta(days=1)), str(old - timedelta(days=14))}, numbers  # each from and to
    whole = {r[0]: (r[1], r[3]) for r in window.start(facts, old + timedelta(days=1)).collect()}
    assert {r[0]: (r[1], r[3]) for r in moved.collect()} == whole


# -- co-located segments ---------------------------------------------------------------
def test_no_exchange_between_facts_and_segments(spark, tmp_scratch):
    facts = spark.range(2000).select(
        (F.col("id") % 50).alias("consumer_key"), F.lit("PL").alias("country_code"), (F.col("id") % 9).alias("partner_info_key"),
        (F.col("id") % 3 + 1).alias("num_streams"), F.lit(date(2024, 1, 7)).alias("report_date"), F.lit("PL").alias("country_code_stream"))
    segments = spark.range(50).select(F.col("id").alias("consumer_key"), F.lit("PL").alias("country_code"), F.concat(F.lit("s"), F.col("id") % 4).alias("segment_name"))
    dim = spark.range(9).select(F.col("id").alias("partner_info_key"), F.concat(F.lit("i"), F.col("id") % 5).alias("track_isrc"))
    top = dim.select(F.lit("PL").alias("market"), "track_isrc").distinct().select(
        "market", "track_isrc", *[F.lit("x").alias(c) for c in ("_track_uri", "_track_artist", "_track_name", "_primary_genre")], F.lit(1).alias("total_streams"))
    name = os.path.basename(tmp_scratch("t")).replace("-", "_")
    stored = CO.store_by_key(facts, f"f_{name}", tmp_scratch("facts"), 4, partition_by=["report_date"])
    kept = CO.store_by_key(segments, f"s_{name}", tmp_scratch("segments"), 4)
    day = "2024-01-07"
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    plain = {tuple(r) for r in C.segment_streams(facts, day, ["PL"], dim, top, segments).collect()}
    # the segments are far larger than a broadcast in production: keep them from being one here
    per_consumer = stored.filter(F.col("report_date") == day).join(F.broadcast(dim), "partner_info_key").groupBy(
        "track_isrc", "consumer_key", "country_code").agg(F.sum("num_streams").alias("streams"))
    joined = per_consumer.join(kept.hint("merge"), ["consumer_key", "country_code"], "left")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "hashpartitioning" not in plan, plan
    got = {tuple(r) for r in C.segment_streams(stored, day, ["PL"], dim, top, kept).collect()}
    assert got == plain and spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == threshold
    assert {r["files"] for r in CO.bucket_files(kept).collect()} == {1}


# -- found columns ---------------------------------------------------------------------
def test_pivot_finds_its_columns(spark):
    rows = [("M", "a", "new", 3), ("M", "a", "old", 4), ("M", "a", "new", 2), ("M", "b", None, 9), ("N", "a", "odd name", 1)]
    tracks = spark.createDataFrame(rows, "market string, track_isrc string, segment_name string, segment_streams long")
    found = C.segment_pivot(tracks)
    assert found.columns == ["market", "track_isrc", "new", "odd name", "old"]
    assert {tuple(r) for r in found.collect()} == {("M", "a", 5, None, 4), ("M", "b", None, None, None), ("N", "a", None, 1, None)}
    with pytest.raises(C.TooManySegmentsError):
        C.segment_pivot(tracks, most=2)
    assert C.segment_pivot(tracks.filter("segment_name is null")).columns == ["market", "track_isrc"]


# -- whole inventory -------------------------------------------------------------------
def test_inventory_lists_hidden_names_and_empty_folders(spark, tmp_scratch):
    from chartwright.sources.listing import whole_inventory

    root = folder(tmp_scratch, {"a.csv": "12345", "_hidden": "1", ".dot/inner.txt": "123", "deep/er/file": ""})
    os.makedirs(f"{root}/empty/nested")
    got = {(r["path"], r["filename"], r["filesize"], r["is_file"]) for r in whole_inventory(spark, root).collect()}
    assert got == {
        ("", "a.csv", 5, True), ("", "_hidden", 1, True), ("", ".dot", None, False), ("/.dot", "inner.txt", 3, True), ("", "deep", None, False),
        ("/deep", "er", None, False), ("/deep/er", "file", 0, True), ("", "empty", None, False), ("/empty", "nested", None, False)}
    assert all(r["modified_at"] is not None for r in whole_inventory(spark, f"file://{root}").collect())
    with pytest.raises(ValueError, match="not mounted"):
        whole_inventory(spark, "s3a://bucket/x")
