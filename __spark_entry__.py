"""

Every query reads the driver's tables under ``sf_dir`` (through the fixture
views of ``chartwright.sources.fixtures``) and runs the whole job over them;
``oracle_sql`` holds the matching DuckDB SQL (see ``oracle_queries.py``).
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from chartwright.operators import playlists as P  # noqa: E402
from chartwright.plans.daily import ALL_MARKETS, FIXTURE_PARAMS, ChartJob, daily_lists, run_daily  # noqa: E402
from chartwright.operators import charts as C  # noqa: E402
from chartwright.operators import edits as ED  # noqa: E402
from chartwright.plans.session import materialize, scratch_path, tune  # noqa: E402
from chartwright.sources import colocated as CO  # noqa: E402
from chartwright.sources import ledger as LD  # noqa: E402
from chartwright.sources import listing as WI  # noqa: E402
from chartwright.sources import tables as TB  # noqa: E402
from chartwright.sources import files as FS  # noqa: E402
from chartwright.sources import playlist_store as PS  # noqa: E402
from chartwright.sources.fixtures import staged_chart_inputs  # noqa: E402
from chartwright.functions.text import artist_tokens, char_counts, cosine, squared_norm  # noqa: E402
from chartwright.functions.time import COMPACT_FORMAT, epoch_timestamp, parse_timestamp  # noqa: E402
from chartwright.streaming.rolling import CoverWindow  # noqa: E402
from chartwright.streaming.watermark import load_watermark  # noqa: E402
from dataclasses import replace  # noqa: E402
from datetime import date  # noqa: E402

import oracle_queries  # noqa: E402

try:  # the training-data operators, and what they need, are a part that can be left out
    import corpus_pipeline  # noqa: E402
    from chartwright.llm import queries as llm_queries  # noqa: E402
except ModuleNotFoundError:
    corpus_pipeline = llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"
LIST_COLS = ["market", "playlist", "position", "chart_rank", "track_isrc", "_track_uri", "_track_artist"]


def _job(spark: SparkSession, sf_dir: str, materialize: bool = True, **overrides) -> ChartJob:
    """The chart job over the driver's tables, facts staged in the production layout.

    ``materialize=False`` leaves the stages in one plan, for looking at it."""
    params = replace(FIXTURE_PARAMS, **overrides) if overrides else FIXTURE_PARAMS
    tune(spark, max(params.top_n_sme, params.top_n_orchard, params.short_video_n_sme, params.short_video_n_orchard))
    return ChartJob(inputs(spark, sf_dir), params, materialize)


def inputs(spark: SparkSession, sf_dir: str):
    """Stand-in input tables for ``sf_dir``, staged once per session."""
    return staged_chart_inputs(spark, sf_dir, lambda s: scratch_path(s, "inputs"))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: every themed playlist of the day, declumped, on sf0.001."""
    return q_playlists_all(spark, SMOKE_DIR)


# --- C1 ---------------------------------------------------------------------
def q_load_watermark(spark, sf_dir):
    job = _job(spark, sf_dir)
    return load_watermark(job.inputs.load_status, job.params.streams_tables, ALL_MARKETS)


# --- C2..C10 ----------------------------------------------------------------
def q_top_tracks_sme(spark, sf_dir):
    return _job(spark, sf_dir).top_sme


def q_top_tracks_orchard(spark, sf_dir):
    return _job(spark, sf_dir).top_orchard


def q_segment_streams_sme(spark, sf_dir):
    return _job(spark, sf_dir).segments("SME")


def q_segment_streams_orchard(spark, sf_dir):
    return _job(spark, sf_dir).segments("ORCHARD")


def q_best_cover(spark, sf_dir):
    return _job(spark, sf_dir).covers("SME")


def q_best_cover_orchard(spark, sf_dir):
    return _job(spark, sf_dir).covers("ORCHARD")


def q_feed_tracks(spark, sf_dir):
    return _job(spark, sf_dir).tracks


def q_track_metadata(spark, sf_dir):
    return _job(spark, sf_dir).metadata


def q_earliest_release(spark, sf_dir):
    return _job(spark, sf_dir).releases


def q_segment_shares(spark, sf_dir):
    return _job(spark, sf_dir).shares


def q_chart(spark, sf_dir):
    return _job(spark, sf_dir).chart


def q_chart_at_watermark(spark, sf_dir):
    """All markets, each on its own newest fully loaded day (C1 + C10)."""
    return _job(spark, sf_dir, day=None, markets=ALL_MARKETS).chart


# --- F6..F13 ----------------------------------------------------------------
def q_artist_tokens(spark, sf_dir):
    dim = inputs(spark, sf_dir).dim_partner
    t = artist_tokens("track_artists")
    return dim.select(
        "partner_info_key", "track_artists",
        F.array_join(F.array_sort(t), "|").alias("tokens"), F.size(t).alias("n_tokens"),
    )


def q_char_cosine(spark, sf_dir):
    i = inputs(spark, sf_dir)
    part = spark.read.parquet(f"{sf_dir.rstrip('/')}/part.parquet").select(
        F.col("p_partkey").alias("partner_info_key"), "p_brand"
    )
    rows = i.dim_partner.join(part, "partner_info_key")
    vectors = rows.select(
        "partner_info_key", "track_name", "track_artists", "p_brand",
        char_counts("track_name").alias("v_name"),
        char_counts("track_artists").alias("v_artist"),
        char_counts("p_brand").alias("v_brand"),
    ).select("*", squared_norm(F.col("v_name")).alias("n_name"))
    return vectors.select(
        "partner_info_key", "track_name", "track_artists", "p_brand",
        cosine(F.col("v_name"), F.col("v_artist"), norm_a=F.col("n_name")).alias("sim_name_artist"),
        cosine(F.col("v_name"), F.col("v_brand"), norm_a=F.col("n_name")).alias("sim_name_brand"),
    )


# --- C13..C20 ---------------------------------------------------------------
def _top_list(job: ChartJob, passes: int) -> DataFrame:
    top = job.chart.filter(F.col("chart_rank") <= job.params.playlist_length).select(
        "market", F.lit("top").alias("playlist"), F.col("chart_rank").alias("position"),
        "chart_rank", "track_isrc", "_track_uri", "_track_artist",
    )
    return P.declump(top, passes).select(*LIST_COLS)


def q_declump_once(spark, sf_dir):
    return _top_list(_job(spark, sf_dir), 1)


def q_declump_four(spark, sf_dir):
    return _top_list(_job(spark, sf_dir), 4)


def q_playlist_top_plain(spark, sf_dir):
    return _top_list(_job(spark, sf_dir), 0)


def _one_list(name: str):
    def q(spark, sf_dir):
        return _job(spark, sf_dir).playlists(names=(name,)).select(*LIST_COLS)

    q.__name__ = f"q_playlist_{name}"
    return q


def q_playlists_all(spark, sf_dir):
    return _job(spark, sf_dir).playlists().select(*LIST_COLS)


def q_playlist_top_by_market(spark, sf_dir):
    return _job(spark, sf_dir, markets=ALL_MARKETS).playlists(names=("top",)).select(*LIST_COLS)


# --- C11, C12, C19 ----------------------------------------------------------
def q_short_video_top(spark, sf_dir):
    return _job(spark, sf_dir).short_video


def q_fuzzy_pairs(spark, sf_dir):
    return _job(spark, sf_dir).fuzzy_pairs()


def q_playlist_viral(spark, sf_dir):
    return _job(spark, sf_dir).viral().select(*LIST_COLS, "tt_creations")


# --- C21, S10..S12 ----------------------------------------------------------
def q_publish_batches(spark, sf_dir):
    job = _job(spark, sf_dir)
    b = P.playlist_batches(job.playlists(), job.params.day)
    return b.select(
        "market", "playlist", "batch_no", "send_order", "insert_at", "n_uris",
        F.array_join("uris", ",").alias("uri_list"), "description",
    )


def q_playlist_diff(spark, sf_dir):
    old = _job(spark, sf_dir, day="1999-01-01").playlists(names=("top",))
    new = _job(spark, sf_dir).playlists(names=("top",))
    return PS.playlist_diff(
        old.withColumnRenamed("_track_uri", "track_uri"), new.withColumnRenamed("_track_uri", "track_uri")
    )


def q_playlist_snapshot(spark, sf_dir):
    job = _job(spark, sf_dir)
    path, manifest = scratch_path(spark, "playlists"), scratch_path(spark, "manifest")
    names = [r.name for r in job.rules()]
    expected = PS.expected_lists(spark, job.params.markets, names)
    PS.write_playlists(job.playlists(), expected, path, manifest, job.params.day)
    return PS.read_playlists(spark, path)


# --- C22..C24 ---------------------------------------------------------------
def q_csv_roundtrip(spark, sf_dir):
    """The chart with spaces, quotes and line breaks put into its texts, and the genre sometimes empty."""
    chart = _job(spark, sf_dir).chart.withColumn("_track_name", F.concat(F.lit(" "), "_track_name", F.lit(' "live"\n, 2 '))).withColumn(
        "_primary_genre", F.when(F.col("feed") == "SME", F.col("_primary_genre")).otherwise(""))
    path = FS.export_csv(chart, scratch_path(spark, "chart-csv"))
    return FS.read_csv_feed(spark, path, chart.schema, multi_line=True)


TRACK_SCHEMA = T.StructType([
    T.StructField("market", T.StringType()),
    T.StructField("track_isrc", T.StringType()),
    T.StructField("segment_name", T.StringType()),
    T.StructField("_track_uri", T.StringType()),
    T.StructField("_track_artist", T.StringType()),
    T.StructField("_track_name", T.StringType()),
    T.StructField("_primary_genre", T.StringType()),
    T.StructField("segment_streams", T.LongType()),
    T.StructField("total_streams", T.LongType()),
    T.StructField("feed", T.StringType()),
])


def q_bulk_load_csv(spark, sf_dir):
    tracks = _job(spark, sf_dir).tracks
    src = FS.export_csv(tracks, scratch_path(spark, "tracks-csv"))
    return FS.bulk_load_csv(spark, src, scratch_path(spark, "tracks-table"), TRACK_SCHEMA,
                            widths={"_track_name": 12}).table


def q_bulk_load_rejects(spark, sf_dir):
    """Rows without a segment are written with a number that is none; their lines are kept."""
    tracks = _job(spark, sf_dir).tracks
    streams = F.when(F.col("segment_name").isNotNull(), F.col("segment_streams").cast("string")).otherwise("n/a")
    src = FS.export_csv(tracks.withColumn("segment_streams", streams), scratch_path(spark, "tracks-csv"))
    return FS.bulk_load_csv(spark, src, scratch_path(spark, "tracks-table"), TRACK_SCHEMA, max_errors=1 << 40).rejects


def q_file_inventory(spark, sf_dir):
    """Folders, and whether they hold files, of an export of the customers by market."""
    segments = inputs(spark, sf_dir).consumer_segments.withColumnRenamed("country_code", "market")
    found = FS.file_inventory(spark, FS.export_csv(segments, scratch_path(spark, "segments-csv"), partition_by=["market"]))
    return found.select("path", F.when(F.col("is_file"), "*").otherwise(F.col("filename")).alias("name"), "is_file").distinct()


# --- S3, S4: columns bound by name ------------------------------------------
def _drifting_feed(spark, sf_dir):
    """The tracks as three deliveries: as they should be, columns in another order and one more, and without a column."""
    tracks = _job(spark, sf_dir).tracks
    folder = scratch_path(spark, "feed-csv")
    names = tracks.columns
    odd = (F.length("_track_name") + F.length(F.coalesce("segment_name", F.lit("")))) % 3
    FS.export_csv(tracks.filter(odd == 0), f"{folder}/plain")
    FS.export_csv(tracks.filter(odd == 1).select(*names[::-1], F.lit("more").alias("comment")), f"{folder}/turned")
    FS.export_csv(tracks.filter(odd == 2).drop("_primary_genre").withColumn(
        "segment_streams", F.when(F.col("feed") == "SME", F.col("segment_streams").cast("string")).otherwise("n/a")), f"{folder}/short")
    return folder


def q_csv_by_name(spark, sf_dir):
    return FS.read_csv_feed(spark, _drifting_feed(spark, sf_dir), T.StructType(
        [f if f.name != "segment_streams" else T.StructField(f.name, T.StringType()) for f in TRACK_SCHEMA]))


def q_csv_drift(spark, sf_dir):
    """What departs from the schema in each delivery, and how many values."""
    found = FS.csv_drift(spark, _drifting_feed(spark, sf_dir), TRACK_SCHEMA)
    delivery = F.regexp_extract("file", r"/(\w+)/[^/]*$", 1)
    return found.groupBy(delivery.alias("delivery"), "column", "change").agg(F.sum("n").alias("n"))


# --- S12: order and pages -----------------------------------------------------
def _two_days(spark, sf_dir):
    """The top lists of all markets on two days, as lists of URIs."""
    days = [_job(spark, sf_dir, markets=ALL_MARKETS, **over).playlists(names=("top",)) for over in ({"day": "1999-01-01"}, {})]
    return [materialize(d.select("market", "playlist", "position", F.col("_track_uri").alias("track_uri")), "list") for d in days]


def q_playlist_edits(spark, sf_dir):
    """Removals, additions and the fewest moves that turn one day's lists into the next one's."""
    steps = ED.playlist_edit_script(*_two_days(spark, sf_dir))
    count = lambda op: F.count(F.when(F.col("op") == op, 1)).alias(f"n_{op}")
    return steps.groupBy("market", "playlist").agg(count("remove"), count("move"), count("add"))


def q_playlist_edit_replay(spark, sf_dir):
    """The next day's lists, made from the first day's by the script."""
    old, new = _two_days(spark, sf_dir)
    return ED.replay_script(old, ED.playlist_edit_script(old, new))


def q_playlist_pages(spark, sf_dir):
    """Every list written in pages of 40 that overlap by 15, and stitched together."""
    return PS.stitch_pages(PS.list_pages(_job(spark, sf_dir).playlists(), 40, 15))


# --- S10, S11: publishing -----------------------------------------------------
def q_published_lists(spark, sf_dir):
    """Two versions: every list of one day, then the top list of the next day; read through the commit."""
    root = scratch_path(spark, "store")
    for over, names in (({"day": "1999-01-01"}, None), ({}, ("top",))):
        job = _job(spark, sf_dir, **over)
        lists = materialize(job.playlists(names=names), "lists")
        expected = PS.expected_lists(spark, job.params.markets, list(names or [r.name for r in job.rules()]))
        manifest = materialize(PS.playlist_manifest(lists, expected, job.params.day), "manifest")
        PS.publish_playlists(lists, P.playlist_batches(lists, job.params.day), manifest, root)
    days = PS.published(spark, root, "manifest").select("market", "playlist", F.col("as_of").cast("string").alias("as_of"))
    return PS.published(spark, root).join(days, ["market", "playlist"]).select("market", "playlist", "position", "track_uri", "as_of")


def q_batch_replay(spark, sf_dir):
    """The lists that publishing the batches builds."""
    job = _job(spark, sf_dir)
    return ED.replay_batches(materialize(P.playlist_batches(job.playlists(), job.params.day), "batches"))


# --- S9: loads that count once --------------------------------------------------
def q_load_once(spark, sf_dir):
    """Two loads, the first of them run twice; names cut to 7 bytes, which end inside a character."""
    tracks = _job(spark, sf_dir).tracks.withColumn("_track_name", F.concat(F.lit("Żółć "), "_track_name"))
    root = scratch_path(spark, "loads")
    sources = {feed: FS.export_csv(tracks.filter(F.col("feed") == feed), scratch_path(spark, "load-csv")) for feed in ("SME", "ORCHARD")}
    for feed in ("SME", "ORCHARD", "SME"):
        done = LD.load_once(spark, sources[feed], root, TRACK_SCHEMA, f"day-{feed}", {"_track_name": 7})
    return done.table


# --- C5 by daily sums, C4 by place, A7 by found columns -------------------------
def q_best_cover_rolling(spark, sf_dir):
    """The covers of seven run dates, each from the last one's state and the days that enter and leave."""
    i, p = inputs(spark, sf_dir), FIXTURE_PARAMS
    window = CoverWindow(p.home_market, p.cover_sources, p.cover_days)
    dates = [date(y, 1, 1) for y in range(1995, 2002)]
    found = window.backfill(i.streams["SME"].unionByName(i.streams["ORCHARD"]), i.dim_partner, dates)
    return found.withColumn("run_date", F.col("run_date").cast("string"))


def q_segment_streams_colocated(spark, sf_dir):
    """``segment_streams_sme`` over facts and segments stored by consumer."""
    job = _job(spark, sf_dir)
    i, p = job.inputs, job.params
    mark = uuid.uuid4().hex[:12]
    facts = CO.store_by_key(i.streams["SME"], f"facts_{mark}", scratch_path(spark, "facts"), 8, partition_by=["report_date"])
    segments = CO.store_by_key(i.consumer_segments, f"segments_{mark}", scratch_path(spark, "segments"), 8)
    return C.segment_streams(facts, job.stream_days, p.markets, i.dim_partner, materialize(job.top_sme, "top"), segments)


def q_segment_pivot(spark, sf_dir):
    return C.segment_pivot(_job(spark, sf_dir).tracks)


# --- S2, S5, S6 -------------------------------------------------------------------
def q_statement_table(spark, sf_dir):
    """A table made and filled by statements with parameters."""
    mark = uuid.uuid4().hex[:12]
    _job(spark, sf_dir).tracks.createOrReplaceTempView(f"tracks_{mark}")
    TB.run_statement(spark, f"CREATE TABLE loud_{mark} (market STRING, track_isrc STRING, segment_name STRING, segment_streams BIGINT) "
                            f"USING parquet LOCATION '{scratch_path(spark, 'loud')}'")
    TB.run_statement(spark, f"INSERT INTO loud_{mark} SELECT market, track_isrc, segment_name, segment_streams FROM tracks_{mark} "
                            "WHERE feed = :feed AND segment_streams >= :least", feed="SME", least=20)
    return TB.read_table(spark, f"loud_{mark}")


def q_whole_inventory(spark, sf_dir):
    """Everything below an export of the customers by market, one file a market, and an empty folder: files, bytes and
    whether times are given, hidden names put together."""
    segments = inputs(spark, sf_dir).consumer_segments
    root = scratch_path(spark, "listing")
    lines = segments.select(F.concat_ws(",", F.col("consumer_key").cast("string"), "segment_name").alias("value"), F.col("country_code").alias("market"))
    lines.repartition(1, "market").write.partitionBy("market").text(root)
    spark.range(0).selectExpr("cast(id as string) as value").write.text(f"{root}/market=NONE")
    found = WI.whole_inventory(spark, root)
    hidden = F.col("filename").rlike("^[._]")
    kind = F.when(~F.col("is_file"), "folder").when(hidden, "hidden").otherwise("data")
    seen = found.filter((F.col("path") != "/market=NONE") & ((kind != "hidden") | (F.col("filename") == "_SUCCESS")))
    return seen.groupBy("path", kind.alias("kind")).agg(
        F.count("*").alias("n"), F.sum("filesize").alias("bytes"), F.count("modified_at").alias("n_times"))


# --- limits that cut ----------------------------------------------------------
def q_top_tracks_sme_100(spark, sf_dir):
    return _job(spark, sf_dir, top_n_sme=100).top_sme


def q_top_tracks_orchard_50(spark, sf_dir):
    return _job(spark, sf_dir, top_n_orchard=50).top_orchard


def q_short_video_top_10_5(spark, sf_dir):
    return _job(spark, sf_dir, short_video_n_sme=10, short_video_n_orchard=5).short_video


def q_playlist_viral_20(spark, sf_dir):
    return _job(spark, sf_dir, playlist_length=20).viral().select(*LIST_COLS, "tt_creations")


# --- C1, C20, C21 for all markets ---------------------------------------------
def q_short_video_at_watermark(spark, sf_dir):
    return _job(spark, sf_dir, short_video_day=None, markets=ALL_MARKETS).short_video


MARKET_LISTS = (("AFRICA", ("top",), 0), ("AMERICA", ("top",), 4), ("ASIA", ("top",), 4), ("MIDDLE EAST", ("top",), 2))


def q_playlist_lists_by_market(spark, sf_dir):
    """One market publishes every list, the others the top list, each with its own passes."""
    return daily_lists(_job(spark, sf_dir, markets=ALL_MARKETS, market_lists=MARKET_LISTS)).select(*LIST_COLS)


def _daily(spark, sf_dir) -> str:
    out = scratch_path(spark, "daily")
    run_daily(_job(spark, sf_dir, markets=ALL_MARKETS), out)
    return out


def q_daily_batches(spark, sf_dir):
    b = PS.published(spark, _daily(spark, sf_dir), "batches")
    return b.select(
        "market", "playlist", "batch_no", "send_order", "insert_at", "n_uris",
        F.array_join("uris", ",").alias("uri_list"), "description",
    )


def q_daily_manifest(spark, sf_dir):
    found = PS.published(spark, _daily(spark, sf_dir), "manifest")
    return found.select("market", "playlist", "description", F.col("as_of").cast("string").alias("as_of"), "n_tracks")


# --- F4, F18 ------------------------------------------------------------------
def q_playlist_items(spark, sf_dir):
    """The lists as the bodies that a playlist service answers with, and read from them."""
    item = F.struct(F.struct(F.col("_track_uri").alias("uri")).alias("track"))
    bodies = _job(spark, sf_dir).playlists().groupBy("market", "playlist").agg(
        F.to_json(F.struct(F.transform(
            F.sort_array(F.collect_list(F.struct("position", item.alias("item")))), lambda x: x["item"]).alias("items"))).alias("body"))
    return PS.playlist_items_from_json(bodies)


def q_parsed_timestamps(spark, sf_dir):
    """The events' times written in three ways and parsed."""
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    written = events.select(
        "event_id", F.date_format("ts", COMPACT_FORMAT).alias("compact"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("iso"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("seconds"), F.concat(F.lit("at "), F.col("event_type")).alias("none"),
    )
    return written.select(
        "event_id", *[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(n) for c, n in (
            (parse_timestamp("compact"), "compact"), (parse_timestamp("iso"), "iso"), (epoch_timestamp("seconds"), "epoch"),
            (parse_timestamp("none"), "none"))])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q = {
        "load_watermark": q_load_watermark,
        "top_tracks_sme": q_top_tracks_sme,
        "top_tracks_orchard": q_top_tracks_orchard,
        "segment_streams_sme": q_segment_streams_sme,
        "segment_streams_orchard": q_segment_streams_orchard,
        "best_cover": q_best_cover,
        "best_cover_orchard": q_best_cover_orchard,
        "feed_tracks": q_feed_tracks,
        "track_metadata": q_track_metadata,
        "earliest_release": q_earliest_release,
        "segment_shares": q_segment_shares,
        "chart": q_chart,
        "chart_at_watermark": q_chart_at_watermark,
        "artist_tokens": q_artist_tokens,
        "char_cosine": q_char_cosine,
        "declump_once": q_declump_once,
        "declump_four": q_declump_four,
        "playlist_top_plain": q_playlist_top_plain,
    }
    for name in ("top", "rap", "gaming", "party", "catalogue"):
        q[f"playlist_{name}"] = _one_list(name)
    q.update({
        "playlist_top_by_market": q_playlist_top_by_market,
        "short_video_top": q_short_video_top,
        "fuzzy_pairs": q_fuzzy_pairs,
        "playlist_viral": q_playlist_viral,
        "publish_batches": q_publish_batches,
        "playlist_diff": q_playlist_diff,
        "playlist_snapshot": q_playlist_snapshot,
        "csv_roundtrip": q_csv_roundtrip,
        "bulk_load_csv": q_bulk_load_csv,
        "file_inventory": q_file_inventory,
        "bulk_load_rejects": q_bulk_load_rejects,
        "top_tracks_sme_100": q_top_tracks_sme_100,
        "top_tracks_orchard_50": q_top_tracks_orchard_50,
        "short_video_top_10_5": q_short_video_top_10_5,
        "playlist_viral_20": q_playlist_viral_20,
        "short_video_at_watermark": q_short_video_at_watermark,
        "playlist_lists_by_market": q_playlist_lists_by_market,
        "daily_batches": q_daily_batches,
        "daily_manifest": q_daily_manifest,
        "playlist_items": q_playlist_items,
        "parsed_timestamps": q_parsed_timestamps,
        "csv_by_name": q_csv_by_name,
        "csv_drift": q_csv_drift,
        "playlist_edits": q_playlist_edits,
        "playlist_edit_replay": q_playlist_edit_replay,
        "playlist_pages": q_playlist_pages,
        "published_lists": q_published_lists,
        "batch_replay": q_batch_replay,
        "load_once": q_load_once,
        "best_cover_rolling": q_best_cover_rolling,
        "segment_streams_colocated": q_segment_streams_colocated,
        "segment_pivot": q_segment_pivot,
        "statement_table": q_statement_table,
        "whole_inventory": q_whole_inventory,
    })
    if llm_queries is not None:
        q.update(llm_queries.queries())
        q["pipeline"] = corpus_pipeline.run
    return q


def oracle_sql() -> dict[str, str]:
    sql = oracle_queries.oracle_sql()
    if llm_queries is not None:
        sql = sql | llm_queries.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {k: v for k, v in sql.items() if k in queries()}
