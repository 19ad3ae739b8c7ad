"""The daily chart job, composed from the operators.

``ChartJob`` wires inputs and parameters into the stage DataFrames.
``run_daily`` is the production form: it materialises the chart once (a
Parquet table in the shared ``spark.checkpoint.dir``), derives every
playlist from it and writes the playlist snapshot, its manifest and the
publish batches.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartwright import defaults as D
from chartwright.operators import charts as C
from chartwright.operators import playlists as P
from chartwright.operators import shortvideo as V
from chartwright.sources.fixtures import (
    STREAMS_ORCHARD,
    STREAMS_SME,
    VIEWS_SME,
    ChartInputs,
)
from chartwright.plans.session import materialize, stage_scope
from chartwright.streaming.watermark import load_watermark, resolve_watermark


@dataclass(frozen=True)
class ChartParams:
    day: str | None                     # None: each market's streams load watermark
    markets: tuple[str, ...]
    run_date: str                       # "today" for the cover window
    segments: tuple[str, ...]           # pinned share columns
    short_video_day: str | None         # None: each market's views load watermark
    catalogue_run_date: str             # "today" for the catalogue age cut
    home_market: str = D.HOME_MARKET
    cover_sources: tuple[int, ...] = D.COVER_SOURCES
    cover_days: int = D.COVER_DAYS
    top_n_sme: int = D.TOP_N_SME
    top_n_orchard: int = D.TOP_N_ORCHARD
    short_video_n_sme: int = D.SHORT_VIDEO_TOP_SME
    short_video_n_orchard: int = D.SHORT_VIDEO_TOP_ORCHARD
    rap_segment: str = "rap"
    edm_segment: str = "edm"
    rap_pattern: str = D.RAP_PATTERN
    gaming_pattern: str = D.GAMING_PATTERN
    party_pattern: str = D.PARTY_PATTERN
    playlist_length: int = D.PLAYLIST_LENGTH
    passes: int = D.DECLUMP_PASSES
    gaming_passes: int = D.GAMING_PASSES
    viral_depth: int = D.VIRAL_CHART_DEPTH
    name_threshold: float = D.NAME_THRESHOLD
    artist_threshold: float = D.ARTIST_THRESHOLD
    streams_tables: tuple[str, ...] = (STREAMS_SME, STREAMS_ORCHARD)
    views_tables: tuple[str, ...] = (VIEWS_SME,)
    # What a market publishes, as (market, list names, passes of "top"); a
    # market that is not listed publishes every list with ``passes``.
    market_lists: tuple[tuple[str, tuple[str, ...], int], ...] = ()


# Parameters for the driver's tables (FIXTURES.md section 2): markets are
# regions, report days are years, segments are customer market segments and
# the theme pattern is a stand-in that matches the generated part names.
FIXTURE_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
FIXTURE_PARAMS = ChartParams(
    day="2000-01-01",
    markets=("EUROPE",),
    run_date="2001-01-01",
    segments=FIXTURE_SEGMENTS,
    short_video_day="2024-01-30",
    catalogue_run_date="1999-01-01",
    home_market="EUROPE",
    cover_sources=(4, 7),
    cover_days=730,
    rap_segment="BUILDING",
    edm_segment="MACHINERY",
    rap_pattern="rod|large",
    gaming_pattern="rod|large",
    party_pattern="rod|large",
)
ALL_MARKETS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


@dataclass
class ChartJob:
    """Stage DataFrames of one run.

    With ``materialize`` (the default) small stages that are read more than
    once are written as Parquet into the shared ``spark.checkpoint.dir`` and
    read back (``plans.session.materialize``): the feed tracks (read by
    metadata, shares and release lookups), the chart (read by every
    playlist and the viral match) and the short-video top (read three times
    by the match).  That cuts lineage, so a lost executor recomputes from
    these tables, not from the raw facts.  Facts are expected in the
    production layout, partitioned by ``report_date, country_code_stream``
    (see ``sources.fixtures.StagedInputs`` for the test data).
    """

    inputs: ChartInputs
    params: ChartParams = field(default=FIXTURE_PARAMS)
    materialize: bool = True

    def _cut(self, df: DataFrame, name: str = "stage") -> DataFrame:
        return materialize(df, name) if self.materialize else df

    # --- C1 ---------------------------------------------------------------
    def streams_watermark(self) -> DataFrame:
        return load_watermark(self.inputs.load_status, self.params.streams_tables, self.params.markets)

    def _watermark_days(self, tables: tuple[str, ...]) -> DataFrame:
        """``(market, day)``: each market's newest fully loaded day.

        Collects at most one row per market and fails when a market has
        none, instead of building (and publishing) an empty chart.
        """
        p = self.params
        days = resolve_watermark(load_watermark(self.inputs.load_status, tables, p.markets), p.markets)
        spark = self.inputs.dim_partner.sparkSession
        return spark.createDataFrame(sorted(days.items()), "market string, day date")

    @cached_property
    def stream_days(self) -> "str | DataFrame":
        p = self.params
        return p.day if p.day is not None else self._watermark_days(p.streams_tables)

    @cached_property
    def video_days(self) -> "str | DataFrame":
        p = self.params
        return p.short_video_day if p.short_video_day is not None else self._watermark_days(p.views_tables)

    # --- C2..C6 -----------------------------------------------------------
    @cached_property
    def _track_streams(self) -> dict[str, DataFrame]:
        p, i = self.params, self.inputs
        return {f: C.track_streams(i.streams[f], self.stream_days, p.markets) for f in D.FEEDS}

    @cached_property
    def top_sme(self) -> DataFrame:
        p, i = self.params, self.inputs
        return C.top_tracks(self._track_streams["SME"], i.dim_partner, p.top_n_sme, i.products_genre)

    @cached_property
    def top_orchard(self) -> DataFrame:
        p, i = self.params, self.inputs
        top = C.top_tracks(self._track_streams["ORCHARD"], i.dim_partner, p.top_n_orchard)
        return C.with_release_genre(top, C.release_genres(i.release_track_details))

    @cached_property
    def _tops(self) -> dict[str, DataFrame]:
        return {}

    def _top(self, feed: str) -> DataFrame:
        """A feed's bounded top list, cut once: read by its segments and its covers."""
        if feed not in self._tops:
            self._tops[feed] = self._cut(self.top_sme if feed == "SME" else self.top_orchard, f"top-{feed.lower()}")
        return self._tops[feed]

    def segments(self, feed: str) -> DataFrame:
        p, i = self.params, self.inputs
        return C.segment_streams(
            i.streams[feed], self.stream_days, p.markets, i.dim_partner, self._top(feed), i.consumer_segments
        )

    def covers(self, feed: str) -> DataFrame:
        p, i = self.params, self.inputs
        return C.best_cover(
            i.streams[feed], i.dim_partner, p.run_date, p.home_market, p.cover_sources, p.cover_days
        )

    def feed_tracks(self, feed: str) -> DataFrame:
        p, i = self.params, self.inputs
        covers = C.best_cover(
            i.streams[feed], i.dim_partner, p.run_date, p.home_market, p.cover_sources, p.cover_days, self._top(feed)
        )
        return C.feed_tracks(self.segments(feed), covers, feed)

    @cached_property
    def tracks(self) -> DataFrame:
        return self._cut(self.feed_tracks("SME").unionByName(self.feed_tracks("ORCHARD")))

    # --- C7..C10 ----------------------------------------------------------
    @cached_property
    def metadata(self) -> DataFrame:
        return C.track_metadata(self.tracks)

    @cached_property
    def releases(self) -> DataFrame:
        i = self.inputs
        return C.earliest_release(
            self.metadata, i.catalog_tracks, i.catalog_albums, i.products, i.product_releases,
            i.release_track_details,
        )

    @cached_property
    def shares(self) -> DataFrame:
        return C.segment_shares(self.tracks, self.params.segments)

    @cached_property
    def chart(self) -> DataFrame:
        return self._cut(C.chart(self.metadata, self.shares, self.releases))

    # --- C11, C12 ---------------------------------------------------------
    @cached_property
    def short_video(self) -> DataFrame:
        p, i = self.params, self.inputs
        sme = V.short_video_top(i.views["SME"], i.dim_partner_tt, self.video_days, p.markets,
                                p.short_video_n_sme, "SME")
        orch = V.short_video_top(i.views["ORCHARD"], i.dim_partner_tt, self.video_days, p.markets,
                                 p.short_video_n_orchard, "ORCHARD")
        return self._cut(sme.unionByName(orch), "short-video")

    def fuzzy_pairs(self, chart: DataFrame | None = None) -> DataFrame:
        p = self.params
        base = self.chart if chart is None else chart
        return V.fuzzy_match_tracks(
            base.filter(F.col("chart_rank") <= p.viral_depth), self.short_video,
            p.name_threshold, p.artist_threshold,
        )

    # --- C13..C20 ---------------------------------------------------------
    def rules(self) -> list[P.PlaylistRule]:
        return P.theme_rules(self.params)

    def lists_of(self, market: str) -> tuple[str, ...]:
        """C20: the names of the lists that a market publishes."""
        own = {m: names for m, names, _ in self.params.market_lists}
        return own.get(market, (*(r.name for r in self.rules()), "viral"))

    def playlists(self, chart: DataFrame | None = None, names: tuple[str, ...] | None = None) -> DataFrame:
        base = self.chart if chart is None else chart
        rules = [r for r in self.rules() if names is None or r.name in names]
        selected = P.select_playlists(base, rules, self.params.playlist_length)
        for market, lists, passes in self.params.market_lists:
            here = F.col("market") == market
            selected = selected.filter(~here | F.col("playlist").isin(*lists)).withColumn(
                "passes", F.when(here & (F.col("playlist") == "top"), F.lit(passes)).otherwise(F.col("passes")))
        return P.declump(selected, max([*(r.passes for r in rules), *(x for _, _, x in self.params.market_lists)]))

    def viral(self, chart: DataFrame | None = None) -> DataFrame:
        p = self.params
        chosen = P.viral_selection(self.fuzzy_pairs(chart), p.playlist_length)
        return P.declump(chosen, p.passes)


LIST_COLUMNS = ("market", "playlist", "position", "chart_rank", "track_isrc", "_track_uri", "_track_artist")


def daily_lists(job: ChartJob) -> DataFrame:
    """Every list of the run (themes + viral, as its market publishes them) in one long table."""
    themes = job.playlists().select(*LIST_COLUMNS)
    markets = [m for m in job.params.markets if "viral" in job.lists_of(m)]
    viral = job.viral().filter(F.col("market").isin(markets)).select(*LIST_COLUMNS)
    return themes.unionByName(viral)


def run_daily(job: ChartJob, out_dir: str) -> DataFrame:
    """The production run: chart, all lists, batches, manifest, published as one version.

    ``out_dir`` is a ``VersionStore``: tables ``playlists``, ``batches`` (publish
    calls) and ``manifest``, replaced together by one commit; a run that breaks
    leaves the last one readable.  Returns the manifest as read back.  The run's stage
    folders are removed when it ends, however it ends.
    """
    from chartwright.sources import playlist_store as PS

    p = job.params
    spark = job.inputs.dim_partner.sparkSession
    with stage_scope(spark):
        lists = materialize(daily_lists(job), "lists")
        expected = PS.expected_lists(spark, p.markets, {m: job.lists_of(m) for m in p.markets})
        days = job.stream_days
        manifest = materialize(PS.playlist_manifest(lists, expected, days), "manifest")
        dated = lists.join(manifest.select("market", "playlist", "as_of"), ["market", "playlist"])
        PS.publish_playlists(lists, P.playlist_batches(dated, F.col("as_of")), manifest, out_dir)
    return PS.published(spark, out_dir, "manifest")
