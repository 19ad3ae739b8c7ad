"""The chart job's input tables, derived from the driver's TPC-H-like tables.

Production reads real fact and dimension tables (``spark.read.parquet`` /
``spark.table``).  The test and bench data has none of them, so each input is
a view over the given tables (FIXTURES.md section 2).  Every view is lazy;
Catalyst pushes a query's day and market filters into these joins.

Every view covers its whole tables.  A customer with a negative balance has no
segment (a NULL one); the one ``%`` predicate adds genre rows (fan-out).
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fact-table names used in the load-status view and by ``load_watermark``.
STREAMS_SME = "streams_sme"
STREAMS_ORCHARD = "streams_orchard"
VIEWS_SME = "views_sme"
VIEWS_ORCHARD = "views_orchard"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _isrc(brand: Column, size: Column) -> Column:
    return F.concat(brand, F.lit("-"), size.cast("string"))


@dataclass(frozen=True)
class ChartInputs:
    """Named inputs of the chart job (schemas as in SURVEY section 1.4)."""

    streams: dict[str, DataFrame]  # feed -> fact_streams
    views: dict[str, DataFrame]  # feed -> fact_views
    dim_partner: DataFrame
    products_genre: DataFrame
    consumer_segments: DataFrame
    release_track_details: DataFrame
    catalog_tracks: DataFrame
    catalog_albums: DataFrame
    products: DataFrame
    product_releases: DataFrame
    dim_partner_tt: DataFrame
    load_status: DataFrame | None

    def with_load_status(self) -> "ChartInputs":
        return replace(self, load_status=load_status_of(self))


def load_status_of(inputs: ChartInputs) -> DataFrame:
    """The load-status view: newest day per (country, fact table)."""
    parts = [
        (STREAMS_SME, inputs.streams["SME"]),
        (STREAMS_ORCHARD, inputs.streams["ORCHARD"]),
        (VIEWS_SME, inputs.views["SME"]),
        (VIEWS_ORCHARD, inputs.views["ORCHARD"]),
    ]
    out = None
    for name, fact in parts:
        one = fact.groupBy("country_code").agg(F.max("report_date").alias("max_report_date")).select(
            "country_code", F.lit(name).alias("fact_table"), "max_report_date"
        )
        out = one if out is None else out.unionByName(one)
    return out


def _region_of(nation: DataFrame, region: DataFrame) -> DataFrame:
    # nation and region are fixed-size TPC-H dimensions (25 and 5 rows).
    return (
        nation.join(region, nation.n_regionkey == region.r_regionkey)
        .select("n_nationkey", "r_name")
    )


STREAM_COLUMNS = (
    "partner_info_key", "consumer_key", "num_streams", "report_date", "country_code_stream", "country_code", "source_type_key",
)
#: Line status -> feed.
_FEED_OF_STATUS = {"O": "SME", "F": "ORCHARD"}


def _with_region(df: DataFrame, nation_col: str, sf_dir: str) -> DataFrame:
    t = lambda name: read_table(df.sparkSession, sf_dir, name)
    nation_region = F.broadcast(_region_of(t("nation"), t("region")))
    return df.join(nation_region, F.col(nation_col) == nation_region.n_nationkey)


def segments_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_region(read_table(spark, sf_dir, "customer"), "c_nationkey", sf_dir).select(
        F.col("c_custkey").alias("consumer_key"), F.col("r_name").alias("country_code"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("segment_name"),
    )


def facts_view(spark: SparkSession, sf_dir: str, consumer_segments: DataFrame) -> DataFrame:
    """The streams of both feeds, with a ``feed`` column.

    An order's customer is found before its lines are, so the lines are shuffled once, by order, and narrow."""
    lineitem, orders = read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "orders")
    regions = consumer_segments.select("consumer_key", "country_code")
    located = orders.select("o_orderkey", "o_custkey").join(regions, F.col("o_custkey") == F.col("consumer_key"))
    supp_region = _with_region(read_table(spark, sf_dir, "supplier"), "s_nationkey", sf_dir).select(
        F.col("s_suppkey"), F.col("r_name").alias("country_code_stream"))
    feed = None
    for status, name in _FEED_OF_STATUS.items():
        feed = (F if feed is None else feed).when(F.col("l_linestatus") == status, F.lit(name))
    return (
        lineitem.select(
            "l_orderkey", "l_suppkey",
            F.col("l_partkey").alias("partner_info_key"),
            F.col("l_quantity").cast("bigint").alias("num_streams"),
            F.to_date(F.date_trunc("year", F.col("l_shipdate"))).alias("report_date"),
            F.col("l_linenumber").alias("source_type_key"),
            feed.alias("feed"),
        )
        .filter("feed is not null")
        .join(located, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(supp_region, F.col("l_suppkey") == F.col("s_suppkey"))
        .select("feed", *STREAM_COLUMNS)
    )


def chart_inputs(spark: SparkSession, sf_dir: str, consumer_segments: DataFrame | None = None) -> ChartInputs:
    """The inputs as views; ``consumer_segments``: that view as stored, so that joins with it are planned from its size."""
    t = lambda name: read_table(spark, sf_dir, name)
    lineitem, orders, part, events = t("lineitem"), t("orders"), t("part"), t("events")
    if consumer_segments is None:
        consumer_segments = segments_view(spark, sf_dir)
    facts = facts_view(spark, sf_dir, consumer_segments)

    isrc = _isrc(F.col("p_brand"), F.col("p_size"))
    dim_partner = part.select(
        F.col("p_partkey").alias("partner_info_key"),
        F.col("p_partkey").alias("product_key"),
        isrc.alias("track_isrc"),
        F.concat(
            F.lit("track:"), F.replace(F.col("p_name"), F.lit(" "), F.lit("-")),
            F.lit(":"), F.col("p_partkey").cast("string"),
        ).alias("track_uri"),
        F.col("p_name").alias("track_artists"),
        F.concat(F.col("p_type"), F.lit(" "), F.col("p_name")).alias("track_name"),
    )

    products_genre = part.select(
        F.col("p_partkey").alias("product_key"), F.col("p_type").alias("primary_genre")
    ).unionByName(
        part.filter(F.col("p_partkey") % 20 == 0).select(
            F.col("p_partkey").alias("product_key"),
            F.concat(F.lit("ALT "), F.col("p_type")).alias("primary_genre"),
        )
    )

    release_track_details = part.join(lineitem, F.col("p_partkey") == F.col("l_partkey")).select(
        isrc.alias("isrc"),
        F.col("p_type").alias("genre_name"),
        F.to_date(F.col("l_shipdate")).alias("release_date"),
    )
    catalog_tracks = part.select(isrc.alias("isrc"), F.col("p_partkey").alias("album_id"))
    catalog_albums = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_partkey").alias("album_id"), F.to_date(F.col("o_orderdate")).alias("release_date")
    )
    products = part.select(isrc.alias("isrc_cd"), F.col("p_partkey").alias("product_key"))
    product_releases = lineitem.select(
        F.col("l_partkey").alias("product_key"), F.to_date(F.col("l_shipdate")).alias("release_date")
    )

    view_rows = events.join(consumer_segments.select("consumer_key", "country_code"), F.col("user_id") == F.col("consumer_key"))

    def views(is_sme: bool) -> DataFrame:
        cond = F.col("event_type") == "view"
        return view_rows.filter(cond if is_sme else ~cond).select(
            F.get_json_object(F.col("props"), "$.k").cast("bigint").alias("partner_info_key"),
            F.round(F.col("value") * 100).cast("bigint").alias("creations"),
            "country_code",
            F.to_date(F.col("ts")).alias("report_date"),
        )

    dim_partner_tt = part.select(
        F.col("p_partkey").alias("partner_info_key"),
        isrc.alias("isrc_cd"),
        F.col("p_name").alias("artist_name"),
        F.concat(F.col("p_type"), F.lit(" "), F.col("p_name")).alias("track_title"),
    )

    streams_by_feed = {f: facts.filter(F.col("feed") == f).select(*STREAM_COLUMNS) for f in _FEED_OF_STATUS.values()}
    views_by_feed = {"SME": views(True), "ORCHARD": views(False)}
    return ChartInputs(
        streams=streams_by_feed,
        views=views_by_feed,
        dim_partner=dim_partner,
        products_genre=products_genre,
        consumer_segments=consumer_segments,
        release_track_details=release_track_details,
        catalog_tracks=catalog_tracks,
        catalog_albums=catalog_albums,
        products=products,
        product_releases=product_releases,
        dim_partner_tt=dim_partner_tt,
        load_status=None,
    ).with_load_status()


class StagedInputs:
    """``chart_inputs``, each written as Parquet when it is first asked for, and read back.

    The stand-ins are joins over the driver's tables; in production the same
    inputs are stored tables.  Facts are written in their layout, so a later
    day/market slice is a partition-pruned scan, the streams of both feeds in
    one pass over the lines; the rebalance splits a large day and market over
    as many tasks and files as its size asks for.  An input that no one asks
    for is not built, and a projection of one table is read where it is.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, base_path: str):
        self._spark, self._sf_dir, self._base = spark, sf_dir, base_path.rstrip("/")

    def _write(self, df: DataFrame, name: str, layout: tuple[str, ...] = ()) -> DataFrame:
        path = f"{self._base}/{name}"
        w = (df.hint("rebalance", *layout) if layout else df).write
        (w.partitionBy(*layout) if layout else w).parquet(path)
        return self._spark.read.parquet(path).select(*df.columns)

    @cached_property
    def _views(self) -> ChartInputs:
        return chart_inputs(self._spark, self._sf_dir, self.consumer_segments)

    @cached_property
    def consumer_segments(self) -> DataFrame:
        return self._write(segments_view(self._spark, self._sf_dir), "consumer_segments")

    @cached_property
    def streams(self) -> dict[str, DataFrame]:
        facts = facts_view(self._spark, self._sf_dir, self.consumer_segments)
        self._write(facts, "streams", ("feed", "report_date", "country_code_stream"))
        return {f: self._spark.read.parquet(f"{self._base}/streams/feed={f}").select(*STREAM_COLUMNS) for f in self._views.streams}

    @cached_property
    def views(self) -> dict[str, DataFrame]:
        return {
            f: self._write(df, f"views_{f.lower()}", ("report_date",)) for f, df in self._views.views.items()
        }

    @cached_property
    def release_track_details(self) -> DataFrame:
        return self._write(self._views.release_track_details, "release_track_details")

    @cached_property
    def catalog_albums(self) -> DataFrame:
        return self._write(self._views.catalog_albums, "catalog_albums")

    @cached_property
    def load_status(self) -> DataFrame:
        return self._write(load_status_of(self), "load_status")

    def stage(self) -> "StagedInputs":
        """Everything at once."""
        for name in ("consumer_segments", "streams", "views", "release_track_details", "catalog_albums", "load_status"):
            getattr(self, name)
        return self

    def __getattr__(self, name: str) -> DataFrame:
        if name in ("dim_partner", "products_genre", "catalog_tracks", "products", "product_releases", "dim_partner_tt"):
            return getattr(self._views, name)
        raise AttributeError(name)


# (application id, data folder) -> staged inputs of that session.
_STAGED: dict[tuple[str, str], StagedInputs] = {}


def staged_chart_inputs(spark: SparkSession, sf_dir: str, base_path_for: Callable[[SparkSession], str]) -> StagedInputs:
    """``chart_inputs``, each staged once per Spark application and data folder.

    ``base_path_for(spark)`` names a fresh folder in the shared scratch area.
    """
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    if key not in _STAGED:
        _STAGED[key] = StagedInputs(spark, sf_dir, base_path_for(spark))
    return _STAGED[key]
