"""Market charts: top tracks per feed, listener-segment shares, metadata.

All operators take and return DataFrames and handle any number of markets in
one plan: ``market`` is a grouping key and every top-k is a
``row_number() <= n`` per market (planned as a partial ``WindowGroupLimit``
before the shuffle, then the final limit).

Scale notes, for a fact of billions of rows per day:

* The day/market filter prunes partitions of a fact laid out by
  ``report_date, country_code_stream``.
* Facts are summed per join key *before* the dimension join (partial
  aggregation in the map tasks), so a hot track or consumer costs one row per
  map task, not one row per stream.
* Only tables of one row per market are broadcast explicitly; every other join
  is sized by Spark / AQE at run time, with a sort-merge join as the fallback.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartwright import defaults as D

DateLike = str | _dt.date


def _date(value: DateLike) -> Column:
    return F.lit(str(value)).cast("date")


def top_n(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    n: int,
    rank_col: str,
    split_by: Sequence[str] = (),
    buckets: int = 0,
) -> DataFrame:
    """Keep the first ``n`` rows per ``by`` group in ``order``; ``rank_col`` is 1-based.

    With ``buckets`` > 1, a hot group (one market holding a third of all
    rows) is cut in two levels: first the top ``n`` within each of
    ``buckets`` sub-groups by ``hash(split_by)``, then the top ``n`` of
    those.  Every row of the group's top ``n`` is in its sub-group's top
    ``n``, so the result is the same; the final window sees at most
    ``n * buckets`` rows per group instead of every row of the group.
    ``order`` must be total (end with a key) for the result to be unique.
    """
    if buckets > 1 and split_by:
        salt = F.pmod(F.hash(*[F.col(c) for c in split_by]), F.lit(buckets))
        sub = Window.partitionBy(*by, "_bucket").orderBy(*order)
        df = (
            df.withColumn("_bucket", salt)
            .withColumn("_sub_rank", F.row_number().over(sub))
            .filter(F.col("_sub_rank") <= n)
            .drop("_bucket", "_sub_rank")
        )
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def on_day(df: DataFrame, day: "DateLike | DataFrame", markets: Sequence[str], market_col: str) -> DataFrame:
    """Rows of ``markets`` on ``day``: one date for all, or a ``(market, day)``
    table with a day per market (e.g. each market's load watermark).

    The per-market form is a semi-join with a broadcast table of one row per
    market; on facts partitioned by date it also prunes partitions at run
    time (dynamic partition pruning).
    """
    rows = df.filter(F.col(market_col).isin(list(markets)))
    if isinstance(day, DataFrame):
        days = F.broadcast(day.select(F.col("market").alias(market_col), F.col("day").alias("report_date")))
        return rows.join(days, [market_col, "report_date"], "left_semi")
    return rows.filter(F.col("report_date") == _date(day))


def track_streams(streams: DataFrame, day: "DateLike | DataFrame", markets: Sequence[str]) -> DataFrame:
    """Streams of one day per (market, track key).

    Summed in the map tasks before the shuffle, so a hot track costs one row
    per task; consumers do not reach this shuffle.
    """
    return (
        on_day(streams, day, markets, "country_code_stream")
        .groupBy(F.col("country_code_stream").alias("market"), "partner_info_key")
        .agg(F.sum("num_streams").alias("streams"))
    )


# --- C1 lives in chartwright.streaming.watermark --------------------------------


def top_tracks(
    per_key: DataFrame,
    dim_partner: DataFrame,
    n: int,
    products_genre: DataFrame | None = None,
    buckets: int = D.TOP_K_BUCKETS,
) -> DataFrame:
    """Top ``n`` ISRCs per market by summed streams of the day.

    ``per_key`` is the output of ``track_streams``.
    With ``products_genre`` (feed SME) the genre view is joined *before* the
    sum, so a product with several genre rows counts its streams once per
    genre row (J2).  Ties are broken by ISRC (ascending), NULL totals rank last.

    Only numbers are summed and cut; the attributes, independent ``min``s per
    column (A2), are then taken for the listed ISRCs alone.
    """
    rows = per_key.join(dim_partner.select("partner_info_key", "product_key", "track_isrc"), "partner_info_key")
    if products_genre is not None:
        rows = rows.join(products_genre.select("product_key"), "product_key")
    per_isrc = rows.groupBy("market", "track_isrc").agg(F.sum("streams").alias("total_streams"))
    top = top_n(
        per_isrc,
        ["market"],
        [F.desc_nulls_last("total_streams"), F.asc_nulls_last("track_isrc")],
        n,
        "top_rank",
        split_by=["track_isrc"],
        buckets=buckets,
    )
    attrs = [
        F.min("track_uri").alias("_track_uri"),
        F.min("track_artists").alias("_track_artist"),
        F.min("track_name").alias("_track_name"),
    ]
    heard = (
        dim_partner.withColumnRenamed("track_isrc", "_isrc")
        .join(top.select("market", "track_isrc"), F.col("_isrc").eqNullSafe(F.col("track_isrc")))
        .join(per_key.select("market", "partner_info_key"), ["market", "partner_info_key"], "left_semi")
    )
    if products_genre is not None:
        heard = heard.join(products_genre, "product_key")
        attrs.append(F.min("primary_genre").alias("_primary_genre"))
    else:
        attrs.append(F.min(F.lit(None).cast("string")).alias("_primary_genre"))
    described = heard.groupBy(F.col("market").alias("_market"), F.col("_isrc")).agg(*attrs)
    return top.join(
        described, (F.col("market") == F.col("_market")) & F.col("track_isrc").eqNullSafe(F.col("_isrc"))
    ).select(
        "market", "top_rank", "track_isrc", "_track_uri", "_track_artist", "_track_name",
        "_primary_genre", "total_streams",
    )


def release_genres(release_track_details: DataFrame) -> DataFrame:
    """A4: one genre per ISRC, ``min(genre_name)``."""
    return release_track_details.groupBy(F.col("isrc").alias("track_isrc")).agg(
        F.min("genre_name").alias("_primary_genre")
    )


def with_release_genre(top: DataFrame, genres: DataFrame) -> DataFrame:
    """Left join of a pre-aggregated genre (no fan-out) onto a top list."""
    return (
        top.drop("_primary_genre")
        .join(genres, "track_isrc", "left")
        .select(
            "market", "top_rank", "track_isrc", "_track_uri", "_track_artist", "_track_name",
            "_primary_genre", "total_streams",
        )
    )


def segment_streams(
    streams: DataFrame,
    day: "DateLike | DataFrame",
    markets: Sequence[str],
    dim_partner: DataFrame,
    top: DataFrame,
    consumer_segments: DataFrame,
) -> DataFrame:
    """C4: streams per (market, ISRC, listener segment) for the top ISRCs.

    Consumers without a segment row form the NULL segment; a consumer with
    several segment rows counts in each (J4).  The day's facts are joined with
    the top list's track keys (at most ``n`` ISRCs per market; the engine picks
    the join from its size) before anything is shuffled by consumer, and summed
    per consumer and ISRC, which bounds a hot consumer to one row per top track
    and task.
    """
    keys = (
        dim_partner.select("partner_info_key", "track_isrc")
        .join(top.select("market", "track_isrc"), "track_isrc")
        .select("market", "partner_info_key", "track_isrc")
    )
    per_consumer = (
        on_day(streams, day, markets, "country_code_stream")
        .select(F.col("country_code_stream").alias("market"), "partner_info_key", "consumer_key", "country_code", "num_streams")
        .join(keys, ["market", "partner_info_key"])
        .groupBy("market", "track_isrc", "consumer_key", "country_code")
        .agg(F.sum("num_streams").alias("streams"))
    )
    per_segment = (
        per_consumer.join(consumer_segments, ["consumer_key", "country_code"], "left")
        .groupBy("market", "track_isrc", "segment_name")
        .agg(F.sum("streams").alias("segment_streams"))
    )
    attrs = top.select(
        "market", "track_isrc", "_track_uri", "_track_artist", "_track_name", "_primary_genre",
        "total_streams",
    )
    return per_segment.join(attrs, ["market", "track_isrc"]).select(
        "market", "track_isrc", "segment_name", "_track_uri", "_track_artist", "_track_name",
        "_primary_genre", "segment_streams", "total_streams",
    )


def best_cover(
    streams: DataFrame,
    dim_partner: DataFrame,
    run_date: DateLike,
    home_market: str = D.HOME_MARKET,
    sources: Sequence[int] = D.COVER_SOURCES,
    days: int = D.COVER_DAYS,
    isrcs: DataFrame | None = None,
) -> DataFrame:
    """Per ISRC the URI with the most streams in the home market over the
    last ``days`` days up to ``run_date``, from the given source types.

    ``isrcs`` (``track_isrc``; a feed's top list) restricts the count to the
    track keys that can be used.

    Order as in the original ``ROW_NUMBER() ... ORDER BY sum DESC``: a NULL
    sum ranks first; ties go to the smallest URI.
    """
    per_key = (
        streams.filter(
            (F.col("country_code") == home_market)
            & F.col("source_type_key").isin(list(sources))
            & F.col("report_date").between(F.date_sub(_date(run_date), days), _date(run_date))
        )
        .groupBy("partner_info_key")
        .agg(F.sum("num_streams").alias("streams"))
    )
    dim = dim_partner.select("partner_info_key", "track_isrc", "track_uri")
    if isrcs is not None:
        dim = dim.join(isrcs.select("track_isrc").distinct(), "track_isrc", "left_semi")
    per_uri = (
        per_key.join(dim, "partner_info_key")
        .groupBy("track_isrc", "track_uri")
        .agg(F.sum("streams").alias("cover_streams"))
    )
    return top_n(
        per_uri,
        ["track_isrc"],
        [F.desc_nulls_first("cover_streams"), F.asc_nulls_last("track_uri")],
        1,
        "cover_no",
    ).select("track_isrc", F.col("track_uri").alias("track_uri_fs"), "cover_streams")


def feed_tracks(segments: DataFrame, covers: DataFrame, feed: str) -> DataFrame:
    """Segment rows with the best cover URI (else the top list's URI)."""
    return segments.join(covers.select("track_isrc", "track_uri_fs"), "track_isrc", "left").select(
        "market", "track_isrc", "segment_name",
        F.coalesce("track_uri_fs", "_track_uri").alias("_track_uri"),
        "_track_artist", "_track_name", "_primary_genre", "segment_streams", "total_streams",
        F.lit(feed).alias("feed"),
    )


def _feed_priority(feeds: Sequence[str] = D.FEEDS) -> Column:
    expr = F.lit(len(feeds))
    for i, feed in reversed(list(enumerate(feeds))):
        expr = F.when(F.col("feed") == feed, F.lit(i)).otherwise(expr)
    return expr


def track_metadata(tracks: DataFrame, feeds: Sequence[str] = D.FEEDS) -> DataFrame:
    """One row per (market, ISRC); the first feed in ``feeds`` wins.

    Within one feed the kept columns are constant per ISRC, so the row taken
    from the winning feed does not matter.
    """
    cols = ["_track_uri", "_track_artist", "_track_name", "_primary_genre", "total_streams", "feed"]
    best = tracks.groupBy("market", "track_isrc").agg(
        F.min_by(F.struct(*cols), _feed_priority(feeds)).alias("m")
    )
    return best.select("market", "track_isrc", *[F.col(f"m.{c}").alias(c) for c in cols])


def earliest_release(
    isrcs: DataFrame,
    catalog_tracks: DataFrame,
    catalog_albums: DataFrame,
    products: DataFrame,
    product_releases: DataFrame,
    release_track_details: DataFrame,
) -> DataFrame:
    """Earliest release date per ISRC over three catalogues.

    ``isrcs`` (a chart's ISRCs, bounded by the top-k limits) is semi-joined
    into each catalogue before its lookup join, so only the chart's catalogue
    rows reach that join.  The minimum of the three
    per-source minima is one ``min`` over their union.
    """
    keys = isrcs.select("track_isrc").distinct()
    albums = (
        catalog_tracks.join(keys, catalog_tracks.isrc == keys.track_isrc, "left_semi")
        .join(catalog_albums, "album_id")
        .select(F.col("isrc").alias("track_isrc"), "release_date")
    )
    releases = (
        products.join(keys, products.isrc_cd == keys.track_isrc, "left_semi")
        .join(product_releases, "product_key")
        .select(F.col("isrc_cd").alias("track_isrc"), "release_date")
    )
    details = release_track_details.join(
        keys, release_track_details.isrc == keys.track_isrc, "left_semi"
    ).select(F.col("isrc").alias("track_isrc"), "release_date")
    return (
        albums.unionByName(releases)
        .unionByName(details)
        .groupBy("track_isrc")
        .agg(F.min("release_date").alias("release_date"))
    )


def segment_shares(tracks: DataFrame, segments: Sequence[str]) -> DataFrame:
    """Listener-segment shares per (market, ISRC), both feeds together.

    For each pinned segment: percent of the streams with a known segment
    (segments outside the pinned list still count in that denominator).
    ``share_of_none_values``: fraction (0..1) of all streams with a NULL
    segment.  An ISRC with no known-segment row, or a zero denominator, gets
    NULL, never NaN.  One hash aggregate with conditional sums replaces the
    pivot, so there is no extra pass to find pivot values.
    """
    seg, n = F.col("segment_name"), F.col("segment_streams")
    aggs = [F.sum(F.when(seg == s, n)).alias(f"_s{i}") for i, s in enumerate(segments)]
    sums = tracks.groupBy("market", "track_isrc").agg(
        *aggs,
        F.count(seg).alias("_known_rows"),
        F.sum(F.when(seg.isNotNull(), n)).alias("_known"),
        F.sum(F.when(seg.isNull(), n)).alias("_none"),
        F.sum(n).alias("_all"),
    )
    has_known = F.col("_known_rows") > 0
    shares = [
        F.when(has_known, F.try_divide(F.coalesce(F.col(f"_s{i}"), F.lit(0)), F.col("_known")) * 100)
        .cast("double")
        .alias(s)
        for i, s in enumerate(segments)
    ]
    return sums.select(
        "market", "track_isrc", *shares,
        F.try_divide(F.coalesce(F.col("_none"), F.lit(0)), F.col("_all"))
        .cast("double")
        .alias("share_of_none_values"),
    )


#: Segments that a pivot may find; each is a column.
MAX_SEGMENTS = 200


class TooManySegmentsError(ValueError):
    """A pivot would have more columns than its bound."""


def found_segments(tracks: DataFrame, most: int = MAX_SEGMENTS) -> list[str]:
    """The segments that occur, in order; an error beyond ``most`` (at most one name more is fetched)."""
    names = tracks.select("segment_name").filter("segment_name is not null").distinct().limit(most + 1).collect()
    if len(names) > most:
        raise TooManySegmentsError(f"more than {most} segments")
    return sorted(r[0] for r in names)


def segment_pivot(tracks: DataFrame, most: int = MAX_SEGMENTS) -> DataFrame:
    """A7 with the columns that the data has: streams per (market, ISRC), one column for each segment that occurs.

    Two phases: a bounded distinct finds the columns, a pivot with known values
    (one aggregate) fills them.  An ISRC without rows of a segment has NULL there.
    """
    names = found_segments(tracks, most)
    if not names:
        return tracks.select("market", "track_isrc").distinct()
    return tracks.groupBy("market", "track_isrc").pivot("segment_name", names).agg(F.sum("segment_streams"))


def chart(metadata: DataFrame, shares: DataFrame, releases: DataFrame) -> DataFrame:
    """Metadata + release date + shares, ranked by total streams.

    ``chart_rank`` is 1-based per market; ties go to the smaller ISRC.  The
    per-market window holds at most the two top-k limits of rows.
    """
    joined = metadata.join(shares, ["market", "track_isrc"]).join(releases, "track_isrc", "left")
    share_cols = [c for c in shares.columns if c not in ("market", "track_isrc")]
    ranked = joined.withColumn(
        "chart_rank",
        F.row_number().over(
            Window.partitionBy("market").orderBy(
                F.desc_nulls_last("total_streams"), F.asc_nulls_last("track_isrc")
            )
        ),
    )
    return ranked.select(
        "market", "chart_rank", "track_isrc", "_track_uri", "_track_artist", "_track_name",
        "_primary_genre", "total_streams", "feed", "release_date", *share_cols,
    )
