"""Short-video chart and its fuzzy match with the streaming chart.

``fuzzy_match_tracks`` keeps a (chart row, short-video row) pair when

    (cos(name) >= t_name AND cos(artist) >= t_artist) OR track_isrc = isrc_cd

with ``cos`` the cosine of character-count vectors.  The original evaluates
the predicate on every pair of a cross join.  Here the ``OR`` is split into
two joins whose union is exactly the set of pairs that can satisfy it:

1. an equi-join on the ISRC (hash join);
2. a similarity join by *prefix filtering* (Bayardo, Ma, Srikant, "Scaling
   Up All Pairs Similarity Search", WWW 2007) over the distinct (name, artist)
   texts of a market.  Fix one order of characters (rare ones first).  For a
   vector x split into a prefix p and a suffix s with ``|s| < t |x|``,
   ``x.y <= p.y + |s| |y|``, so ``cos >= t`` forces ``p.y > 0``; with both
   sides cut by the same order, the two prefixes must share a character.  Both
   the name and the artist condition must hold, so candidates share a
   (name-prefix char, artist-prefix char) key.

A pair comes out of that join once, at its first shared key, and only if
``p.y + |s| |y outside p's characters|`` can still reach the threshold for name
and artist; then the exact predicate decides.  Rows and their texts are attached
to the texts that match.  No pair above the thresholds is lost.

Neither side is broadcast on the assumption of smallness: Spark / AQE size the
joins at run time, and AQE splits a skewed join partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartwright import defaults as D
from chartwright.functions.text import char_counts, cosine, let, squared_norm
from chartwright.operators.charts import DateLike, on_day, top_n

# Make the prefix a little longer than the exact bound so that pairs whose
# floating-point cosine lands on the threshold are never pruned.
_PREFIX_SLACK = 1e-9


def short_video_top(
    views: DataFrame,
    dim_partner_tt: DataFrame,
    day: "DateLike | DataFrame",
    markets: Sequence[str],
    n: int,
    feed: str,
    buckets: int = D.TOP_K_BUCKETS,
) -> DataFrame:
    """C11: top ``n`` ISRCs per market by summed creations on ``day``.

    A NULL ISRC is a group of its own and may rank.  Ties: ISRC ascending.
    """
    per_key = (
        on_day(views, day, markets, "country_code")
        .groupBy(F.col("country_code").alias("market"), "partner_info_key")
        .agg(F.sum("creations").alias("creations"))
    )
    per_isrc = (
        per_key.join(dim_partner_tt, "partner_info_key")
        .groupBy("market", "isrc_cd")
        .agg(
            F.min("artist_name").alias("_artist_name_tt"),
            F.min("track_title").alias("_track_name_tt"),
            F.sum("creations").alias("tt_creations"),
        )
    )
    return top_n(
        per_isrc, ["market"], [F.desc_nulls_last("tt_creations"), F.asc_nulls_last("isrc_cd")], n, "tt_rank",
        split_by=["isrc_cd"], buckets=buckets,
    ).select(
        "market", F.lit(feed).alias("feed"), "tt_rank", "isrc_cd", "_artist_name_tt", "_track_name_tt",
        "tt_creations",
    )


# The order of characters: those not listed come first (by code point), then
# these, from rare to common.  Any fixed order is exact; this one is selective.
COMMON_LAST = "zqxjkvbpygfwmucldrhsnioate "


def prefix(vec: Column, threshold: float) -> Column:
    """``struct(p, s2)`` of a count map: the prefix entries ``(r, ch, c)`` in
    character order and the squared mass of the suffix.

    Entry i belongs to the prefix while the squared mass from i to the end is
    at least ``t^2`` of the squared norm.
    """
    t = threshold - _PREFIX_SLACK
    ranked = F.array_sort(F.transform(
        F.map_entries(vec),
        lambda e: F.struct(F.position(e["key"], F.lit(COMMON_LAST)).alias("r"), e["key"].alias("ch"), e["value"].alias("c")),
    ))

    def mass(entries: Column) -> Column:
        return F.aggregate(entries, F.lit(0).cast("bigint"), lambda acc, x: acc + x["c"] * x["c"])

    def cut(entries: Column, norm2: Column) -> Column:
        kept = F.filter(entries, lambda e, i: (norm2 - mass(F.slice(entries, 1, i))) >= F.lit(t * t) * norm2)
        return let(kept, lambda p: F.struct(p.alias("p"), (norm2 - mass(p)).alias("s2")))

    return let(ranked, lambda entries: let(squared_norm(vec), lambda norm2: cut(entries, norm2)))


def _reachable(x: Column, x_norm2: Column, y: Column, y_norm2: Column, threshold: float) -> Column:
    """Whether cos(x, y) can reach the threshold, from x's prefix and y's counts on its characters."""
    at = lambda e: F.coalesce(F.try_element_at(y, e["ch"]), F.lit(0).cast("bigint"))
    shared = F.aggregate(x["p"], F.lit(0).cast("bigint"), lambda acc, e: acc + e["c"] * at(e))
    there = F.aggregate(x["p"], F.lit(0).cast("bigint"), lambda acc, e: acc + at(e) * at(e))
    most = shared + F.sqrt(x["s2"]) * F.sqrt(y_norm2 - there)
    return most >= F.lit(threshold - _PREFIX_SLACK) * F.sqrt(x_norm2) * F.sqrt(y_norm2)


def _texts(rows: DataFrame, name: str, artist: str, side: str, t_name: float, t_artist: float) -> DataFrame:
    """Distinct texts of a market with their vectors, prefixes and keys."""
    v = rows.select("market", F.col(name).alias("name"), F.col(artist).alias("artist")).dropna().distinct().select(
        "*", char_counts("name").alias("nv"), char_counts("artist").alias("av")
    ).select("*", squared_norm(F.col("nv")).alias("nn"), squared_norm(F.col("av")).alias("an"),
             prefix(F.col("nv"), t_name).alias("np"), prefix(F.col("av"), t_artist).alias("ap"))
    names, artists = F.transform("np.p", lambda e: e["ch"]), F.transform("ap.p", lambda e: e["ch"])
    keyed = v.select("*", names.alias("nc"), artists.alias("ac")).select(
        "*", F.explode("nc").alias("kn")).select("*", F.explode("ac").alias("ka"))
    return keyed.select(*[F.col(c).alias(f"{side}_{c}") for c in keyed.columns])


def candidate_texts(chart_rows: DataFrame, short_video: DataFrame, name_threshold: float, artist_threshold: float) -> DataFrame:
    """Pairs of distinct (name, artist) texts that may match, each once."""
    left = _texts(chart_rows, "_track_name", "_track_artist", "l", name_threshold, artist_threshold)
    right = _texts(short_video, "_track_name_tt", "_artist_name_tt", "r", name_threshold, artist_threshold)
    c = F.col
    return left.join(
        right,
        (c("l_market") == c("r_market")) & (c("l_kn") == c("r_kn")) & (c("l_ka") == c("r_ka"))
        & (F.array_intersect("l_nc", "r_nc")[0] == c("l_kn")) & (F.array_intersect("l_ac", "r_ac")[0] == c("l_ka"))
        & _reachable(c("l_ap"), c("l_an"), c("r_av"), c("r_an"), artist_threshold)
        & _reachable(c("r_ap"), c("r_an"), c("l_av"), c("l_an"), artist_threshold)
        & _reachable(c("l_np"), c("l_nn"), c("r_nv"), c("r_nn"), name_threshold)
        & _reachable(c("r_np"), c("r_nn"), c("l_nv"), c("l_nn"), name_threshold),
    )


def fuzzy_match_tracks(
    chart_rows: DataFrame,
    short_video: DataFrame,
    name_threshold: float,
    artist_threshold: float,
) -> DataFrame:
    """Chart rows x short-video rows that match by name+artist or ISRC.

    ``chart_rows``: ``market, chart_rank, track_isrc, _track_uri,
    _track_artist, _track_name, ...``; ``short_video``: output of
    ``short_video_top`` for one or more feeds.  Returns one row per matching
    pair with both similarities.
    """
    for t in (name_threshold, artist_threshold):
        if not 0.0 < t <= 1.0:
            raise ValueError("similarity thresholds must be in (0, 1]")
    left = chart_rows.select("market", "chart_rank", "track_isrc", "_track_uri", "_track_artist", "_track_name")
    right = short_video.select(
        F.col("market").alias("r_market"), F.col("feed").alias("tt_feed"), "tt_rank", "isrc_cd",
        "_artist_name_tt", "_track_name_tt", "tt_creations",
    )
    texts = (
        candidate_texts(chart_rows, short_video, name_threshold, artist_threshold)
        .select(
            "l_market", "l_name", "l_artist", "r_name", "r_artist",
            cosine(F.col("l_nv"), F.col("r_nv"), F.col("l_nn"), F.col("r_nn")).alias("sim_name"),
            cosine(F.col("l_av"), F.col("r_av"), F.col("l_an"), F.col("r_an")).alias("sim_artist"),
        )
        .filter((F.col("sim_name") >= name_threshold) & (F.col("sim_artist") >= artist_threshold))
    )
    same_isrc = F.coalesce(F.col("track_isrc") == F.col("isrc_cd"), F.lit(False))
    by_text = (
        left.join(texts, (F.col("market") == F.col("l_market")) & (F.col("_track_name") == F.col("l_name"))
                  & (F.col("_track_artist") == F.col("l_artist")))
        .join(right, (F.col("market") == F.col("r_market")) & (F.col("_track_name_tt") == F.col("r_name"))
              & (F.col("_artist_name_tt") == F.col("r_artist")))
        .filter(~same_isrc)     # those come from the other branch
    )
    by_isrc = left.join(right, (F.col("market") == F.col("r_market")) & (F.col("track_isrc") == F.col("isrc_cd"))).select(
        "*",
        cosine(char_counts("_track_name"), char_counts("_track_name_tt")).alias("sim_name"),
        cosine(char_counts("_track_artist"), char_counts("_artist_name_tt")).alias("sim_artist"),
    )
    cols = [
        "market", "chart_rank", "track_isrc", "_track_uri", "_track_artist", "_track_name",
        "tt_feed", "tt_rank", "isrc_cd", "_artist_name_tt", "_track_name_tt", "tt_creations",
        "sim_name", "sim_artist",
    ]
    return by_text.select(*cols).unionByName(by_isrc.select(*cols))


__all__ = ["short_video_top", "prefix", "candidate_texts", "fuzzy_match_tracks"]
