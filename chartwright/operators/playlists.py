"""Playlists: themed selections from a chart, artist declumping, batches.

A playlist is a long table ``market, playlist, position, ...`` (position is
1-based).  All lists of all markets are built in one plan: rules are data
(name, predicate, passes), each chart row is tagged with the lists it
qualifies for, and every window is partitioned by ``(market, playlist)``,
whose size is bounded by the list length.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartwright import defaults as D
from chartwright.functions.text import artist_tokens, tokens_overlap
from chartwright.operators.charts import DateLike, _date, top_n

LIST_KEY = ("market", "playlist")


@dataclass(frozen=True)
class PlaylistRule:
    name: str
    predicate: Column | None  # None: every chart row qualifies
    passes: int = D.DECLUMP_PASSES


def _gt(col: str, value: float) -> Column:
    return F.coalesce(F.col(col) > F.lit(value), F.lit(False))


def uri_matches(pattern: str, text_col: str = "_track_uri") -> Column:
    """Case-insensitive regex *contains*; NULL text never matches."""
    return F.coalesce(F.col(text_col).rlike(f"(?i){pattern}"), F.lit(False))


def released_before(run_date: DateLike, days: int = D.CATALOGUE_AGE_DAYS) -> Column:
    """Released at least ``days`` days before ``run_date``; NULL is out."""
    return F.coalesce(F.col("release_date") <= F.date_sub(_date(run_date), days), F.lit(False))


def theme_rules(p) -> list[PlaylistRule]:
    """C14-C18 with the given parameters (see ``plans.daily.ChartParams``)."""
    rap, edm = p.rap_segment, p.edm_segment
    return [
        PlaylistRule("top", None, p.passes),
        PlaylistRule("rap", _gt(rap, D.RAP_SHARE_MIN) | uri_matches(p.rap_pattern), p.passes),
        PlaylistRule(
            "gaming",
            _gt(edm, D.GAMING_EDM_MIN)
            | (_gt(rap, D.GAMING_RAP_MIN) & _gt(edm, D.GAMING_EDM_FLOOR))
            | uri_matches(p.gaming_pattern),
            p.gaming_passes,
        ),
        PlaylistRule("party", _gt(edm, D.PARTY_EDM_MIN) | uri_matches(p.party_pattern), p.passes),
        PlaylistRule("catalogue", released_before(p.catalogue_run_date), p.passes),
    ]


def select_playlists(chart: DataFrame, rules: Sequence[PlaylistRule], length: int = D.PLAYLIST_LENGTH) -> DataFrame:
    """The first ``length`` qualifying chart rows per (market, rule).

    One scan of the chart tags each row with the rules it passes; the cut
    per list is a ``row_number`` in chart order.
    """
    tags = [
        F.when(r.predicate if r.predicate is not None else F.lit(True),
               F.struct(F.lit(r.name).alias("name"), F.lit(r.passes).alias("passes")))
        for r in rules
    ]
    tagged = chart.select("*", F.explode(F.filter(F.array(*tags), lambda x: x.isNotNull())).alias("_rule"))
    tagged = tagged.select(
        "*", F.col("_rule.name").alias("playlist"), F.col("_rule.passes").alias("passes")
    ).drop("_rule")
    return top_n(tagged, list(LIST_KEY), [F.asc("chart_rank")], length, "position")


def declump(lists: DataFrame, passes: int, artist_col: str = "_track_artist") -> DataFrame:
    """Spread out neighbouring tracks that share an artist token.

    One pass compares each row with the row before it *before the pass*; a
    row that shares a token moves from position i to i + 2.5, then the list
    is re-numbered.  A row's ``passes`` column (default: ``passes``) limits
    how many of the passes apply to its list, so lists with different
    settings share one plan.  All windows use the same partitioning, so the
    passes add sorts but no shuffles.
    """
    if "passes" not in lists.columns:
        lists = lists.withColumn("passes", F.lit(passes))
    w = Window.partitionBy(*LIST_KEY).orderBy("position")
    out = lists.withColumn("_tokens", artist_tokens(F.col(artist_col)))
    for k in range(1, passes + 1):
        hit = tokens_overlap(F.col("_tokens"), F.lag("_tokens").over(w)) & (F.col("passes") >= k)
        out = out.withColumn(
            "_key", F.when(hit, F.col("position") + 2.5).otherwise(F.col("position").cast("double"))
        )
        out = out.withColumn(
            "position", F.row_number().over(Window.partitionBy(*LIST_KEY).orderBy("_key"))
        ).drop("_key")
    return out.drop("_tokens")


def viral_selection(pairs: DataFrame, length: int = D.PLAYLIST_LENGTH, passes: int = D.DECLUMP_PASSES,
                    feeds: Sequence[str] = D.FEEDS) -> DataFrame:
    """C19 before declumping: distinct by URI, then most creations first.

    A14: per (market, URI) the first pair in pair order wins (best chart
    rank, then short-video order: feed priority, then rank), not the pair
    with the most creations.  T5: order by creations, ties by chart rank.
    """
    prio = F.lit(len(feeds))
    for i, feed in reversed(list(enumerate(feeds))):
        prio = F.when(F.col("tt_feed") == feed, F.lit(i)).otherwise(prio)
    payload = ["track_isrc", "_track_artist", "_track_name", "isrc_cd", "tt_creations"]
    first = pairs.withColumn("tt_prio", prio).groupBy("market", "_track_uri").agg(
        F.min(F.struct("chart_rank", "tt_prio", "tt_rank", "tt_feed", *payload)).alias("p")
    )
    flat = first.select(
        "market", "_track_uri",
        *[F.col(f"p.{c}").alias(c) for c in ["chart_rank", "tt_feed", "tt_rank", *payload]],
    ).withColumn("playlist", F.lit("viral")).withColumn("passes", F.lit(passes))
    return top_n(
        flat, list(LIST_KEY), [F.desc_nulls_last("tt_creations"), F.asc("chart_rank")], length, "position"
    )


def playlist_batches(lists: DataFrame, as_of: "DateLike | Column", batch_size: int = D.BATCH_SIZE,
                     uri_col: str = "_track_uri") -> DataFrame:
    """Publish calls of up to ``batch_size`` URIs per list.

    ``as_of``: the data date, or a column of ``lists`` with it.

    The original sends the last batch first and inserts each at position 0,
    so the final list is in list order; ``send_order`` 0 is sent first.  Each
    batch collects at most ``batch_size`` URIs.
    """
    batch_no = F.floor((F.col("position") - 1) / batch_size).cast("int")
    as_of_col = as_of if isinstance(as_of, Column) else _date(as_of)
    per_batch = lists.groupBy(*LIST_KEY, batch_no.alias("batch_no")).agg(
        F.sort_array(F.collect_list(F.struct("position", uri_col))).alias("_items"),
        F.max(as_of_col).alias("_as_of"),
    )
    n_batches = F.max("batch_no").over(Window.partitionBy(*LIST_KEY))
    return per_batch.select(
        *LIST_KEY,
        "batch_no",
        (n_batches - F.col("batch_no")).cast("int").alias("send_order"),
        F.lit(0).alias("insert_at"),
        F.transform("_items", lambda x: x[uri_col]).alias("uris"),
        F.size("_items").alias("n_uris"),
        playlist_description(F.col("_as_of")).alias("description"),
    )


def playlist_description(as_of: "DateLike | Column") -> Column:
    """F16 + F5: the list description, e.g. ``Dane na dzien 2024-01-07``."""
    day = as_of if isinstance(as_of, Column) else _date(as_of)
    return F.concat(F.lit(D.DESCRIPTION_PREFIX), F.date_format(day, "yyyy-MM-dd"))
