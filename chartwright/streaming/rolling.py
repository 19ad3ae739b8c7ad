"""The best-cover window kept as daily sums instead of read anew each day.

The state holds, per track key, the streams and the rows of the current window.
To move on, the days that enter are summed and added, the days that leave are
summed and subtracted: of a window of any length only those days' partitions are
read.  Sums are of whole numbers, so adding and subtracting leaves nothing behind.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartwright import defaults as D
from chartwright.operators.charts import top_n
from chartwright.plans.session import materialize

STATE = ("partner_info_key", "streams", "n_values", "n_rows")


class WindowStateError(ValueError):
    """A window cannot move back, or its state does not fit it."""


@dataclass(frozen=True)
class CoverWindow:
    """What counts: rows of the home market and the sources, on ``days`` days up to the run date, both ends included."""

    home_market: str = D.HOME_MARKET
    sources: Sequence[int] = D.COVER_SOURCES
    days: int = D.COVER_DAYS

    def _sums(self, streams: DataFrame, first: date, last: date, sign: int) -> DataFrame:
        """Sums per track key of the days first..last, with a sign."""
        rows = streams.filter(
            (F.col("country_code") == self.home_market) & F.col("source_type_key").isin(list(self.sources))
            & F.col("report_date").between(F.lit(first), F.lit(last)))
        return rows.groupBy("partner_info_key").agg(
            (F.coalesce(F.sum("num_streams"), F.lit(0)) * sign).alias("streams"),
            (F.count("num_streams") * sign).alias("n_values"), (F.count("*") * sign).alias("n_rows"))

    def start(self, streams: DataFrame, run_date: date) -> DataFrame:
        """The state of the window up to ``run_date``, from all its days."""
        return self._sums(streams, run_date - timedelta(days=self.days), run_date, 1).select(*STATE)

    def advance(self, state: DataFrame, streams: DataFrame, old: date, new: date) -> DataFrame:
        """The state of the window up to ``new``, from the one up to ``old`` and the days that enter and leave."""
        if new < old:
            raise WindowStateError(f"the window up to {old} cannot move back to {new}")
        if (new - old).days > self.days:  # nothing of the old window stays
            return self.start(streams, new)
        if new == old:
            return state
        back = timedelta(days=self.days)
        entering = self._sums(streams, old + timedelta(days=1), new, 1)
        leaving = self._sums(streams, old - back, new - back - timedelta(days=1), -1)
        moved = state.select(*STATE).unionByName(entering).unionByName(leaving).groupBy("partner_info_key").agg(
            *[F.sum(c).alias(c) for c in STATE[1:]])
        return moved.filter("n_rows > 0").select(*STATE)

    def covers(self, state: DataFrame, dim_partner: DataFrame) -> DataFrame:
        """Per ISRC the URI with the most streams in the window (as ``best_cover``: a NULL sum first, ties by URI)."""
        per_key = state.select("partner_info_key", F.when(F.col("n_values") > 0, F.col("streams")).alias("streams"))
        per_uri = per_key.join(dim_partner.select("partner_info_key", "track_isrc", "track_uri"), "partner_info_key").groupBy(
            "track_isrc", "track_uri").agg(F.sum("streams").alias("cover_streams"))
        order = [F.desc_nulls_first("cover_streams"), F.asc_nulls_last("track_uri")]
        return top_n(per_uri, ["track_isrc"], order, 1, "cover_no").select("track_isrc", F.col("track_uri").alias("track_uri_fs"), "cover_streams")

    def backfill(self, streams: DataFrame, dim_partner: DataFrame, run_dates: Sequence[date]) -> DataFrame:
        """Covers (run_date, ...) of several run dates in order; each state is written and read by the next."""
        state, at, out = None, None, None
        for day in run_dates:
            moved = self.start(streams, day) if state is None else self.advance(state, streams, at, day)
            state, at = materialize(moved, "cover-window"), day
            own = self.covers(state, dim_partner).withColumn("run_date", F.lit(day))
            out = own if out is None else out.unionByName(own)
        if out is None:
            raise WindowStateError("no run date")
        return out.select("run_date", "track_isrc", "track_uri_fs", "cover_streams")
