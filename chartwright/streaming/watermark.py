"""The newest day that every listed fact table has fully loaded.

The original job has no Structured Streaming; its only guard against late
data is this load watermark over a load-status view.  It is a small batch
aggregate (one row per market and table), kept here as the place where
"how late is the data" is decided.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class WatermarkError(RuntimeError):
    """A market has no load-status row for the requested tables."""


def load_watermark(
    load_status: DataFrame,
    tables: Sequence[str],
    markets: Sequence[str],
    strict: bool = False,
) -> DataFrame:
    """``min(max_report_date)`` per market over ``tables``.

    A table without a status row does not hold the watermark back (as in the
    original); with ``strict=True`` the watermark is NULL unless every
    listed table has a row.  Returns ``market, watermark, n_tables``.
    """
    rows = load_status.filter(
        F.col("fact_table").isin(list(tables)) & F.col("country_code").isin(list(markets))
    )
    out = rows.groupBy(F.col("country_code").alias("market")).agg(
        F.min("max_report_date").alias("watermark"),
        F.count_distinct("fact_table").alias("n_tables"),
    )
    if strict:
        out = out.withColumn(
            "watermark",
            F.when(F.col("n_tables") == len(set(tables)), F.col("watermark")),
        )
    return out.select("market", "watermark", F.col("n_tables").cast("int").alias("n_tables"))


def resolve_watermark(watermarks: DataFrame, markets: Sequence[str]) -> dict[str, _dt.date]:
    """Collect the (at most one row per market) watermark and fail loudly.

    The original fell back to "today" in dead code and then crashed on a
    NULL; here a missing or NULL watermark is an explicit error.
    """
    found = {r["market"]: r["watermark"] for r in watermarks.collect()}
    missing = [m for m in markets if found.get(m) is None]
    if missing:
        raise WatermarkError(f"no load watermark for markets {missing}")
    return {m: found[m] for m in markets}
