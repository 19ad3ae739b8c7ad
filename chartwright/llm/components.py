"""Connected components of a link table, by alternating large and small stars.

Every round is two joins on the links; each star keeps the least neighbour only,
so a node with very many links sends one row per link and task.  Rounds end when
the links no longer change; they are written between rounds, so the lineage
stays short and lost executors cost no earlier round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartwright.plans.session import materialize


def _star(links: DataFrame, *, large: bool) -> DataFrame:
    """Each node's larger (or smaller, and itself) neighbours linked to the least node around it."""
    if large:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        made = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        made = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return made.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _print(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first()
    return row[0], row[1]


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component) of every linked node; component: the least node reachable.

    ``links``: two id columns; order, repeats and loops do not matter.
    """
    a, b = links.columns[:2]
    now = materialize(
        links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct(), "links")
    seen = _print(now)
    while seen[0]:
        now = materialize(_star(_star(now, large=True), large=False), "links")
        new = _print(now)
        if new == seen:
            break
        seen = new
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
