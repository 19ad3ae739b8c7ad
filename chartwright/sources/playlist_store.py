"""Playlist snapshots: the sink that replaces the original's playlist API
calls (S10-S12, C21).

Layout: a Parquet table partitioned by ``market, playlist``, rewritten per
run with dynamic partition overwrite (one list replaced, all others left
as they are), and a manifest table with one row per list written after it.

Dynamic overwrite only replaces partitions that receive rows, so a list
that became empty would keep its old tracks.  Every expected list therefore
writes at least one row: an empty list writes a single tombstone row
(``position`` NULL) that readers drop.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartwright.operators.charts import DateLike, _date
from chartwright.plans.session import materialize
from chartwright.operators.playlists import LIST_KEY, playlist_description
from chartwright.sources.versions import Commit, VersionStore


class EmptyPlaylistError(RuntimeError):
    """A list is empty and ``allow_empty`` is off."""


class UnexpectedPlaylistError(RuntimeError):
    """There are tracks for a list that the run is not responsible for."""


def expected_lists(spark: SparkSession, markets: Sequence[str], playlists: "Sequence[str] | Mapping[str, Sequence[str]]") -> DataFrame:
    """One row per (market, playlist) this run is responsible for.

    ``playlists``: the names for every market, or names by market.
    """
    names = playlists if isinstance(playlists, Mapping) else {m: playlists for m in markets}
    rows = [(m, p) for m in markets for p in names[m]]
    return spark.createDataFrame(rows, "market string, playlist string")


def playlist_manifest(lists: DataFrame, expected: DataFrame, as_of: "DateLike | DataFrame", allow_empty: bool = True) -> DataFrame:
    """One row per expected list: ``market, playlist, description, as_of, n_tracks``.

    ``as_of`` is the data date of all lists, or a ``(market, day)`` table.
    Raises before anything is written when ``lists`` has a list that is not
    expected or, with ``allow_empty=False``, when an expected list is empty.
    """
    counts = lists.groupBy(*LIST_KEY).agg(F.count("*").alias("n_tracks"))
    if isinstance(as_of, DataFrame):
        days = as_of.select("market", F.col("day").alias("_as_of"))     # one row per market
        expected = expected.join(F.broadcast(days), "market", "left")
    else:
        expected = expected.withColumn("_as_of", _date(as_of))
    joined = materialize(
        expected.withColumn("_expected", F.lit(True)).join(counts, list(LIST_KEY), "full"), "manifest-stage"
    )
    strange = joined.filter(F.col("_expected").isNull()).select(*LIST_KEY).limit(5).collect()
    if strange:
        raise UnexpectedPlaylistError(f"unexpected playlists: {[tuple(r) for r in strange]}")
    if not allow_empty:
        empty = joined.filter(F.col("n_tracks").isNull()).select(*LIST_KEY).limit(5).collect()
        if empty:
            raise EmptyPlaylistError(f"empty playlists: {[tuple(r) for r in empty]}")
    return joined.select(
        *LIST_KEY,
        playlist_description(F.col("_as_of")).alias("description"),
        F.col("_as_of").alias("as_of"),
        F.coalesce("n_tracks", F.lit(0)).cast("int").alias("n_tracks"),
    )


def _replace(df: DataFrame, path: str) -> None:
    """Rewrite the lists that ``df`` has rows for, and leave all others."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*LIST_KEY)
        .parquet(path)
    )


def write_lists(lists: DataFrame, manifest: DataFrame, path: str, uri_col: str = "_track_uri") -> None:
    """Replace each list of the manifest; an empty one becomes a tombstone."""
    rows = lists.select(*LIST_KEY, "position", F.col(uri_col).alias("track_uri"))
    tombstones = manifest.filter(F.col("n_tracks") == 0).select(
        *LIST_KEY, F.lit(None).cast("int").alias("position"), F.lit(None).cast("string").alias("track_uri")
    )
    _replace(rows.unionByName(tombstones).repartition(*LIST_KEY), path)


def write_batches(batches: DataFrame, manifest: DataFrame, path: str) -> None:
    """Replace the publish batches of each list of the manifest.

    An empty list gets a tombstone (no ``batch_no``), so the batches of an
    earlier run do not stay behind; ``read_batches`` drops it.
    """
    gone = manifest.filter(F.col("n_tracks") == 0).select(*LIST_KEY, "description")
    for field in batches.schema.fields:
        if field.name not in gone.columns:
            gone = gone.withColumn(field.name, F.lit(None).cast(field.dataType))
    _replace(batches.unionByName(gone), path)


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The batches to publish, without tombstones."""
    return spark.read.parquet(path).filter(F.col("batch_no").isNotNull())


def write_manifest(manifest: DataFrame, path: str) -> None:
    """The last write of a run: readers that follow it see finished lists."""
    _replace(manifest, path)


def write_playlists(
    lists: DataFrame,
    expected: DataFrame,
    path: str,
    manifest_path: str,
    as_of: "DateLike | DataFrame",
    uri_col: str = "_track_uri",
    allow_empty: bool = True,
) -> DataFrame:
    """Replace each expected list with its new contents, then the manifest.

    Returns the manifest rows written; see ``playlist_manifest`` for what
    raises before anything is written.  ``lists`` is computed once.
    """
    rows = materialize(lists.select(*LIST_KEY, "position", uri_col), "lists")
    manifest = playlist_manifest(rows, expected, as_of, allow_empty)
    write_lists(rows, manifest, path, uri_col)
    write_manifest(manifest, manifest_path)
    return manifest


def publish_playlists(
    lists: DataFrame,
    batches: DataFrame | None,
    manifest: DataFrame,
    root: str,
    uri_col: str = "_track_uri",
) -> Commit:
    """Replace the manifest's lists, their batches and manifest rows in one step.

    Lists that the manifest does not name are carried over from the current
    version.  An empty list has its manifest row (0 tracks) and no others, so
    nothing of an earlier run stays behind.
    """
    store = VersionStore(lists.sparkSession, root)
    before = store.current()
    own = manifest.select(*LIST_KEY)
    new = {"playlists": lists.select(*LIST_KEY, "position", F.col(uri_col).alias("track_uri")), "batches": batches, "manifest": manifest}
    tables = {}
    for name, rows in new.items():
        kept = store.read(name, before).join(own, list(LIST_KEY), "left_anti") if before and name in before.tables else None
        whole = rows if kept is None else kept if rows is None else rows.unionByName(kept)
        if whole is not None:
            tables[name] = whole
    return store.publish(tables, after=before)


def published(spark: SparkSession, root: str, table: str = "playlists") -> DataFrame:
    """A table (``playlists``, ``batches`` or ``manifest``) of the newest published version."""
    return VersionStore(spark, root).read(table)


def read_playlists(spark: SparkSession, path: str) -> DataFrame:
    """Current lists without tombstones: ``market, playlist, position, track_uri``."""
    return (
        spark.read.parquet(path)
        .filter(F.col("position").isNotNull())
        .select(*LIST_KEY, "position", "track_uri")
    )


def playlist_diff(old: DataFrame, new: DataFrame, uri_col: str = "track_uri") -> DataFrame:
    """Tracks added to and removed from each list (two anti joins)."""
    key = [*LIST_KEY, uri_col]
    o, n = old.select(*key).distinct(), new.select(*key).distinct()
    added = n.join(o, key, "left_anti").withColumn("change", F.lit("added"))
    removed = o.join(n, key, "left_anti").withColumn("change", F.lit("removed"))
    return added.unionByName(removed)


class PageError(RuntimeError):
    """The pages of a list do not make up the list."""


ITEMS_SCHEMA = "struct<items: array<struct<track: struct<uri: string>>>>"
PAGE_SCHEMA = "struct<offset: bigint, total: bigint, items: array<struct<track: struct<uri: string>>>>"


def playlist_items_from_json(df: DataFrame, body_col: str = "body") -> DataFrame:
    """track URIs out of a playlist-items JSON page, in order.

    ``df`` has ``market, playlist`` and one JSON body per row
    (``{"items": [{"track": {"uri": ...}}, ...]}``); returns one row per item
    with its 1-based position, for comparing a published list with a snapshot.
    """
    uris = F.transform(F.from_json(F.col(body_col), ITEMS_SCHEMA)["items"], lambda x: x["track"]["uri"])
    return df.select(*LIST_KEY, F.posexplode(uris).alias("pos", "track_uri")).select(
        *LIST_KEY, (F.col("pos") + 1).alias("position"), "track_uri"
    )


def stitch_pages(df: DataFrame, body_col: str = "body") -> DataFrame:
    """Whole lists out of their pages, whatever order the pages come in.

    ``df`` has ``market, playlist`` and one JSON page per row
    (``{"offset": 0, "total": 250, "items": [...]}``).  An item stands at its
    page's offset plus its place in the page.  Pages may overlap and repeat:
    equal items of one position count once.  Raises ``PageError`` when
    pages disagree on an item or on the total, when a page has no offset or
    total, or when a position up to the total is not covered (or one beyond it is).
    """
    page = F.from_json(F.col(body_col), PAGE_SCHEMA)
    pages = df.select(*LIST_KEY, page.alias("p")).select(
        *LIST_KEY, F.col("p.offset").alias("offset"), F.col("p.total").alias("total"),
        F.transform(F.col("p.items"), lambda x: F.struct(x["track"]["uri"].alias("uri"))).alias("items"))
    pages = materialize(pages, "pages")
    spots = materialize(
        pages.select(*LIST_KEY, "offset", F.posexplode("items").alias("i", "item"))
        .groupBy(*LIST_KEY, (F.col("offset") + F.col("i") + 1).alias("position"))
        .agg(F.min("item").alias("low"), F.max("item").alias("high")), "spots")
    told = pages.groupBy(*LIST_KEY).agg(
        F.min("total").alias("total"), F.max("total").alias("other"),
        F.count(F.when(F.col("offset").isNull() | F.col("total").isNull() | (F.col("offset") < 0), 1)).alias("blank"))
    covered = spots.groupBy(*LIST_KEY).agg(
        F.count("*").alias("n"), F.max("position").alias("last"), F.count(F.when(~F.col("low").eqNullSafe(F.col("high")), 1)).alias("torn"))
    state = told.join(covered, list(LIST_KEY), "left").fillna(0, ["n", "last", "torn"])
    fault = (
        F.when(F.col("blank") > 0, "a page without offset or total")
        .when(F.col("total") != F.col("other"), "pages with different totals")
        .when(F.col("torn") > 0, "pages with different items at one position")
        .when(F.col("last") > F.col("total"), "items beyond the total")
        .when(F.col("n") < F.col("total"), "positions that no page covers"))
    faults = state.select(*LIST_KEY, fault.alias("fault")).filter("fault is not null").limit(5).collect()
    if faults:
        raise PageError("; ".join(f"{r['market']}/{r['playlist']}: {r['fault']}" for r in faults))
    return spots.select(*LIST_KEY, F.col("position").cast("int").alias("position"), F.col("low.uri").alias("track_uri"))


def list_pages(lists: DataFrame, size: int, overlap: int = 0, uri_col: str = "_track_uri") -> DataFrame:
    """Pages (market, playlist, body) of up to ``size`` items, each beginning ``overlap`` items before the last one's end."""
    step = size - overlap
    place = F.col("position") - 1
    last = F.floor(place / step)
    first = F.greatest(F.lit(0), F.floor((place - size) / step) + 1)
    n = lists.groupBy(*LIST_KEY).agg(F.count("*").alias("total"))
    item = F.struct("position", F.struct(F.struct(F.col(uri_col).alias("uri")).alias("track")).alias("item"))
    return lists.select(*LIST_KEY, F.explode(F.sequence(first, last)).alias("page"), item.alias("x")).groupBy(*LIST_KEY, "page").agg(
        F.sort_array(F.collect_list("x")).alias("xs")).join(n, list(LIST_KEY)).select(
        *LIST_KEY, F.to_json(F.struct(
            (F.col("page") * step).alias("offset"), "total", F.transform("xs", lambda x: x["item"]).alias("items"))).alias("body"))
