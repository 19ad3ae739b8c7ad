"""Benchmark decontamination (4): winnowing, on DataFrame functions only.

A window is ``WINDOW`` consecutive words of an item.  Both sides are cut into
runs of ``GRAM`` words; of every ``WINDOW - GRAM + 1`` neighbouring runs the one
with the least hash is a fingerprint (ties: the last).  A shared window chooses
the same run on both sides, so joining fingerprints misses no window.  Each hit
names a diagonal (document, item, offset), which is extended by comparing the
words themselves, so a hash collision adds nothing.

An item of fewer words than a window is one window; it is joined on the hash of
its whole word run with the documents' runs of that length, again compared word
by word.  Only the lengths that occur (12 at most) are built.

Items with the same words are joined once and their ids put back at the end.
The join side is chosen by the engine from the written fingerprint table's size;
nothing is broadcast by hint.

Defined cases: a null or empty text has no words and is never contaminated; an
item without words matches nothing; an empty benchmark leaves every document
clean.  Repeated rows of an id count as one document.  Rows without an id are
left out.  Only ids and texts are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartwright.plans.session import materialize

WINDOW = 13
GRAM = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PLACE = (1 << 31) - 1


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), use)[0]


def word_array(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z; null text: none."""
    text = F.coalesce(text, F.lit(""))
    lowered = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def upto(n: Column) -> Column:
    """1..n as an array; empty below 1."""
    return F.when(n >= 1, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))


def _joined(values: Column, step: int, use: Callable[[Column, Column], Column]) -> Column:
    """``use(values[i], values[i + step])`` wherever both are there."""
    return bind(values, lambda x: F.zip_with(
        F.slice(x, 1, F.greatest(F.size(x) - step, F.lit(0))), F.slice(x, 1 + step, F.greatest(F.size(x) - step, F.lit(0))), use))


def _least(a: Column, b: Column) -> Column:
    return F.least(a, b)


def run_hashes(hashes: Column, length: int) -> Column:
    """Hash of every run of ``length`` words, put together from runs of half the length."""
    if length == 1:
        return hashes
    half = length // 2
    if length % 2 == 0:
        return _joined(run_hashes(hashes, half), half, lambda a, b: F.xxhash64(a, b))
    return bind(hashes, lambda h: F.zip_with(
        run_hashes(F.slice(h, 1, F.greatest(F.size(h) - 1, F.lit(0))), length - 1),
        F.slice(h, length, F.greatest(F.size(h) - length + 1, F.lit(0))), lambda a, b: F.xxhash64(a, b)))


def _marks(length: int, places: Column, runs: Column) -> Column:
    """(window length, place, hash) of the runs at the places, places from 0."""
    return F.transform(
        places,
        lambda p: F.struct(F.lit(length).alias("length"), (p - 1).cast("int").alias("place"), F.element_at(runs, p.cast("int")).alias("mark")),
    )


def _winnowed(hashes: Column) -> Column:
    """Fingerprints of all windows."""

    def chosen(runs: Column) -> Column:
        # the hash's upper 32 bits, then the place such that the last one is least
        keys = F.transform(runs, lambda g, i: F.shiftleft(F.shiftright(g, 31), 31) + (F.lit(_PLACE) - i))
        two = _joined(keys, 1, _least)
        six = bind(two, lambda t: _joined(_joined(t, 2, _least), 2, _least))  # least of 6 = WINDOW - GRAM + 1
        places = F.transform(F.array_distinct(six), lambda k: F.lit(_PLACE + 1) - k.bitwiseAND(F.lit(_PLACE)))
        return bind(places, lambda p: _marks(WINDOW, p, runs))

    return bind(run_hashes(hashes, GRAM), chosen)


def _fingerprints(hashes: Column, lengths: list[int]) -> Column:
    """Fingerprints of the windows and all runs of the short lengths."""

    def short(n: int) -> Column:
        return bind(run_hashes(hashes, n), lambda runs: _marks(n, upto(F.size(runs)), runs))

    return F.concat(_winnowed(hashes), *map(short, lengths))


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def contamination(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per document: words, hit words, items with occurring windows and the verdict."""
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).filter(F.col("_id").isNotNull())
    items = materialize(
        benchmark.select(F.col(item_col).cast("string").alias("item"), word_array(F.col(item_text_col)).alias("item_words"))
        .filter(F.col("item").isNotNull() & (F.size("item_words") > 0))
        .groupBy("item_words").agg(F.sort_array(F.collect_set("item")).alias("items"))
        .withColumn("set", F.col("items")[0]),
        "items",
    )
    short = F.size("item_words") < WINDOW
    lengths = sorted(r[0] for r in items.filter(short).select(F.size("item_words")).distinct().collect())
    runs = [F.when(F.size("item_words") == n, run_hashes(_hashes(F.col("item_words")), n)[0]) for n in lengths]
    whole = F.array(F.struct(
        F.size("item_words").alias("length"), F.lit(0).alias("place"), F.coalesce(*runs, F.lit(0).cast("long")).alias("mark")))
    marks = materialize(
        items.select("set", F.explode(F.when(short, whole).otherwise(bind(_hashes(F.col("item_words")), _winnowed))).alias("m"))
        .select("set", "m.length", "m.mark", F.col("m.place").alias("item_place")),
        "marks",
    )

    # one pass over the texts; of each document its first row and its hits are kept
    made = source.select(
        "_id",
        bind(word_array(F.col("_text")), lambda w: F.struct(
            F.size(w).alias("n_words"), bind(_hashes(w), lambda h: _fingerprints(h, lengths)).alias("marks"))).alias("d"),
    ).select("_id", F.col("d.n_words").alias("n_words"), F.posexplode_outer("d.marks").alias("at", "m"))
    hits = materialize(
        made.select("_id", "n_words", "at", "m.length", "m.place", "m.mark")
        .join(marks, ["length", "mark"], "left")
        .filter(F.col("set").isNotNull() | (F.coalesce("at", F.lit(0)) == 0))
        .select("_id", "n_words", "set", (F.col("place") - F.col("item_place")).alias("shift")),
        "hits",
    )
    counted = hits.groupBy("_id").agg(F.max("n_words").cast("long").alias("n_words"))
    diagonals = hits.filter("set is not null").select("_id", "set", "shift").distinct()

    # extend: the words of both sides along each diagonal, compared
    measured = diagonals.join(items.select("set", F.size("item_words").alias("n_item")), "set")
    by_doc = measured.groupBy("_id").agg(F.collect_list(F.struct("set", "shift", "n_item")).alias("diagonals"))
    sides = (
        source.join(by_doc, "_id")
        .select("_id", F.explode(bind(word_array(F.col("_text")), lambda w: F.transform("diagonals", lambda d: F.struct(
            d["set"].alias("set"), d["shift"].alias("shift"),
            F.slice(w, F.greatest(d["shift"], F.lit(0)) + 1, d["n_item"] + F.least(d["shift"], F.lit(0))).alias("part"))))).alias("d"))
        .select("_id", "d.set", "d.shift", "d.part")
        .join(items.select("set", "item_words"), "set")
        .select("_id", "set", F.greatest("shift", F.lit(0)).alias("start"), F.least(F.size("item_words"), F.lit(WINDOW)).alias("need"),
                bind(F.slice("item_words", F.greatest(-F.col("shift"), F.lit(0)) + 1, F.size("part")),
                     lambda own: F.zip_with("part", own, lambda a, b: a == b)).alias("same"))
    )
    windows = F.filter(
        upto(F.size("same") - F.col("need") + 1), lambda s: ~F.array_contains(F.slice(F.col("same"), s, F.col("need")), False)
    )
    found = materialize(
        sides.select("_id", "set", "start", "need", windows.alias("at")).filter(F.size("at") > 0)
        .select("_id", "set", F.array_distinct(F.flatten(F.transform(
            "at", lambda s: F.sequence(F.col("start") + s - 1, F.col("start") + s - 2 + F.col("need"))))).alias("places")),
        "windows",
    )
    words = found.select("_id", F.explode("places").alias("place")).distinct().groupBy("_id").agg(F.count("*").alias("n_hit"))
    names = (
        found.select("_id", "set").distinct().join(items.select("set", F.explode("items").alias("item")), "set")
        .select("_id", "item").distinct()  # an item may stand in several rows, with other texts
        .groupBy("_id").agg(F.count("*").alias("n_items"), F.array_join(F.sort_array(F.collect_list("item")), ",").alias("item_list"))
    )
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return (
        counted.join(words, "_id", "left").join(names, "_id", "left")
        .select(
            F.col("_id").alias(id_col), "n_words", n_hit.alias("n_hit"),
            F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
            F.sha2(F.coalesce("item_list", F.lit("")).cast("binary"), 256).alias("items_sha256"),
            ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
        )
    )
