"""Hard-negative mining (12): a secondary sort on (anchor, descending score, id).

1. **Cells.**  Rows are dealt into groups of bounded size by a hash of their id.
   Each group's rows are held as one integer matrix; the anchors (a stated
   part of the rows) pass by in blocks.  Scores are integer inner products,
   exact: a product is taken in the narrowest float type that holds every
   partial sum, or else in 64-bit integers.
2. **Positives.**  A group sends an anchor's first few rows of its label.  They are
   shuffled under (anchor, descending score, id) keys and the stream's first few
   are the anchor's positives, which fix the score windows.
3. **Negatives.**  A group sends, for each window of an anchor, its first few rows of
   other labels inside it; all others could not be among the first of all.
4. **Stream.**  Positives and negatives are shuffled and sorted under (anchor,
   descending score, positives first, id).  The iterator opens a window when a
   positive passes and gives negatives out while the window wants more; it
   holds an anchor's few windows and nothing else of it.

The sort is the engine's (``repartition`` by anchor and ``sortWithinPartitions``),
the same plan as repartitionAndSortWithinPartitions without rows of Python objects.
An anchor costs at most ``groups x (positives + positives x negatives)`` rows,
whatever label or vector a third of all rows has.

Defined cases: rows with a null id, label or vector, or a null or non-finite
component, take no part.  Of rows with one id the least (label, then vector)
stands for all.  A shorter vector counts as filled up with zeros.  Scores that
do not fit into 64 bits raise ``ScoreRangeError``.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartwright.plans.session import discard, materialize

POSITIVES = 5
NEGATIVES = 3
#: The window of a positive: from LOW to HIGH hundredths of its score.
LOW, HIGH = 50, 95
SCALE = 256
#: Rows of a group, at most on average, and anchors of a block.
GROUP_ROWS = 16_384
ANCHOR_ROWS = 512

_HITS = "anchor long, score long, kind int, id long"


class ScoreRangeError(ValueError):
    """An inner product may not fit into 64 bits."""


def _matrix(vectors: list[np.ndarray], width: int, scale: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    return np.floor(scale * out)


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of every row of a with every row of b, whole numbers held as doubles."""
    bound = float(np.abs(a).max(initial=0.0)) * float(np.abs(b).max(initial=0.0)) * a.shape[1]
    if bound < 1 << 24:
        return a.astype(np.float32) @ b.T.astype(np.float32)
    if bound < 1 << 53:
        return a @ b.T
    if max(bound, np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0)) >= 2.0**62:
        raise ScoreRangeError(f"an inner product may reach {bound:.3g}")
    return a.astype(np.int64) @ b.T.astype(np.int64)


def _lowest(scores: np.ndarray):
    return -np.inf if scores.dtype.kind == "f" else np.iinfo(np.int64).min


def first_of(scores: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each row of scores the places of its n largest, one after another (of equal ones the first): (rows, places).
    ``scores`` is used up."""
    low = _lowest(scores)
    rows = np.arange(len(scores))
    for _ in range(min(n, scores.shape[1])):
        at = scores[rows, :].argmax(axis=1) if len(rows) < len(scores) else scores.argmax(axis=1)
        live = scores[rows, at] > low
        rows, at = rows[live], at[live]
        if not len(rows):
            return
        yield rows, at
        scores[rows, at] = low


def windows(score: int, low: int, high: int) -> tuple[int, int]:
    """Least and largest negative score for a positive's; empty if the first is larger."""
    return -((-low * score) // 100), (high * score) // 100


Hits = Callable[[np.ndarray, np.ndarray, np.ndarray, list], Iterator[tuple[np.ndarray, np.ndarray]]]


def _cell_task(hits: Hits, kind: int, scale: int):
    """From (part, kind, id, label, vector, positives), a part's rows before its anchors: rows (anchor, score, kind, id)."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part: int | None = None
        held: list[tuple[np.ndarray, np.ndarray, list[np.ndarray]]] = []
        rows: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

        def meet(ids, labels, vectors, positives) -> Iterator[pa.RecordBatch]:
            nonlocal rows
            if rows is None:
                every = [v for h in held for v in h[2]]
                rows = (np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), _matrix(every, max(map(len, every), default=0), scale))
            for lo in range(0, len(ids), ANCHOR_ROWS):
                own = slice(lo, lo + ANCHOR_ROWS)
                width = max(rows[2].shape[1], max(map(len, vectors[own]), default=0))
                matrix = rows[2] if width == rows[2].shape[1] else np.pad(rows[2], ((0, 0), (0, width - rows[2].shape[1])))
                scores = inner_products(_matrix(vectors[own], width, scale), matrix)
                found = list(hits(scores, labels[own][:, None] == rows[1][None, :], ids[own][:, None] == rows[0][None, :], positives[own]))
                if found:
                    i, at = (np.concatenate(c) for c in zip(*found, strict=True))
                    i, at = np.unique(np.stack((i, at)), axis=1) if len(found) > 1 else (i, at)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[own][i]), pa.array(scores[i, at].astype(np.int64)), pa.array(np.full(len(i), kind, np.int32)), pa.array(rows[0][at])],
                        ["anchor", "score", "kind", "id"])

        for batch in batches:
            parts, kinds, ids, labels = (batch.column(c).to_numpy() for c in range(4))
            lists = batch.column(4)
            flat, ends = lists.flatten().to_numpy(), np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
            cut = np.flatnonzero(np.concatenate(([True], (parts[1:] != parts[:-1]) | (kinds[1:] != kinds[:-1]), [True])))
            for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                if parts[lo] != part:
                    part, held, rows = int(parts[lo]), [], None
                vectors = [flat[ends[i] : ends[i + 1]] for i in range(lo, hi)]
                if kinds[lo] == 0:
                    held.append((ids[lo:hi], labels[lo:hi], vectors))
                elif held:
                    yield from meet(ids[lo:hi], labels[lo:hi], vectors, batch.column(5).slice(lo, hi - lo).to_pylist())

    return task


def _same(n: int) -> Hits:
    def hits(scores, alike, itself, positives):
        yield from first_of(np.where(alike & ~itself, scores, _lowest(scores)), n)

    return hits


def _within(n: int, low: int, high: int) -> Hits:
    def hits(scores, alike, itself, positives):
        least = _lowest(scores)
        other = np.where(alike, least, scores)
        for turn in range(max(map(len, positives), default=0)):
            bounds = np.array([windows(p[turn], low, high) if turn < len(p) else (1, 0) for p in positives], np.int64)
            lo, hi = bounds[:, :1], bounds[:, 1:]
            yield from first_of(np.where((other >= lo) & (other <= hi), other, least), n)

    return hits


def _first_task(n: int):
    """Of (anchor, score, kind, id) in order, each anchor's first n rows."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for batch in batches:
            anchors = batch.column(0).to_numpy()
            begin = np.concatenate(([True], anchors[1:] != anchors[:-1]))
            turn = np.arange(len(anchors)) - np.maximum.accumulate(np.where(begin, np.arange(len(anchors)), 0))
            if len(anchors) and anchors[0] == last:
                turn[: int(np.argmax(begin[1:])) + 1 if begin[1:].any() else len(turn)] += seen
            if len(anchors):
                last, seen = anchors[-1], int(turn[-1]) + 1
            yield batch.filter(pa.array(turn < n))

    return task


_OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _stream_task(n: int, low: int, high: int):
    """Of positives (kind 0) and negatives (kind 1) in order: the first n negatives of each positive's window."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, opened = None, []
        for batch in batches:
            made = []
            for a, score, kind, ident in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                if a != anchor:
                    anchor, opened = a, []
                if kind == 0:
                    opened.append([ident, score, *windows(score, low, high), 0])
                    continue
                for window in opened:
                    if window[2] <= score <= window[3] and window[4] < n:
                        window[4] += 1
                        made.append((a, window[0], window[4], ident, window[1], score))
            columns = list(zip(*made, strict=True)) if made else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if i == 2 else pa.int64()) for i, c in enumerate(columns)],
                ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    return task


def mine(rows: DataFrame, is_anchor: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE,
         group_rows: int = GROUP_ROWS) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor``: a condition on ``id``.  Components count as ``floor(scale * x)``.
    """
    spark = rows.sparkSession
    vector = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    usable = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    clean = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), vector.alias("vector")).filter(
        "id is not null and label is not null and vector is not null").filter(usable)
    least = clean.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("v"))
    kept = materialize(least.select("id", "v.label", "v.vector"), "vectors")
    total = kept.count()
    groups = max(1, -(-total // group_rows), min(2 * spark.sparkContext.defaultParallelism, total // 1024))
    dealt = kept.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int"))
    none = F.lit(None).cast("array<long>")
    asking = kept.filter(is_anchor)
    parts = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))

    def cells(anchors: DataFrame, hits: Hits, kind: int) -> DataFrame:
        stream = dealt.select("part", F.lit(0).alias("kind"), "id", "label", "vector", none.alias("positives")).unionByName(
            anchors.select(parts.alias("part"), F.lit(1).alias("kind"), "id", "label", "vector", "positives"))
        met = stream.repartition(groups, "part").sortWithinPartitions("part", "kind", "id")
        return met.mapInArrow(_cell_task(hits, kind, scale), _HITS)

    def by_anchor(found: DataFrame) -> DataFrame:
        return found.repartition("anchor").sortWithinPartitions("anchor", F.desc("score"), "kind", "id")

    close = cells(asking.withColumn("positives", none), _same(positives), 0)
    best = materialize(by_anchor(close).mapInArrow(_first_task(positives), _HITS), "positives")
    scores = best.groupBy(F.col("anchor").alias("id")).agg(F.collect_set("score").alias("positives"))
    open_anchors = asking.join(scores, "id")
    far = cells(open_anchors, _within(negatives, low, high), 1)
    return by_anchor(best.unionByName(far)).mapInArrow(_stream_task(negatives, low, high), _OUT)
