"""N-gram Jaccard join (6): universe partition and the pigeonhole, verified exactly.

A document's set holds the 64-bit hashes of its distinct word shingles.  Equal
sets are found by a digest and collapse into one representative; all that
follows works on representatives.

**Partition.**  Two sets x, y with |x| <= |y| and Jaccard similarity t or more
differ in at most H = |x| (1 - t) / t elements.  The universe of hashes is dealt
into m segments by hash; if more than H segments of x hold something, one of
them is untouched by the differences, so x and y have the same subset there.
Sets are taken by size band (ratio 1 / t^2), which fixes m; a set also files its
segments under the band below when a smaller partner can be there.  Segment
subsets are hashed together with band and segment number and joined on that key.

**Allocation.**  Each segment of x is worth its threshold plus one; thresholds
must add up to more than H.

* Elements in a large share of all documents (found by lossy counting over all
  of them) make useless segments: they get none (cost without selectivity), and
  exact subsets (threshold 0) of the other elements are used while x has more
  than H such segments.
* Otherwise (small sets, sets of mostly frequent elements) x takes coarse
  segments over all its elements, in order of cost: threshold 1, the subset and
  its one-deletion neighbourhood, for segments of two elements or more, threshold
  0 for single elements, the ones with the most infrequent elements first, until
  H is passed.  All sets are filed under their coarse subsets and deletions, of
  which only those that some x asked for leave the task (or, past
  ``MAX_KEYS`` asked keys, all of them, and the join does the filtering).

**Buckets.**  A key's sets arrive sorted by size in one stream, cut into runs
without being held.  Short runs give all their pairs.  A long run gives pairs
with its first set and with the one before; after these are verified and joined
into components, only pairs of a run in different components are left.  A long
run is dealt in blocks of bounded size, each two of them a task of their own.
There a sketch of each set (the parity of the elements that fall on each of
SKETCH_BITS bits) rules out pairs for certain, because sketches differ in no
more bits than the sets do in elements; sets that may still have a link are
sent once and compared in the task, which keeps what is joined already and
gives a spanning forest.  So a family of near copies costs rows in proportion to
its sets, and no link between different components is lost.

**Counting.**  The pigeonhole counts: if x has N segments and differs from y in
H elements at most, they share N - H keys at least.  A pair that met in c short
runs, and can have met in no more long ones than either has, is dropped when
that is too few; and a set whose long runs alone are too few asks for no further
comparison there.  A passage shared by many documents thus costs no comparison
of documents that are otherwise different.

**Verification** compares the sets themselves.

Defined cases: a null text, or one without words, has the empty set and no
links.  A text shorter than a shingle is one shingle.  Rows without an id are
left out; repeated rows of an id count once.  Only ids and texts are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from fractions import Fraction
from functools import lru_cache
from math import ceil, floor, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartwright.llm.components import components
from chartwright.llm.words import LOWER, gram_hashes, mix, slices, split_words
from chartwright.plans.session import materialize

SHINGLE = 5
THRESHOLD = Fraction(3, 4)
#: An element in one of so many documents is frequent; counted with a quarter of that as error.
FREQUENT_ONE_IN = 500
#: Asked keys and elements that are handed to the tasks (8 bytes each) rather than joined.
MAX_KEYS = 6_000_000
#: Runs up to this length give all pairs at once.
SHORT_RUN = 16
#: Ids of documents that are handed to the tasks as a broadcast table (16 bytes each); more are joined.
MAX_IDS = 500_000
#: Bits of the parity sketch by which long runs rule pairs out.
SKETCH_BITS = 1024
_U = np.uint64


# -- sets ------------------------------------------------------------------
def shingle_sets(texts: pa.StringArray, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = split_words(texts, LOWER)
    h = words.hashes()
    grams = gram_hashes(h, k)
    out = []
    for a, b in zip(words.starts[:-1].tolist(), words.starts[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(grams[a : b - k + 1]))
        else:
            out.append(gram_hashes(h[a:b], b - a) if b > a else h[:0])
    return out


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)


# -- partition -------------------------------------------------------------
class Plan:
    """Bands, segments and differences for one threshold."""

    def __init__(self, threshold: Fraction):
        self.t = Fraction(threshold)
        self.ratio = float(1 / self.t) ** 2

    @lru_cache(1 << 14)  # noqa: B019
    def differences(self, n: int) -> int:
        """Most elements by which a set of n and a partner that is no smaller can differ."""
        return floor(n * (1 - self.t) / self.t)

    @lru_cache(1 << 14)  # noqa: B019
    def band(self, n: int) -> int:
        return floor(log(n) / log(self.ratio) + 1e-9)

    @lru_cache(1 << 14)  # noqa: B019
    def lowest(self, n: int) -> int:
        """The band of the smallest partner of a set of n."""
        return self.band(max(1, ceil(n * self.t)))

    @lru_cache(1 << 14)  # noqa: B019
    def fine(self, band: int) -> int:
        """Segments of a band for exact subsets: the largest set fills more than H of them."""
        top = self.ratio ** (band + 1)
        return ceil(1.4 * top * float((1 - self.t) / self.t)) + 1

    @lru_cache(1 << 14)  # noqa: B019
    def coarse(self, band: int) -> int:
        """Segments of a band for subsets and their one-deletion neighbourhoods."""
        return max(1, ceil(self.ratio**band / 3))


def dealing(s: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """What places each element in a segment, whatever their number, and its hash."""
    return mix(s ^ _U(salt)) >> _U(32), mix(s)


def segments(dealt: tuple[np.ndarray, np.ndarray], m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segment number of each filled segment, where it begins in the order of segments, its subset's hash, and that order.

    The hash of a subset is the sum of its elements' hashes, so deletions are differences.
    """
    place, hashes = dealt
    number = place * _U(m) >> _U(32)
    order = np.argsort(number.astype(np.uint16) if m <= 1 << 16 else number, kind="stable")
    n = number[order]
    cut = np.flatnonzero(np.concatenate(([True], n[1:] != n[:-1])))
    return n[cut], cut, np.add.reduceat(hashes[order], cut), order


def _keys(sums: np.ndarray, number: np.ndarray, band: int, kind: int) -> np.ndarray:
    return mix(sums + mix(number * _U(1024) + _U(2 * band + kind)))


def infrequent(s: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How the set's infrequent elements are dealt into segments for exact subsets."""
    return dealing(s[~_among(s, frequent)] if len(frequent) else s, 1)


def fine_keys(rare: tuple[np.ndarray, np.ndarray], plan: Plan, band: int) -> np.ndarray:
    """Keys of the exact subsets of the infrequent elements, under a band."""
    if not len(rare[0]):
        return rare[0]
    number, _, sums, _ = segments(rare, plan.fine(band))
    return _keys(sums, number, band, 0)


def _among(s: np.ndarray, listed: np.ndarray) -> np.ndarray:
    at = np.searchsorted(listed, s)
    return listed[np.minimum(at, len(listed) - 1)] == s


def coarse_keys(s: np.ndarray, plan: Plan, band: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Subset keys, deletion keys (one for each element of segments of two or more), every element's segment, and sizes."""
    number, cut, sums, order = segments(dealing(s, 2), plan.coarse(band))
    sizes = np.diff(np.append(cut, len(s)))
    which = np.empty(len(s), np.int64)
    which[order] = np.repeat(np.arange(len(cut)), sizes)
    many = sizes[which] > 1
    deleted = _keys(sums[which[many]] - mix(s[many]), number[which[many]], band, 1)
    return _keys(sums, number, band, 1), deleted, which, sizes


def asked_keys(s: np.ndarray, frequent: np.ndarray, plan: Plan, n_fine: int) -> np.ndarray | None:
    """What x asks for under coarse segments; None if its ``n_fine`` exact subsets are enough.

    Cheapest first: segments with the most infrequent elements.
    """
    band, h = plan.band(len(s)), plan.differences(len(s))
    if n_fine > h:
        return None
    subset, deleted, which, sizes = coarse_keys(s, plan, band)
    of = which[sizes[which] > 1]
    rare = np.zeros(len(sizes), np.int64)
    rare_elements = ~_among(s, frequent) if len(frequent) else np.ones(len(s), bool)
    np.add.at(rare, which, rare_elements)
    order = np.lexsort((np.arange(len(sizes)), -np.minimum(rare, 3)))
    worth = np.where(sizes > 1, 2, 1)
    need = int(np.searchsorted(np.cumsum(worth[order]), h + 1)) + 1
    if worth.sum() > h:
        taken = np.zeros(len(sizes), bool)
        taken[order[:need]] = True
        return np.concatenate((subset[taken], deleted[taken[of]]))
    return _single_keys(s, frequent, band, h)


def _single_keys(s: np.ndarray, frequent: np.ndarray, band: int, h: int) -> np.ndarray:
    """The finest partition, each element its own segment: H + 1 of them are always enough."""
    rare = ~_among(s, frequent) if len(frequent) else np.ones(len(s), bool)
    return _keys(mix(np.concatenate((s[rare], s[~rare]))[: h + 1]), np.zeros(1, np.uint64), band, 2)


def filed_keys(s: np.ndarray, plan: Plan, band: int) -> np.ndarray:
    """All keys under which a set can be asked for: subsets, deletions, single elements."""
    subset, deleted, _, _ = coarse_keys(s, plan, band)
    return np.concatenate((subset, deleted, _keys(mix(s), np.zeros(1, np.uint64), band, 2)))


# -- frequent elements -----------------------------------------------------
class Lossy:
    """Lossy counting of elements over one task's documents."""

    def __init__(self, one_in: int):
        self.width = 4 * one_in  # documents to a bucket: error of a quarter of the frequency
        self.values, self.counts, self.missed = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.held: list[np.ndarray] = []
        self.bucket = 1

    def add(self, s: np.ndarray) -> None:
        self.held.append(s)
        if len(self.held) >= self.width:
            self.flush(prune=True)

    def flush(self, *, prune: bool) -> None:
        if not self.held:
            return
        found, counts = np.unique(np.concatenate(self.held), return_counts=True)
        self.held = []
        known = np.zeros(len(found), bool)
        if len(self.values):
            at = np.minimum(np.searchsorted(self.values, found), len(self.values) - 1)
            known = self.values[at] == found
            np.add.at(self.counts, at[known], counts[known])
        keep = ~known & (counts > 1)
        values = np.concatenate((self.values, found[keep]))
        tally = np.concatenate((self.counts, counts[keep]))
        missed = np.concatenate((self.missed, np.full(keep.sum(), self.bucket - 1, np.int64)))
        stay = tally + missed > self.bucket if prune else np.ones(len(values), bool)
        order = np.argsort(values[stay])
        self.values, self.counts, self.missed = values[stay][order], tally[stay][order], missed[stay][order]
        self.bucket += 1


# -- streams ---------------------------------------------------------------
def _pairs_of(key: np.ndarray, ident: np.ndarray, size: np.ndarray, asks: np.ndarray, t: Fraction) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From rows sorted by key: pairs (i, j) to verify, and which rows lie in long runs."""
    n = len(key)
    cut = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    length = np.diff(np.append(cut, n))
    first, run = np.repeat(cut, length), np.repeat(length, length)
    left, right = [], []
    for d in range(1, SHORT_RUN):
        i = np.arange(n - d)
        ok = (key[:-d] == key[d:]) & ((d == 1) | (run[:-d] <= SHORT_RUN)) if n > d else np.zeros(0, bool)
        left.append(i[ok])
        right.append(i[ok] + d)
    star = np.flatnonzero((run > SHORT_RUN) & (np.arange(n) > first))
    left.append(first[star])
    right.append(star)
    i, j = np.concatenate(left), np.concatenate(right)
    ok = (ident[i] != ident[j]) & (asks[i] | asks[j]) & (
        np.minimum(size[i], size[j]) * t.denominator >= np.maximum(size[i], size[j]) * t.numerator)
    return i[ok], j[ok], run > SHORT_RUN


def _stream_pairs(t: Fraction):
    """Task over rows (key, size, id, asks) sorted by key and size: pairs (null, a, b, times met) and members of long runs (key, id, size and asks, 0)."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 4

        def out(rows: list[np.ndarray]) -> pa.RecordBatch:
            key, size, ident, asks = rows
            i, j, long = _pairs_of(key, ident, size, asks.astype(bool), t)
            a, b = ident[i], ident[j]  # the earlier of a run first, which is the same in all runs
            met = np.zeros(0, np.int64)
            if len(a):
                (a, b), met = np.unique(np.stack((a, b)), axis=1, return_counts=True)
            member = np.flatnonzero(long)
            packed = size[member] * 2 + asks[member]
            return pa.RecordBatch.from_arrays([
                pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(key[member])]),
                pa.array(np.concatenate((a, ident[member]))), pa.array(np.concatenate((b, packed))),
                pa.array(np.concatenate((met, np.zeros(len(member), np.int64))))], ["key", "a", "b", "met"])

        for batch in batches:
            rows = [np.concatenate((h, batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64))) for c, h in enumerate(held)]
            start = int(np.flatnonzero(np.concatenate(([True], rows[0][1:] != rows[0][:-1])))[-1])
            if len(rows[0]) - start > 1 << 16:  # a run longer than this goes on with its first row and its last ones
                yield out(rows)
                keep = np.concatenate(([start], np.arange(len(rows[0]) - SHORT_RUN, len(rows[0]))))
                held = [r[keep] for r in rows]
            else:
                held = [r[start:] for r in rows]
                if start:
                    yield out([r[:start] for r in rows])
        if len(held[0]):
            yield out(held)

    return task


def sketch(s: np.ndarray) -> bytes:
    """Parity of the elements on each bit."""
    hits = np.bincount((mix(s) % _U(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS)
    return np.packbits((hits & 1).astype(np.uint8)).tobytes()


def _sketches(docs: DataFrame, k: int) -> DataFrame:
    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            made = [sketch(s) for s in shingle_sets(texts, k)]
            yield pa.RecordBatch.from_arrays([pa.array(_ids(batch)), pa.array(made, pa.binary())], ["id", "sketch"])

    return docs.mapInArrow(task, "id long, sketch binary")


#: Rows of a long run that one task compares with each other, or with as many others.
RUN_ROWS = 4096
#: Keys of a set that tell whether a pair meets under an earlier key too.
FIRST_KEYS = 8


class Forest:
    """Which of the labels are known to be one."""

    def __init__(self):
        self.above: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = x
        while (up := self.above.get(root, root)) != root:
            root = up
        while x != root:
            self.above[x], x = root, self.above.get(x, root)
        return root

    def join(self, x: int, y: int) -> None:
        self.above[self.find(y)] = self.find(x)


def _cells(batches: Iterable[pa.RecordBatch], n_keys: int = 3) -> Iterator[pa.RecordBatch]:
    """The rows of each cell (equal first ``n_keys`` columns), put together once."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in range(n_keys)], axis=1)
        cut = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for lo, hi in zip(cut[:-1], cut[1:], strict=True):
            if hi == lo:
                continue
            key = tuple(keys[lo].tolist())
            if held and key != last:
                yield pa.concat_batches(held)
                held = []
            last = key
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.concat_batches(held)


def _crossing(cell: pa.RecordBatch, t: Fraction) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j): rows of a cell that may be links of sets in different components, some rows i at a time.

    The smaller set asks, or either where both are of one size.  The sketches
    differ in few enough bits.  A pair is left to an earlier key where i's first asked keys
    and j's first keys show one; so a pair of sets with many keys in common is
    met once or a few times.
    """
    key, lo, hi, size, _, asks, part, block = (cell.column(c).to_numpy() for c in range(8))
    asked, seen = (cell.column(c).flatten().to_numpy().reshape(-1, FIRST_KEYS) for c in (8, 9))
    bits = np.frombuffer(b"".join(cell.column(10).to_pylist()), np.uint64).reshape(-1, SKETCH_BITS // 64)
    head = np.ascontiguousarray(bits[:, :4])
    here = np.where((asked == key[0]).any(axis=1), (asked == key[0]).argmax(axis=1), FIRST_KEYS)
    asked = np.where((np.arange(FIRST_KEYS) < here[:, None]) & (asked != 0), asked, 0)  # the asked keys before this one
    low = np.searchsorted(size, size)
    top = np.searchsorted(size, size * t.denominator // t.numerator, side="right")
    places = np.arange(len(size))
    rows = np.flatnonzero(asks)
    step = max(1, (1 << 18) // max(1, len(size)))
    for at in range(0, len(rows), step):
        own = rows[at : at + step]
        first, last = int(low[own].min()), int(top[own].max())
        j = slice(first, last)
        ok = (part[own][:, None] != part[j]) & (places[j] >= low[own][:, None]) & (places[j] < top[own][:, None])
        if lo[0] != hi[0]:
            ok &= block[own][:, None] != block[j]
        most = (size[own][:, None] + size[j]) * (t.denominator - t.numerator) // (t.denominator + t.numerator)
        ok &= np.bitwise_count(head[own][:, None] ^ head[j]).sum(axis=2, dtype=np.int32) <= most
        of, to = np.nonzero(ok)
        i, to = own[of], to + first
        near = np.bitwise_count(bits[i] ^ bits[to]).sum(axis=1, dtype=np.int32) <= most[of, to - first]
        i, to = i[near], to[near]
        met = ((asked[i][:, :, None] == seen[to][:, None, :]) & (asked[i] != 0)[:, :, None]).any(axis=(1, 2))
        yield i[~met], to[~met]


_CELL = ("key", "lo", "hi", "size", "id", "asks", "component", "block", "asked", "seen", "sketch")


def _members_task(t: Fraction):
    """Of each cell's rows those that are in a pair that may be a link: (key, lo, hi, id)."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _cells(batches):
            hit = np.zeros(cell.num_rows, bool)
            for i, j in _crossing(cell, t):
                hit[i] = hit[j] = True
            yield cell.select(["key", "lo", "hi", "id"]).filter(pa.array(hit))

    return task


def _links_task(t: Fraction):
    """Links (a, b) of each cell that join different components, compared exactly: no more than its rows, as what is joined already is not compared again."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _cells(batches):
            ident, part = cell.column(4).to_numpy().tolist(), cell.column(6).to_numpy().tolist()
            sets = [np.frombuffer(x, np.uint64) for x in cell.column(11).to_pylist()]
            joined, made = Forest(), []
            for left, right in _crossing(cell, t):
                for i, j in zip(left.tolist(), right.tolist(), strict=True):
                    if joined.find(part[i]) == joined.find(part[j]):
                        continue
                    both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if both * (t.denominator + t.numerator) >= t.numerator * (len(sets[i]) + len(sets[j])):
                        joined.join(part[i], part[j])
                        made.append(sorted((ident[i], ident[j])))
            if made:
                yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made]), pa.array([m[1] for m in made])], ["a", "b"])

    return task


def _crossing_links(docs: DataFrame, long: DataFrame, k: int, t: Fraction) -> DataFrame:
    """Links (a, b) between different components among the rows (key, size, id, asks, component) of long runs.

    A run is dealt in blocks of about ``RUN_ROWS`` rows, and each two blocks (and each with itself)
    are a cell: what a task holds does not grow with the run.  First each cell
    names the rows that may be in a link, by their sketches; then only their sets
    travel and are compared in the cell.
    """
    mixed = long.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.max("asks").alias("any"),
        F.ceil(F.count("*") / RUN_ROWS).cast("int").alias("blocks")).filter("low < high and any > 0")
    rows = materialize(long.join(mixed.select("key", "blocks"), "key"), "mixed")
    of = F.struct(F.xxhash64("key").alias("h"), "key")

    def first(keys: Column) -> Column:
        least = F.transform(F.slice(F.array_sort(F.collect_set(keys)), 1, FIRST_KEYS), lambda x: x["key"])
        return F.slice(F.concat(least, F.array_repeat(F.lit(0).cast("long"), FIRST_KEYS)), 1, FIRST_KEYS)

    firsts = rows.groupBy("id").agg(first(F.when(F.col("asks") > 0, of)).alias("asked"), first(of).alias("seen"))
    drawn = _sketches(_among_ids(docs, materialize(rows.select("id").distinct(), "mixed-ids")).select("id", "text"), k)
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    cells = rows.withColumn("block", block).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "size", "id", "asks", "component", "block")
    sketches = materialize(firsts.join(drawn, "id"), "sketches")

    def by_cell(some: DataFrame) -> DataFrame:
        return some.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "size", "id")

    hit = materialize(by_cell(cells.join(sketches, "id").select(*_CELL)).mapInArrow(_members_task(t), "key long, lo int, hi int, id long"), "members")
    ids = materialize(hit.select("id").distinct(), "member-ids")
    sets = _sets(_among_ids(docs, ids).select("id", "text"), k)
    full = cells.join(hit, ["key", "lo", "hi", "id"]).join(sketches, "id").join(materialize(sets, "member-sets"), "id").select(*_CELL, "s")
    return materialize(by_cell(full).mapInArrow(_links_task(t), "a long, b long").distinct(), "crossing")


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """Rows (id, s): the sorted 64-bit hashes of each set."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(_ids(batch)), pa.array([s.tobytes() for s in shingle_sets(texts, k)], pa.binary())], ["id", "s"])

    return docs.mapInArrow(task, "id long, s binary")


# -- the join --------------------------------------------------------------
def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64), pa.int64())


def describe(docs: DataFrame, k: int, one_in: int) -> DataFrame:
    """Rows (id, n, k1, k2) of every document, and (null, count, element, missed) of elements that may be frequent."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lossy = Lossy(one_in)
        names = ["id", "n", "k1", "k2"]
        for batch, texts in slices(batches):
            sets = shingle_sets(texts, k)
            for s in sets:
                lossy.add(s)
            marks = np.array([divmod(xxhash.xxh3_128_intdigest(s.tobytes()), 1 << 64) for s in sets], np.uint64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(_ids(batch)), pa.array([len(s) for s in sets], pa.int64()), _long(marks[:, 0]), _long(marks[:, 1])], names)
        lossy.flush(prune=False)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(lossy.values), pa.int64()), pa.array(lossy.counts), _long(lossy.values), pa.array(lossy.missed)], names)

    return docs.mapInArrow(task, "id long, n long, k1 long, k2 long")


KEY, ELEMENT, COUNT = 0, 1, 2


def _asked(docs: DataFrame, k: int, plan: Plan, frequent) -> DataFrame:
    """Rows (kind, value, n): KEY, a key that a set asks for beyond its exact subsets; ELEMENT, an
    element of such a set; COUNT, of every other set its id and its filled segments."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            kinds, values, counts = [], [], []
            for ident, s in zip(_ids(batch).tolist(), shingle_sets(texts, k), strict=True):
                if not len(s):
                    continue
                n = len(fine_keys(infrequent(s, frequent.value), plan, plan.band(len(s))))
                keys = asked_keys(s, frequent.value, plan, n)
                found = [(COUNT, np.array([ident], np.uint64), n)] if keys is None else [(KEY, keys, 0), (ELEMENT, s, 0)]
                for kind, value, n in found:
                    kinds.append(np.full(len(value), kind, np.int32))
                    values.append(value)
                    counts.append(np.full(len(value), n, np.int64))
            if kinds:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(kinds)), _long(np.concatenate(values)), pa.array(np.concatenate(counts))], ["kind", "value", "n"])

    return docs.mapInArrow(task, "kind int, value long, n long")


def _filed(docs: DataFrame, k: int, plan: Plan, frequent, wanted) -> DataFrame:
    """Rows (key, size, id, asks) of every set.

    ``wanted``: the asked keys and the asking sets' elements, sorted, or None
    for no filter.  A partner has the share t of its own elements in common with
    the asking set, so a set with fewer among all of them files nothing.
    """

    def rows_of(s: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        n = len(s)
        band, lowest = plan.band(n), plan.lowest(n)
        rare = infrequent(s, frequent.value)
        fine = {b: fine_keys(rare, plan, b) for b in range(lowest, band + 1)}
        ask = asked_keys(s, frequent.value, plan, len(fine[band]))
        for b, keys in fine.items():
            yield keys, np.full(len(keys), ask is None and b == band)
        if wanted is not None:
            asked, elements = wanted.value
            if not len(asked) or int(_among(s, elements).sum()) * plan.t.denominator < n * plan.t.numerator:
                return
        for b in fine:
            filed = filed_keys(s, plan, b)
            if wanted is not None:
                filed = filed[_among(filed, asked)]
            filed = np.unique(filed)
            yield filed, np.isin(filed, ask) if ask is not None and b == band else np.zeros(len(filed), bool)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            keys, asks, counts = [np.zeros(0, np.uint64)], [np.zeros(0, bool)], []
            sets = shingle_sets(texts, k)
            for s in sets:
                made = list(rows_of(s)) if len(s) else []
                keys += [x for x, _ in made]
                asks += [x for _, x in made]
                counts.append(sum(len(x) for x, _ in made))
            yield pa.RecordBatch.from_arrays(
                [_long(np.concatenate(keys)), pa.array(np.repeat([len(s) for s in sets], counts).astype(np.int64)),
                 pa.array(np.repeat(_ids(batch), counts)), pa.array(np.concatenate(asks).astype(np.int64))],
                ["key", "size", "id", "asks"])

    return docs.mapInArrow(task, "key long, size long, id long, asks long")


def _among_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents with the (written) ids; texts are not shuffled while the ids are few."""
    return docs.join(F.broadcast(ids) if ids.count() <= MAX_IDS else ids, "id", "left_semi")


def _compare(t: Fraction, kind: np.dtype, slack: int):
    """Task over rows (id, hub, s), a set and then its hubs' sets: (a, b, sure) of the similar pairs.

    Short values can only overstate what is shared: fewer than needed is
    certain, and so is more than ``slack`` above it.
    """

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ident, own = None, np.zeros(0, kind)
        for batch in batches:
            made = []
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for i, hub, data in zip(*(part.column(c).to_pylist() for c in range(3)), strict=True):
                    s = np.frombuffer(data, kind)
                    if hub is None:
                        ident, own = i, s
                    elif i == ident:
                        both = len(s) + len(own) - len(np.union1d(s, own)) if slack == 0 else _shared(s, own)
                        over = both * (t.denominator + t.numerator) - t.numerator * (len(s) + len(own))
                        if over >= 0:
                            made.append((hub, i, over >= slack * (t.denominator + t.numerator)))
            columns = list(zip(*made, strict=True)) if made else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.bool_())], ["a", "b", "sure"])

    return task


def _shared(x: np.ndarray, y: np.ndarray) -> int:
    """Values in common, each as often as it is in both; both are sorted."""
    merged = np.concatenate((x, y))
    order = np.argsort(merged, kind="stable")
    merged, left = merged[order], order < len(x)
    cut = np.flatnonzero(np.concatenate(([True], merged[1:] != merged[:-1])))
    n_left = np.add.reduceat(left.astype(np.int64), cut)
    n_all = np.diff(np.append(cut, len(merged)))
    return int(np.minimum(n_left, n_all - n_left).sum())


def _verified(docs: DataFrame, pairs: DataFrame, k: int, t: Fraction) -> DataFrame:
    """The pairs (a, b) whose sets really are that similar.

    The sets meet at b, streamed: b's own, then those of its partners.  They
    travel as the upper 32 bits of their hashes; pairs so close to the threshold
    that a chance agreement of those could matter are compared again in full.
    """

    def similar(pairs: DataFrame, kind: np.dtype, slack: int) -> DataFrame:
        def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, texts in slices(batches):
                found = shingle_sets(texts, k)
                if slack:
                    found = [(s >> _U(32)).astype(kind) for s in found]
                yield pa.RecordBatch.from_arrays([pa.array(_ids(batch)), pa.array([s.tobytes() for s in found], pa.binary())], ["id", "s"])

        needed = materialize(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "needed")
        known = materialize(_among_ids(docs, needed).select("id", "text").mapInArrow(sets, "id long, s binary"), "sets")
        sent = pairs.join(known.withColumnRenamed("id", "a"), "a").select(F.col("b").alias("id"), F.col("a").alias("hub"), "s")
        own = known.join(pairs.select(F.col("b").alias("id")).distinct(), "id", "left_semi").select("id", F.lit(None).cast("long").alias("hub"), "s")
        met = own.union(sent).repartition("id").sortWithinPartitions("id", "hub")
        return materialize(met.mapInArrow(_compare(t, kind, slack), "a long, b long, sure boolean").distinct(), "similar")

    first = similar(pairs, np.dtype(np.uint32), 3)
    close = first.filter("not sure").select("a", "b")
    sure = first.filter("sure").select("a", "b")
    if close.isEmpty():
        return sure
    return sure.union(similar(close, np.dtype(np.uint64), 0).select("a", "b"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    threshold: Fraction = THRESHOLD, one_in: int = FREQUENT_ONE_IN, max_keys: int = MAX_KEYS) -> DataFrame:
    """Per document: its id, the size of its set, its component and its class of equal sets."""
    spark = docs.sparkSession
    plan = Plan(threshold)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter("id is not null")
    described = materialize(describe(source, shingle, one_in), "described")
    own = described.filter("id is not null").dropDuplicates(["id"])
    classes = own.filter("n > 0").groupBy("n", "k1", "k2").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    member = materialize(own.join(classes, ["n", "k1", "k2"], "left").select("id", "n", F.coalesce("rep", "id").alias("rep")), "classes")

    total = own.count()
    least = max(3, ceil(total / one_in * 3 / 4))
    # at most (mean set size) * one_in * 4 / 3 elements can be this frequent
    elements = described.filter("id is null").groupBy("k1").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("k1")
    frequent = spark.sparkContext.broadcast(np.sort(np.array([r[0] for r in elements.collect()], np.int64).view(np.uint64)))

    alone = source.join(materialize(member.filter("id <> rep").select("id"), "copies"), "id", "left_anti").select("id", "text")
    asked = materialize(_asked(alone, shingle, plan, frequent).distinct(), "asked")
    wanted = None
    if asked.filter(F.col("kind") != COUNT).count() <= max_keys:
        wanted = spark.sparkContext.broadcast(tuple(
            np.sort(asked.filter(F.col("kind") == kind).select("value").toArrow().column(0).to_numpy().view(np.uint64)) for kind in (KEY, ELEMENT)))
    rows = _filed(alone, shingle, plan, frequent, wanted)
    dealt = rows.repartition("key").sortWithinPartitions("key", "size", "id")
    found = materialize(dealt.mapInArrow(_stream_pairs(plan.t), "key long, a long, b long, met long"), "found")
    met = found.filter("key is null").groupBy("a", "b").agg(F.sum("met").alias("met"))
    members = found.filter("key is not null").select("key", F.col("a").alias("id"), F.shiftright("b", 1).alias("size"), F.col("b").bitwiseAND(1).alias("asks")).distinct()
    # of each set: its size, its filled segments (null if it asked for more), its long runs
    sizes = materialize(
        member.filter("id = rep").select("id", "n")
        .join(asked.filter(F.col("kind") == COUNT).select(F.col("value").alias("id"), F.col("n").alias("filled")), "id", "left")
        .join(members.groupBy("id").agg(F.count("*").alias("runs")), "id", "left").na.fill(0, ["runs"]), "sizes")
    left, right = (sizes.select(F.col("id").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("n", "filled", "runs"))) for x in ("a", "b"))
    num, den = plan.t.numerator, plan.t.denominator
    differ = F.floor((F.col("n_a") + F.col("n_b")) * (den - num) / (den + num) + 1e-9)
    enough = F.col("filled_a").isNull() | (F.col("met") + F.least("runs_a", "runs_b") >= F.col("filled_a") - differ)
    pairs = materialize(met.join(left, "a").join(right, "b").filter(enough).select("a", "b"), "pairs")
    links = _verified(alone, pairs, shingle, plan.t)
    parts = materialize(components(links), "parts")

    # what is left to compare: sets of one long run in different components that may still share enough
    may = F.col("filled").isNull() | (F.col("runs") >= F.col("filled") - F.floor(F.col("n") * (den - num) / num + 1e-9))
    long = (
        members.join(sizes.select("id", F.col("filled").isNull().alias("asker"), may.alias("may")), "id")
        .withColumn("asks", F.when(F.col("asker"), F.col("asks")).otherwise(F.col("may").cast("long")))
        .join(parts.select(F.col("node").alias("id"), "component"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    )
    long = materialize(long.select("key", "size", "id", "asks", "component"), "runs")
    more = _crossing_links(alone, long, shingle, plan.t)
    if not more.isEmpty():
        parts = components(links.union(more))
    parts = parts.select(F.col("node").alias("rep"), "component")
    return member.join(parts, "rep", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"), F.col("rep").alias("class_id"))
