"""Packing (11): documents laid along a space-filling curve and cut into full sequences.

1. **Tokens.**  One pass tokenises every document and writes its ids once, with a
   small vector: token ids are hashed into signed buckets, counts damped by
   the square root, the vector set to length one and projected to ``DIMS``
   numbers by a fixed random matrix.
2. **Curve.**  Each number is set against its mean and deviation over all documents
   and becomes a cell of ``BITS`` bits; the cells' place on the Hilbert curve is
   the document's key.  Similar documents are neighbours on the curve.
3. **Range sort.**  Only (row, key, length) is range-sorted, by key and then by row,
   so a key of very many copies is split.  Running sums give every document its
   place in one long row of tokens.
4. **Cuts.**  That row is cut every ``length`` tokens.  What remains at its end is cut
   into powers of two, so no sequence needs padding.  Ids meet their place by
   row number, spread evenly, and a task makes a document's pieces one by one.

Ids are those of a byte-level BPE file of the tokenizers library.  They are
computed with the same vocabulary's ranks by tiktoken, which is four times as
fast; the tests hold both against each other on every code point.  Special tokens
of the file are found in the text, as the library does.

Defined cases: a null or empty text is the closing id alone; rows without an id
and repeated rows are packed like any other; no rows give no pieces.  Other
columns are not read.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartwright.llm.ranges import running
from chartwright.llm.words import mix, slices
from chartwright.plans.session import discard, materialize

LENGTH = 1024
#: The id that closes a document.
CLOSING = 0
DIMS = 4
BITS = 12
BUCKETS = 512
SEED = 11
#: Documents whose vectors are built at once.
VECTOR_ROWS = 512
#: Bytes of ids that a task puts together before it writes them out.
FLUSH = 8 << 20


@dataclass(frozen=True)
class Vocabulary:
    """A byte-level BPE vocabulary: the ranks file, the pattern of its pieces, and the library's file for special tokens."""

    ranks: str
    pattern: str
    file: str


@lru_cache(maxsize=2)
def _encoding(vocabulary: Vocabulary):
    import tiktoken

    with open(vocabulary.ranks, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    with open(vocabulary.file, encoding="utf-8") as file:
        special = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
    return tiktoken.Encoding("packing", pat_str=vocabulary.pattern, mergeable_ranks=ranks, special_tokens=special)


def ids_of(text: str, vocabulary: Vocabulary) -> np.ndarray:
    """Ids of one text, special tokens found."""
    return _encoding(vocabulary).encode_to_numpy(text, allowed_special="all")


def id_type(vocabulary: Vocabulary, closing: int) -> str:
    """What the ids are kept in between the passes: two bytes where they fit."""
    return "<u2" if max(_encoding(vocabulary).n_vocab - 1, closing) < 1 << 16 else "<u4"


# -- vectors ---------------------------------------------------------------
def _projection() -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((BUCKETS, DIMS)) / np.sqrt(DIMS)


def vectors(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The projected hashed vector of each document; its ids are ``ids[starts[i]:starts[i + 1]]``."""
    hashed = mix(ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    bucket, sign = (hashed % np.uint64(BUCKETS)).astype(np.int64), np.where(hashed >> np.uint64(63), 1.0, -1.0)
    table, out = _projection(), np.zeros((len(starts) - 1, DIMS))
    for lo in range(0, len(starts) - 1, VECTOR_ROWS):
        hi = min(lo + VECTOR_ROWS, len(starts) - 1)
        own = slice(starts[lo], starts[hi])
        owner = np.repeat(np.arange(hi - lo), np.diff(starts[lo : hi + 1]))
        counts = np.bincount(owner * BUCKETS + bucket[own], sign[own], (hi - lo) * BUCKETS).reshape(hi - lo, BUCKETS)
        damped = np.sign(counts) * np.sqrt(np.abs(counts))
        size = np.linalg.norm(damped, axis=1, keepdims=True)
        out[lo:hi] = damped / np.where(size > 0, size, 1.0) @ table
    return out


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cells (each of ``bits`` bits; at most 63 bits in all).

    Skilling's transform (AIP Conference Proceedings 707, 2004): from the highest bit
    down, cells are reflected or exchanged with the first axis, then Gray-coded.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            up = (x[i] & q) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(up, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where(x[n - 1] & q, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_keys(points: np.ndarray, mean: np.ndarray, deviation: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Keys of points, each number first dealt evenly over the cells (a logistic stand-in for the normal distribution)."""
    z = (points - mean) / np.where(deviation > 0, deviation, 1.0)
    share = 1.0 / (1.0 + np.exp(-1.702 * np.clip(z, -30, 30)))
    return hilbert(np.minimum((share * (1 << bits)).astype(np.int64), (1 << bits) - 1), bits)


# -- tasks -----------------------------------------------------------------
_COORDINATES = [f"c{i}" for i in range(DIMS)]


def _token_task(vocabulary: Vocabulary, closing: int):
    """From (id, text, row): (id, row, n, c0.., ids in the narrowest type)."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([closing], np.uint32)
        width = id_type(vocabulary, closing)
        for batch, texts in slices(batches):
            found = [ids_of(t, vocabulary) for t in texts.to_pylist()]
            starts = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int64)
            points = vectors(np.concatenate([*found, end[:0]]), starts)
            ids = pa.array([np.append(x, end).astype(width).tobytes() for x in found], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(np.diff(starts) + 1), *map(pa.array, points.T.copy()), ids],
                ["id", "row", "n", *_COORDINATES, "ids"])

    return task


def _key_task(mean: np.ndarray, deviation: np.ndarray):
    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = np.stack([batch.column(2 + i).to_numpy() for i in range(DIMS)], axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(curve_keys(points, mean, deviation))], ["row", "n", "key"])

    return task


def boundaries(total: int, length: int) -> tuple[int, list[int]]:
    """Number of full sequences, and where the sequences begin that the rest is cut into (and its end)."""
    full, rest = divmod(total, length)
    at = [full * length]
    for bit in range(rest.bit_length() - 1, -1, -1):
        if rest >> bit & 1:
            at.append(at[-1] + (1 << bit))
    return full, at


def _piece_task(total: int, length: int, width: str):
    """From (id, start, ids): the documents' pieces, written out whenever ``FLUSH`` bytes of ids are ready."""
    full, tail = boundaries(total, length)
    ends = np.array(tail)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = batch.column(1).to_numpy()
            rows: list[np.ndarray] = []
            made: list[bytes] = []
            size = 0

            def out() -> pa.RecordBatch:
                row, cuts, sizes, n = (np.concatenate(c) for c in zip(*rows, strict=True))
                of = np.maximum(np.searchsorted(ends, cuts, side="right") - 1, 0)
                inside = cuts < full * length
                return pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), pa.array(cuts - first[row]), pa.array(sizes), pa.array(made, pa.binary()), pa.array(n),
                     pa.array(np.where(inside, cuts // length, full + of)), pa.array(np.where(inside, cuts % length, cuts - ends[of]))],
                    ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

            for i in range(batch.num_rows):
                ids = np.frombuffer(batch.column(2)[i].as_buffer(), width)
                g, n = int(first[i]), len(ids)
                cuts = np.concatenate((
                    [g], np.arange(g // length + 1, min((g + n - 1) // length, full) + 1) * length,
                    [t for t in tail[1:-1] if g < t < g + n])).astype(np.int64)
                sizes = np.diff(np.append(cuts, g + n))
                rows.append((np.full(len(cuts), i), cuts, sizes, np.full(len(cuts), n)))
                made += [ids[c - g : c - g + x].astype("<u4").tobytes() for c, x in zip(cuts.tolist(), sizes.tolist(), strict=True)]
                size += 4 * n
                if size >= FLUSH:
                    yield out()
                    rows, made, size = [], [], 0
            if rows:
                yield out()

    return task


# -- the operator ----------------------------------------------------------
def pack(docs: DataFrame, vocabulary: Vocabulary, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
         closing: int = CLOSING) -> DataFrame:
    """Rows (id, start, length, ids, doc_tokens, sequence_id, offset): every document's pieces, each in one sequence.

    ``ids``: little-endian unsigned 32-bit integers.  Sequences hold ``length``
    ids, but for the last few, whose sizes are powers of two.
    """
    kind = dict(docs.dtypes)[id_col]
    numbered = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("row"))
    coordinates = ", ".join(f"{c} double" for c in _COORDINATES)
    tokens = materialize(numbered.mapInArrow(_token_task(vocabulary, closing), f"id {kind}, row long, n long, {coordinates}, ids binary"), "tokens")
    spread = tokens.agg(*[F.coalesce(f(c), F.lit(0.0)) for f in (F.avg, F.stddev_pop) for c in _COORDINATES]).first()
    keys = tokens.select("row", "n", *_COORDINATES).mapInArrow(
        _key_task(np.array(spread[:DIMS]), np.array(spread[DIMS:])), "row long, n long, key long")
    keyed = materialize(keys, "keys")
    placed, total = running(keyed, ["key", "row"], "n", name="curve")
    discard(keyed)
    met = tokens.select("id", "row", "ids").join(placed.select("row", "start"), "row").select("id", "start", "ids")
    return met.mapInArrow(
        _piece_task(total, length, id_type(vocabulary, closing)),
        f"id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
