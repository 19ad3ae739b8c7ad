"""Word splitting over Arrow text columns, vectorised, and word-run hashes.

Every delimiter of the two word rules is an ASCII byte and every byte of a
non-ASCII character is at least 0x80, so splitting UTF-8 bytes gives the same
words as splitting characters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from weakref import WeakMethod

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z: digits, a-z and all
# that is not ASCII stay, every other byte becomes a space.
PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
#: Lower-cases A-Z and leaves the rest.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

#: Entries of one generation of a per-task cache; bounds a worker's memory.
CACHE_ENTRIES = 300_000
#: Words longer than this are not cached.
CACHE_WORD_BYTES = 64
#: Text that a task works on at once; a longer text is a slice of its own.  What a task makes
#: of a slice is many times as long, and a worker keeps that memory for the tasks after it.
SLICE_BYTES = 1 << 20


def plain_words(text: bytes) -> list[bytes]:
    """Words of one text under PLAIN."""
    return text.translate(PLAIN).split()


class WordCache(dict):
    """``cache[word]`` is ``make(word)``, kept for the next time.

    Two generations: when the young one is full it becomes the old one, and
    words met again move on, so frequent words stay and memory is bounded.

    ``make`` is a method of the cache's owner and held weakly: the cache goes with
    its owner when a task ends, not at some collection in a later task of the worker.
    """

    def __init__(self, make: Callable[[bytes], object]):
        super().__init__()
        self.make = WeakMethod(make)
        self.old: dict = {}

    def __missing__(self, word):
        value = self.old.get(word)
        if value is None:
            value = self.make()(word)
        if len(word) <= CACHE_WORD_BYTES:
            self.put(word, value)
        return value

    def put(self, word: bytes, value: object) -> None:
        if len(self) >= CACHE_ENTRIES:
            self.old = dict(self)
            self.clear()
        self[word] = value


def text_array(column: pa.Array) -> pa.StringArray:
    """The column as a 32-bit string array; null becomes the empty text."""
    return pc.fill_null(column.cast(pa.string()), "")


def slices(batches: Iterable[pa.RecordBatch], text_at: int = 1) -> Iterator[tuple[pa.RecordBatch, pa.StringArray]]:
    """The batches in slices of bounded text, each with its text column filled."""
    for batch in batches:
        texts = text_array(batch.column(text_at))
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + SLICE_BYTES, side="right")))
            yield batch.slice(at, to - at), texts.slice(at, to - at)
            at = to


@dataclass(frozen=True)
class Words:
    """Words of a slice of texts: text i has ``codes[starts[i]:starts[i + 1]]``."""

    codes: np.ndarray
    starts: np.ndarray
    vocabulary: list[bytes]
    strings: pa.StringArray

    def lengths(self) -> np.ndarray:
        """Code points of each entry of the vocabulary."""
        return pc.utf8_length(self.strings).to_numpy(zero_copy_only=False).astype(np.int64)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word in place, the same in every task."""
        found = np.fromiter(map(xxhash.xxh3_64_intdigest, self.vocabulary), np.uint64, len(self.vocabulary))
        return found[self.codes]

    def code(self, word: bytes) -> int:
        """The word's code, or -1."""
        return pc.index(self.strings, pa.scalar(word.decode(), pa.string())).as_py()

    def counts(self) -> np.ndarray:
        return np.diff(self.starts)

    def owners(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.starts) - 1), self.counts())


def split_words(texts: pa.StringArray, table: bytes | None = None) -> Words:
    """Words between ASCII white space, after a byte-for-byte ``table``."""
    if table is not None and len(texts):
        texts = pa.concat_arrays([texts])  # offsets from 0
        _, offsets, data = texts.buffers()
        if data is not None:
            texts = pa.StringArray.from_buffers(len(texts), offsets, pa.py_buffer(data.to_pybytes().translate(table)), None, 0, texts.offset)
    lists = pc.ascii_split_whitespace(texts)
    coded = lists.flatten().dictionary_encode()
    codes = coded.indices.to_numpy()
    starts = lists.offsets.to_numpy().astype(np.int64)
    starts = starts - starts[0]
    vocabulary = coded.dictionary.cast(pa.binary()).to_pylist()
    if b"" in vocabulary:
        keep = codes != vocabulary.index(b"")
        starts = np.concatenate(([0], np.cumsum(keep)))[starts]
        codes = codes[keep]
    return Words(codes, starts, vocabulary, coded.dictionary)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k words, from the words' hashes; empty if fewer."""
    n = len(h) - k + 1
    if n <= 0:
        return h[:0]
    out = h[:n].copy()
    for j in range(1, k):
        out = mix(out) + h[j : j + n]
    return mix(out)


def inside(words: Words, k: int) -> np.ndarray:
    """Of the runs of k words over the whole slice: whether they lie in one text."""
    n = len(words.codes) - k + 1
    if n <= 0:
        return np.zeros(0, bool)
    owner = words.owners()
    return owner[:n] == owner[k - 1 : k - 1 + n]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the runs that begin at ``starts`` and have ``lengths``, one after another."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.int64)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)


def join_codes(words: Words, coded: list[bytes], kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """Each text's words replaced by their codes (``coded``: one run for each entry of the vocabulary).

    All texts' codes one after another, and where each text's begin.
    """
    lengths = np.fromiter(map(len, coded), np.int64, len(coded)) // kind.itemsize
    flat = np.frombuffer(b"".join(coded), kind)
    begin = np.cumsum(lengths) - lengths
    codes = flat[ragged(begin[words.codes], lengths[words.codes])]
    ends = np.concatenate(([0], np.cumsum(lengths[words.codes])))
    return codes, ends[words.starts]
