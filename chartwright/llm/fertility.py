"""Quality rules (10): tokeniser fertility.

A public subword vocabulary is run over each text, and the shape of its output
tells prose from junk without any model of the corpus:

* characters per token: prose of a script the vocabulary knows lies in a band;
  symbol noise, keyboard noise or hex dumps need a token for nearly every
  character, padding runs give far too few;
* byte-fallback share: tokens that stand for single bytes because no piece
  covers the character;
* token entropy: Shannon entropy of the text's token distribution in bits,
  held against the most that a text of its length can have.  A text that
  repeats a few tokens has a low one at any length.

The bands depend on the script that most letters belong to (``BANDS``).  They
are parameters, not statistics of the input, so a document's verdict depends on
nothing but the document.

Defined cases: a null or empty text has no words and fails the base rule; a
text without tokens has fertility 0, byte share 0 and entropy 0.  Repeated rows
give repeated results.  Only the id and the text are read, so further columns
do not matter.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from chartwright.llm.words import (
    CACHE_WORD_BYTES,
    WordCache,
    Words,
    gram_hashes,
    inside,
    join_codes,
    mix,
    slices,
    split_words,
)

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 20
REPEAT_WINDOW = 8
REPEAT_PERCENT = 30


@dataclass(frozen=True)
class Band:
    """What a text of one script may measure."""

    min_chars_per_token: float
    max_chars_per_token: float
    max_byte_share: float


#: By the script of most letters.  Scripts that the vocabulary has few pieces
#: for take about a token a character, or several byte tokens.
BANDS = {
    "latin": Band(1.45, 9.0, 0.15),
    "cyrillic": Band(1.2, 8.0, 0.15),
    "greek": Band(0.8, 6.0, 0.50),
    "han": Band(0.3, 4.0, 0.80),
    "other": Band(0.2, 8.0, 1.00),
}
#: First code points of the ranges that ``script`` tells apart.
_EDGES = np.array([0x41, 0x5B, 0x61, 0x7B, 0xC0, 0x250, 0x370, 0x400, 0x530, 0x3040, 0xA000, 0xAC00, 0xD7B0], np.uint32)
_SCRIPTS = [None, "latin", None, "latin", None, "latin", "other", "greek", "cyrillic", "other", "han", "other", "han", "other"]


@dataclass(frozen=True)
class FertilityRules:
    """Parameters of the verdict beyond the base rule."""

    bands: dict[str, Band] = field(default_factory=lambda: dict(BANDS))
    #: Least share of the entropy that a text of as many tokens (256 at most) can have.
    min_entropy_share: float = 0.35
    #: Texts of fewer tokens are judged by the base rule alone.
    min_tokens: int = 40
    #: Most symbols of SYMBOLS a word, as junk has one at every word.
    max_symbols_per_word: float = 1.0


def script(text: str) -> str:
    """Script of most letters; ``other`` without any, ties to the first of BANDS."""
    if text.isascii():
        return "latin" if any(map(str.isalpha, text)) else "other"
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    counts = np.bincount(np.searchsorted(_EDGES, codes, side="right"), minlength=len(_SCRIPTS))
    found = {name: sum(int(c) for c, s in zip(counts, _SCRIPTS, strict=True) if s == name) for name in BANDS}
    best = max(found, key=found.get)
    return best if found[best] else "other"


def repeated_words(words: Words, window: int = REPEAT_WINDOW) -> np.ndarray:
    """For each text, its words inside a window of words that it has at least twice."""
    n_texts = len(words.starts) - 1
    found = np.zeros(n_texts, np.int64)
    whole = inside(words, window)
    if not whole.any():
        return found
    owner = words.owners()
    grams = gram_hashes(mix(words.codes.astype(np.uint64) + np.uint64(1)), window)
    at = np.flatnonzero(whole)
    key = mix(grams[at] ^ mix(owner[at].astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(words.codes) + 1, np.int64)
    np.add.at(edge, at[twice], 1)
    np.add.at(edge, at[twice] + window, -1)
    np.add.at(found, owner[np.cumsum(edge)[:-1] > 0], 1)
    return found


def entropy_bits(ids: np.ndarray) -> float:
    """Shannon entropy of the ids' distribution."""
    if not len(ids):
        return 0.0
    s = np.sort(ids)
    ends = np.append(np.flatnonzero(s[1:] != s[:-1]) + 1, len(s))
    p = np.diff(ends, prepend=0) / len(s)
    return float(max(0.0, -(p * np.log2(p)).sum()))


class Fertility:
    """Tokens of words under one sentencepiece vocabulary; made once a task."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.pieces = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(self.pieces.get_piece_size())])
        self.known = WordCache(self._encode_one)

    def _encode(self, words: list[bytes]) -> list[bytes]:
        found = self.pieces.encode([w.decode("utf-8", "replace") for w in words], num_threads=1)
        return [array("i", ids).tobytes() for ids in found]

    def _encode_one(self, word: bytes) -> bytes:
        return self._encode([word])[0]

    def tokens(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts one after another, and where each text's begin.

        Pieces never cross white space, so a text's tokens are its words'.
        """
        known, old = self.known, self.known.old
        new = [w for w in words.vocabulary if w not in known and w not in old]
        fresh = dict(zip(new, self._encode(new), strict=True))
        coded = [fresh[w] if w in fresh else known[w] for w in words.vocabulary]
        for word, ids in fresh.items():
            if len(word) <= CACHE_WORD_BYTES:
                known.put(word, ids)
        return join_codes(words, coded, np.dtype(np.int32))


def verdict(rules: FertilityRules, kind: str, n_words: int, n_symbols: int, n_tokens: int,
            fertility: float, byte_share: float, entropy: float) -> str:
    """Name of the rule that rejects the text, or an empty string."""
    if n_tokens < rules.min_tokens:
        return ""
    band = rules.bands[kind]
    if n_symbols > rules.max_symbols_per_word * n_words:
        return "symbols"
    if fertility < band.min_chars_per_token:
        return "fertility_low"
    if fertility > band.max_chars_per_token:
        return "fertility_high"
    if byte_share > band.max_byte_share:
        return "byte_fallback"
    if entropy < rules.min_entropy_share * np.log2(min(n_tokens, 256)):
        return "entropy"
    return ""


SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean,"
    " kept boolean, script string, n_tokens long, chars_per_token double, byte_share double, entropy double, reason string"
)


def measure(texts: pa.StringArray, model: Fertility, rules: FertilityRules) -> list[tuple]:
    """The columns of SCHEMA for each text of a slice."""
    words = split_words(texts)
    n_words = words.counts()
    chars = words.lengths()
    n_chars = np.diff(np.concatenate(([0], np.cumsum(chars[words.codes])))[words.starts])
    repeats = repeated_words(words)
    ids, starts = model.tokens(words)
    made = []
    for i, text in enumerate(texts.cast(pa.binary()).to_pylist()):
        n, own = int(n_words[i]), ids[starts[i] : starts[i + 1]]
        symbols = len(text) - len(text.translate(None, SYMBOLS))
        lines = [x for x in text.split(b"\n") if x.strip()]
        base = n < MIN_WORDS or 100 * int(repeats[i]) > REPEAT_PERCENT * n
        kind = script(text.decode("utf-8", "replace"))
        shape = (len(own), int(n_chars[i]) / len(own), float(model.is_byte[own].mean()), entropy_bits(own)) if len(own) else (0, 0.0, 0.0, 0.0)
        reason = "base" if base else verdict(rules, kind, n, symbols, *shape)
        made.append((n, int(n_chars[i]), symbols, len(lines) - len(set(lines)), int(repeats[i]), base, not reason, kind, *shape, reason))
    return made


def quality(docs: DataFrame, model_file: str, *, id_col: str = "doc_id", text_col: str = "text",
            rules: FertilityRules = FertilityRules()) -> DataFrame:  # noqa: B008
    """One row per document: the id, the base counts, the token measures and the verdict.

    One pass without a shuffle.  ``model_file`` is read by every worker and must
    be present on every machine, like an installed package's data file.
    """
    source = docs.select(id_col, text_col)
    kind = dict(source.dtypes)[id_col]
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Fertility(model_file)
        for batch, texts in slices(batches):
            columns = [pa.array(x) for x in zip(*measure(texts, model, rules), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [id_col, *names])

    return source.mapInArrow(task, f"`{id_col}` {kind}, {SCHEMA}")
