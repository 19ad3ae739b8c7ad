"""BPE encoding and decoding (1): a bounded-lookahead streaming transducer.

The vocabulary file is a public one in the ``tokenizers`` JSON form: byte-level
BPE with a word-end suffix, text normalised to NFC and lower case, white space
dropped, two special strings recognised in the raw text.

Encoding streams over the symbols of one piece of text.  ``lookahead`` is the
merge list's sufficient lookahead: let two inputs share a prefix.  Run the
merges by rank over both; the part on which the two runs agree shrinks only
when a merge (u, v) joins the agreed part's last token u to a v beyond it, and
then by u.  A later merge (u', v') can shrink it again only if v' begins with
the tokens left there, that is, if u lies on v's chain of leftmost parts, and
only at a higher rank.  So the most that can be lost is the longest chain of
such merges, weighted by the length of each left part.  ``sufficient_lookahead``
finds it in one pass over the merges by rank.  Tokens that end at least that
many symbols before the end of what was read are therefore final and are
emitted; only the rest is kept, so memory is constant however long the piece.

Decoding feeds tokens to a state machine that turns bytes into text as soon as
a character is complete.

Defined cases: a null text encodes like an empty one, to no tokens.  Repeated
rows give repeated results.  Only the id and the text are read.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
from array import array
from collections.abc import Iterable, Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from chartwright.llm.words import WordCache, Words, join_codes, slices, split_words

#: Symbols read beyond the lookahead before the stable tokens are emitted.
BLOCK = 4096
#: Pieces of at most this many symbols are merged at once, longer ones streamed.
SHORT = 256
_NEVER = 1 << 30


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    names = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [names[b] for b in range(256)]


def sufficient_lookahead(merges: Iterable[tuple[str, str]], suffix: str) -> int:
    """Symbols after which what follows can no longer change a token (see above)."""
    first: dict[str, str] = {}  # a merged token's left part
    lost: dict[str, int] = {}  # the longest chain that ends with a merge of this left part
    longest = 0
    for u, v in merges:
        chain, part = lost.get(v, 0), v
        while part in first:
            part = first[part]
            chain = max(chain, lost.get(part, 0))
        chain += len(u.removesuffix(suffix))
        lost[u] = max(lost.get(u, 0), chain)
        longest = max(longest, chain)
        first.setdefault(u + v, u)
    return longest


class Bpe:
    """Encoder and decoder of one vocabulary file; made once a task."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = dict(model["vocab"])
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(merges)}
        self.merged = [u + v for u, v in merges]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.lookahead = sufficient_lookahead(merges, self.suffix)
        self.symbols = byte_symbols()
        self.names = [""] * (max([*self.ids.values(), *self.special.values()]) + 1)
        for name, i in {**self.ids, **self.special}.items():
            self.names[i] = name
        split = next(x for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        self.pieces = regex.compile(split["pattern"]["Regex"])
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)  # its Unicode tables; the merging is this class's
        self.normal = library.normalizer.normalize_str
        self.split = library.pre_tokenizer.pre_tokenize_str
        self.words = WordCache(self._word)
        self.runs = WordCache(self._piece)

    # -- encoding ----------------------------------------------------------
    def merge(self, parts: list[str]) -> list[str]:
        """Merge by rank, leftmost first."""
        if len(parts) > SHORT:
            return self._merge_long(parts)
        rank, merged = self.ranks.get, self.merged
        while len(parts) > 1:
            found = list(map(rank, zip(parts, parts[1:]), repeat(_NEVER)))
            best = min(found)
            if best == _NEVER:
                break
            at = found.index(best)
            parts[at : at + 2] = [merged[best]]
        return parts

    def _merge_long(self, parts: list[str]) -> list[str]:
        """The same with a heap of (rank, place), for blocks."""
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive: list[str | None] = list(parts)
        heap = [(r, i) for i in range(n - 1) if (r := self.ranks.get((parts[i], parts[i + 1]), _NEVER)) < _NEVER]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i] if alive[i] is not None else n
            if j >= n or self.ranks.get((alive[i], alive[j])) != rank:
                continue
            alive[i], alive[j] = self.merged[rank], None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for x, y in ((before[i], i), (i, k)):
                if x >= 0 and y < n and (r := self.ranks.get((alive[x], alive[y]), _NEVER)) < _NEVER:
                    heapq.heappush(heap, (r, x))
        return [t for t in alive if t is not None]

    def transduce(self, symbols: Iterable[str]) -> Iterator[str]:
        """Tokens of one piece, each as soon as nothing that follows can change it."""
        held: list[str] = []
        for symbol in symbols:
            held.append(symbol)
            if len(held) >= self.lookahead + BLOCK:
                stable = done = 0
                tokens = self.merge(list(held))
                for token in tokens:
                    end = done + len(token.removesuffix(self.suffix))
                    if end > len(held) - self.lookahead:
                        break
                    done, stable = end, stable + 1
                yield from tokens[:stable]
                held = held[done:]
        yield from self.merge(held)

    def _symbols(self, piece: str) -> Iterator[str]:
        data = piece.encode()
        yield from map(self.symbols.__getitem__, data[:-1])
        yield self.symbols[data[-1]] + self.suffix

    def _piece(self, piece: str) -> bytes:
        data = list(self._symbols(piece)) if len(piece) <= SHORT else None
        tokens = self.merge(data) if data is not None and len(data) <= SHORT else self.transduce(self._symbols(piece))
        return array("I", map(self.ids.__getitem__, tokens)).tobytes()

    def _word(self, word: bytes) -> bytes:
        """Ids of a run without ASCII white space, as little-endian 32-bit integers."""
        if word.isascii() and b"<|" not in word:
            return b"".join(map(self.runs.__getitem__, self.pieces.findall(word.decode().lower())))
        out = []
        for part in self.specials.split(word.decode("utf-8", "replace")):
            if part in self.special:
                out.append(array("I", [self.special[part]]).tobytes())
            elif part:
                part = self.normal(part)
                old = max(part, default="") < "\u0530"  # letters that every Unicode table has
                pieces = self.pieces.findall(part) if old else [part[a:b] for _, (a, b) in self.split(part)]
                out.extend(map(self.runs.__getitem__, pieces))
        return b"".join(out)

    def encode(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a slice one after another, and where each text's begin."""
        return join_codes(words, list(map(self.words.__getitem__, words.vocabulary)), np.dtype("<u4"))

    # -- decoding ----------------------------------------------------------
    def text(self, ids: Iterable[int], *, spaced: bool = False) -> Iterator[str]:
        """The text of the tokens, incrementally: word ends become spaces.

        ``spaced``: the form that the file's library decodes to; the file names no decoder,
        so the tokens' own names stand between spaces.
        """
        if spaced:
            ids, between = iter(ids), ""
            while block := " ".join(map(self.names.__getitem__, islice(ids, BLOCK))):
                yield between + block
                between = " "
            return
        value = {s: b for b, s in enumerate(self.symbols)}
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        special = set(self.special.values())
        for i in ids:
            if i in special:
                yield machine.decode(b"", True) + self.names[i]
                machine.reset()
                continue
            name = self.names[i]
            ends = bool(self.suffix) and name.endswith(self.suffix)
            yield machine.decode(bytes(value[c] for c in name.removesuffix(self.suffix)), ends) + (" " if ends else "")
        yield machine.decode(b"", True)

    def digest(self, ids: np.ndarray, *, spaced: bool = True) -> str:
        """SHA-256 of the decoded text in UTF-8, fed with what the machine gives."""
        found = hashlib.sha256()
        for piece in self.text(ids.tolist(), spaced=spaced):
            found.update(piece.encode())
        return found.hexdigest()


def encode(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: the id, ``ids array<int>``, and the digests of the ids and of what they decode to.

    One pass without a shuffle; ``path`` must be readable on every machine.
    """
    source = docs.select(id_col, text_col)
    kind = dict(source.dtypes)[id_col]

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(path)
        for batch, texts in slices(batches):
            ids, starts = bpe.encode(split_words(texts))
            own = [ids[a:b] for a, b in zip(starts, starts[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids.astype(np.int32))),
                    pa.array(np.diff(starts)),
                    pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in own]),
                    pa.array([bpe.digest(x) for x in own]),
                ],
                [id_col, "ids", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return source.mapInArrow(
        task, f"`{id_col}` {kind}, ids array<int>, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def decode(coded: DataFrame, path: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: the id and the text of its ids (null ids: an empty text)."""
    source = coded.select(id_col, ids_col)
    kind = dict(source.dtypes)[id_col]

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(path)
        for batch in batches:
            texts = ["".join(bpe.text(x or ())) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    return source.mapInArrow(task, f"`{id_col}` {kind}, text string")
