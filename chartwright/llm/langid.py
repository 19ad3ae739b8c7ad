"""Language ID (7): family first, then one-versus-one linear SVMs within it.

A text becomes the relative frequencies of its hashed letter n-grams (n = 1 to
3, over lower-cased letters with word ends).  One linear SVM for each family
against the rest picks the family; inside it one linear SVM for each pair of
languages votes, and the language with most votes wins (ties: larger summed
margin, then name).  Every score is linear in the features, so a whole text is
scored by adding up the weights of its n-grams.

Training reads at most ``per_language`` labelled documents of each of at most
``max_languages`` languages (those with most rows), the ones with the least
hash of their id: a bounded sample.  A language that FAMILIES lacks is a family
of its own.

Defined cases: a null text, or one without a letter, is ``und`` with score 0.
Repeated rows give repeated results.  No labelled row at all: everything is
``und``.  One language: it is predicted with score 1.  Only the id, the text and
(for training) the label are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartwright.llm.words import mix, slices

#: Families of languages by their two-letter codes.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("pl", "cs", "sk", "ru", "uk", "bg", "sr", "hr", "sl"),
    "baltic": ("lt", "lv"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk"),
}
UNKNOWN = "und"
FEATURES = 1 << 13
#: Training rows of all labels together: what the driver may be sent.
MAX_ROWS = 9600


def family(lang: str) -> str:
    return next((f for f, members in FAMILIES.items() if lang in members), lang)


def feature_ids(text: str) -> np.ndarray:
    """Hashed n-grams of the letters, lower-cased, other characters as word ends; empty without a letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = (codes >= 97) & (codes <= 122) | (codes >= 0xAA)
    if (codes >= 0xAA).any():
        kinds, back = np.unique(codes, return_inverse=True)
        letters = np.fromiter((chr(c).isalpha() for c in kinds), bool, len(kinds))[back]
    if not letters.any():
        return np.zeros(0, np.int64)
    codes = np.where(letters, codes, np.uint32(32))
    codes = codes[np.concatenate(([True], (codes[1:] != 32) | (codes[:-1] != 32)))]
    codes = np.concatenate(([32] * int(codes[0] != 32), codes, [32] * int(codes[-1] != 32)))
    x = codes.astype(np.uint64)
    two = (x[:-1] << np.uint64(21)) | x[1:]
    three = (two[:-1] << np.uint64(21)) | x[2:]
    one = x[x != 32]
    return (mix(np.concatenate((one, two | np.uint64(1 << 62), three | np.uint64(1 << 63)))) % np.uint64(FEATURES)).astype(np.int64)


def frequencies(text: str) -> np.ndarray:
    """Square roots of the n-grams' shares, of length 1."""
    ids = feature_ids(text)
    return np.sqrt(np.bincount(ids, minlength=FEATURES) / max(1, len(ids)))


def linear_svm(x: np.ndarray, y: np.ndarray, *, c: float = 10.0, rounds: int = 30, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and bias of an L2-regularised linear SVM (hinge loss), by dual coordinate descent."""
    w, b = np.zeros(x.shape[1]), 0.0
    alpha = np.zeros(len(y))
    norm = (x * x).sum(1) + 1.0
    order, draw = np.arange(len(y)), np.random.default_rng(seed)
    for _ in range(rounds):
        draw.shuffle(order)
        moved = 0.0
        for i in order:
            gradient = y[i] * (x[i] @ w + b) - 1.0
            new = min(max(alpha[i] - gradient / norm[i], 0.0), c)
            if step := new - alpha[i]:
                alpha[i] = new
                w += step * y[i] * x[i]
                b += step * y[i]
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w, b


@dataclass(frozen=True)
class Model:
    """All SVMs as one weight matrix; rows: families, then pairs of languages."""

    families: list[str]
    languages: list[str]
    pairs: list[tuple[str, str]]
    weights: np.ndarray
    bias: np.ndarray

    def predict(self, text: str) -> tuple[str, float]:
        if not self.languages:
            return UNKNOWN, 0.0
        x = frequencies(text)
        if not x.any():
            return UNKNOWN, 0.0
        found = self.weights @ x + self.bias if len(self.weights) else np.zeros(0)
        n = len(self.families) if len(self.families) > 1 else 0
        best = max(range(len(self.families)), key=lambda i: found[i]) if n else 0
        name = self.families[best]
        sure = 1.0 if not n else 1 / (1 + np.exp(-2 * found[best]))
        own = [x for x in self.languages if family(x) == name]
        votes = {x: [0, 0.0] for x in own}
        for (a, b), s in zip(self.pairs, found[n:], strict=True):
            if a in votes:
                winner, loser = (a, b) if s >= 0 else (b, a)
                votes[winner][0] += 1
                votes[winner][1] += abs(s)
                votes[loser][1] -= abs(s)
        lang = max(own, key=lambda v: (*votes[v], [-ord(c) for c in v]))
        least = min((abs(s) for p, s in zip(self.pairs, found[n:], strict=True) if lang in p), default=None)
        if least is not None:
            sure *= 1 / (1 + np.exp(-2 * least))
        return lang, float(sure)


class TooManyLabelsError(ValueError):
    """More labels than rows that may be fetched."""


def sample(docs: DataFrame, trainable: Column, *, id_col: str = "doc_id", text_col: str = "text",
           lang_col: str = "lang", per_language: int = 300, max_rows: int = MAX_ROWS) -> list[tuple[str, bytes]]:
    """(label, frequencies) of some documents of every label, ``max_rows`` in all at most.

    Each label has up to ``per_language`` documents, or its equal share of ``max_rows``
    where there are so many labels that this is less.  Of rows of one id one is
    taken.  The vectors are made by the tasks from whole texts; what reaches
    the driver is at most ``max_rows`` vectors of FEATURES half floats.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), trainable.alias("_trainable"))
    rows = rows.filter("_trainable and lang is not null and text is not null").select("id", "text", "lang")
    labels = rows.select("lang").distinct().count()
    if labels > max_rows:
        raise TooManyLabelsError(f"{labels} labels, at most {max_rows} rows")
    most = min(per_language, max_rows // max(1, labels))
    draw = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = rows.select("id", "lang").withColumn("_at", F.row_number().over(draw)).filter(F.col("_at") <= most).select("id", "lang").distinct()
    met = F.broadcast(chosen.limit(max_rows))  # the limit states the bound: there are no more rows
    found = rows.join(met.select(F.col("id").alias("_id"), F.col("lang").alias("_lang")), F.col("id").eqNullSafe(F.col("_id")) & (F.col("lang") == F.col("_lang")), "left_semi")
    kind = dict(rows.dtypes)["id"]

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            vectors = [frequencies(t).astype(np.float16).tobytes() for t in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(vectors, pa.binary())], ["id", "lang", "x"])

    made = found.mapInArrow(task, f"id {kind}, lang string, x binary").groupBy("id", "lang").agg(F.min("x").alias("x"))
    return sorted(((r["lang"], bytes(r["x"])) for r in made.select("lang", "x").collect()), key=lambda r: (r[0], r[1]))


def train(rows: list[tuple[str, bytes]]) -> Model:
    """Fit the hierarchy on labelled vectors of ``sample``."""
    vectors = [(lang, np.frombuffer(x, np.float16).astype(np.float32)) for lang, x in rows]
    vectors = [(lang, x) for lang, x in vectors if x.any()]
    labels = np.array([lang for lang, _ in vectors], dtype=object)
    languages = sorted(set(labels.tolist()))
    families = sorted({family(x) for x in languages})
    x = np.stack([v for _, v in vectors]) if vectors else np.zeros((0, FEATURES), np.float32)
    groups = np.array([family(lang) for lang in labels.tolist()], dtype=object)
    made = []
    if len(families) > 1:
        made += [linear_svm(x, np.where(groups == f, 1.0, -1.0)) for f in families]
    pairs = [(a, b) for f in families for a, b in combinations([v for v in languages if family(v) == f], 2)]
    for a, b in pairs:
        of = (labels == a) | (labels == b)
        made.append(linear_svm(x[of], np.where(labels[of] == a, 1.0, -1.0)))
    weights = np.stack([w for w, _ in made]).astype(np.float32) if made else np.zeros((0, FEATURES), np.float32)
    return Model(families, languages, pairs, weights, np.array([b for _, b in made]))


def predict(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: the id, ``lang_pred`` and ``score``; one pass over whole texts."""
    source = docs.select(id_col, text_col)
    kind = dict(source.dtypes)[id_col]

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            found = [model.predict(t) for t in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                [id_col, "lang_pred", "score"],
            )

    return source.mapInArrow(task, f"`{id_col}` {kind}, lang_pred string, score double")
