"""Text helpers as Column expressions (JVM-side, no Python UDF).

* ``artist_tokens`` (F6-F9): lower-case, drop everything but letters,
  digits, underscore and whitespace (Unicode-aware), drop stop words, and
  return the distinct words.  An artist that cleans to nothing gives
  ``[""]`` (so two such artists overlap); a NULL artist gives NULL (never
  overlaps).
* ``char_counts`` (F11, F12): lower-case, drop the 32 ASCII punctuation
  characters, count code points (spaces count).
* ``cosine`` (F13): cosine of two count maps, 0.0 when either is empty.

Pitfalls handled: Java's plain ``\\w`` is ASCII-only and would eat ``Ż``
or ``Ł``; ``(?U)\\w`` still eats ``²`` and ``½``, so the kept set is
spelled out as ``\\p{L}\\p{N}_``.  ``split(s, '')`` yields one empty
element for ``''``, so characters come from ``regexp_extract_all``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartwright import defaults as D

# Whitespace as Python's str.split() sees it: Unicode White_Space plus the
# four information separators U+001C..U+001F.
NOT_WORD_OR_SPACE = r"(?U)[^\p{L}\p{N}_\s\x{1C}-\x{1F}]"
WHITESPACE_RUN = r"(?U)[\s\x{1C}-\x{1F}]+"
ASCII_PUNCTUATION = r"\p{Punct}"
ANY_CODE_POINT = r"(?s)."


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body``.

    Lambda bodies are evaluated per element and share no subexpressions, so
    a value used inside one (or used twice) is bound through a one-element
    array instead of being recomputed.
    """
    return F.transform(F.array(value), body)[0]


def clean_words(artist: Column | str, stop_words: tuple[str, ...] = D.STOP_WORDS) -> Column:
    """Words of the cleaned, lower-cased text without stop words (may be empty)."""
    cleaned = F.regexp_replace(F.lower(_col(artist)), NOT_WORD_OR_SPACE, "")
    words = F.split(cleaned, WHITESPACE_RUN)
    stops = [F.lit(w) for w in stop_words]
    return F.filter(words, lambda w: (w != "") & ~w.isin(*stops))


def artist_tokens(artist: Column | str, stop_words: tuple[str, ...] = D.STOP_WORDS) -> Column:
    """the token set used to detect neighbouring tracks by one artist."""
    tokens = let(
        clean_words(artist, stop_words),
        lambda words: F.when(F.size(words) == 0, F.array(F.lit(""))).otherwise(F.array_distinct(words)),
    )
    return F.when(_col(artist).isNull(), F.lit(None).cast("array<string>")).otherwise(tokens)


def tokens_overlap(a: Column, b: Column) -> Column:
    """True when two token sets share a token; NULL on either side is False."""
    return F.coalesce(F.arrays_overlap(a, b), F.lit(False))


def similarity_text(text: Column | str) -> Column:
    """lower-case and remove ASCII punctuation; other marks stay."""
    return F.regexp_replace(F.lower(_col(text)), ASCII_PUNCTUATION, "")


def char_counts(text: Column | str) -> Column:
    """map code point -> count of the preprocessed text (NULL stays NULL).

    Each distinct code point is counted natively as the length lost when it
    is removed, so the lambda runs once per distinct character.
    """
    def counts(s: Column) -> Column:
        distinct = F.array_distinct(F.regexp_extract_all(s, F.lit(ANY_CODE_POINT), 0))
        return F.map_from_entries(F.transform(
            distinct,
            lambda ch: F.struct(
                ch.alias("key"),
                (F.char_length(s) - F.char_length(F.replace(s, ch, F.lit("")))).cast("bigint").alias("value"),
            ),
        ))

    return F.when(_col(text).isNotNull(), let(similarity_text(text), counts))


def squared_norm(counts: Column) -> Column:
    return F.aggregate(F.map_values(counts), F.lit(0).cast("bigint"), lambda acc, v: acc + v * v)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.map_entries(a),
        F.lit(0).cast("bigint"),
        lambda acc, e: acc + e["value"] * F.coalesce(F.try_element_at(b, e["key"]), F.lit(0)),
    )


def cosine(a: Column, b: Column, norm_a: Column | None = None, norm_b: Column | None = None) -> Column:
    """``dot / (sqrt(|a|^2) * sqrt(|b|^2))``; 0.0 if either is empty or NULL.

    The operation order (integer dot product, product of two square roots)
    is kept so results are bit-identical to a plain-Python evaluation.
    """
    na = squared_norm(a) if norm_a is None else norm_a
    nb = squared_norm(b) if norm_b is None else norm_b
    value = dot(a, b).cast("double") / (F.sqrt(na) * F.sqrt(nb))
    return F.coalesce(F.when((na > 0) & (nb > 0), value), F.lit(0.0))
