"""Tokens and character cosine against plain-Python expectations."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import pyref
from chartwright.functions.text import artist_tokens, char_counts, cosine, tokens_overlap

ARTISTS = {
    "Żabson & Sanah, feat. The ŁONA²_x½": {"żabson", "sanah", "łona²_x½"},
    "the and feat": {""},          # only stop words
    "!!! ... ,,,": {""},           # only punctuation
    "": {""},
    None: None,
    "  Sanah   ft.  Vito  Bambino ": {"sanah", "vito", "bambino"},
    "Kękę x TACONAFIDE": {"kękę", "x", "taconafide"},
    "AC/DC": {"acdc"},
    "Beyoncé feat. JAY-Z": {"beyoncé", "jayz"},
}


def _tokens(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, a string")
    rows = df.select("i", artist_tokens("a").alias("t")).orderBy("i").collect()
    return [None if r["t"] is None else set(r["t"]) for r in rows]


def test_artist_tokens_edge_rows(spark):
    assert _tokens(spark, list(ARTISTS)) == list(ARTISTS.values())


def test_unicode_letters_and_numbers_stay(spark):
    (t,) = _tokens(spark, ["Żabson & Sanah, feat. The ŁONA²_x½"])
    assert t == {"żabson", "sanah", "łona²_x½"}


def test_empty_artists_overlap_null_never(spark):
    df = spark.createDataFrame([("", ""), (None, None), ("", None), ("a b", "b c")], "x string, y string")
    got = [r[0] for r in df.select(tokens_overlap(artist_tokens("x"), artist_tokens("y"))).collect()]
    assert got == [True, False, False, True]


COSINE_PAIRS = [
    ("Hello, World!", "hello world"),   # equal after punctuation is removed
    ("listen", "silent"),                # anagrams: 1.0
    ("", "text"),                        # empty: 0.0
    ("...", "abc"),                      # punctuation only: 0.0
    ("love 💔", "love 💔"),              # emoji is one code point
    ("don’t", "dont"),                   # typographic apostrophe stays
    ("Ąę ŻÓŁ", "ąę żół"),
    (None, "x"),
]


def test_cosine_edge_rows(spark):
    df = spark.createDataFrame(list(enumerate(COSINE_PAIRS)), "i int, p struct<a:string,b:string>")
    rows = df.select("i", cosine(char_counts("p.a"), char_counts("p.b")).alias("c")).orderBy("i").collect()
    got = [r["c"] for r in rows]
    assert got == [pyref.cosine(a, b) for a, b in COSINE_PAIRS]
    assert got[1] == pytest.approx(1.0) and got[2] == 0.0 and got[3] == 0.0


def test_char_counts_by_code_point(spark):
    (r,) = spark.createDataFrame([("A a-b 💔💔",)], "s string").select(char_counts("s").alias("m")).collect()
    assert dict(r["m"]) == {"a": 2, " ": 2, "b": 1, "💔": 2}


text = st.lists(
    st.sampled_from(list("abcłżó ŁŻ.,-!'’ 12²_💔") + ["feat", " the ", " ft. "]), max_size=12
).map("".join)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(text, text), min_size=1, max_size=15))
def test_cosine_matches_python_and_is_symmetric(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string").withColumn("i", F.monotonically_increasing_id())
    rows = df.select(
        "a", "b",
        cosine(char_counts("a"), char_counts("b")).alias("ab"),
        cosine(char_counts("b"), char_counts("a")).alias("ba"),
    ).collect()
    for r in rows:
        assert r["ab"] == pyref.cosine(r["a"], r["b"])
        assert r["ab"] == pytest.approx(r["ba"])
        assert -1e-12 <= r["ab"] <= 1 + 1e-12


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.none(), text), min_size=1, max_size=15))
def test_tokens_match_python(spark, artists):
    assert _tokens(spark, artists) == [pyref.tokens(a) for a in artists]


def test_unicode_whitespace_like_python(spark):
    odd = ["a\u00a0b", "a\x1cb\x1fc", "a\u2003b\u3000c", "x\u0085y", "tab\tand\nnew\x0bz"]
    assert _tokens(spark, odd) == [pyref.tokens(a) for a in odd]
    assert _tokens(spark, ["a\x1cb"]) == [{"a", "b"}]
