"""The split fuzzy join equals the all-pairs predicate."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import pyref
from chartwright.operators import playlists as P
from chartwright.operators.shortvideo import fuzzy_match_tracks

CHART = ("market string, chart_rank int, track_isrc string, _track_uri string, _track_artist string, "
         "_track_name string")
SV = ("market string, feed string, tt_rank int, isrc_cd string, _artist_name_tt string, "
      "_track_name_tt string, tt_creations long")


def brute_force(chart_rows, sv_rows, tn=0.9, ta=0.9):
    out = set()
    for c in chart_rows:
        for s in sv_rows:
            if c[0] != s[0]:
                continue
            ok = (pyref.cosine(c[5], s[5]) >= tn and pyref.cosine(c[4], s[4]) >= ta) or (
                c[2] is not None and c[2] == s[3])
            if ok:
                out.add((c[0], c[1], s[1], s[2]))
    return out


def _pairs(df):
    return {(r["market"], r["chart_rank"], r["tt_feed"], r["tt_rank"]) for r in df.collect()}


def test_split_join_equals_all_pairs_on_fixture(spark):
    import __spark_entry__ as E

    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        job = E._job(spark, sf)
        chart = job.chart.filter("chart_rank <= 500")
        c_rows = [tuple(r) for r in chart.select(*[f.split()[0] for f in CHART.split(", ")]).collect()]
        s_rows = [tuple(r) for r in job.short_video.select(*[f.split()[0] for f in SV.split(", ")]).collect()]
        got = _pairs(job.fuzzy_pairs())
        assert got == brute_force(c_rows, s_rows)
        assert len(got) > 0


words = st.sampled_from(["ana", "nana", "Łódź", "ring", "gnir", "small", "blue", "", "x", "feat.", "💔", "A-B"])
names = st.lists(words, max_size=4).map(" ".join)


@settings(max_examples=10, deadline=None)
@given(
    st.lists(st.tuples(names, names, st.sampled_from(["I1", "I2", None])), min_size=1, max_size=12),
    st.lists(st.tuples(names, names, st.sampled_from(["I1", "I3", None])), min_size=1, max_size=12),
    st.sampled_from([0.5, 0.8, 0.9, 1.0]),
)
def test_split_join_property(spark, left, right, t):
    c_rows = [("M", i + 1, isrc, f"u{i}", artist, name) for i, (name, artist, isrc) in enumerate(left)]
    s_rows = [("M", "SME", i + 1, isrc, artist, name, 10) for i, (name, artist, isrc) in enumerate(right)]
    chart = spark.createDataFrame(c_rows, CHART)
    sv = spark.createDataFrame(s_rows, SV)
    assert _pairs(fuzzy_match_tracks(chart, sv, t, t)) == brute_force(c_rows, s_rows, t, t)


def test_thresholds_must_be_positive(spark):
    chart = spark.createDataFrame([("M", 1, "I", "u", "a", "n")], CHART)
    sv = spark.createDataFrame([("M", "SME", 1, "I", "a", "n", 1)], SV)
    with pytest.raises(ValueError):
        fuzzy_match_tracks(chart, sv, 0.0, 0.9)


def test_viral_first_pair_wins(spark):
    cols = ("market string, chart_rank int, track_isrc string, _track_uri string, _track_artist string, "
            "_track_name string, tt_feed string, tt_rank int, isrc_cd string, tt_creations long")
    pairs = spark.createDataFrame([
        ("M", 1, "A", "uA", "x", "n", "ORCHARD", 1, "A", 900),   # most creations, but ORCHARD
        ("M", 1, "A", "uA", "x", "n", "SME", 2, "A", 10),        # SME first in pair order -> wins
        ("M", 2, "B", "uB", "y", "n", "SME", 1, "B", 50),
    ], cols)
    got = {r["_track_uri"]: (r["tt_feed"], r["tt_creations"], r["position"]) for r in P.viral_selection(pairs).collect()}
    assert got == {"uA": ("SME", 10, 2), "uB": ("SME", 50, 1)}
