"""Declump against the plain-Python pass, edge rows and properties."""

from hypothesis import given, settings
from hypothesis import strategies as st

import pyref
from chartwright.operators.playlists import declump


def _run(spark, artists, passes, lists=1):
    rows = [
        ("M", f"L{j}", i + 1, i, a) for j in range(lists) for i, a in enumerate(artists)
    ]
    df = spark.createDataFrame(rows, "market string, playlist string, position int, id int, _track_artist string")
    out = declump(df, passes).collect()
    by_list = {}
    for r in sorted(out, key=lambda r: (r["playlist"], r["position"])):
        by_list.setdefault(r["playlist"], []).append(r["id"])
    return by_list


EDGE = {
    "empty": [],
    "one row": ["Solo"],
    "all same artist": ["A", "A feat. B", "A", "A"],
    "two empty artists": ["X", "", "", "Y", "Z"],
    "null artist": [None, None, "Q", "Q"],
    "two overlapping pairs in a row": ["A", "A", "B", "B", "C", "D"],
}


def test_edge_rows(spark):
    for name, artists in EDGE.items():
        for passes in (1, 4):
            got = _run(spark, artists, passes).get("L0", [])
            assert got == pyref.declump(artists, passes), (name, passes)


def test_passes_column_limits_per_list(spark):
    rows = [("M", "keep", 1, 0, "A"), ("M", "keep", 2, 1, "A"), ("M", "keep", 3, 2, "B"),
            ("M", "move", 1, 0, "A"), ("M", "move", 2, 1, "A"), ("M", "move", 3, 2, "B")]
    df = spark.createDataFrame(rows, "market string, playlist string, position int, id int, _track_artist string")
    df = df.selectExpr("*", "CASE WHEN playlist = 'keep' THEN 0 ELSE 4 END AS passes")
    got = {}
    for r in declump(df, 4).orderBy("playlist", "position").collect():
        got.setdefault(r["playlist"], []).append(r["id"])
    assert got["keep"] == [0, 1, 2]
    assert got["move"] == pyref.declump(["A", "A", "B"], 4)


names = st.one_of(st.none(), st.sampled_from(["A", "B", "A & B", "C feat. A", "", "the", "Ż", "ż x"]))


@settings(max_examples=20, deadline=None)
@given(st.lists(names, max_size=25), st.integers(min_value=0, max_value=4))
def test_matches_python_and_is_permutation(spark, artists, passes):
    got = _run(spark, artists, passes, lists=2)
    for ids in got.values():
        assert sorted(ids) == list(range(len(artists)))
        assert ids == pyref.declump(artists, passes)
