"""Physical-plan checks over the operators, with all stages in one plan."""

import re

import pytest

import __spark_entry__ as E
from chartwright.operators import playlists as P
from chartwright.operators.shortvideo import candidate_texts
from chartwright.plans.daily import daily_lists
from conftest import SF_MID, SF_SMALL

BANNED = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInArrow", "CartesianProduct", "BroadcastNestedLoopJoin")
STAGES = {
    "top_sme": lambda j: j.top_sme,
    "top_orchard": lambda j: j.top_orchard,
    "segments_sme": lambda j: j.segments("SME"),
    "segments_orchard": lambda j: j.segments("ORCHARD"),
    "covers": lambda j: j.covers("SME"),
    "tracks": lambda j: j.tracks,
    "metadata": lambda j: j.metadata,
    "releases": lambda j: j.releases,
    "shares": lambda j: j.shares,
    "chart": lambda j: j.chart,
    "short_video": lambda j: j.short_video,
    "fuzzy_pairs": lambda j: j.fuzzy_pairs(),
    "viral": lambda j: j.viral(),
    "lists": daily_lists,
    "batches": lambda j: P.playlist_batches(j.playlists(), j.params.day),
}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    job = E._job(spark, SF_SMALL, materialize=False)
    return {name: _plan(stage(job)) for name, stage in STAGES.items()}


def test_no_python_and_no_pair_explosion(plans):
    for name, plan in plans.items():
        for op in BANNED:
            assert op not in plan, (name, op)


def test_the_plans_hold_the_stages(plans):
    for name in ("chart", "tracks", "lists", "batches"):
        assert plans[name].count("Join") > 5 and plans[name].count("Exchange") > 5, name


def test_top_k_is_a_partial_group_limit(plans):
    assert "WindowGroupLimit" in plans["top_sme"]
    assert "WindowGroupLimit" in plans["covers"]


def test_top_tracks_shuffle_no_consumers_and_sum_numbers_only(plans):
    for name in ("top_sme", "top_orchard"):
        plan = plans[name]
        assert "consumer_key" not in plan
        # everything below the cut sums by hash; sorting aggregates serve the listed ISRCs' texts alone
        below = plan[plan.index("WindowGroupLimit"):]
        assert "HashAggregate(keys=[market" in below
        for line in plan.splitlines():
            if "SortAggregate" in line:
                assert "min(" in line and "sum(" not in line, line


def test_segments_are_cut_to_the_top_list_before_the_consumer_shuffle(plans):
    lines = plans["segments_sme"].splitlines()
    shuffle = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(" in line and "consumer_key" in line)
    below = "\n".join(lines[shuffle:])
    assert re.search(r"Join.*partner_info_key", below)


def test_cover_window_is_closed_on_both_sides(plans):
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plans["covers"])
    assert any(">=" in f and "<=" in f and "report_date" in f for f in filters), filters


def test_fuzzy_join_gives_few_candidates_each_once(spark):
    job = E._job(spark, SF_MID)
    chart = job.chart.filter("chart_rank <= 500")
    found = candidate_texts(chart, job.short_video, job.params.name_threshold, job.params.artist_threshold)
    rows, pairs = found.count(), found.select("l_market", "l_name", "l_artist", "r_name", "r_artist").distinct().count()
    every = chart.count() * job.short_video.count()
    assert rows == pairs and 0 < rows < every / 5, (rows, pairs, every)


def test_day_slice_prunes_partitions(spark):
    plan = _plan(E._job(spark, SF_SMALL)._track_streams["SME"])
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert any("report_date" in f and "country_code_stream" in f for f in filters), filters


def test_staging_splits_a_large_day_and_market(spark):
    from chartwright.sources.fixtures import chart_inputs

    facts = chart_inputs(spark, SF_SMALL).streams["SME"]
    plan = _plan(facts.hint("rebalance", "report_date", "country_code_stream"))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_scans_read_only_needed_columns(spark):
    from chartwright.sources.fixtures import chart_inputs

    inputs = chart_inputs(spark, SF_SMALL)
    plan = _plan(inputs.streams["SME"])
    lineitem_schema = [p for p in plan.split("ReadSchema: ") if p.startswith("struct<l_orderkey")][0]
    assert "l_extendedprice" not in lineitem_schema and "l_comment" not in lineitem_schema


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["market", "playlist", "position", "chart_rank", "track_isrc", "_track_uri", "_track_artist"]
