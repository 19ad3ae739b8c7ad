"""Stand-in inputs: staged when asked for, the same rows as the views, the lines shuffled once by order."""

import os
import re

from chartwright.sources.fixtures import StagedInputs, chart_inputs
from conftest import SF_SMALL


def test_inputs_are_staged_when_asked_for(spark, tmp_scratch):
    base = tmp_scratch("inputs")
    staged, views = StagedInputs(spark, SF_SMALL, base), chart_inputs(spark, SF_SMALL)
    assert staged.product_releases.columns == views.product_releases.columns
    for feed, facts in staged.streams.items():
        assert facts.dtypes == views.streams[feed].dtypes
        assert facts.count() > 0 and facts.exceptAll(views.streams[feed]).isEmpty() and views.streams[feed].exceptAll(facts).isEmpty()
    assert sorted(os.listdir(base)) == ["consumer_segments", "streams"]


def test_lines_meet_orders_that_know_their_customer(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = chart_inputs(spark, SF_SMALL).streams["SME"]._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    by_customer = [i for i, line in enumerate(lines) if re.search(r"Exchange hashpartitioning\((o_custkey|consumer_key)", line)]
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    for i in by_customer:
        end = next((j for j in range(i + 1, len(lines)) if depth(lines[j]) <= depth(lines[i])), len(lines))
        assert "l_orderkey" not in "\n".join(lines[i:end])
    assert by_customer
