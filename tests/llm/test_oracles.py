"""Registered queries against DuckDB, and the plans of the operators that use DataFrame functions only."""

from __future__ import annotations

import duckdb
import pytest

from chartwright.llm.queries import oracle_sql, queries
from conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in "documents pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = queries()[name](spark, SF_SMALL)
    result = con.execute(oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    mine = sorted(repr([r[c] for c in sorted(columns)]) for r in df.collect())
    theirs = sorted(repr([r[columns.index(c)] for c in sorted(columns)]) for r in result.fetchall())
    assert mine == theirs


@pytest.mark.parametrize("name", ["op4_decontamination", "op8_chat_formatting"])
def test_dataframe_functions_only(spark, name):
    plan = queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries()) == list(range(1, 11))
