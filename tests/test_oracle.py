"""Every registered query against its DuckDB oracle (sf0.001)."""

import re

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events".split()
# the training-data queries have their own tests
NAMES = sorted(n for n in E.queries() if not re.match(r"op\d+_|pipeline$", n))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    res = con.execute(E.oracle_sql()[name])
    dcols, drows = [d[0] for d in res.description], res.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _canon(scols, srows) == _canon(dcols, drows)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql())
