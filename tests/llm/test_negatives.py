"""Hard negatives against a plain statement of the rules."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chartwright.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, id string, score string, positives string, part string"


def expected(rows, every=5, positives=5, n=3):
    best = {}
    for ident, vector, label in rows:
        if ident is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        vector = [float(np.float32(x)) for x in vector]
        if ident not in best or (label, vector) < best[ident]:
            best[ident] = (label, vector)
    q = {i: (lab, [math.floor(256 * x) for x in v]) for i, (lab, v) in best.items()}
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a, (label, va) in q.items():
        if a % every:
            continue
        scored = sorted((-dot(va, v), i, lab) for i, (lab, v) in q.items() if i != a)
        for minus, p, lab in [s for s in scored if s[2] == label][:positives]:
            ps = -minus
            inside = [(i, -m) for m, i, lab2 in scored if lab2 != label and 50 * ps <= -100 * m <= 95 * ps][:n]
            out += [(a, p, k + 1, i, ps, s) for k, (i, s) in enumerate(inside)]
    return sorted(out)


def found(spark, rows, group_rows=64, **kw):
    df = spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], SCHEMA)
    return sorted(tuple(r) for r in negatives.mine(df, F.col("id") % 5 == 0, group_rows=group_rows, **kw).collect())


def rows_of(seed, n, dims, spread, labels=4):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0.1, spread) for _ in range(dims)], rng.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize(("seed", "n", "dims", "spread"), [(1, 300, 8, 0.3), (2, 150, 3, 0.05), (3, 200, 4, 40.0)])
def test_against_plain_rules(spark, seed, n, dims, spread):
    rows = rows_of(seed, n, dims, spread)
    want = expected(rows)
    assert want and found(spark, rows) == want


def test_ties_and_copies(spark):
    """A vector held by most rows: all ties go by id, over every group."""
    rows = [(i, [0.5, 0.25], i % 2) for i in range(120)] + [(200 + i, [0.4, 0.2 + i / 100], i % 3) for i in range(30)]
    assert found(spark, rows, group_rows=16) == expected(rows)


def test_zero_and_negative_scores(spark):
    rows = [(0, [0.0, 0.0], 1), (1, [0.3, 0.1], 1), (2, [0.2, 0.2], 2), (5, [-0.5, -0.5], 1), (6, [0.5, 0.4], 1), (7, [0.4, 0.5], 2), (10, [0.5, 0.5], 2)]
    want = expected(rows)
    assert found(spark, rows) == want and any(r[4] == 0 for r in want)


def test_rows_that_take_no_part(spark):
    rows = rows_of(4, 60, 3, 0.3) + [
        (None, [1.0, 1.0, 1.0], 1), (100, None, 1), (105, [1.0, None, 1.0], 1), (110, [1.0, float("nan"), 1.0], 1), (115, [float("inf"), 0.0, 0.0], 1),
        (120, [0.1, 0.1, 0.1], None), (125, [], 2), (130, [0.5], 1)]
    assert found(spark, rows) == expected(rows)
    repeated = rows_of(5, 40, 3, 0.3)
    assert found(spark, repeated + repeated) == expected(repeated)
    other = [(5, [0.9, 0.9, 0.9], 0)]
    assert found(spark, repeated + other) == expected(repeated + other)
    assert found(spark, []) == []
    assert found(spark, [(5, [0.1], 1)]) == []


def test_large_components(spark):
    """Scores beyond 2 ** 53 are still exact; beyond 64 bits they are refused."""
    rows = [(i, [1e6 + i, 3e5 * (i % 7), 2e6 - 13 * i], i % 3) for i in range(0, 60)]
    assert found(spark, rows) == expected(rows)
    with pytest.raises(Exception, match="an inner product may reach"):
        found(spark, [(0, [1e30], 1), (1, [1e30], 1), (2, [1e30], 2)])


def test_products():
    rng = np.random.default_rng(1)
    for top in (200, 1 << 20, 1 << 28):
        a, b = (np.floor(rng.uniform(-top, top, (5, 7))) for _ in range(2))
        want = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
        assert negatives.inner_products(a, b).astype(np.int64).tolist() == want
