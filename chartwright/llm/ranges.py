"""Running sums over a whole table in a given order, without one task seeing it all.

Rows are dealt by ranges of the order and sorted inside each range; a task adds
up its own range, and the ranges' totals (one number per range) are added up on
the driver.  The order should end in a column that tells equal rows apart, so
that a key held by very many rows is split over several ranges.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartwright.plans.session import materialize


def running(rows: DataFrame, order: list[str], weight: str | None = None, *, start: str = "start", name: str = "ranges") -> tuple[DataFrame, int]:
    """The rows with ``start``, the weights (or number) of the rows before them, and the total.

    ``rows`` must read the same each time (a table, or a stage): ranges are
    found by a first look at the order's columns.  Nulls come first.
    """
    part, at = "_range", "_before"
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema]

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            if weight is None:
                own = np.ones(batch.num_rows, np.int64)
            else:
                own = batch.column(batch.schema.get_field_index(weight)).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = done + np.cumsum(own)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(batch.num_rows, number, np.int32)), pa.array(ends - own)], [*batch.schema.names, part, at])
            done = int(ends[-1]) if len(ends) else done

    in_order = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    staged = materialize(in_order.mapInArrow(task, ", ".join([*fields, f"{part} int", f"{at} long"])), name)
    size = F.lit(1) if weight is None else F.col(weight)
    totals = sorted(tuple(r) for r in staged.groupBy(part).agg(F.sum(size).cast("long")).collect())  # one row per range
    upto = list(accumulate((n for _, n in totals), initial=0))
    before = rows.sparkSession.createDataFrame(
        [(p, b) for (p, _), b in zip(totals, upto, strict=False)], f"{part} int, _earlier long")
    placed = staged.join(F.broadcast(before), part)
    return placed.select(*rows.columns, (F.col("_earlier") + F.col(at)).alias(start)), upto[-1]
