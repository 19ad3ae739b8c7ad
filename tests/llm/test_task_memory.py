"""What a task holds: caches go with the task, rows travel in bounded batches."""

import gc
import random
import weakref

import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from chartwright.llm import bpe, fertility, jaccard, queries
from pyspark.sql import functions as F

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.mark.parametrize(("make", "file"), [(bpe.Bpe, "word_bpe_49k.json"), (fertility.Fertility, "piece_bpe_32k.model")])
def test_caches_go_with_their_owner(make, file):
    """A worker is used for other tasks: nothing waits for a collection there."""
    gc.collect()
    gc.disable()
    try:
        coder = make(public_tokenizers.path(file))
        assert (coder.words if make is bpe.Bpe else coder.known)[b"word"]
        owner = weakref.ref(coder)
        del coder
        assert owner() is None
    finally:
        gc.enable()


def test_filed_keys_leave_in_bounded_batches():
    class Docs:
        def mapInArrow(self, task, schema):  # noqa: N802
            return task

    class Held:
        def __init__(self, value):
            self.value = value

    draw = random.Random(3)
    texts = [" ".join(str(draw.randrange(10**6)) for _ in range(500)) for _ in range(1500)]
    assert sum(map(len, texts)) > 5_000_000
    none = np.zeros(0, np.uint64)
    task = jaccard._filed(Docs(), jaccard.SHINGLE, jaccard.Plan(jaccard.THRESHOLD), Held(none), Held((none, none)))
    made = list(task([pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["id", "text"])]))
    assert max(b.nbytes for b in made) < 6 << 20
    assert len(set(pa.concat_batches(made).column(2).to_pylist())) == len(texts)


def test_arrow_batches_bounds_what_a_task_is_given(spark):
    from chartwright.plans.session import arrow_batches

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes]), pa.array([b.num_rows])], ["size", "rows"])

    wide = spark.range(0, 6000, 1, 1).select(F.repeat(F.lit("abcdefghij"), 300).alias("text"))
    before = spark.conf.get(LIMIT)
    with arrow_batches(spark):
        got = wide.mapInArrow(sizes, "size long, rows long").collect()
    assert spark.conf.get(LIMIT) == before
    assert sum(r["rows"] for r in got) == 6000 and max(r["size"] for r in got) < 5 << 20


def test_near_duplicates_run_with_bounded_batches(spark, monkeypatch):
    """In the pipeline and in the query; the session's own limit is back afterwards."""
    seen = []

    def told(docs):
        seen.append(docs.sparkSession.conf.get(LIMIT))
        return docs.select("doc_id", F.col("doc_id").alias("component_id"), F.col("doc_id").alias("class_id"))

    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    monkeypatch.setattr(jaccard, "near_duplicates", told)
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    before = spark.conf.get(LIMIT)
    assert corpus_pipeline.near_duplicates(spark, docs, "").count() == 2
    assert queries.op6_jaccard_join(spark, "").count() == 2
    assert seen == ["4m", "4m"] and spark.conf.get(LIMIT) == before
