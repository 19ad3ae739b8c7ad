"""Packing along the Hilbert curve, against the tokenizers library and a plain statement of the packing."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

from chartwright.llm import packing

from conftest import SF_SMALL

VOCABULARY = packing.Vocabulary(
    public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, public_tokenizers.path("byte_bpe_50k.json"))
LIBRARY = Tokenizer.from_file(VOCABULARY.file)


def ids(text: str | None) -> list[int]:
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0]


def whole(rows, texts, length=1024):
    """The packing's rules, on rows of pieces: every id once, sequences gapless, no padding but at the end, and there none."""
    of = {}
    for r in rows:
        of.setdefault(r["doc_id"], []).append(r)
    assert set(of) == set(texts)
    for doc, pieces in of.items():
        own, at = ids(texts[doc]), 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(own) and r["length"] > 0
            assert r["ids_crc32"] == zlib.crc32(np.array(own[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(own)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    padding = 0
    for pieces in sequences.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    assert padding == 0
    assert sorted(sequences) == list(range(len(sequences)))


def test_query_against_the_library(spark):
    from chartwright.llm import queries

    texts = {r["doc_id"]: r["text"] for r in queries.table(spark, SF_SMALL, "documents").collect()}
    whole(queries.op11_packing(spark, SF_SMALL).collect(), texts)


def test_ids_are_the_librarys(spark):
    rng = random.Random(3)
    special = ["<|endoftext|>", "<|endof", "  ", "\n\n", "'ll", "'S", " ", "　", "é", "\U0001f600", "\x00", "\u0085", "東京", "naïve", "123", "x" * 700]
    for _ in range(400):
        text = "".join(rng.choice(special) if rng.random() < 0.4 else chr(rng.randrange(32, 0x2FF)) for _ in range(rng.randrange(1, 60)))
        assert packing.ids_of(text, VOCABULARY).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids, repr(text)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for lo in range(0, len(points), 4096):
        text = "".join(f"a{chr(c)}1{chr(c)} {chr(c)}" for c in points[lo : lo + 4096])
        assert packing.ids_of(text, VOCABULARY).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids, hex(points[lo])


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_visits_every_cell_by_single_steps(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = packing.hilbert(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_like_documents_are_neighbours():
    """Documents about one of 16 topics lie next to one of their own topic more than four times as often as by chance."""
    rng = np.random.default_rng(5)
    topics = [rng.integers(1, 50_000, 300) for _ in range(16)]
    made = [(t, rng.choice(topics[t], 400)) for t in rng.integers(0, 16, 600).tolist()]
    starts = np.concatenate(([0], np.cumsum([len(x) for _, x in made])))
    points = packing.vectors(np.concatenate([x for _, x in made]).astype(np.uint32), starts)
    order = np.argsort(packing.curve_keys(points, points.mean(axis=0), points.std(axis=0)))
    labels = np.array([t for t, _ in made])[order]
    assert (labels[1:] == labels[:-1]).mean() > 4 / 16


def test_boundaries():
    assert packing.boundaries(0, 1024) == (0, [0])
    assert packing.boundaries(2048, 1024) == (2, [2048])
    assert packing.boundaries(1024 + 700, 1024) == (1, [1024, 1536, 1664, 1696, 1712, 1720, 1724])


SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       *(T.StructField(c, T.StringType()) for c in ("id", "row", "key", "n", "ids", "start", "c0", "sequence_id"))])


def test_edge_cases(spark):
    texts = {1: None, 2: "", 3: " \n ", 4: "one", 5: "same text", 6: "same text", 7: "same text", 8: "lorem ipsum " * 20_000, 9: "<|endoftext|>", 10: "x" * 30_000}
    rows = [(d, t, *["clash"] * 8) for d, t in texts.items()]
    pieces = packing.pack(spark.createDataFrame(rows, SCHEMA), VOCABULARY)
    from pyspark.sql import functions as F

    whole([r.asDict() for r in pieces.withColumn("ids_crc32", F.crc32("ids")).withColumnRenamed("id", "doc_id").collect()], texts)
    assert packing.pack(spark.createDataFrame([], SCHEMA), VOCABULARY).count() == 0
    twice = packing.pack(spark.createDataFrame([(None, "a", *[""] * 8), (1, "b", *[""] * 8), (1, "b", *[""] * 8)], SCHEMA), VOCABULARY).collect()
    assert sorted((r["id"] is None, r["doc_tokens"]) for r in twice) == [(False, 2), (False, 2), (True, 2)]
    assert sum(r["length"] for r in twice) == 6


def test_a_key_of_one_document_only_is_split(spark):
    """Copies share a key; the ranges they are sorted by go on by row."""
    from pyspark.sql import functions as F

    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("the same words in every text").alias("text"))
    from chartwright.llm.ranges import running

    rows = docs.select(F.lit(7).alias("key"), F.col("doc_id").alias("row"), F.lit(3).cast("long").alias("n"))
    placed, total = running(rows, ["key", "row"], "n")
    assert total == 12_000 and sorted(r["start"] for r in placed.collect()) == list(range(0, 12_000, 3))
    ranges = rows.repartitionByRange(8, "key", "row").groupBy(F.spark_partition_id()).count().collect()
    assert len(ranges) == 8 and max(r["count"] for r in ranges) < 1000
    assert packing.pack(docs, VOCABULARY).agg(F.sum("length")).first()[0] == 4000 * len(ids("the same words in every text"))
