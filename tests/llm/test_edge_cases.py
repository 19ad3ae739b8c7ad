"""Every operator on nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartwright.llm import bpe, chat, decontaminate, extract, fertility, jaccard, langid, licenses, passages, warc

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
EMPTY = hashlib.sha256(b"").hexdigest()
LONG = "lorem ipsum " * 30_000

# columns named like the operators' own
CLASH = ["n", "key", "hash", "target", "set", "kept", "labels", "ids", "component", "_id"]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       *(T.StructField(c, T.StringType()) for c in CLASH)])
ROWS = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two three"), (6, "A b C d E f g H i"), (7, "A b C d E f g H i"),
        (8, LONG), (9, LONG), (10, "naïve Ünïcode Σίσυφος 東京 😀 text"), (11, "x" * 50_000), (11, "x" * 50_000)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, *["clash"] * len(CLASH)) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_bpe(docs, none):
    found = bpe.encode(docs, WORD_BPE)
    rows = by_id(found)
    assert found.count() == len(ROWS)
    assert rows[1]["n_tokens"] == rows[2]["n_tokens"] == rows[3]["n_tokens"] == 0
    assert rows[1]["ids_sha256"] == rows[1]["decoded_sha256"] == EMPTY
    assert rows[8]["ids_sha256"] == rows[9]["ids_sha256"]
    assert bpe.encode(none, WORD_BPE).count() == 0
    texts = by_id(bpe.decode(found, WORD_BPE))
    assert texts[1]["text"] == "" and texts[6]["text"].split() == "a b c d e f g h i".split()


def test_licenses(docs, none):
    rows = by_id(licenses.scan(docs))
    assert rows[1] | {"doc_id": 0} == rows[2] | {"doc_id": 0}
    assert rows[1]["n_words"] == 0 and rows[1]["labels"] == "" and rows[1]["score"] == 0 and rows[1]["first_word"] is None
    assert rows[8]["n_words"] == 60_000
    assert licenses.scan(none).count() == 0


def test_passages(docs, none):
    found = passages.passages(docs).collect()
    assert {(r["id"], r["target"], r["start"]) for r in found if r["end"] - r["start"] > 50_000} == {(9, 8, 0)}
    assert all(r["target"] < r["id"] for r in found)
    assert passages.passages(none).count() == 0
    cut = passages.cut(docs, passages.passages(docs))
    assert cut.columns == docs.columns and cut.count() == docs.count()
    assert by_id(cut)[9]["text"] == "" and by_id(cut)[1]["text"] is None and by_id(cut)[8]["text"] == LONG


def test_decontamination(spark, docs, none):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "a b c"), (4, "a b c"), (5, "lorem ipsum " * 10)], "item_id long, text string")
    rows = by_id(decontaminate.contamination(docs, items))
    assert rows[6]["n_hit"] == 3 and rows[6]["n_items"] == 2 and rows[6]["items_sha256"] == hashlib.sha256(b"3,4").hexdigest()
    assert rows[8]["n_hit"] == 60_000 and rows[8]["contaminated"]
    assert rows[1]["n_words"] == 0 and not rows[1]["contaminated"] and rows[1]["items_sha256"] == EMPTY
    assert not any(r["contaminated"] for r in decontaminate.contamination(docs, items.limit(0)).collect())
    assert decontaminate.contamination(none, items).count() == 0


def test_jaccard(docs, none):
    found = jaccard.near_duplicates(docs)
    rows = by_id(found)
    assert found.count() == len({r[0] for r in ROWS})
    assert {i: r["component_id"] for i, r in rows.items()} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, 7: 6, 8: 8, 9: 8, 10: 10, 11: 11}
    assert [rows[i]["n_shingles"] for i in (1, 2, 3, 4, 5, 6, 8)] == [0, 0, 0, 1, 1, 5, 2]
    assert jaccard.near_duplicates(none).count() == 0


def test_language(docs, none):
    model = langid.train(langid.sample(docs.withColumn("lang", F.lit(None).cast("string")), F.lit(True)))
    assert {r["lang_pred"] for r in langid.predict(docs, model).collect()} == {"und"}
    model = langid.train(langid.sample(docs.withColumn("lang", F.lit("la")), F.lit(True)))
    rows = by_id(langid.predict(docs, model))
    assert rows[1]["lang_pred"] == "und" and rows[1]["score"] == 0 and rows[8]["lang_pred"] == "la"
    assert langid.predict(none, model).count() == 0


def test_quality(docs, none):
    found = fertility.quality(docs, PIECES)
    rows = by_id(found)
    assert found.count() == len(ROWS)
    assert rows[1]["base_failed"] and not rows[1]["kept"] and rows[1]["n_words"] == rows[1]["n_tokens"] == 0
    assert rows[8]["n_repeat_words"] == 60_000 and rows[8]["base_failed"]
    assert rows[10]["word_chars"] == sum(map(len, ROWS[9][1].split()))
    assert fertility.quality(none, PIECES).count() == 0


PAGES = "page_id long, url string, html string, text string, n string, value string"


def test_extraction(spark):
    pages = spark.createDataFrame(
        [(1, "u", None, "t", "n", "v"), (2, None, "", "t", "n", "v"), (3, "u", "<p>" + "Word word word. " * 20_000 + "</p>", "t", "n", "v"),
         (4, "u", "<<<>>><a <b </p></div>&#x41;&bogus; &amp <!-- open", "t", "n", "v"), (4, "u", "<nav>x</nav>", "t", "n", "v")], PAGES)
    found = extract.extract(pages).collect()
    assert len(found) == 5
    rows = {(r["page_id"], r["url"]): r for r in found}
    assert rows[1, "u"]["text"] == "" and rows[2, None]["text"] == "" and rows[2, None]["n_chars"] == 0
    assert rows[3, "u"]["n_chars"] == 16 * 20_000 - 1
    assert extract.extract(pages.limit(0)).count() == 0


def test_warc(spark):
    same = "é" * 60
    pages = spark.createDataFrame(
        [(1, "u", None, "t", "n", "v"), (2, None, "", "t", "n", "v"), (5, "u", same, "t", "n", "v"), (4, "u\r\nX: y", same, "t", "n", "v"),
         (6, "u", "a\r\n\r\nWARC/1.1\r\n\n", "t", "n", "v"), (7, "u", "a\r\n\r\nWARC/1.1\r\n\n", "t", "n", "v"), (8, "u", "日本" * 2_000 + "\n\n", "t", "n", "v"),
         (None, "u", "x", "t", "n", "v"), (9, "u", "z" * 200, "t", "n", "v"), (9, "u", "z" * 200, "t", "n", "v")], PAGES)
    for size in (64, 1 << 20):  # every long payload in many records, and in one
        found = warc.round_trip(pages, size=size).collect()
        assert len(found) == 9
        rows = {r["page_id"]: r for r in found}
        for r in pages.filter("page_id is not null").collect():
            data = (r["html"] or "").encode()
            assert (rows[r["page_id"]]["payload_bytes"], rows[r["page_id"]]["payload_digest"]) == (len(data), hashlib.sha256(data).hexdigest())
        assert {i: r["refers_to"] for i, r in rows.items() if r["record_type"] == "revisit"} == {5: 4}
    assert warc.round_trip(pages.limit(0)).count() == 0
    chunked = warc.chunk_table(pages, size=100).orderBy("record_id", "chunk_no").collect()
    assert b"".join(bytes(r["chunk"]) for r in chunked if r["record_id"] == 8).decode() == "日本" * 2_000 + "\n\n"
    assert all(len(r["chunk"]) <= 100 for r in chunked)
    assert {r["record_id"]: r["digest_so_far"] for r in chunked if r["last"]}[4] == hashlib.sha256(same.encode()).hexdigest()


def test_chat(spark):
    turns = spark.createDataFrame(
        [(1, 0, "ann", "hi", "x"), (1, 1, "bob", None, "x"), (1, 2, None, "who?", "x"), (1, None, "system", "be nice", "x"), (1, 200, "ann", "bye", "x"),
         (2, 0, "system", "only", "x"), (None, 0, "ann", "lost", "x"), (3, 0, "ann", "a", "x"), (3, 0, "ann", "a", "x")],
        "conv_id long, turn long, role string, text string, participant string")
    rows = chat.rotate(turns).collect()
    assert {(r["conv_id"], r["participant"], r["chunk_no"]) for r in rows} == {(1, "ann", 0), (1, "ann", 3), (1, "bob", 0), (1, "bob", 3), (3, "ann", 0)}
    whole = {}
    for r in sorted(rows, key=lambda r: r["chunk_no"]):
        text, spans = whole.setdefault((r["conv_id"], r["participant"]), ["", []])
        assert r["start"] == len(text)
        whole[r["conv_id"], r["participant"]] = [text + r["text"], spans + [(s["start"], s["end"]) for s in r["spans"]]]
    text, spans = whole[1, "ann"]
    assert text == ("<|im_start|>system\nbe nice<|im_end|>\n<|im_start|>assistant\nhi<|im_end|>\n<|im_start|>user name=bob\n<|im_end|>\n"
                    "<|im_start|>user name=unknown\nwho?<|im_end|>\n<|im_start|>assistant\nbye<|im_end|>\n")
    assert [text[a:b] for a, b in spans] == ["hi", "bye"]
    assert whole[1, "bob"][1][0][0] == whole[1, "bob"][1][0][1]
    assert len(whole[3, "ann"][1]) == 2
    assert chat.rotate(turns.limit(0)).count() == 0
