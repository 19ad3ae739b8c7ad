"""Cases in which earlier versions lost links, labels or items, or put too much into one task."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from chartwright.llm import bpe, chat, decontaminate, jaccard, langid, passages, warc

WORDS = [a + b + c for a in "bdfgklmnprst" for b in "aeiou" for c in "lnrst"]


def text(rng, n):
    return [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n)]


def edited(rng, words, changes):
    out = list(words)
    for i in rng.sample(range(len(out)), changes):
        out[i] = "x" + out[i]
    return out


def table(spark, texts):
    return spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")


# -- op3_substring_dedup ------------------------------------------------------
def test_fragments_do_not_hide_the_whole_passage(spark):
    """30 edited copies of 60 words (4 changed); of each passage eight other documents hold 20 words, before and after the
    document that has it whole, so they are the first and the last holders of its seeds."""
    rng = random.Random(5)
    docs, want = {}, {}
    for case in range(30):
        passage = text(rng, 60)
        base = case * 100
        for k in range(8):
            at = k % 4 * 40 // 3
            docs[base + (k if k < 4 else 20 + k)] = text(rng, 40) + passage[at : at + 20] + text(rng, 40)
        docs[base + 10] = text(rng, 50) + passage + text(rng, 50)
        docs[base + 50] = text(rng, 70) + edited(rng, passage, 4) + text(rng, 30)
        want[base + 50] = base + 10
    found = {(r["id"], r["target"]): r for r in passages.passages(table(spark, docs)).collect()}
    assert {k for k in found} == set(want.items())
    for r in found.values():
        assert r["end"] - r["start"] >= 50 and 70 <= r["start"] and r["end"] <= 130 and r["target_start"] - 50 == r["start"] - 70


@pytest.mark.parametrize(("changed", "least"), [(0.05, 1.0), (0.10, 1.0), (0.15, 0.98), (0.18, 0.98), (0.20, 0.97)])
def test_recall_of_edited_passages(spark, changed, least):
    """150 passages of 60 words with a share of them replaced at random places, each in two documents; all of
    identity 0.8 or more, as an alignment of the two passages shows."""
    rng = random.Random(int(1000 * changed))
    docs, pairs = {}, set()
    for case in range(150):
        passage = text(rng, 60)
        docs[2 * case] = text(rng, rng.randrange(20, 80)) + passage + text(rng, 40)
        docs[2 * case + 1] = text(rng, rng.randrange(20, 80)) + edited(rng, passage, round(60 * changed)) + text(rng, 40)
        pairs.add((2 * case + 1, 2 * case))
    found = {(r["id"], r["target"]) for r in passages.passages(table(spark, docs)).collect()}
    assert found <= pairs
    assert len(found) >= least * len(pairs), len(found) / len(pairs)


def test_common_subsequence():
    import numpy as np

    def plain(x, y):
        row = [0] * (len(y) + 1)
        for v in x:
            new = [0]
            for j, w in enumerate(y):
                new.append(row[j] + 1 if v == w else max(new[j], row[j + 1]))
            row = new
        return row[-1]

    rng = np.random.default_rng(3)
    for _ in range(300):
        x, y = (rng.integers(0, 6, rng.integers(0, 90)).astype(np.uint64) for _ in range(2))
        assert passages._common(x, y) == plain(x.tolist(), y.tolist())


def test_equal_documents_are_met_once(spark):
    rng = random.Random(8)
    same, other, short = text(rng, 90), text(rng, 80), text(rng, 20)
    docs = {i: same for i in range(40)} | {100: other + same[:60], 101: other + same[:60], 200: short, 201: short, 202: []}
    found = passages.passages(table(spark, docs)).collect()
    whole = {(r["id"], r["target"], r["start"], r["end"], r["identity"]) for r in found if r["id"] < 40}
    assert whole == {(i, 0, 0, 90, 1.0) for i in range(1, 40)}
    assert {(r["id"], r["target"]) for r in found if r["id"] >= 40} == {(100, 0), (101, 100)}
    assert sum(r["id"] == 101 for r in found) == 1


# -- op6_jaccard_join ------------------------------------------------------------
def test_long_runs_dealt_in_blocks(spark, monkeypatch):
    """A family of edited copies on both sides of the threshold, in blocks of a few rows: components as of all pairs."""
    rng = random.Random(4)
    base = text(rng, 120)
    docs = {i: edited(rng, base, rng.randrange(0, 7)) for i in range(150)} | {200 + i: text(rng, 60) for i in range(20)}
    sets = {i: {tuple(t[k : k + 5]) for k in range(len(t) - 4)} for i, t in docs.items()}
    parent = {i: i for i in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(docs)
    for a in ids:
        for b in ids:
            if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    want = {i: find(i) for i in ids}
    assert 2 < len(set(want.values())) < len(ids)
    for rows, short in ((8, 4), (4096, 16)):
        monkeypatch.setattr(jaccard, "RUN_ROWS", rows)
        monkeypatch.setattr(jaccard, "SHORT_RUN", short)
        got = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(table(spark, docs)).collect()}
        assert got == want


# -- op4_decontamination ---------------------------------------------------------
def test_an_item_in_two_rows_is_one_item(spark):
    items = spark.createDataFrame([(1, "a b c"), (1, "x y z"), (2, "m n")], "item_id long, text string")
    docs = spark.createDataFrame([(7, "a b c x y z m n")], "doc_id long, text string")
    (row,) = decontaminate.contamination(docs, items).collect()
    import hashlib

    assert row["n_items"] == 2 and row["items_sha256"] == hashlib.sha256(b"1,2").hexdigest()


# -- op7_language_id ---------------------------------------------------------------
def test_one_row_of_an_id_and_every_label(spark):
    rows = [(1, "the same id again and again", "en")] * 500 + [(i, f"words of label {i % 40} {'abcdefghij'[i % 10] * 3}", f"l{i % 40:02}") for i in range(2, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = langid.sample(docs, F.lit(True), per_language=300, max_rows=120)
    assert len({lang for lang, _ in found}) == 41 and len(found) <= 120
    assert sum(lang == "en" for lang, _ in found) == 1
    with pytest.raises(langid.TooManyLabelsError):
        langid.sample(docs, F.lit(True), max_rows=40)
    assert set(langid.train(found).languages) == {lang for lang, _ in found}


# -- op8_chat_formatting -------------------------------------------------------------
def test_texts_are_not_dealt_by_the_conversation_alone(spark):
    import re

    turns = spark.createDataFrame([(1, 1, "a", "x")], "conv_id long, turn long, role string, text string")
    plan = chat.rotate(turns)._jdf.queryExecution().sparkPlan().toString()
    keys = [{c.split("#")[0] for c in left.split(", ")} for left in re.findall(r"\w*Join \[([^\]]*)\], \[", plan)]
    assert {"c", "chunk_no"} in keys and {"c", "participant", "chunk_no"} in keys
    lines = plan.splitlines()
    alone = [i for i, line in enumerate(lines) if re.search(r"Join \[c#\d+L?\], \[c#", line)]
    assert alone  # chunk numbers meet speakers there; the rows below carry no words
    for i in alone:
        depth = re.search(r"\w", lines[i]).start()
        for line in lines[i + 1 :]:
            if re.search(r"\w", line).start() <= depth:
                break
            assert "HashAggregate" not in line or "words" not in line
    assert all("words" not in line for line in lines if "Window " in line)


# -- op9_warc ------------------------------------------------------------------------
def test_archives_come_out_of_the_chunk_table(spark, monkeypatch):
    seen = []
    real = warc.chunk_table
    monkeypatch.setattr(warc, "chunk_table", lambda *a, **k: seen.append(1) or real(*a, **k))
    body = "zażółć " * 100
    pages = spark.createDataFrame([(1, "http://a/", body), (2, None, body), (2, "http://b/", body + "!"), (3, "u", None)], "page_id long, url string, html string")
    rows = sorted((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.round_trip(pages, size=64).collect())
    n = len(body.encode())
    assert seen and rows == [(1, n, "response", None), (2, n, "revisit", 1), (2, n + 1, "response", None), (3, 0, "response", None)]


# -- op1_bpe -------------------------------------------------------------------------
def test_the_digest_is_that_of_the_machine(spark):
    import hashlib

    import numpy as np
    import public_tokenizers

    coder = bpe.Bpe(public_tokenizers.path("word_bpe_49k.json"))
    ids = np.arange(0, 49_400, 7, dtype=np.uint32)
    for spaced in (True, False):
        assert coder.digest(ids, spaced=spaced) == hashlib.sha256("".join(coder.text(ids.tolist(), spaced=spaced)).encode()).hexdigest()
    assert coder.digest(ids[:0]) == hashlib.sha256(b"").hexdigest()
