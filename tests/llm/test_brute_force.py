"""Operators that SQL cannot express, against plain statements of the same thing."""

from __future__ import annotations

import hashlib
import random
from itertools import product

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chartwright.llm import bpe, extract, fertility, jaccard, langid, licenses, passages
from chartwright.llm.words import split_words, text_array
from conftest import SF_MID, SF_SMALL

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


# -- BPE --------------------------------------------------------------------
@pytest.fixture(scope="module")
def coder():
    return bpe.Bpe(WORD_BPE)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(WORD_BPE)
    found.no_truncation()
    found.no_padding()
    return found


def coded(coder, texts):
    ids, starts = coder.encode(split_words(text_array(pa.array(texts, pa.string()))))
    return [ids[a:b].tolist() for a, b in zip(starts, starts[1:])]


def test_bpe_equals_the_library(small, coder, library):
    draw = random.Random(3)
    texts = [r["text"] for r in small.collect()]
    texts += ["".join(draw.choice("abcdethinsS'éΣ.<|endoftext|> 12\n\x1c ") for _ in range(draw.randint(0, 80))) for _ in range(500)]
    texts += ["<|startoftext|>a<|ENDOFTEXT|><|endoftext|>", "a" * 20_000, "the" * 4_000, "é" * 3_000, "!?" * 5_000]
    mine, theirs = coded(coder, texts), library.encode_batch(texts, add_special_tokens=False)
    assert mine == [x.ids for x in theirs]
    assert ["".join(coder.text(x, spaced=True)) for x in mine] == [library.decode(x, skip_special_tokens=False) for x in mine]


def test_bpe_streams_the_same_tokens_in_small_blocks(coder, monkeypatch):
    draw = random.Random(5)
    for block in (1, 7, 64):
        monkeypatch.setattr(bpe, "BLOCK", block)
        for _ in range(3):
            symbols = [coder.symbols[ord(draw.choice("abcdethinors"))] for _ in range(3 * coder.lookahead)]
            assert list(coder.transduce(iter(symbols))) == coder.merge(list(symbols))


def test_bpe_round_trip(small, spark):
    found = bpe.decode(bpe.encode(small, WORD_BPE), WORD_BPE)
    texts = {r["doc_id"]: r["text"] for r in found.collect()}
    for r in small.collect():  # word ends come back as spaces, case and white space do not come back
        assert "".join(texts[r["doc_id"]].split()) == "".join(c.lower() for c in "".join(r["text"].split()))


# -- licenses ---------------------------------------------------------------
def test_licenses_against_every_block(spark, small):
    lines = [t for _, t in licenses.TEMPLATES]
    extra = [(10**6 + i, f"{'filler words ' * (i * 7)}{t} {'more filler ' * (i * 5)}") for i, t in enumerate(lines)]
    extra += [(2 * 10**6, "Under the MIT license, under THE mit License; Apache License version 2 cc-by-nc"), (2 * 10**6 + 1, "under the\nmit, license")]
    docs = small.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    found = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    templates = [(label, set(licenses._tokens(t))) for label, t in licenses.TEMPLATES]
    for r in docs.collect():
        words = licenses._tokens(r["text"] or "")
        base = [(i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(words))
                if words[i : i + len(phrase.split())] == [w.encode() for w in phrase.split()]]
        shares = [(label, len(t & set(words[i : i + licenses.BLOCK])) / len(t)) for i in range(0, max(1, len(words)), licenses.BLOCK // 2) for label, t in templates]
        hits = [(label, s) for label, s in shares if s >= licenses.THRESHOLD]
        row = found[r["doc_id"]]
        assert (row["n_words"], row["n_base"]) == (len(words), len(base))
        assert row["labels"] == ",".join(sorted({x for _, x in base} | {x for x, _ in hits}))
        assert row["base_labels"] == ",".join(sorted({x for _, x in base}))
        assert (row["first_word"], row["last_word"]) == (min((i for i, _ in base), default=None), max((i for i, _ in base), default=None))
        assert row["score"] == pytest.approx(max([1.0 if base else 0.0, *(s for _, s in hits)]))
    assert found[2 * 10**6]["n_base"] == 4 and found[2 * 10**6 + 1]["n_base"] == 1
    assert all(label in found[10**6 + i]["labels"].split(",") for i, (label, _) in enumerate(licenses.TEMPLATES))


# -- substring dedup ----------------------------------------------------------
def words_of(draw, n):
    return ["".join(draw.choice("abcdefghij") for _ in range(6)) for _ in range(n)]


def test_passages_are_found_to_the_word_and_cut(spark):
    draw = random.Random(11)
    passage, near = words_of(draw, 60), words_of(draw, 120)
    changed = [w if i % 15 else "changed" for i, w in enumerate(near)]
    texts = {1: (words_of(draw, 200), passage, words_of(draw, 90)), 2: (words_of(draw, 30), passage, words_of(draw, 300)),
             3: (words_of(draw, 77), near, []), 4: (words_of(draw, 5), changed, words_of(draw, 50)), 5: ([], passage, words_of(draw, 40)),
             6: (words_of(draw, 400), passage[:30], [])}
    docs = spark.createDataFrame([(i, ". ".join(a + b + c)) for i, (a, b, c) in texts.items()], "doc_id long, text string").withColumn("n_chars", F.length("text").cast("long"))
    spans = passages.passages(docs)
    found = {(r["id"], r["target"]): r for r in spans.collect()}
    assert set(found) == {(2, 1), (5, 1), (5, 2), (4, 3)}
    assert (found[2, 1]["start"], found[2, 1]["end"], found[2, 1]["target_start"]) == (30, 90, 200)
    assert (found[5, 2]["start"], found[5, 2]["end"]) == (0, 60)
    r = found[4, 3]
    assert abs(r["start"] - 5) <= 1 and abs(r["end"] - 125) <= 1 and r["identity"] > 0.9
    cut = {x["doc_id"]: x for x in passages.cut(docs, spans).collect()}
    assert cut[1]["text"] == ". ".join(sum(texts[1], []))
    assert cut[2]["text"] == ". ".join(texts[2][0]) + ". " + ". ".join(texts[2][2]) and cut[2]["n_chars"] == len(cut[2]["text"])
    assert cut[5]["text"] == ". ".join(texts[5][2])
    assert cut[6]["text"] == ". ".join(sum(texts[6], []))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60), st.integers(1, 12)), min_size=1, max_size=9))
def test_best_chain_equals_all_chains(anchors):
    b, a, n = (list(x) for x in zip(*anchors, strict=True))

    def best(j):
        gains = [best(i) - passages.GAP * (b[j] - b[i] - n[i] + a[j] - a[i] - n[i]) for i in range(len(n))
                 if b[i] + n[i] <= b[j] and a[i] + n[i] <= a[j]]
        return n[j] + max([0.0, *gains])

    first = passages.chains(b, a, n)[0]
    score = sum(n[i] for i in first) - passages.GAP * sum(
        b[j] - b[i] - n[i] + a[j] - a[i] - n[i] for i, j in zip(first, first[1:]))
    assert score == pytest.approx(max(map(best, range(len(n)))))


# -- extraction ---------------------------------------------------------------
@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(-6, 6), min_size=1, max_size=7),
       st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6), st.integers(1, 5)), max_size=10))
def test_minimum_cut_is_the_least_of_all_labellings(scores, links):
    links = [(a, b, float(c)) for a, b, c in links if a != b and max(a, b) < len(scores)]

    def cost(label):
        return sum(abs(s) for s, x in zip(scores, label, strict=True) if (s > 0) != x and s) + sum(c for a, b, c in links if label[a] != label[b])

    label = extract.minimum_cut([float(s) for s in scores], links)
    assert cost(label) == pytest.approx(min(map(cost, product((False, True), repeat=len(scores)))))


def test_extraction_of_articles(spark):
    import html
    import re

    pages = spark.read.parquet(f"{SF_MID}/pages.parquet")
    for r in extract.extract(pages).join(pages.select("page_id", "html"), "page_id").collect():
        inside = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        text = html.unescape(re.sub(r"</?(?:b|i|em|a)\b[^>]*>", "", re.sub(r"</?(?:p|h1|br)>", " ", inside)))
        assert r["text"] == " ".join(text.split())


PAGE = """<html><head><title>T</title></head><body><div class="site-header"><a href="/">Home</a></div><ul class="menu"><li><a href="/1">One</a></li></ul>
<div class="cookie-notice">We use cookies. <button>Accept</button></div><div id="content"><h2>A title</h2><div>The first long paragraph has enough
words to be the story, and <b>some</b> of them are <a href="x">linked</a>.</div><p>Short.</p><div class="ad-box"><p>Buy this thing now, it is very
good and has many words of praise around it.</p></div><p>The last paragraph of the story ends&nbsp;here &amp; now.</p><form><label>Name</label><input></form>
<aside><p>Related: another long story that is not this one, with several words.</p></aside></div><section id="comments"><p>I really liked this long
story, thank you for writing it down.</p></section><footer><p>&copy; 2020 Someone, all rights reserved.</p></footer><script>var a = "<p>no</p>";</script></body></html>"""


def test_extraction_without_an_article_element():
    assert extract.main_text(PAGE)[0] == (
        "A title The first long paragraph has enough words to be the story, and some of them are linked. Short."
        " The last paragraph of the story ends here & now.")


# -- Jaccard ------------------------------------------------------------------
def components_by_force(sets, t=0.75):
    ids = sorted(sets)
    label = {i: i for i in ids}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for x in ids:
        for y in ids:
            if x < y and sets[x] and len(sets[x] & sets[y]) >= t * len(sets[x] | sets[y]):
                a, b = sorted((root(x), root(y)))
                label[b] = a
    return {i: root(i) for i in ids}


def test_jaccard_equals_all_pairs(spark):
    draw = random.Random(17)
    common = words_of(draw, 40)  # a passage in most documents
    texts = {}
    for i in range(120):
        n = draw.choice([1, 2, 3, 5, 6, 7, 8, 9, 11, 14, 20, 35, 60, 150])
        texts[i] = words_of(draw, n) + (common if i % 3 else [])
    for i in range(120, 420):  # copies with edits, some of copies
        own = list(texts[draw.randrange(i if i % 2 else 120)])
        for _ in range(draw.choice([0, 1, 1, 2, 3])):
            at = draw.randrange(len(own) + 1)
            own[at : at + draw.choice([0, 1])] = words_of(draw, draw.choice([0, 1, 2]))
        texts[i] = own
    for i in range(420, 520):  # a family of near copies
        own = common * 1 + texts[119]
        own[draw.randrange(len(own))] = "edit" + str(i)
        texts[i] = own
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")
    sets = {i: {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set() for i, w in texts.items()}
    want = components_by_force(sets)
    for one_in in (500, 4):  # few and very many frequent elements
        rows = {r["doc_id"]: r for r in jaccard.near_duplicates(docs, one_in=one_in).collect()}
        assert {i: r["n_shingles"] for i, r in rows.items()} == {i: len(s) for i, s in sets.items()}
        assert {i: r["component_id"] for i, r in rows.items()} == want
    rows = jaccard.near_duplicates(docs, max_keys=0).collect()  # asked keys joined instead of handed out
    assert {r["doc_id"]: r["component_id"] for r in rows} == want


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 400), st.integers(0, 2**32))
def test_partition_always_meets(n, seed):
    """Any partner within the allowed differences shares a key with what the smaller set asks for."""
    draw = np.random.default_rng(seed)
    plan = jaccard.Plan(jaccard.THRESHOLD)
    x = np.unique(draw.integers(0, 2**63, n).astype(np.uint64))
    frequent = np.sort(draw.choice(x, draw.integers(0, len(x) + 1), replace=False))
    h = plan.differences(len(x))
    gone = int(draw.integers(0, h + 1))
    new = int(draw.integers(gone, h - gone + 1)) if h - gone >= gone else gone
    y = np.unique(np.concatenate((draw.permutation(x)[gone:], draw.integers(0, 2**63, new).astype(np.uint64))))
    both = len(np.intersect1d(x, y))
    if len(y) < len(x) or both * 4 < 3 * (len(x) + len(y) - both):
        return
    band = plan.band(len(x))
    assert plan.lowest(len(y)) <= band <= plan.band(len(y))
    fine = jaccard.fine_keys(jaccard.infrequent(x, frequent), plan, band)
    asked = jaccard.asked_keys(x, frequent, plan, len(fine))
    if asked is None:
        assert np.intersect1d(fine, jaccard.fine_keys(jaccard.infrequent(y, frequent), plan, band)).size
    else:
        assert np.intersect1d(asked, jaccard.filed_keys(y, plan, band)).size


# -- language -------------------------------------------------------------------
def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = langid.train(langid.sample(docs, ~held_out))
    found = langid.predict(docs, model).join(docs.filter(held_out), "doc_id")
    right, all_of_them = found.agg(F.count(F.when(F.col("lang") == F.col("lang_pred"), 1)), F.count("*")).first()
    assert all_of_them > 200 and right / all_of_them > 0.95
    assert found.filter("score < 0 or score > 1").count() == 0


# -- quality --------------------------------------------------------------------
def test_quality_measures(small):
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = {r["doc_id"]: r for r in fertility.quality(small, PIECES).collect()}
    for r in small.collect():
        words = r["text"].split()
        windows: dict[tuple, list[int]] = {}
        for i in range(len(words) - 7):
            windows.setdefault(tuple(words[i : i + 8]), []).append(i)
        inside = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
        lines = [x for x in r["text"].split("\n") if x.strip()]
        row = rows[r["doc_id"]]
        assert (row["n_words"], row["word_chars"], row["n_repeat_words"]) == (len(words), sum(map(len, words)), len(inside))
        assert (row["n_symbols"], row["n_dup_lines"]) == (sum(r["text"].count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)))
        assert row["base_failed"] == (len(words) < 20 or 100 * len(inside) > 30 * len(words))
        tokens = [t for w in words for t in pieces.encode(w)]
        shares = np.unique(tokens, return_counts=True)[1] / max(1, len(tokens))
        assert row["n_tokens"] == len(tokens)
        assert row["chars_per_token"] == pytest.approx(sum(map(len, words)) / max(1, len(tokens)))
        assert row["entropy"] == pytest.approx(-(shares * np.log2(shares)).sum() if tokens else 0.0, abs=1e-9)
        assert row["kept"] == (not row["reason"]) and (not row["base_failed"] or not row["kept"])


def test_quality_verdicts(spark):
    draw = random.Random(2)
    prose = " ".join("the story of a small town by the sea and of those who lived there in the years after the war".split() * 1)
    texts = [
        (1, "Once upon a time there was a small town by the sea. Those who lived there caught fish, mended nets and told each other long stories in the evening, when the boats were back and the lamps were lit along the quay."),
        (2, " ".join(w + 3 * draw.choice("#$%&*|<>") for w in words_of(draw, 60))),
        (3, " ".join("".join(draw.choice("qxzjkvwpy0123456789") for _ in range(30)) for _ in range(30))),
        (4, " ".join("".join(chr(draw.randrange(0x10400, 0x10450)) for _ in range(8)) for _ in range(40))),
        (5, prose),
    ]
    rows = {r["doc_id"]: r for r in fertility.quality(spark.createDataFrame(texts, "doc_id long, text string"), PIECES).collect()}
    assert rows[1]["kept"] and rows[5]["kept"]
    assert rows[2]["reason"] == "symbols" and rows[3]["reason"] == "fertility_low"
    assert rows[4]["byte_share"] > 0.9


# -- pipeline -------------------------------------------------------------------
def test_pipeline_stage_by_stage(spark, library):
    import corpus_pipeline
    import duckdb
    from chartwright.plans.session import materialize

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "substring_dedup", "decontamination", "token_ids"]
    stages = []
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, docs, SF_SMALL), name)
        stages.append(([r.asDict() for r in docs.collect()], {r["doc_id"]: r.asDict() for r in out.collect()}))
        if name != "token_ids":
            assert out.columns == docs.columns
        docs = out
    (given_, kept), (before, unique), (whole, cut), (dirty, clean), (last, tokens) = stages
    verdicts = {r["doc_id"]: r["kept"] for r in fertility.quality(spark.createDataFrame([(r["doc_id"], r["text"]) for r in given_], "doc_id long, text string"), PIECES).collect()}
    assert set(kept) == {i for i, ok in verdicts.items() if ok}

    def lowered(text):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in text).split()

    sets = {r["doc_id"]: {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} for r in before if (w := lowered(r["text"])) or True}
    groups = components_by_force(sets)
    assert set(unique) == {i for i, c in groups.items() if i == c}
    assert set(cut) == {r["doc_id"] for r in whole}
    for r in whole:  # what stays is what was there, in order
        left = iter(r["text"])
        assert all(c in left for c in cut[r["doc_id"]]["text"]) and cut[r["doc_id"]]["n_chars"] == len(cut[r["doc_id"]]["text"])
    seen: dict[tuple, int] = {}
    for i in sorted(cut):  # no run of 50 words of a document repeats in a later one
        w = licenses._tokens(cut[i]["text"])
        runs = {tuple(w[j : j + 50]) for j in range(len(w) - 49)}
        assert not any(seen.get(x, i) != i for x in runs)
        seen.update(dict.fromkeys(runs, i))
    from chartwright.llm.oracles import OP4

    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": [r["doc_id"] for r in dirty], "text": [r["text"] for r in dirty]}))
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{SF_SMALL}/benchmark.parquet'")
    bad = {r[0] for r in con.execute(f"SELECT doc_id FROM ({OP4}) WHERE contaminated").fetchall()}
    assert set(clean) == {r["doc_id"] for r in dirty} - bad
    want = {r["doc_id"]: library.encode(r["text"], add_special_tokens=False).ids for r in last}
    assert {i: r["ids"] for i, r in tokens.items()} == want
    assert all(r["ids_sha256"] == hashlib.sha256(np.array(want[i], "<u4").tobytes()).hexdigest() for i, r in tokens.items())


# -- components -----------------------------------------------------------------
def test_components_of_chains_stars_and_random_links(spark):
    from chartwright.llm.components import components

    draw = random.Random(23)
    links = [(i, i + 1) for i in range(100, 160)] + [(200, 300 + i) for i in range(50)] + [(5, 5), (7, 8), (8, 7), (7, 8)]
    links += [(draw.randrange(1000, 1200), draw.randrange(1000, 1200)) for _ in range(120)]
    sets = {i: {frozenset((i,))} for pair in links for i in pair}
    label = {i: i for i in sets}
    for _ in links:  # the least label spreads along every link
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: c for i, c in label.items() if any(a != b and i in (a, b) for a, b in links)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


LONG_TEXT = "The council met on Monday to talk about the new bridge, and after a long debate its members agreed on a plan that the town will pay for over ten years."


@pytest.mark.parametrize(("body", "want"), [
    # marked inline elements leave out their own run and nothing else
    (f"<p><span class='share'>Berlin</span> {LONG_TEXT}</p>", LONG_TEXT),
    (f"<p><b class='widget'>Box</b> {LONG_TEXT}</p>", LONG_TEXT),
    (f"<p><label>Name</label> {LONG_TEXT}</p>", LONG_TEXT),
    (f"<p>{LONG_TEXT} <span class='advert'>BUY NOW</span></p>", LONG_TEXT),
    (f"<p>{LONG_TEXT[:40]}<span class='advert'>BUY NOW</span>{LONG_TEXT[40:]}</p>", f"{LONG_TEXT[:40].rstrip()} {LONG_TEXT[40:].lstrip()}"),
    (f"<p>{LONG_TEXT} <span hidden>secret</span></p>", LONG_TEXT),
    (f"<p>{LONG_TEXT} <i aria-hidden='true'>secret</i></p>", LONG_TEXT),
    (f"<p>{LONG_TEXT} <span style='display: none'><b>sec</b>ret</span></p>", LONG_TEXT),
    # unmarked ones stay, without a space of their own
    (f"<p>{LONG_TEXT[:7]}<b>{LONG_TEXT[7:9]}</b>{LONG_TEXT[9:]}</p>", LONG_TEXT),
    # a class that denies the word, a layout word on a paragraph of the article, the article's heading and its lists
    (f"<p class='intro ad-free'>{LONG_TEXT}</p>", LONG_TEXT),
    (f"<p class='note meta'>{LONG_TEXT}</p>", LONG_TEXT),
    (f"<header><h1>A new bridge</h1><div class='byline'>By X</div></header><p>{LONG_TEXT}</p>", f"A new bridge {LONG_TEXT}"),
    (f"<p>{LONG_TEXT}</p><ul><li><a href='/a'>Plan of the bridge</a></li><li><a href='/b'>Minutes of the council</a></li></ul><p>{LONG_TEXT}</p>",
     f"{LONG_TEXT} Plan of the bridge Minutes of the council {LONG_TEXT}"),
    (f"<p class='byline meta'>By X</p><p>{LONG_TEXT}</p>", LONG_TEXT),
    (f"<p>{LONG_TEXT}</p><div class='share'><p>Tell your friends about this story now.</p></div>", LONG_TEXT),
])
def test_extraction_inside_an_article(body, want):
    rest = f"<p>Second. {LONG_TEXT}</p>"
    page = f"<html><body><nav><ul><li><a href='/'>Home</a></li></ul></nav><article>{body}{rest}</article><footer><p>{LONG_TEXT}</p></footer></body></html>"
    assert extract.main_text(page)[0] == f"{want} Second. {LONG_TEXT}"


def test_extraction_of_a_page_inside_an_inline_wrapper():
    """An inline element around everything is the page, whatever its name."""
    page = f"<body><span class='header'>{LONG_TEXT}<br>{LONG_TEXT}<br>{LONG_TEXT}</span></body>"
    assert extract.main_text(page)[0] == " ".join([LONG_TEXT] * 3)
