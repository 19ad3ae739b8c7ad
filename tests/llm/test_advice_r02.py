
from __future__ import annotations

import random
import time

import numpy as np
import pytest

from chartwright.llm import extract, passages


def words_of(draw, n):
    return ["".join(draw.choice("abcdefghij") for _ in range(6)) for _ in range(n)]


def frame(spark, texts):
    return spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")


# -- op3_substring_dedup: passages of one pair of documents ---------------------
def test_two_passages_of_a_pair_at_any_gap(spark):
    draw, texts, gaps = random.Random(5), {}, [(g, g) for g in (0, 5, 10, 20, 30, 40, 60, 80, 120, 200, 400)] + [(0, 100), (100, 0), (0, 30)]
    for i, (g, h) in enumerate(gaps):
        one, two = words_of(draw, 60), words_of(draw, 60)
        texts[2 * i] = words_of(draw, 20) + one + words_of(draw, g) + two + words_of(draw, 20)
        texts[2 * i + 1] = words_of(draw, 35) + one + words_of(draw, h) + two + words_of(draw, 35)
    found: dict[int, list] = {}
    for r in passages.passages(frame(spark, texts)).collect():
        assert r["target"] == r["id"] - 1
        found.setdefault(r["id"], []).append((r["start"], r["end"], r["target_start"], r["target_end"], r["identity"]))
    for i, (g, h) in enumerate(gaps):
        want = [(35, 95, 20, 80, 1.0), (95 + h, 155 + h, 80 + g, 140 + g, 1.0)] if g or h else [(35, 155, 20, 140, 1.0)]
        assert sorted(found[2 * i + 1]) == want, (g, h)


@pytest.mark.parametrize("sizes, gap, want", [
    ((40, 40), 10, [(0, 90)]),  # neither is long enough alone
    ((30, 200), 10, [(0, 240)]),
    ((200, 200), 100, [(0, 200), (300, 500)]),  # identity 0.8 with the gap
    ((40, 40), 30, []),
    ((45, 7), 10, [(0, 62)]),
    ((60, 30, 30), 8, [(0, 60), (68, 136)]),
])
def test_short_parts_join_and_long_ones_stand_alone(sizes, gap, want):
    parts, at = [], 0
    for n in sizes:
        parts.append((at, at + n, at + 7, at + 7 + n, n))
        at += n + gap
    assert sorted(p[:2] for p in passages.accepted(parts, 50, 0.8)) == want


def test_an_anchor_is_split_where_its_words_differ():
    x = np.arange(136, dtype=np.uint64)
    y = x.copy()
    y[60:76] += np.uint64(1000)
    assert passages.align(x, 0, y, 0, [0, 0, 136]) == [(0, 60, 0, 60, 60), (76, 136, 76, 136, 60)]


# -- op5_html_extraction: tags that end the page -------------------------------
STORY = "This paragraph tells a long enough story of the day, with many plain words in a row, so that it is the article."


@pytest.mark.parametrize("tag", [
    "<svg/>", "<svg class='icon' viewBox=\"0 0 1 > 1\" />", "<math/>", "<title-bar>x</title-bar>", "<select-box></select-box>",
    "<object-view a=1></object-view>", "<svg-icon></svg-icon>", "<script-host></script-host>", "<object data='x'>", "<select><option>1",
    "<svg><path d='M0'></svg>", "<svg><title>icon</title></svg >", "<script>var a = '<p>no</p>';</script\n>", "<STYLE>p {}</Style>",
])
def test_a_tag_does_not_take_the_rest_of_the_page(tag):
    text = extract.main_text(f"<html><body><article><p>First. {STORY}</p>{tag}<p>Last. {STORY}</p></article></body></html>")[0]
    assert f"First. {STORY}" in text and f"Last. {STORY}" in text
    assert "icon" not in text and "no" not in text.split() and "{}" not in text


def test_raw_text_goes_on_to_the_end_and_many_open_tags_are_quick():
    for name in ("script", "style", "textarea", "title"):
        assert extract.main_text(f"<article><p>{STORY}</p><{name}><p>{STORY}</p>")[0] == STORY
    page = "<article>" + "<object><select>" * 2_000 + f"<p>{STORY}</p>" + "x " * 500_000
    start = time.process_time()
    assert STORY in extract.main_text(page)[0]
    assert time.process_time() - start < 20


# -- op5_html_extraction: wrappers named like boilerplate ------------------------
COMMENT = "I really liked this long story, thank you for writing it down for all of us here."


@pytest.mark.parametrize("wrapper", [
    "div class='layout has-sidebar'", "div class='content-with-sidebar'", "div class='no-comments'", "form", "form id='aspnetForm'",
    "div class='sidebar-right'", "div id='page' class='header-fixed'", "div class='widgets-layout'", "section class='site comments-open'",
])
@pytest.mark.parametrize("inside", ["article", "main", "div class='post-content'", "div"])
def test_a_wrapper_does_not_empty_the_page(wrapper, inside):
    story = " ".join(f"<p>{i}. {STORY}</p>" for i in range(6))
    page = (f"<html><body><{wrapper}><nav><a href='/'>Home</a> <a href='/a'>All stories</a></nav><{inside}>{story}</{inside.split()[0]}>"
            f"<div class='sidebar'><div class='content'><p>{COMMENT}</p></div></div><footer><p>{COMMENT}</p></footer></{wrapper.split()[0]}></body></html>")
    assert extract.main_text(page)[0] == " ".join(f"{i}. {STORY}" for i in range(6))


def test_an_article_below_a_smaller_wrapper_and_comments():
    comments = "".join(f"<article class='comment'><div class='text'><p>{i}. {COMMENT}</p></div></article>" for i in range(12))
    page = (f"<body><div class='toolbar-layout'><article><p>1. {STORY}</p><p>2. {STORY}</p></article></div>"
            f"<section id='comments'>{comments}</section><aside><article><p>{STORY}</p></article></aside>"
            f"<div class='related'><article><p>{STORY}</p></article></div><div style='display: none'><main><p>{STORY}</p></main></div></body>")
    assert extract.main_text(page)[0] == f"1. {STORY} 2. {STORY}"


# -- op3_substring_dedup: partners and seeds -----------------------------------
def test_a_passage_made_of_frequent_lines(spark):
    draw = random.Random(7)
    one, two = words_of(draw, 30), words_of(draw, 30)
    alone = lambda line: words_of(draw, 40) + line + words_of(draw, 40)
    texts = {0: alone(one), 1: alone(two), 2: alone(one), 3: alone(two), 10: words_of(draw, 20) + one + two + words_of(draw, 50),
             11: alone(one), 12: alone(two), 13: alone(two), 14: alone(one), 20: words_of(draw, 70) + one + two + words_of(draw, 9)}
    found = [(r["id"], r["target"], r["start"], r["end"], r["target_start"], r["target_end"]) for r in passages.passages(frame(spark, texts)).collect()]
    assert found == [(20, 10, 70, 130, 20, 80)]


def test_edited_passages(spark):
    draw, texts, n = random.Random(9), {}, 100
    for i in range(n):
        one = words_of(draw, 60)
        texts[2 * i] = words_of(draw, 50) + one + words_of(draw, 50)
        at = set(draw.sample(range(60), 6))
        texts[2 * i + 1] = words_of(draw, 70) + [words_of(draw, 1)[0] if j in at else w for j, w in enumerate(one)] + words_of(draw, 50)
    found = {r["id"] for r in passages.passages(frame(spark, texts)).collect() if r["target"] == r["id"] - 1}
    assert len(found) >= 0.95 * n
