"""HTML extraction (5): minimum-cut labelling of a page's blocks.

A page is cut into blocks of text at block-level tags.  Text of a marked inline element
(hidden, or with a class that names an advert, a label and the like) is a run
of its own inside the block and is left out alone.  A linear classifier
gives each block a score from its tags, its ancestors' class and id words, its
link density and its wording (a word that marks the wrapper of most of the
page's text costs little, and an article or main element below a wrapper named
for its layout starts anew); the score becomes the capacity of its edge to the
content terminal or to the boilerplate terminal.  Neighbouring blocks, and
blocks close in the document tree, are joined by smoothness edges, the heavier
the closer their parents.  The minimum cut of that graph labels all blocks at
once: a short line between two paragraphs follows them, a lone link list does
not.  Blocks whose score outweighs all their edges are settled first (no cut
can gain by turning them); max-flow runs over the rest.

Defined cases: a null or empty page, or one without content, gives an empty
text.  Malformed markup is read as browsers do where that is simple: unclosed
elements end with their parents, stray end tags are ignored, a script, style,
textarea or title that nothing closes goes on to the end of the page.  Repeated rows give
repeated results.  Only id, url and html are read.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from chartwright.llm.words import slices

_ATTRS = r"(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(/?)([a-z][^\s/>]*)({_ATTRS})>"
    r"|<(/?)([a-z][^\s/>]*)([^>]*)>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
_HINT = re.compile(r"\b(class|id|role|hidden|aria-hidden|style|itemprop)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_PART = re.compile(r"[a-z]+")

# Element names.
#: Elements whose inside is no text of the page.
SKIPPED = frozenset("script style noscript template iframe noembed noframes textarea title svg math select object xmp".split())
#: Of these, those that run to the end of the page when nothing closes them.
RAW = frozenset("script style textarea title".split())
_CLOSING = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in SKIPPED}
BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search"
    " section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Opening one of these ends an open element of the set, unless a barrier is between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_NO_P = BLOCKS - {"br", "button", "option", "optgroup", "body", "html", "head", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend"}
# Words of class, id and role that tell what an element holds.
BOILERPLATE_TAGS = frozenset("nav header footer aside form button dialog menu fieldset head search label".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads adbox adv advert adverts advertisement advertising sponsor sponsored sponsors promo promoted promotion banner cookie"
    " cookies consent gdpr notice notices alert modal popup overlay newsletter subscribe subscription signup signin login menu nav"
    " navbar navigation navigationbar breadcrumb breadcrumbs sidebar sidebars side aside widget widgets related recommended"
    " recommendations footer foot header masthead topbar toolbar comment comments commentlist respond reply replies disqus share"
    " sharing social follow copyright legal disclaimer search form pagination pager tags taglist skip hidden toc outbrain taboola"
    " contentinfo complementary rail teaser teasers byline meta".split()
)
#: Tags and words that also name the layout of a wrapper around the whole; the others name what is never the article.
LAYOUT_TAGS = frozenset("form fieldset label search".split())
LAYOUT_WORDS = frozenset(
    "alert banner notice notices overlay menu nav navbar navigation breadcrumb breadcrumbs sidebar sidebars side aside widget widgets"
    " footer foot header masthead topbar toolbar follow search form pagination pager tags skip toc rail byline meta".split()
)
#: A class such as has-sidebar tells what an element has or lacks, not what it is.
HAVING = frozenset("has have having with no not without free".split())
CONTENT_WORDS = frozenset("article articlebody content contents main post posts entry story text body prose maincontent".split())
NOTICE = re.compile(
    r"\bcookies?\b|\bsubscribe\b|\bnewsletter\b|\badvertisement\b|\bsponsored\b|\ball rights reserved\b|\bprivacy policy\b"
    r"|\bterms of (?:use|service)\b|\bsign (?:in|up)\b|\blog in\b|©|\bcopyright\b",
    re.I,
)


@dataclass(frozen=True)
class Weights:
    """The classifier and the smoothness; positive scores speak for content."""

    bias: float = -0.5
    boilerplate: float = -12.0
    named_paragraph: float = -9.0
    wide_wrapper: float = -1.0
    inside_content: float = 5.0
    paragraph: float = 1.5
    heading: float = 0.5
    item: float = -0.5
    bare: float = 1.0
    link_density: float = -5.0
    content_links: float = -3.5
    words: float = 0.08
    most_words: float = 40.0
    sentence_end: float = 1.0
    notice: float = -2.0
    neighbour: float = 1.5
    same_parent: float = 1.0


@dataclass(slots=True)
class Element:
    name: str
    parent: Element | None
    depth: int
    mark: int  # what its own tag and words say: 0, LAYOUT, FOREIGN or FIXED
    words: bool  # whether a class or id word speaks against it
    own: bool  # whether its own tag or words speak for content
    content: bool
    chars: int = 0  # text outside links
    boilerplate: int = 0  # the mark that holds here
    wrapped: bool = False  # below a marked element that holds most of the page


@dataclass(slots=True)
class Block:
    parent: Element  # the nearest block-level element; of a run, the marked inline one
    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""
    run: bool = False  # text of a marked inline element, apart from the block around it
    content: bool = False  # whether an element around some of it speaks for content


#: Elements of running text: a layout word on one of them weighs less inside an article.
TEXTUAL = frozenset("p pre blockquote".split())
#: Marks: a word or tag that may name a layout, one that may not, and what nothing below can lift.
LAYOUT, FOREIGN, FIXED = 1, 2, 3
#: A heading of an article's header takes the article's mark, not the header's.
LIFTED = -1
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


def _element(name: str, attrs: str, parent: Element | None) -> Element:
    mark = LAYOUT if name in LAYOUT_TAGS else FIXED if name in BOILERPLATE_TAGS else 0
    good, words = name in ("article", "main"), False
    if attrs and not attrs.isspace():
        for key, value in _HINT.findall(attrs):
            key, value = key.lower(), value.strip("\"'").lower()
            if key in ("class", "id", "role", "itemprop"):
                good = good or not CONTENT_WORDS.isdisjoint(_PART.findall(value))
                if not BOILERPLATE_WORDS.isdisjoint(_PART.findall(value)):
                    parts = {x for v in value.split() if HAVING.isdisjoint(own := _PART.findall(v)) for x in own} & BOILERPLATE_WORDS
                    words = words or bool(parts)
                    if parts and name not in ("body", "html", "article", "main"):
                        mark = max(mark, LAYOUT if parts <= LAYOUT_WORDS else FOREIGN)
            elif key == "style":
                mark = FIXED if "display:none" in value.replace(" ", "") else mark
            elif value != "false":
                mark = FIXED
    if name in HEADINGS and mark == 0 and parent is not None and parent.name == "header" and parent.parent is not None and parent.parent.name == "article":
        mark = LIFTED  # the article's own heading
    return Element(name, parent, parent.depth + 1 if parent else 0, mark, words, good, good or bool(parent and parent.content))


#: Shares of the page's text outside links from which a wrapper is the page's, by its mark, and a content element the article.
WIDE = {LAYOUT: 0.5, FOREIGN: 0.9}
ARTICLE = 0.25


def _settle(found: list[Block]) -> None:
    """Which marks hold below which elements, once the page's text is known."""
    seen: dict[int, Element] = {}
    total = 0
    for block in found:
        n = max(0, len(block.text) - block.linked)
        total += n
        e = block.parent
        e.chars += n
        while e is not None and id(e) not in seen:
            seen[id(e)] = e
            e = e.parent
    order = sorted(seen.values(), key=lambda e: e.depth)
    for e in reversed(order):
        if e.parent:
            e.parent.chars += e.chars
    for e in order:
        above = e.parent.boilerplate if e.parent else 0
        if above and above < FIXED and not e.words and e.own:
            if e.name == "main" or above == LAYOUT and (e.name == "article" or e.chars >= ARTICLE * total):
                above = 0
        e.wrapped = bool(e.parent and e.parent.wrapped)
        own = e.mark
        if own == LIFTED:
            above, own = e.parent.parent.boilerplate, 0
        if own in WIDE and total and e.chars >= WIDE[own] * total:
            own, e.wrapped = 0, True
        e.boilerplate = max(above, own)


def blocks(page: str) -> list[Block]:
    """The page's blocks of text in page order, with white space made single."""
    found: list[Block] = []
    stack = [Element("", None, 0, 0, False, False, False)]
    block: Block | None = None  # the block that text goes on with
    run: Block | None = None  # the run of a marked inline element inside it
    links = at = 0

    def text(piece: str) -> None:
        nonlocal block, run
        if not piece:
            return
        marked, around = None, stack[-1]
        while around.parent is not None and around.name not in BLOCKS:
            marked = around if around.mark else marked
            around = around.parent
        if marked is None:
            run = None
            if block is None:
                if piece.isspace():
                    return
                block = Block(around)
                found.append(block)
            into = block
        else:
            if run is None or run.parent is not marked:
                if block is not None:
                    block.pieces.append(" ")  # where the run stands
                run = Block(marked, run=True)
                found.append(run)
            into = run
        into.pieces.append(piece)
        into.content = into.content or stack[-1].content
        if links:
            into.linked += len(piece)

    open_ended: set[str] = set()  # nothing closes these from here on
    while token := _TOKEN.search(page, at):
        text(page[at : token.start()])
        at = token.end()
        end, name, attrs, end2, name2, attrs2 = token.groups()
        if name is None and name2 is None:
            continue
        if name is None:
            end, name, attrs = end2, name2, attrs2
        name = name.lower()
        if name in SKIPPED and not end and name not in open_ended:
            if name in ("svg", "math") and attrs.endswith("/"):
                continue
            if close := _CLOSING[name].search(page, at):
                at = close.end()
                continue
            if name in RAW:
                at = len(page)
                break
            open_ended.add(name)
        breaks = name in BLOCKS
        if breaks:
            block = run = None
        if end:
            if name == "a":
                links = max(0, links - 1)
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == name:
                    del stack[i:]
                    break
                if not breaks and stack[i].name in BLOCKS:
                    break  # an inline end tag closes nothing beyond its block
            continue
        if name in _NO_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == "p":
                    del stack[i:]
                    break
                if stack[i].name in BLOCKS:
                    break
        if name in ENDS:
            closed, barriers = ENDS[name]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name in barriers:
                    break
                if stack[i].name in closed:
                    del stack[i:]
                    break
        if breaks:
            links = 0
        if name == "a":
            links += 1
        if name not in VOID and not (attrs or "").endswith("/"):
            stack.append(_element(name, attrs or "", stack[-1]))
    text(page[at:])
    for b in found:
        b.text = " ".join(unescape("".join(b.pieces)).split())
    found = [b for b in found if b.text]
    _settle(found)
    return [b for b in found if not (b.run and b.parent.boilerplate)]


def score(block: Block, w: Weights) -> float:
    """The classifier: above 0 speaks for content."""
    parent, own = block.parent, block.parent
    while own.parent is not None and own.name not in BLOCKS:
        own = own.parent
    s = w.bias
    named = parent.mark == LAYOUT and parent.boilerplate == LAYOUT and parent.name in TEXTUAL and not parent.parent.boilerplate
    if named and block.content:
        s += w.named_paragraph
    elif parent.boilerplate:
        s += w.boilerplate
    elif parent.wrapped:
        s += w.wide_wrapper
    if block.content:
        s += w.inside_content
    if own.name in ("p", "pre", "blockquote"):
        s += w.paragraph
    elif own.name in ("h1", "h2", "h3", "h4", "h5", "h6"):
        s += w.heading
    elif own.name in ("li", "td", "th", "dt", "dd"):
        s += w.item
    elif own.name in ("", "html", "body"):
        s += w.bare
    if block.linked:
        clean = block.content and not parent.boilerplate
        s += (w.content_links if clean else w.link_density) * min(1.0, block.linked / len(block.text))
    s += w.words * min(block.text.count(" ") + 1, w.most_words)
    if block.text[-1] in ".!?:;…。\"'”»)":
        s += w.sentence_end
    if len(block.text) < 300 and NOTICE.search(block.text):
        s += w.notice
    return s


def _distance(a: Element, b: Element) -> int:
    """Steps between two elements of the tree."""
    n = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        n += 1
    return n


def edges(found: list[Block], w: Weights) -> list[tuple[int, int, float]]:
    """Smoothness edges: page neighbours, and the next block below the same parent's parent."""
    made = []
    last: dict[int, int] = {}
    for i, block in enumerate(found):
        if i:
            made.append((i - 1, i, w.neighbour / (1 + _distance(found[i - 1].parent, block.parent))))
        above = block.parent.parent or block.parent
        if (j := last.get(id(above), i - 1)) < i - 1:
            made.append((j, i, w.same_parent))
        last[id(above)] = i
    return made


def minimum_cut(scores: list[float], links: list[tuple[int, int, float]]) -> list[bool]:
    """Labels (content or not) of least total cost; a tie goes to boilerplate."""
    n = len(scores)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, c in links:
        near[a][b] = near[a].get(b, 0.0) + c
        near[b][a] = near[b].get(a, 0.0) + c
    s = list(scores)
    label: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:  # settle what no cut can turn; its edges become terminal capacity
        i = todo.popleft()
        if label[i] is not None or abs(s[i]) <= sum(near[i].values()) and (near[i] or s[i] > 0):
            continue
        label[i] = s[i] > 0
        for j, c in near[i].items():
            del near[j][i]
            s[j] += c if label[i] else -c
            todo.append(j)
        near[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        source_side = _source_side(rest, s, near)
        for i in rest:
            label[i] = i in source_side
    return [bool(x) for x in label]


def _source_side(rest: list[int], s: list[float], near: list[dict[int, float]]) -> set[int]:
    """Dinic's max-flow; the nodes still reachable from the content terminal."""
    cap: dict[int, dict[int, float]] = {i: dict(near[i]) for i in rest}
    top, sink = -1, -2
    cap[top], cap[sink] = {}, {}
    for i in rest:
        if s[i] > 0:
            cap[top][i] = s[i]
            cap[i][top] = 0.0
        elif s[i] < 0:
            cap[i][sink] = -s[i]
            cap[sink][i] = 0.0
    while True:
        level, todo = {top: 0}, deque([top])
        while todo:
            u = todo.popleft()
            for v, c in cap[u].items():
                if c > 1e-9 and v not in level:
                    level[v] = level[u] + 1
                    todo.append(v)
        if sink not in level:
            return set(level) - {top}
        walk = {u: iter(list(cap[u])) for u in level}
        path = [top]
        while path:
            u = path[-1]
            if u == sink:
                flow = min(cap[a][b] for a, b in zip(path, path[1:]))
                for a, b in zip(path, path[1:]):
                    cap[a][b] -= flow
                    cap[b][a] += flow
                path = path[: next(k for k, (a, b) in enumerate(zip(path, path[1:])) if cap[a][b] <= 1e-9) + 1]
                continue
            for v in walk[u]:
                if cap[u][v] > 1e-9 and level.get(v, -1) == level[u] + 1:
                    path.append(v)
                    break
            else:
                path.pop()
                level[u] = -1


def main_text(page: str, w: Weights = Weights()) -> tuple[str, int, int]:  # noqa: B008
    """The main text, the number of blocks and how many of them are content."""
    found = blocks(page)
    labels = minimum_cut([score(b, w) for b in found], edges(found, w))
    kept = [b.text for b, keep in zip(found, labels, strict=True) if keep]
    return " ".join(kept), len(found), len(kept)


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            weights: Weights = Weights()) -> DataFrame:  # noqa: B008
    """Per page: id, url, main text, its characters, blocks and content blocks; one pass."""
    source = pages.select(id_col, url_col, html_col)
    kinds = dict(source.dtypes)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, 2):
            made = [main_text(t, weights) for t in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([m[0] for m in made], pa.string()),
                 *(pa.array(x, pa.int64()) for x in ([len(m[0]) for m in made], [m[1] for m in made], [m[2] for m in made]))],
                [id_col, url_col, "text", "n_chars", "n_blocks", "n_content_blocks"],
            )

    return source.mapInArrow(
        task, f"`{id_col}` {kinds[id_col]}, `{url_col}` {kinds[url_col]}, text string, n_chars long, n_blocks long, n_content_blocks long")
