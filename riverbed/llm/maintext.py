"""Main text of web pages by minimum cut.

A page is read into blocks (the text of a block-level element between its block-level children).
A classifier says how much each block looks like article text: a logistic model of its shape, plus
what the elements around it say (an article element, a menu, a list of comments). A name given in class, id or role
counts where all of it names furniture ("cookie-notice", "site-footer", not "has-sidebar"), not on the page as a whole and not on
what holds its article, and it is evidence like the shape: both together with the neighbours decide. That score is
the capacity of the block's edge to the source (content) or to the sink (boilerplate). Blocks
that follow each other, and blocks of the same parent, are joined by smoothness edges that weaken
with their distance in the element tree. The minimum cut labels the whole page at the least total
cost of going against the classifier and of parting neighbours.

The model of shapes is fitted on a bounded sample of pages (SAMPLE_PAGES), on the blocks whose
surroundings are unmistakable (SAMPLE_BLOCKS of a page at most, so that none of them decides alone); it is what
decides on pages without such marks.

Special cases: a null or empty page has an empty text; unclosed elements, quotes and comments are read
leniently; a page without any tag is one block; text of hidden elements is none; repeated rows give equal rows; very long and very
deeply nested pages take work in proportion to their elements (an element knows its parent, and distances are followed as far as
they count); other columns than page_id, url and html are ignored; an empty table gives none."""

from __future__ import annotations

import html as entities
import re
from collections import deque
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbed.llm.common import arrow_pass, hash_order, pick

#: Pages that the shape model is fitted on, at most, and blocks of each.
SAMPLE_PAGES = 600
SAMPLE_BLOCKS = 300
#: Smoothness between blocks of one parent, and its fall per further step in the tree.
SMOOTH, FALL = 1.2, 0.5
#: What the surroundings count for: an element that is furniture by its kind, one by its name, each further name around that (up
#: to MOST_NAMES in all), and an article.
MARKED_BOILERPLATE, NAMED_BOILERPLATE, NAMED_MORE, MARKED_CONTENT = -9.0, -4.5, -1.5, 3.0
MOST_NAMES = 3
SHAPE_LIMIT = 3.0

# Element names by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes svg canvas object audio video".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img
    math mfrac mi mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtext munder munderover semantics""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BOILERPLATE_TAGS = frozenset("nav footer aside form menu button select option fieldset legend dialog noscript template head".split())
CONTENT_TAGS = frozenset("article main".split())
#: Words of class, id and role that name a page's furniture, and those that name its article.
BOILERPLATE_WORDS = frozenset("""ad ads advert advertisement advertising adsense banner breadcrumb breadcrumbs byline comment comments commentlist
    consent cookie cookies copyright dialog disqus footer form gdpr hidden header login masthead menu modal nav navbar navigation newsletter notice
    overlay pager pagination popup promo promotion recommended related replies reply respond search share sharing sidebar signup skip social
    sponsor sponsored subscribe subscription toolbar topbar trending widget widgets""".split())
CONTENT_WORDS = frozenset("article content entry main post story text".split())
#: Words that stand beside those without changing what they name.
PLACE_WORDS = frozenset("""area block bottom box container content desktop first global group inner item items last left link links list main mobile module outer page
    panel primary right secondary section site sub third top wrap wrapper""".split())
#: Elements whose start closes an open one of these.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("table td th ul ol dl article section main div body aside nav footer header form button blockquote figure details".split())

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/<>]*)(?P<attrs>(?:[^<>\"']++|\"[^\"]{0,8192}\"|'[^']{0,8192}')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/<>]*)(?P<attrs2>[^<>]*)>"
    r"|<(?P<end3>/?)(?P<name3>[a-zA-Z][^\s/<>]*)(?=[^<>\"']*[\"'])"
    r"|<[!?/][^>]*>", re.S)
_ATTR = re.compile(r"(?<![\w-])(class|id|role|style|hidden|aria-hidden)(?![\w-])(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in (*RAW, "xmp")}
_QUOTE = re.compile(r"[\"'<>]")
# By kind, by name, an article, hidden, an article or main element.
_KIND, _NAME, _GOOD, _GONE, _HOLDS = 1, 2, 4, 8, 16
#: Steps up the tree after which two blocks are too far apart for an edge.
_FAR = 24


@dataclass
class Page:
    """Elements by number (0 is the root): name, parent, what they say of themselves, characters of text in them."""

    names: list[str]
    parents: list[int]
    marks: list[int]
    sizes: list[int]


@dataclass
class Block:
    text: str
    linked: int  # characters in links
    tag: str
    element: int  # the block-level element that it stands in
    kind: bool = False  # inside furniture by kind
    named: int = 0  # elements around it that are furniture by name
    good: bool = False
    parent: int = 0
    apart: int = 0  # steps in the tree from the block before


def names_furniture(value: str) -> bool:
    """Whether one of the names in a class, id or role is that of furniture as a whole."""
    for token in value.split():
        words = {w.lower() for w in _WORDS.findall(token)}
        if words & BOILERPLATE_WORDS and words <= BOILERPLATE_WORDS | PLACE_WORDS:
            return True
    return False


def _marks(name: str, attrs: str, in_article: bool) -> int:
    """What an element says about its content."""
    out = 0
    if name in BOILERPLATE_TAGS or name == "header" and not in_article:
        out |= _KIND
    if name in CONTENT_TAGS:
        out |= _GOOD | _HOLDS
    if attrs and ("=" in attrs or "hidden" in attrs):
        for m in _ATTR.finditer(attrs):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                out |= _GONE
            elif key in ("class", "id", "role") and name not in ("html", "body"):
                if names_furniture(value):
                    out |= _NAME
                elif name not in INLINE and {w.lower() for w in _WORDS.findall(value)} & CONTENT_WORDS:
                    out |= _GOOD
    return out


def _tag_end(page: str, at: int, unclosed: dict[str, int]) -> int:
    """Where a tag whose attributes begin at ``at`` ends, however long its values are; -1 if it doesn't. ``unclosed``: from
    where on a quote is known to have no partner."""
    while m := _QUOTE.search(page, at):
        if m[0] == ">":
            return m.end()
        if m[0] == "<" or unclosed.get(m[0], len(page)) <= m.start():
            return -1
        end = page.find(m[0], m.end())
        if end < 0:
            unclosed[m[0]] = m.start()
            return -1
        at = end + 1
    return -1


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order, with what the elements around them say."""
    out, tree = read(page)
    judge_surroundings(out, tree)
    return out


def read(page: str) -> tuple[list[Block], Page]:
    out: list[Block] = []
    tree = Page([""], [0], [0], [0])
    # name, its element, the nearest block-level element, inside an article, hidden; the root stands below everything
    stack: list[tuple[str, int, int, bool, bool]] = [("", 0, 0, False, False)]
    open_: dict[str, int] = {}
    parts: list[str] = []
    unclosed: dict[str, int] = {}
    linked = 0

    def close() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            element = stack[-1][2]
            out.append(Block(text, min(linked, len(text)), tree.names[element], element))
            tree.sizes[element] += len(text)
        parts.clear()
        linked = 0

    def pop(to: int) -> None:
        for e in stack[to:]:
            open_[e[0]] -= 1
        del stack[to:]

    def add(raw: str, plain: bool = False) -> None:
        nonlocal linked
        if raw and not stack[-1][4]:
            text = entities.unescape(raw) if "&" in raw and not plain else raw
            parts.append(text)
            if open_.get("a"):
                linked += len(text.strip())

    def shut(names: frozenset | set, limit) -> None:
        """Pop the innermost element of ``names`` (and those right around it), unless one of ``limit`` stands inside it."""
        if not any(open_.get(n) for n in names):
            return
        found = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] in names or stack[i][0] in limit), 0)
        while found and stack[found][0] in names and stack[found - 1][0] in names:
            found -= 1
        if found and stack[found][0] in names:
            pop(found)

    at = 0
    while m := _TOKEN.search(page, at):
        add(page[at:m.start()])
        at = m.end()
        name = (m["name"] or m["name2"] or m["name3"] or "").lower()
        if not name:
            continue
        attrs = m["attrs"] or m["attrs2"] or ""
        if m["name3"] or m["name2"] and ('"' in attrs or "'" in attrs):  # a long value, or a broken quote
            begin = m.end("name3" if m["name3"] else "name2")
            end = _tag_end(page, begin, unclosed)
            if end > 0:
                attrs, at = page[begin:end - 1], end
            elif m["name3"]:  # no tag
                add(m[0])
                continue
        if m["end"] or m["end2"] or m["end3"]:
            if not open_.get(name):
                continue
            found = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name or name in INLINE and stack[i][0] in SCOPES), 0)
            if found and stack[found][0] == name:
                if name not in INLINE:
                    close()
                pop(found)
            continue
        if name == "br":
            parts.append(" ")
            continue
        if (name in RAW or name == "xmp") and not attrs.endswith("/"):
            if name == "xmp":
                close()
            elif name not in INLINE:
                parts.append(" ")
            end = _RAW_END[name].search(page, at)
            if name == "xmp":  # shown as it is
                add(page[at:end.start() if end else len(page)], plain=True)
                close()
            at = end.end() if end else len(page)
            continue
        if name not in INLINE:
            close()
            if name in VOID:
                continue
            if name in CLOSES:
                shut(CLOSES[name], {"table", "ul", "ol", "dl", "select"})
            else:  # a block-level element ends an open paragraph or heading
                shut(_PARAGRAPHS, SCOPES | {"li"})
        elif name in VOID:
            continue
        if attrs.endswith("/") and name in INLINE:
            continue
        number, inside = len(tree.names), stack[-1]
        marks = _marks(name, attrs, inside[3])
        tree.names.append(name)
        tree.parents.append(inside[1])
        tree.marks.append(marks)
        tree.sizes.append(0)
        open_[name] = open_.get(name, 0) + 1
        stack.append((name, number, inside[2] if name in INLINE else number, inside[3] or bool(marks & _GOOD), inside[4] or bool(marks & _GONE)))
    rest = page[at:]
    cut = re.search(r"<[a-zA-Z/!?][^<>]*\Z", rest)  # a tag that the page breaks off in
    add(rest[:cut.start()] if cut else rest)
    close()
    # blocks' parents among block-level elements only
    level = [0] * len(tree.names)
    for i in range(1, len(tree.names)):
        up = tree.parents[i]
        level[i] = i if tree.names[i] not in INLINE else level[up]
        tree.parents[i] = level[up]
    return out, tree


_PARAGRAPHS = HEADINGS | {"p"}


def judge_surroundings(bs: list[Block], tree: Page) -> None:
    """Elements are numbered as they begin, so that a parent comes before its children."""
    n = len(tree.names)
    sizes, holds = list(tree.sizes), [False] * n
    for i in range(n - 1, 0, -1):
        sizes[tree.parents[i]] += sizes[i]
    for i in range(n - 1, 0, -1):
        main = tree.marks[i] & _HOLDS and not tree.marks[i] & _NAME and (tree.names[i] == "main" or 2 * sizes[i] > sizes[0])
        holds[tree.parents[i]] |= holds[i] or bool(main)
    kind, named, good = [False] * n, [0] * n, [False] * n
    for i in range(1, n):
        up, mark = tree.parents[i], tree.marks[i] if tree.names[i] not in INLINE else 0
        own = bool(mark & _KIND) and not (holds[i] and tree.names[i] in ("form", "header", "dialog"))
        # what holds the article isn't furniture, whatever it is called; nor is the article
        name = bool(mark & _NAME) and not holds[i] and not (mark & _HOLDS and 2 * sizes[i] > sizes[0])
        kind[i], named[i], good[i] = kind[up] or own, named[up] + name, good[up] or bool(mark & _GOOD)
    for b in bs:
        b.kind, b.named, b.good = kind[b.element], named[b.element], good[b.element]
    parents = tree.parents
    for a, b in zip([None, *bs], bs):
        b.parent = parents[b.element]
        b.apart = _FAR + 1 if a is None else _distance(a.element, b.element, parents)


def _distance(a: int, b: int, parents: list[int]) -> int:
    """Steps between two elements by way of the one that holds both; of no account beyond _FAR."""
    steps = 0
    while a != b and steps <= _FAR:
        if a > b:  # the one that began later isn't around the other
            a = parents[a]
        else:
            b = parents[b]
        steps += 1
    return steps


def shape(bs: list[Block]) -> np.ndarray:
    """Features of what a block looks like, whatever surrounds it."""
    rows = []
    for i, b in enumerate(bs):
        n = len(b.text)
        words = b.text.count(" ") + 1
        stops = sum(map(b.text.count, ".,;:!?"))
        rows.append((1.0, np.log1p(words), min(words, 40) / 40, b.linked / n, min(1.0, stops / words * 4), b.text[-1] in ".!?:\"'…»”", b.tag in HEADINGS, b.tag == "li",
                     b.tag == "p", b.tag in ("td", "th"), words < 4, "©" in b.text or "copyright" in b.text.lower(),
                     sum(map(str.isdigit, b.text)) / n, i / len(bs), i == len(bs) - 1))
    return np.array(rows, float).reshape(len(rows), 15)


#: The shape model where a sample has no marked blocks: long unlinked blocks with sentence marks
#: are content.
DEFAULT = np.array([-2.0, 0.5, 1.5, -4.0, 0.8, 0.8, 1.0, -0.8, 0.5, -0.3, -0.8, -2.5, -1.0, 0.0, 0.0])


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Logistic regression with a pull towards DEFAULT; both classes weigh the same."""
    w = DEFAULT.copy()
    if not len(y) or y.min() == y.max():
        return w
    weight = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    for _ in range(rounds):
        g = (1 / (1 + np.exp(-np.clip(x @ w, -30, 30))) - y) * weight
        w -= 1.5 * (x.T @ g + 0.01 * (w - DEFAULT))
    return w


def scores(bs: list[Block], w: np.ndarray) -> np.ndarray:
    """Positive: content. The capacity of the edge to the source or, if negative, to the sink."""
    s = np.clip(shape(bs) @ w, -SHAPE_LIMIT, SHAPE_LIMIT)
    for i, b in enumerate(bs):
        if b.kind:
            s[i] += MARKED_BOILERPLATE
        elif b.named:
            s[i] += NAMED_BOILERPLATE + NAMED_MORE * (min(b.named, MOST_NAMES) - 1)
        elif b.good:
            s[i] += MARKED_CONTENT
    return s


def smoothness(bs: list[Block]) -> list[tuple[int, int, float]]:
    """Edges between blocks that follow each other, and between those of the same parent."""
    edges: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}
    for i, b in enumerate(bs):
        if i and b.apart <= _FAR:
            edges[i - 1, i] = SMOOTH * FALL ** max(0, b.apart - 2)
        if b.parent in last:
            edges[last[b.parent], i] = edges.get((last[b.parent], i), 0.0) + SMOOTH / 2
        last[b.parent] = i
    return [(a, b, c) for (a, b), c in edges.items() if c > 1e-6]


def minimum_cut(score: np.ndarray, edges: list[tuple[int, int, float]]) -> np.ndarray:
    """True for the blocks on the source's side of a minimum cut. Blocks whose score outweighs
    all their edges are settled first, which changes no minimum; the others are cut by
    shortest augmenting paths."""
    n = len(score)
    label = np.zeros(n, np.int8)
    own = score.astype(float).tolist()
    around: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, c in edges:
        around[a][b] = around[a].get(b, 0.0) + c
        around[b][a] = around[b].get(a, 0.0) + c
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if not label[i] and abs(own[i]) >= sum(around[i].values()) and (own[i] or not around[i]):
            label[i] = 1 if own[i] > 0 else -1
            for j, c in around[i].items():
                own[j] += c * int(label[i])
                del around[j][i]
                queue.append(j)
            around[i] = {}
    left = [i for i in range(n) if not label[i]]
    if left:
        source, sink = n, n + 1
        cap: dict[int, dict[int, float]] = {i: dict(around[i]) for i in left}
        cap[source], cap[sink] = {}, {}
        for i in left:
            if own[i] > 0:
                cap[source][i], cap[i][source] = own[i], 0.0
            elif own[i] < 0:
                cap[i][sink], cap[sink][i] = -own[i], 0.0
        while True:
            before = {source: source}
            todo = deque([source])
            while todo and sink not in before:
                i = todo.popleft()
                for j, c in cap[i].items():
                    if c > 1e-9 and j not in before:
                        before[j] = i
                        todo.append(j)
            if sink not in before:
                break
            flow, j = float("inf"), sink
            while j != source:
                flow, j = min(flow, cap[before[j]][j]), before[j]
            j = sink
            while j != source:
                i = before[j]
                cap[i][j] -= flow
                cap[j][i] = cap[j].get(i, 0.0) + flow
                j = i
        for i in left:
            label[i] = 1 if i in before else -1
    return label > 0


def extract(page: str | None, w: np.ndarray) -> tuple[str, int, int]:
    """The main text, the number of blocks and how many of them are content."""
    bs = blocks(page or "")
    if not bs:
        return "", 0, 0
    stay = minimum_cut(scores(bs, w), smoothness(bs))
    return "\n\n".join(b.text for b, s in zip(bs, stay) if s), len(bs), int(stay.sum())


def _sample_blocks(columns: dict[str, list]) -> dict[str, list]:
    out: dict[str, list] = {k: [] for k in ("*", "x", "y")}
    for i, page in enumerate(columns["html"]):
        bs = blocks(page or "")
        if not bs:
            continue
        for b, x in list(zip(bs, shape(bs)))[:SAMPLE_BLOCKS]:
            if b.kind or b.named or b.good:
                out["*"].append(i)
                out["x"].append(x.tolist())
                out["y"].append(int(not (b.kind or b.named)))
    return out


def learn(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> np.ndarray:
    rows = pick(pages, page_id="long", html="string")
    n = rows.count()
    lot = F.pmod(hash_order("page_id", 5), F.lit(1 << 40))
    few = rows.where(lot < int(min(1.0, 3.0 * sample_pages / max(1, n)) * (1 << 40))).orderBy(lot, "page_id", F.crc32(F.col("html").cast("binary"))).limit(sample_pages)
    got = arrow_pass(few, _sample_blocks, "x array<double>, y int", keep=("page_id",), text="html").collect()
    got.sort(key=lambda r: (r["page_id"] is None, r["page_id"], r["x"]))
    return fit(np.array([r["x"] for r in got], float).reshape(len(got), 15), np.array([r["y"] for r in got], float))


def main_text(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars, n_blocks, n_content."""
    w = learn(pages)

    def work(columns: dict[str, list]) -> dict[str, list]:
        got = [extract(page, w) for page in columns["html"]]
        return {"text": [t for t, *_ in got], "n_chars": [len(t) for t, *_ in got], "n_blocks": [n for _, n, _ in got], "n_content": [n for *_, n in got]}

    return arrow_pass(pick(pages, page_id="long", url="string", html="string"), work, "text string, n_chars long, n_blocks int, n_content int", keep=("page_id", "url"), text="html")
