"""Main text of a page by tag-path ratios.

A page is cut into blocks of text, each on the tag path from the root to it (tag, first class, id; a container without a name counts with its number among its like). For each path the
text outside links and the punctuation of all its blocks are aggregated to a ratio by block, and times how the text of the path's containers compares with their neighbours'. The ratios are
smoothed along the page, and fused: with the best path of the same container, where the block is one of running text, and with the next block's, where it is a heading. Elements and words
of class, id or role that stand for boilerplate, and links, are features that lower a path's score. Paths over the threshold are content, and the article is the blocks on them:
nothing else chooses. A page is worked on alone, in time linear in its size: no exchange.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I | re.A) for t in RAW}
BLOCK = frozenset(
    "html head body article section main div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption address header footer nav aside form fieldset details summary hgroup noscript template select option button dialog menu center hr".split()
)
CLOSES_P = BLOCK - {"option", "button", "html", "body", "head"}
_P_BOUNDS = ("article", "section", "div", "td", "th", "table", "body", "button")
#: An element that is open when another of its kind begins, up to the nearest of the bounds, ends there.
ENDS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",))}
#: Elements that aren't shown as text.
UNSEEN = frozenset("head noscript template select button dialog svg object canvas audio video".split())
#: Elements whose text is set apart from the rest, once they hold other blocks; blocks of the others are running text of the nearest of these.
CONTAINERS = frozenset("html body article section main div header footer nav aside form fieldset details menu center td th".split())
#: Containers that say nothing by their tag: without a class or id they count one by one.
NAMELESS = frozenset("div td th center".split())
HEADINGS = frozenset("h1 h2 h3".split())
#: Features: what a path's score is multiplied by for boilerplate by tag or role, for a heading within a page's header, and for a word of class or id.
BY_TAG, BY_WORD = 0.01, 0.05
BAD_TAGS = frozenset("nav footer aside form menu".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar toolbar form".split())
_BAD_WORDS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adbox|adslot|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|sidebar|side|aside|widget\w*|footer|foot|masthead|topbar|toolbar|header|cookies?|consent|gdpr|notice|notification|popup|modal|overlay|newsletter|subscribe|signup|login|search\w*|share|sharing|social|related|recommend\w*|comments?|commentlist|disqus|replies|reply|respond|pagination|pager|copyright|legal|skip|hidden|tags|tagcloud|outbrain|taboola|teaser)(?=$|[\s_-])",
    re.I,
)
#: Of these, no good word beside them makes up.
_WORST_WORDS = re.compile(r"(?:^|[\s_-])(?:comments?|sidebar|cookies?|adverts?|ads?|related|newsletter)(?=$|[\s_-])", re.I)
_GOOD_WORDS = re.compile(r"(?:^|[\s_-])(?:article|content|main|post|story|entry|text|body)(?=$|[\s_-])", re.I)
#: A tag as browsers read it: a quote within an unquoted value is a character like others.
_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*+)((?:[\s/]++|[^\s/>=][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)?+|=)*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s/>=]+)(?:\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*)))?""")
_COMMENT_END = re.compile(r"--!?>")
_UNSEEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_PUNCTUATION = re.compile(r"[.,;:!?…¡¿。，！？、]")
_DIGITS = re.compile(r"\d+")
#: Share of the page's text from which on an element is no boilerplate by a whole word of its class or id, its tag or role; for a part of a word ("has-sidebar"), HALF.
MOST, HALF = 0.85, 0.5
#: Weight of either neighbour along the page.
BESIDE = 0.15
#: The threshold is the deviation of the paths' scores, but between these parts of the best score, and LEAST at the least.
LOW_PART, HIGH_PART, LEAST = 0.15, 0.4, 0.3


class Element:
    #: factor: what its tag, role and words count; mark: 0, or the share of the page's text from which on they don't; number: its place in the page; named: whether it has a class or id.
    __slots__ = ("tag", "label", "parent", "seen", "mark", "factor", "number", "holds", "named")

    def __init__(self, tag: str, label: str, parent: Element | None, seen: bool, number: int, mark: float = 0.0, factor: float = 1.0, named: bool = False) -> None:
        self.tag, self.label, self.parent, self.seen, self.number, self.mark, self.factor, self.named = tag, label, parent, seen, number, mark, factor, named
        #: Whether other blocks lie within it.
        self.holds = False


class Block(NamedTuple):
    element: Element
    text: str
    #: Characters of it in links.
    linked: int


def _element(tag: str, attributes: str, parent: Element, number: int, within_article: bool) -> Element:
    label, names, seen, role, named = tag, "", tag not in UNSEEN, False, False
    if attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key in ("class", "id"):
                names += " " + value
                first = _DIGITS.sub("", value.split()[0]) if value.split() else ""
                if first:
                    label += ("." if key == "class" else "#") + first
                    named = True
            elif key == "role":
                role |= value.lower() in BAD_ROLES
            elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and _UNSEEN_STYLE.search(value)):
                seen = False
    mark, factor = 0.0, 1.0
    if tag in BAD_TAGS or role or (tag == "header" and not within_article):
        mark, factor = MOST, BY_TAG
    elif names and tag not in ("html", "body", "article", "main"):
        if (_BAD_WORDS.search(names) and not (tag == "header" or _GOOD_WORDS.search(names))) or _WORST_WORDS.search(names):
            mark, factor = MOST if any(_BAD_WORDS.fullmatch(x) for x in names.split()) else HALF, BY_WORD
    return Element(tag, label, parent, seen and parent.seen, number, mark, factor, named)


class _Open:
    """The open elements. Where a tag or a block was opened last is known without a search."""

    def __init__(self) -> None:
        self.stack = [Element("#root", "", None, True, 0)]
        self.at: dict[str, list[int]] = defaultdict(list)
        self.blocks = [0]
        self.links = 0

    def last(self, *tags: str) -> int:
        return max((self.at[t][-1] for t in tags if self.at[t]), default=0)

    def push(self, e: Element) -> None:
        self.at[e.tag].append(len(self.stack))
        if e.tag in BLOCK:
            self.stack[self.blocks[-1]].holds = True
            self.blocks.append(len(self.stack))
        self.links += e.tag == "a"
        self.stack.append(e)

    def cut(self, k: int) -> None:
        while len(self.stack) > k:
            e = self.stack.pop()
            self.at[e.tag].pop()
            self.links -= e.tag == "a"
            if e.tag in BLOCK:
                self.blocks.pop()


def blocks_of(page: str) -> tuple[list[Element], list[Block]]:
    """The elements in the order in which they begin, and the blocks in page order, with one space for each run of white space; what isn't shown and empty blocks are left out."""
    opened = _Open()
    stack = opened.stack
    elements = [stack[0]]
    out: list[Block] = []
    parts: list[str] = []
    linked: list[str] = []

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join("".join(parts).split())
            block = stack[opened.blocks[-1]]
            if text:
                out.append(Block(block, text, len(" ".join("".join(linked).split()))))
            parts, linked = [], []

    def say(text: str) -> None:
        if text and stack[-1].seen:
            if "&" in text:
                text = html.unescape(text)
            parts.append(text)
            if opened.links:
                linked.append(text)

    def begin(tag: str, attributes: str) -> None:
        e = _element(tag, attributes, stack[-1], len(elements), bool(opened.at["article"] or opened.at["main"]))
        elements.append(e)
        opened.push(e)

    at, size = 0, len(page)
    while at < size:
        cut = page.find("<", at)
        if cut < 0:
            say(page[at:])
            break
        say(page[at:cut])
        following = page[cut + 1 : cut + 2]
        if not (following.isascii() and following.isalpha()):
            closing = page[cut + 2 : cut + 3]
            if following == "/" and closing.isascii() and closing.isalpha():
                pass
            elif page.startswith("<!--", cut):
                if page.startswith(("<!-->", "<!--->"), cut):
                    at = page.index(">", cut) + 1
                else:
                    end = _COMMENT_END.search(page, cut + 4)
                    at = end.end() if end else size
                continue
            elif following in ("!", "?") or (following == "/" and closing):  # what browsers take as a comment, to the next ">"
                end = page.find(">", cut)
                at = end + 1 if end >= 0 else size
                continue
            else:
                say("<")
                at = cut + 1
                continue
        m = _TAG.match(page, cut)
        if not m:
            break  # a tag that never ends
        at, tag = m.end(), m[2].lower()
        if m[1]:
            found = opened.last(tag)
            if found and tag in BLOCK:
                flush()
                opened.cut(found)
            elif found > opened.blocks[-1]:
                opened.cut(found)
            elif tag == "p":
                flush()
            continue
        if tag in RAW:
            ending = RAW_END[tag].search(page, at)
            if not ending:
                break
            close = page.find(">", ending.end())
            at = close + 1 if close >= 0 else size
            continue
        if tag == "br" or tag == "hr" or tag == "img":
            if stack[-1].seen:
                parts.append(" ")
            if tag == "hr":
                flush()
            continue
        if tag in VOID:
            continue
        if tag in BLOCK:
            flush()
            if tag in CLOSES_P and opened.last("p") > opened.last(*_P_BOUNDS):
                opened.cut(opened.last("p"))
            if tag in ENDS:
                same, bounds = ENDS[tag]
                if opened.last(*same) > opened.last(*bounds):
                    opened.cut(opened.last(*same))
            if tag == "body" and opened.last("head"):
                opened.cut(opened.last("head"))
            begin(tag, m[3])
        elif tag == "a":
            if opened.last("a") > opened.blocks[-1]:
                opened.cut(opened.last("a"))
            begin("a", "")
        elif not m[3].endswith("/"):
            begin(tag, m[3])
    flush()
    return elements, out


class Nodes(NamedTuple):
    """Of each block its path, and of each path what is known of it."""

    path: list[int]
    #: Of each path: leaf tag, container path, feature.
    leaf: list[str]
    container: list[int]
    feature: list[float]
    #: Of each container path the one around it; those of the page itself, down to <body>.
    around: list[int]
    outermost: set[int]


def _features(elements: list[Element], blocks: list[Block]) -> list[float]:
    """Of each element the product of what its own and its ancestors' tags, roles and words count; an element with most of the page's text is no boilerplate."""
    mass = [0] * len(elements)
    for b in blocks:
        mass[b.element.number] += len(b.text) - b.linked
    whole = sum(mass)
    for e in reversed(elements[1:]):
        mass[e.parent.number] += mass[e.number]
    out = [1.0] * len(elements)
    for e in elements[1:]:
        own = e.factor if e.mark and not (0 < mass[e.number] >= e.mark * whole) else 1.0
        out[e.number] = out[e.parent.number] * own
    return out


def nodes_of(elements: list[Element], blocks: list[Block]) -> Nodes:
    """The blocks' paths."""
    features = _features(elements, blocks)
    around: list[int] = [-1]
    numbers: dict[tuple, int] = {}
    # The container path of each element that is one; of another the nearest one's, and the labels from there on.
    inside: list[tuple[int, str]] = [(0, "")] * len(elements)
    nameless: dict[int, int] = defaultdict(int)
    outermost = {0}
    for e in elements[1:]:
        container, labels = inside[e.parent.number]
        if e.tag in CONTAINERS and e.holds:
            label = labels + "/" + e.label
            if e.tag in NAMELESS and not e.named:
                nameless[e.parent.number] += 1
                label += f"[{nameless[e.parent.number]}]"
            key = (container, label)
            if key not in numbers:
                numbers[key] = len(around)
                around.append(container)
            inside[e.number] = (numbers[key], "")
            if e.tag in ("html", "body"):
                outermost.add(numbers[key])
        elif e.tag in BLOCK:
            inside[e.number] = (container, labels + "/" + e.label if len(labels) < 200 else labels)
        else:
            inside[e.number] = (container, labels)
    paths: dict[tuple, int] = {}
    path, leaf, containers, feature = [], [], [], []
    for b in blocks:
        e = b.element
        f = features[e.number]
        if e.tag in HEADINGS and e.parent and e.parent.tag == "header" and f < 1:
            f = features[e.parent.parent.number]  # a heading is judged by what follows it
        key = (*inside[e.number], f)
        if key not in paths:
            paths[key] = len(leaf)
            leaf.append("" if e.holds else e.tag)
            containers.append(key[0])
            feature.append(f)
        path.append(paths[key])
    return Nodes(path, leaf, containers, feature, around, outermost)


def path_scores(nodes: Nodes, blocks: list[Block]) -> list[float]:
    """The fused score of each path."""
    count = len(nodes.leaf)
    length, punctuation, number, linked = [0] * count, [0] * count, [0] * count, [0] * count
    for p, b in zip(nodes.path, blocks):
        length[p] += len(b.text)
        punctuation[p] += len(_PUNCTUATION.findall(b.text))
        linked[p] += b.linked
        number[p] += 1
    free = [n - m for n, m in zip(length, linked)]
    # How the text of a container compares with that of its neighbours: the least of the levels. A leaf that is a container by its tag (a lone <div>) is one of the neighbours itself; other leaves are the container's running text.
    mass, running = [0] * len(nodes.around), [0] * len(nodes.around)
    for p in range(count):
        c = nodes.container[p]
        if nodes.leaf[p] not in CONTAINERS:
            running[c] += free[p]
        mass[c] += free[p]
    for c in range(len(mass) - 1, 0, -1):
        mass[nodes.around[c]] += mass[c]
    most = list(running)
    for p in range(count):
        if nodes.leaf[p] in CONTAINERS:
            most[nodes.container[p]] = max(most[nodes.container[p]], free[p])
    for c in range(1, len(mass)):
        most[nodes.around[c]] = max(most[nodes.around[c]], mass[c])
    level = [1.0] * len(mass)
    for c in range(1, len(mass)):
        level[c] = min(level[nodes.around[c]], math.sqrt(mass[c] / (most[nodes.around[c]] or 1)))
    own = []
    for p in range(count):
        c = nodes.container[p]
        part = min(level[c], math.sqrt((free[p] if nodes.leaf[p] in CONTAINERS else running[c]) / (most[c] or 1)))
        own.append(part * math.log1p(free[p] / number[p]) * (0.3 + math.log1p(punctuation[p] / number[p])))
    # Smoothed along the page; a path has the mean of its blocks.
    total = [0.0] * count
    for k, p in enumerate(nodes.path):
        s, w = (1 - 2 * BESIDE) * own[p], 1 - 2 * BESIDE
        for j in (k - 1, k + 1):
            if 0 <= j < len(nodes.path):
                s, w = s + BESIDE * own[nodes.path[j]], w + BESIDE
        total[p] += s / w
    smooth = [t / n for t, n in zip(total, number)]
    # Fused with the best path of the container, and a heading with what follows it. Right under <body> a lone <div> is no running text.
    kin: dict[int, float] = defaultdict(float)
    judged = [s * f for s, f in zip(smooth, nodes.feature)]
    for p in range(count):
        kin[nodes.container[p]] = max(kin[nodes.container[p]], judged[p])
    fused = []
    following: dict[int, float] = {}
    ahead = 0.0
    for p in reversed(nodes.path):
        if nodes.leaf[p] in HEADINGS:
            following[p] = max(following.get(p, 0.0), ahead)
        else:
            ahead = judged[p]
    for p in range(count):
        c = nodes.container[p]
        text = nodes.leaf[p] not in CONTAINERS or (c not in nodes.outermost and level[c] > 0.99)
        best = max(judged[p], kin[c] * nodes.feature[p] if text else 0.0, following.get(p, 0.0) * nodes.feature[p])
        links = min(1.0, 1.6 * free[p] / length[p])
        fused.append(links * (0.5 * judged[p] + 0.5 * best))
    return fused


def threshold(scores: list[float]) -> float:
    most, mean = max(scores), sum(scores) / len(scores)
    deviation = math.sqrt(sum((v - mean) ** 2 for v in scores) / len(scores))
    return max(LEAST, min(max(deviation, LOW_PART * most), HIGH_PART * most))


def main_text(page: str | None) -> str:
    """Blocks of the article, joined by an empty line; empty if there is none."""
    elements, blocks = blocks_of(page or "")
    if not blocks:
        return ""
    nodes = nodes_of(elements, blocks)
    scores = path_scores(nodes, blocks)
    least = threshold(scores)
    return "\n\n".join(b.text for p, b in zip(nodes.path, blocks) if scores[p] >= least)


@F.pandas_udf(StringType())
def main_text_udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for pages in batches:
        yield pd.Series([main_text(p) for p in pages], dtype=object)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text, n_chars.

    A null or empty page, or one without an article, gives the empty text. Very long and deeply nested pages are read whole, in time linear in their size. Repeated pages give the same text each; an empty table gives an
    empty result; columns beside the three named are ignored, whatever their names.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), main_text_udf(F.col(html_col)).alias("text"))
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
