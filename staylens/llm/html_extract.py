"""Main text of web pages by minimum-cut labelling.

A page is cut into text blocks at block-level tags. A classifier gives each block a score
from its place in the document (elements and class, id or role words above it), its length
and its share of link text. The score is the block's capacity from the content terminal, or
to the boilerplate terminal if negative. Edges between neighbouring blocks and between
consecutive blocks of one parent cost more the closer the blocks stand in the element tree.
The minimum cut, found by maximum flow, labels all blocks at once, so that a short paragraph
goes with the paragraphs around it.

A class, id or role word such as "search" marks an element as boilerplate, but one such word
must not empty a page: where the running text under the mark outweighs all that stands outside
marks, and no article is known outside, the mark falls (``rescue``). Reader comments are
never taken, whatever stands inside them.

One narrow pass over the rows; a page is one task's work. Tags are read once from left to right
and elements know their parent alone, so time and memory grow with the size of the page, however
deep its elements nest.

Cases: null or empty html gives empty text, as does a page without content; a tag or comment
without an end is markup up to the end of the page, as browsers read it; an attribute whose
quote is never closed ends with its tag; unknown references stay as written; repeated rows each
give a row; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm import common

# Elements of the HTML standard, by role.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary "
    "table tbody td tfoot th thead tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no text of the page.
RAW_TAGS = frozenset("script style title textarea xmp iframe noembed noframes noscript".split())
SKIPPED_TAGS = frozenset("head template svg math object audio video canvas select datalist".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: A block under one of these is boilerplate whatever else holds.
BOILER_TAGS = frozenset("nav footer aside menu dialog button fieldset search".split())
#: What may stand in a head; any other element ends it.
HEAD_TAGS = frozenset("base bgsound link meta noscript script style template title".split())
CONTENT_TAGS = frozenset(("article", "main"))
# Words of class, id and role attributes.
BOILER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner billboard breadcrumb breadcrumbs byline comment comments "
    "commentlist consent contentinfo cookie cookies copyright dfp disclaimer disqus footer footnav gdpr header infobar "
    "legal login masthead menu menubar modal nav navbar navigation newsletter notice notification overlay pager "
    "pagination popup privacy promo promoted promotion recommended related replies reply respond search share sharing "
    "sidebar sidenav signup skip skyscraper social sponsor sponsored sponsors subscribe subscription tagcloud tags "
    "teaser toc toolbar topbar tracking warning widget widgets alert aside complementary".split())
CONTENT_WORDS = frozenset("article articlebody content entry main maincontent post postbody story".split())
#: At the start or end of a class, id or role they name what readers wrote.
COMMENT_WORDS = frozenset("comment commentlist comments disqus replies reply respond".split())
#: Before another word they make it tell about a container, not what it is.
ABOUT_WORDS = frozenset("category has is no tag type with without".split())

_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_TAG_STOP = re.compile(r">|=\s*[\"']")
_HINTS = re.compile(r"(?<![\w-])(?:class|id|role|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_LEGAL = re.compile("©|\\(c\\) ?[0-9]{4}|all rights reserved", re.I)


@dataclass(frozen=True)
class Costs:
    """Weights of the classifier and of the smoothness edges.

    ``outside`` and ``no_words`` were chosen on the pages of sf0.01 with their article element
    renamed or taken out, from a grid of five weights; the others are set by hand."""
    boiler_tag: float = -8.0
    boiler_word: float = -6.0
    content_place: float = 4.0
    outside: float = 0.0
    no_words: float = -0.5
    ten_words: float = 1.3
    most_words: float = 3.0
    links: float = -4.0
    links_inside: float = 0.4
    legal: float = -3.0
    heading: float = 0.8
    adjacent: float = 1.6
    sibling: float = 0.6
    distance: float = 0.55
    found: float = 0.4
    rescue: float = 3.0
    rescue_words: int = 10


@dataclass(slots=True)
class Element:
    tag: str
    up: Element | None  # the nearest block-level element above
    depth: int  # block-level elements from the root
    place: float  # score of the nearest telling element
    boiler: bool  # under a boilerplate element
    content: bool  # under a content element
    skipped: bool
    link: bool
    mark: Mark | None  # the nearest boilerplate word or form above


@dataclass(slots=True)
class Mark:
    """A boilerplate word or a form; if it falls, blocks under it have the place it hid."""
    place: float
    held: float  # score of what is under it
    inside: bool  # whether it stands in a content element
    running: int = 0  # unlinked words of its running blocks
    blocks: int = 0
    fallen: bool = False


@dataclass(slots=True)
class Block:
    text: str
    words: int
    links: float  # share of link characters
    under: Element
    heading: bool


def _hint_words(attributes: str) -> list[list[str]]:
    """The words of each class, id or role."""
    if not attributes:
        return []
    names = (name for m in _HINTS.finditer(attributes) for name in m[1].strip("\"'").split())
    return [words for words in ([w.lower() for w in _WORDS.findall(name)] for name in names) if words]


def _open(parent: Element, block: Element, tag: str, attributes: str, costs: Costs) -> Element:
    """The element of a start tag under ``parent``; block: the nearest block-level element."""
    names = _hint_words(attributes)
    words = [w for name in names for w, before in zip(name, ["", *name]) if before not in ABOUT_WORDS]
    place, content, boiler, mark = parent.place, parent.content, parent.boiler, parent.mark
    root = tag in ("html", "body")
    if mark is None and (tag in CONTENT_TAGS or any(w in CONTENT_WORDS for w in words)):
        place, content = costs.content_place, True
    if not root and any(name[0] in COMMENT_WORDS or name[-1] in COMMENT_WORDS and name[0] not in ABOUT_WORDS for name in names):
        boiler = True
    # a page's header is boilerplate, an article's own holds its headings
    elif tag in BOILER_TAGS or tag == "header" and not parent.content:
        boiler = True
    elif tag == "form":
        mark = Mark(place, costs.boiler_tag, parent.content)
    elif not root and tag not in CONTENT_TAGS and any(w in BOILER_WORDS and not (w == "header" and content) for w in words):
        mark = Mark(place, costs.boiler_word, parent.content)
    return Element(tag, block, block.depth + (tag in BLOCK_TAGS), place, boiler, content, parent.skipped or tag in SKIPPED_TAGS,
                   parent.link or tag == "a", mark)


class _Stack:
    """The open elements. Each is put and taken once, and the last of a tag is known."""

    def __init__(self, root: Element):
        self.open, self.of_tag, self.blocks = [root], {}, [0]

    def put(self, e: Element) -> None:
        self.of_tag.setdefault(e.tag, []).append(len(self.open))
        if e.tag in BLOCK_TAGS:
            self.blocks.append(len(self.open))
        self.open.append(e)

    def cut(self, at: int) -> None:
        """Closes the element at a place and all in it."""
        for e in self.open[at:]:
            self.of_tag[e.tag].pop()
        del self.open[at:]
        while self.blocks[-1] >= at:
            self.blocks.pop()

    def close(self, tag: str) -> None:
        """An end tag: of a block-level element it closes what is in it; another one does not
        reach over block-level elements, and one without a start is no tag."""
        at = self.of_tag.get(tag)
        if at and (tag in BLOCK_TAGS or at[-1] > self.blocks[-1]):
            self.cut(at[-1])


def _tag_end(page: str, at: int, never: set[str]) -> tuple[int, int]:
    """Where the attributes of a tag end and what follows it begins. Quotes count after an equals
    sign only. never: what is known not to come any more, so that nothing is searched twice."""
    n = len(page)
    while True:
        m = None if ">" in never else _TAG_STOP.search(page, at)
        if m is None:
            never.add(">")
            return n, n
        if m[0] == ">":
            return m.start(), m.end()
        quote = m[0][-1]
        end = -1 if quote in never else page.find(quote, m.end())
        if end < 0:  # never closed: the tag ends at the next ">"
            never.add(quote)
            end = page.find(">", m.end())
            return (end, end + 1) if end >= 0 else (n, n)
        at = end + 1


def blocks(page: str, costs: Costs = Costs()) -> list[Block]:
    """The text blocks of a page in order."""
    root = Element("", None, 0, costs.outside, False, False, False, False, None)
    stack, never = _Stack(root), set()
    out: list[Block] = []
    parts: list[str] = []
    first: Element | None = None
    heading, linked, at, n = False, 0, 0, len(page)

    def add(text: str) -> None:
        nonlocal first, linked, heading
        top = stack.open[-1]
        if text and not top.skipped:
            if not text.isspace():
                if first is None:
                    first, heading = top, any(e.tag in HEADINGS for e in stack.open[-4:])
                linked += len(text) if top.link else 0
            parts.append(text)

    def flush() -> None:
        nonlocal first, linked, heading
        if first is not None:
            raw = "".join(parts)
            words = html.unescape(raw).split()
            if words:
                out.append(Block(" ".join(words), len(words), min(1.0, linked / max(1, len(raw.strip()))), first, heading))
        parts.clear()
        first, linked, heading = None, 0, False

    while at < n:
        less = page.find("<", at)
        add(page[at:less if less >= 0 else n])
        if less < 0:
            break
        m = _TAG.match(page, less)
        if m is None:
            if page.startswith("<!--", less):
                end, size = page.find("-->", less + 4), 3
            elif page.startswith(("<!", "<?"), less):
                end, size = page.find(">", less), 1
            else:
                add("<")
                end, size = less, 1
            at = end + size if end >= 0 else n
            continue
        stop, at = _tag_end(page, m.end(), never)
        if stop == n:
            break
        tag, attributes, closing = m[1].lower(), page[m.end():stop], page[less + 1] == "/"
        if tag == "br":
            add(" ")
            continue
        if tag in BLOCK_TAGS:
            flush()
        if closing:
            stack.close(tag)
            continue
        if tag not in HEAD_TAGS and stack.of_tag.get("head"):
            stack.cut(stack.of_tag["head"][0])
        empty = attributes.rstrip().endswith("/")
        if tag in RAW_TAGS and not empty:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|$)", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if tag in VOID_TAGS or empty and tag not in BLOCK_TAGS:
            continue
        if tag in BLOCK_TAGS:  # a paragraph ends where another block starts, an item where the next does
            last = stack.open[stack.blocks[-1]].tag
            if last == "p" or last == tag and tag in ("li", "dd", "dt", "tr", "td", "th"):
                stack.cut(stack.blocks[-1])
        stack.put(_open(stack.open[-1], stack.open[stack.blocks[-1]], tag, attributes, costs))
    flush()
    rescue(out, costs)
    return out


def rescue(found: list[Block], costs: Costs = Costs()) -> None:
    """Lets the mark fall that holds the page's main text, if there is one: at least two running
    blocks, ``costs.rescue`` times the words outside marks. Where an article stands outside
    marks, only marks inside an article may fall."""
    outside, article, marks = 0, False, {}
    for b in found:
        e = b.under
        if e.boiler or b.links >= 0.5:
            continue
        if e.mark is None:
            article |= e.content
            outside += b.words
        elif b.words >= costs.rescue_words:
            e.mark.running += b.words
            e.mark.blocks += 1
            marks[id(e.mark)] = e.mark
    able = [m for m in marks.values() if m.blocks > 1 and m.running > costs.rescue * outside and (m.inside or not article)]
    if able:
        max(able, key=lambda m: m.running).fallen = True


def score(b: Block, costs: Costs = Costs()) -> float:
    """Above 0 for content."""
    if b.under.boiler:
        return costs.boiler_tag
    mark, place = b.under.mark, b.under.place
    if mark is not None:
        place = max(mark.place, costs.found) if mark.fallen else mark.held
    s = place + min(costs.most_words, costs.no_words + costs.ten_words * b.words / 10)
    s += costs.links * b.links * (costs.links_inside if b.under.content else 1)
    if b.heading:
        s += costs.heading
    if b.words < 40 and _LEGAL.search(b.text):
        s += costs.legal
    return s


def _apart(a: Element, b: Element) -> int:
    """Steps from the deeper of two block-level elements to the lowest one that holds both.
    Between neighbouring blocks these are elements closed or opened, so all steps of a page are
    no more than its elements."""
    deep = max(a.depth, b.depth)
    while a is not b:
        if a.depth >= b.depth:
            a = a.up
        else:
            b = b.up
    return deep - a.depth


def edges(found: list[Block], costs: Costs = Costs()) -> list[tuple[int, int, float]]:
    """Between neighbours, by their distance in the tree, and consecutive blocks of a parent. A
    block under a boilerplate element is settled and tells nothing about its neighbours."""
    out, last = [], {}
    tops = [b.under if b.under.tag in BLOCK_TAGS or b.under.up is None else b.under.up for b in found]
    for i, (b, top) in enumerate(zip(found, tops)):
        if b.under.boiler:
            continue
        if i and not found[i - 1].under.boiler:
            out.append((i - 1, i, costs.adjacent * costs.distance ** _apart(tops[i - 1], top)))
        parent = id(top.up)
        if parent in last:
            out.append((last[parent], i, costs.sibling))
        last[parent] = i
    return out


def min_cut(scores: list[float], links: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay on the source's side of the minimum cut.

    Node i has capacity scores[i] from the source if positive, -scores[i] to the sink if
    negative; links carry their weight either way. Flow goes along shortest paths in levels."""
    left = [max(0.0, s) for s in scores]  # from the source
    room = [max(0.0, -s) for s in scores]  # to the sink
    to: list[list[int]] = [[] for _ in scores]  # arcs by node
    head, cap = [], []
    for a, b, w in links:
        for x, y in ((a, b), (b, a)):
            to[x].append(len(head))
            head.append(y)
            cap.append(w)
    eps = 1e-9
    while True:
        level = [0 if c > eps else -1 for c in left]
        queue = deque(i for i, c in enumerate(left) if c > eps)
        reach = math.inf
        while queue:
            x = queue.popleft()
            if room[x] > eps:
                reach = min(reach, level[x])
            for e in to[x]:
                if cap[e] > eps and level[head[e]] < 0:
                    level[head[e]] = level[x] + 1
                    queue.append(head[e])
        if reach is math.inf:
            return [v >= 0 for v in level]
        nxt = [0] * len(scores)
        for s in range(len(scores)):
            while left[s] > eps and level[s] == 0:
                path: list[int] = []
                x = s
                while room[x] <= eps:
                    arcs = to[x]
                    while nxt[x] < len(arcs):
                        e = arcs[nxt[x]]
                        if cap[e] > eps and level[head[e]] == level[x] + 1:
                            break
                        nxt[x] += 1
                    if nxt[x] < len(arcs):
                        path.append(arcs[nxt[x]])
                        x = head[path[-1]]
                    elif path:
                        x = head[path.pop() ^ 1]
                        nxt[x] += 1
                    else:
                        break
                if room[x] <= eps:
                    break
                flow = min([left[s], room[x], *(cap[e] for e in path)])
                left[s] -= flow
                room[x] -= flow
                for e in path:
                    cap[e] -= flow
                    cap[e ^ 1] += flow


def main_text(page: str | None, costs: Costs = Costs()) -> str:
    found = blocks(page or "", costs)
    kept = min_cut([score(b, costs) for b in found], edges(found, costs))
    return "\n".join(b.text for b, k in zip(found, kept) if k)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            costs: Costs = Costs()) -> DataFrame:
    """(page_id, url, text, n_blocks, n_kept) of every page."""
    types = {f.name: f.dataType.simpleString() for f in pages.schema}

    def run(batches):
        for batch in common.blocks(batches, "html"):
            texts, n, n_kept = [], [], []
            for page in common.texts_of(batch, "html"):
                found = blocks(page, costs)
                kept = min_cut([score(b, costs) for b in found], edges(found, costs))
                texts.append("\n".join(b.text for b, k in zip(found, kept) if k))
                n.append(len(found))
                n_kept.append(sum(kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(n, pa.int64()), pa.array(n_kept, pa.int64())],
                names=["page_id", "url", "text", "n_blocks", "n_kept"])
    return pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")).mapInArrow(
        run, f"page_id {types[id_col]}, url {types[url_col]}, text string, n_blocks bigint, n_kept bigint")
