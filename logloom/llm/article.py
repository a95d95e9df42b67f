"""HTML extraction by tree scoring.

A page becomes a tree of elements with blocks of text. Every paragraph-like
block gives points for its length and its commas to the elements above it: all
to the nearest container, half to the next, less further up. A container's
points are discounted by its link density. Around the best container the
article is its outermost article or main element, with the others of that
element that have a fair share of its points. Where there is none, it is the
least element around the containers whose own discounted points are a fair share
of the largest. Beside it, and beside each element around it, stay blocks of the
same structure (tags and class names, as the columns of one article have),
blocks named as its lead, plain paragraphs, the headings before it, and what
stands between those; other containers go, whatever their name.
What is boilerplate by element or by name (menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles, reader comments) takes no part. But a
form, or an element that only a part of its name calls boilerplate, stays where
it holds most of the page's paragraph text and no other marked article stands
beside it; so does any of them, whatever its name, around the heading or marked
article of a page that has no paragraph elsewhere. Controls, and boilerplate
inside what stays, go as before.

Inside the article every block and every bare text counts, in page order: white
space becomes one space, blocks are joined by one space. Without an article or
main element, lists of nothing but links are menus and are left out.

Results: a null or empty page, or one without text, gives an empty text. Broken
or unclosed markup is read as far as it goes. Repeated pages are extracted each
for itself; ties between containers go to the first one. Extra columns stay
aside.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements of HTML by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
SKIPPED = frozenset("""script style noscript template head title nav header footer aside form button select textarea input
    iframe object embed svg canvas map audio video dialog menu option label fieldset xmp noembed noframes""".split())
BLOCKS = frozenset("""address article aside blockquote body br caption center dd details div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr
    ul""".split())
CONTAINERS = frozenset("article main section div body blockquote td center html root".split())
PARAGRAPHS = frozenset("p pre td blockquote li dd h1 h2 h3 h4 h5 h6 div section article main body figcaption form".split())
CLOSED_BY_BLOCK = frozenset("p".split())
SELF_CLOSING_PEERS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"},
                      "td": {"tr"}, "th": {"tr"}, "option": {"select"}}
BASE_POINTS = {"article": 25.0, "main": 20.0, "section": 3.0, "div": 5.0, "td": 3.0, "blockquote": 3.0, "body": 0.0}

# Words of a class, id or role that name boilerplate, and those that name the article.
BOILERPLATE = frozenset("""ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion
    promoted affiliate outbrain taboola nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager header
    masthead topbar footer foot sidebar side aside rail widget widgets related recommended recommendations trending popular
    newsletter subscribe subscription signup login share sharing social socials cookie cookies consent gdpr notice notices
    alert popup modal overlay toast comment comments commentlist respond disqus discussion replies reply copyright legal
    disclaimer skip toolbar search contentinfo complementary hidden paywall feedback responses onetrust next prev
    previous""".split())
COMMENTS = frozenset("comment comments commentlist respond responses disqus discussion replies reply".split())
ARTICLE_WORDS = frozenset("article content entry post story body main text page hentry blog prose".split())
LEADS = frozenset("lead lede intro introduction abstract standfirst deck subtitle conclusion".split())

LAYOUT = frozenset("has no with without is not".split())

HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

LENGTH_STEP, MOST_LENGTH_POINTS, SHORTEST = 100, 3.0, 25
SIBLING_SHARE = 0.2
#: Share of the largest container's own points from which another one belongs to the article, whatever its structure.
FAIR_SHARE = 0.35
#: Length from which a paragraph beside the article needs no sentence mark.
LONG_PARAGRAPH = 80
PAGE_ELEMENTS = frozenset("root html body".split())
#: Share of link text from which a block tells nothing itself, and from which several links are a menu.
MOSTLY_LINKS, MENU_LINKS = 0.5, 0.75

TAG = re.compile(r"""<(?:(!--)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|([!?/][^>]*)>)""")
ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Node:
    __slots__ = ("tag", "parent", "children", "skip", "points", "chars", "link_chars", "links", "told", "good",
                 "doubt", "names", "direct", "held", "scored")

    def __init__(self, tag: str, parent: Node | None, skip: bool, good: bool = False):
        self.tag, self.parent, self.skip, self.good = tag, parent, skip, good
        self.doubt: Doubt | None = None
        self.names: frozenset[str] = frozenset()
        self.direct, self.held, self.scored = 0.0, 0, False
        self.children: list[Node | str | None] = []
        self.points, self.chars, self.link_chars, self.links, self.told = 0.0, 0, 0, 0, 0


class Doubt:
    """An element that is boilerplate by name, or a form: whether it holds the article is judged over the page."""

    __slots__ = ("name", "sure", "comments", "node", "inner", "own", "own_marked", "chars", "whole", "marked", "around")

    def __init__(self, name: str = "", sure: bool = False, comments: bool = False):
        self.name, self.sure, self.comments = name, sure, comments
        self.node: Node | None = None
        self.inner: list[Doubt] = []
        self.own, self.chars, self.whole, self.marked = 0, 0, 0, False
        self.own_marked: dict[Node, int] = {}
        self.around: Node | None = None


def attributes(raw: str) -> dict[str, str]:
    return {k.lower(): unescape(v.strip("\"'")) for k, v in reversed(ATTRIBUTE.findall(raw))} if raw.strip() else {}


def parts_of(names: str) -> set[str]:
    return {p.lower() for p in NAME_PART.findall(names)}


def boilerplate(tag: str, attrs: dict[str, str]) -> bool | Doubt:
    """Whether an element is boilerplate, as far as that is certain from the element alone."""
    if tag in SKIPPED and tag != "form":
        return True
    doubt = Doubt() if tag == "form" else None
    if not attrs or tag in ("html", "body"):
        return doubt or False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", "")):
        return True
    tokens = [[p.lower() for p in NAME_PART.findall(t)] for k in ("class", "id", "role") for t in attrs.get(k, "").split()]
    if any(t and set(t) <= ARTICLE_WORDS for t in tokens):
        return doubt or False
    # A name such as has-sidebar says what a layout holds, not what the element is.
    named = [t for t in tokens if t and t[0] not in LAYOUT and (t[0] in BOILERPLATE or t[-1] in BOILERPLATE)]
    if not named:
        return doubt or False
    comments = any(COMMENTS.intersection(t) for t in named)
    sure = comments or any(all(p in BOILERPLATE or p.isdigit() for p in t) for t in named)
    return Doubt(" ".join("-".join(t) for t in named), sure, comments)


def tree_of(page: str) -> Node:
    """The element tree; texts are children of their element, None marks a break between blocks."""
    root = node = Node("root", None, False)
    at, end = 0, len(page)
    while at < end:
        found = TAG.search(page, at)
        if not found:
            break
        if found.start() > at:
            node.children.append(unescape(page[at:found.start()]))
        at = found.end()
        if found[1]:
            close = page.find("-->", at)
            at = end if close < 0 else close + 3
            continue
        if found[5] is not None:
            continue
        tag = found[3].lower()
        if found[2]:
            node = closed(node, tag)
            continue
        node = opened(node, tag)
        attrs = attributes(found[4])
        if tag in VOID:
            if tag in BLOCKS:
                node.children.append(None)
            continue
        skip = (node.skip and not node.doubt) or boilerplate(tag, attrs)
        child = Node(tag, node, bool(skip), tag in ("article", "main") or bool(
            attrs and parts_of(attrs.get("class", "") + " " + attrs.get("id", "")) & ARTICLE_WORDS))
        if attrs and tag in BLOCKS:
            child.names = frozenset(re.sub(r"\d+", "", n).lower() for k in ("class", "id") for n in attrs.get(k, "").split())
        node.children.append(child)
        if isinstance(skip, Doubt):
            child.doubt, skip.node = skip, child
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}[^>]*>", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if not found[4].rstrip().endswith("/") or tag not in ("svg", "path"):
            node = child
    if at < end:
        rest = page[at:]
        cut = re.search(r"<(?:[a-zA-Z/!][^>]*)?$", rest)  # a tag that the page's end cuts off
        node.children.append(unescape(rest[:cut.start()] if cut else rest))
    return root


def opened(node: Node, tag: str) -> Node:
    """Where a new element goes: a block ends an open paragraph, a list item the one before."""
    if tag in BLOCKS and tag != "br":
        up = node
        while up.parent and up.tag not in CONTAINERS and up.tag not in CLOSED_BY_BLOCK and up.tag not in SELF_CLOSING_PEERS:
            up = up.parent
        if up.tag in CLOSED_BY_BLOCK:
            node = up.parent
    if tag in SELF_CLOSING_PEERS:
        up = node
        while up.parent and up.tag != tag and up.tag not in SELF_CLOSING_PEERS[tag]:
            up = up.parent
        if up.tag == tag:
            node = up.parent
    return node


def closed(node: Node, tag: str) -> Node:
    up = node
    while up.parent and up.tag != tag:
        # An inline end tag without its start does not close a container.
        if up.tag in CONTAINERS and tag not in BLOCKS:
            return node
        up = up.parent
    return up.parent if up.parent else node


def text_blocks(node: Node) -> list[str]:
    """Texts of the blocks below a node, without boilerplate."""
    found, parts = [], []

    def flush():
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            found.append(text)

    stack = [iter((node,))]
    ends: list[bool] = [False]
    while stack:
        child = next(stack[-1], stack)
        if child is stack:
            stack.pop()
            if ends.pop():
                flush()
        elif child is None:
            flush()
        elif isinstance(child, str):
            parts.append(child)
        elif not child.skip:
            block = child.tag in BLOCKS
            if block:
                flush()
            stack.append(iter(child.children))
            ends.append(block)
        elif child.tag in BLOCKS:
            flush()
    flush()
    return found


def score(root: Node) -> list[Node]:
    """Give points from paragraphs to their ancestors; returns the containers that got some, in page order.

    ``told`` of a node becomes the number of headings and paragraphs in it that are not mostly links.
    """
    scored: list[Node] = []
    stack: list[tuple[Node, bool, int]] = [(root, False, 0)]
    order: list[tuple[Node, bool]] = []
    while stack:
        node, in_link, depth = stack.pop()
        order.append((node, in_link))
        for child in reversed(node.children):
            if isinstance(child, Node) and not child.skip:
                stack.append((child, in_link or child.tag == "a", depth + 1))
    for node, in_link in reversed(order):  # children first: own text and links add up
        own = sum(len(c.strip()) for c in node.children if isinstance(c, str))
        node.chars += own
        node.link_chars += own if in_link else 0
        node.links += node.tag == "a"
        if node.parent:
            node.parent.chars += node.chars
            node.parent.link_chars += node.link_chars
            node.parent.links += node.links
    for node, in_link in order:
        if node.tag not in PARAGRAPHS or in_link:
            continue
        text = direct_text(node)
        long = len(text) >= SHORTEST
        if text and (long or node.tag in HEADINGS):
            node.told = not node.links or len(direct_text(node, links=False)) > (1 - MOSTLY_LINKS) * len(text)
        if not long:
            continue
        points = 1 + text.count(",") + text.count("，") + text.count("、") + min(len(text) / LENGTH_STEP, MOST_LENGTH_POINTS)
        up, level = (node if node.tag in CONTAINERS else node.parent), 0
        while up is not None:
            if up.tag in CONTAINERS:
                if not up.points:
                    up.points = BASE_POINTS.get(up.tag, 0.0) + (10.0 if up.good else 0.0) + 1e-9
                    scored.append(up)
                up.points += points / (1, 2, 6, 9, 12, 15)[min(level, 5)]
                up.direct += 0.0 if level else points
                level += 1
            up = up.parent
    for node, _ in reversed(order):
        if node.parent:
            node.parent.told += node.told
    return [n for n, _ in order if n.points]


def direct_text(node: Node, links: bool = True) -> str:
    """The node's text outside of blocks below it."""
    parts: list[str] = []
    stack = [iter(node.children)]
    while stack:
        child = next(stack[-1], stack)
        if child is stack:
            stack.pop()
        elif isinstance(child, str):
            parts.append(child)
        elif child is not None and not child.skip and child.tag not in BLOCKS and (links or child.tag != "a"):
            stack.append(iter(child.children))
    return " ".join("".join(parts).split())


def keep_article(root: Node) -> None:
    """End the skipping of elements in doubt that hold the page's article."""
    page = Doubt()
    doubts: list[Doubt] = []
    # Per doubt: the characters of paragraphs outside inner doubts, and of those below each innermost marked container.
    stack: list[tuple[Node, Doubt, Node | None, bool]] = [(root, page, None, False)]
    above: dict[Node, Node | None] = {}
    while stack:
        node, owner, mark, in_link = stack.pop()
        if node.doubt:
            node.doubt.around = mark
            owner.inner.append(node.doubt)
            owner = node.doubt
            doubts.append(owner)
        if node.good and node.tag not in ("html", "body"):
            above[node] = mark
            mark = node
        if node.tag in PARAGRAPHS and not in_link:
            text = direct_text(node)
            if text and node.tag == "h1":
                owner.marked = True
            if len(text) >= SHORTEST and len(direct_text(node, links=False)) > (1 - MOSTLY_LINKS) * len(text):
                owner.own += len(text)
                if mark is not None:
                    owner.own_marked[mark] = owner.own_marked.get(mark, 0) + len(text)
                    # Each reader comment may be an article of its own.
                    owner.marked |= mark is not owner.around and (not owner.comments or mark.tag == "main")
        stack += [(c, owner, mark, in_link or c.tag == "a") for c in reversed(node.children)
                  if isinstance(c, Node) and (not c.skip or c.doubt)]
    if not doubts or (page.own and all(d.sure for d in page.inner)):
        return
    for doubt in reversed([page, *doubts]):  # inner ones first
        doubt.chars = doubt.own + sum(d.chars for d in doubt.inner if not d.sure)
        doubt.whole = doubt.own + sum(d.whole for d in doubt.inner)
        doubt.marked |= any(d.marked for d in doubt.inner)
    open_, total, marked, judged = page.own, page.chars, dict(page.own_marked), page.inner
    while judged:
        # An article may be cut into elements of one name.
        groups: dict[str | Doubt, list[Doubt]] = {}
        for doubt in judged:
            if not doubt.sure:
                groups.setdefault(doubt.name or doubt, []).append(doubt)
        kept = []
        for group in groups.values():
            chars = sum(d.chars for d in group)
            if 2 * chars > total:
                kept += [d for d in group if not beside(d, chars, marked, above)]
        if not kept and not open_:
            kept = sorted((d for d in judged if d.marked), key=lambda d: -d.whole)[:1]
        for doubt in kept:
            doubt.node.skip = False
            open_ += doubt.own
            total += doubt.chars if doubt.sure else 0
            for mark, chars in doubt.own_marked.items():
                marked[mark] = marked.get(mark, 0) + chars
        judged = [d for doubt in kept for d in doubt.inner]


def beside(doubt: Doubt, chars: int, marked: dict[Node, int], above: dict[Node, Node | None]) -> bool:
    """Whether a marked container that is not around the element in doubt holds an article by itself."""
    around, up = set(), doubt.around
    while up is not None:
        around.add(up)
        up = above[up]
    return any(m not in around and (m.tag in ("article", "main") or n >= SIBLING_SHARE * chars) for m, n in marked.items())


def discounted(node: Node) -> float:
    return node.points * (1 - node.link_chars / node.chars) if node.chars else 0.0


def outermost(node: Node) -> Node | None:
    """The outermost article or main element that holds the node."""
    found, up = None, node
    while up is not None:
        if up.tag in ("article", "main"):
            found = up
        up = up.parent
    return found


def own_points(node: Node) -> float:
    """Points of the paragraphs next to the container, discounted by its link density."""
    return node.direct * (1 - node.link_chars / node.chars) if node.chars else 0.0


def strongest(node: Node) -> Node | None:
    """The child with the most points, the first of equal ones."""
    return max((c for c in node.children if isinstance(c, Node) and c.points and not c.skip), key=lambda c: c.points, default=None)


def continues(other: Node | None, node: Node | None) -> bool:
    """Whether two blocks look alike all the way down: same tags, shared names or, down to the paragraphs, none at all."""
    named = False
    while other is not None and node is not None:
        if other.tag != node.tag or bool(other.names) != bool(node.names) or (node.names and not node.names & other.names):
            return False
        named |= bool(node.names)
        other, node = strongest(other), strongest(node)
    return named or other is node


def plain_paragraph(node: Node) -> bool:
    """A paragraph with a sentence of its own."""
    if node.tag not in ("p", "pre") or not node.told:
        return False
    text = direct_text(node)
    return len(text) >= LONG_PARAGRAPH or (not node.links and text.endswith((".", "!", "?", "…", "。")))


def heads(node: Node) -> bool:
    """A heading, or a block that tells something without any paragraph long enough for points."""
    return bool(node.told and not node.scored and (node.tag in HEADINGS or any(
        isinstance(c, Node) and c.tag in HEADINGS for c in node.children)))


def span(kept: list[int]) -> range:
    return range(kept[0], kept[-1] + 1) if kept else range(0)


def prune(node: Node, parts: list[Node], whole: bool) -> None:
    """Keep of an element's children the article's parts and what belongs to them.

    ``whole``: whether children without points stay wherever they stand, as in the article's own element.
    """
    def alike(child: Node) -> bool:
        named = any(p and p <= ARTICLE_WORDS | LEADS for p in map(parts_of, child.names))
        return bool(child.told) and (named or any(continues(child, p) for p in parts))

    held = set(map(id, parts))
    main = [i for i, c in enumerate(node.children) if isinstance(c, Node) and not c.skip and (id(c) in held or alike(c))]
    first = main[0] if main else len(node.children)
    kept = set(span(main))
    beside = main + [i for i, c in enumerate(node.children) if isinstance(c, Node) and not c.skip
                     and (plain_paragraph(c) or (i < first and heads(c)))]
    # Between a heading or paragraph and the parts, only containers with points of their own go.
    loose = range(len(node.children)) if whole else span(sorted(beside))
    kept |= {i for i in loose if not isinstance(node.children[i], Node) or not node.children[i].scored
             or node.children[i].tag == "blockquote"}
    node.children = [c for i, c in enumerate(node.children) if i in kept or c is None]


def keep_parts(root: Node, containers: list[Node]) -> None:
    """Reduce a page without article element to the containers with a fair share and what continues them."""
    most = max(map(own_points, containers))
    fair = [n for n in containers if own_points(n) >= FAIR_SHARE * most > 0] or containers[:1]
    chosen = set(map(id, fair))
    for node in fair:
        node.held = 1
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in node.children if isinstance(c, Node) and not c.skip]
    for node in reversed(order):
        node.scored |= bool(node.points)
        if node.parent:
            node.parent.held += node.held
            node.parent.scored |= node.scored
    top = root
    while id(top) not in chosen:
        inner = next((c for c in top.children if isinstance(c, Node) and c.held == len(fair)), None)
        if inner is None:
            break
        top = inner
    around, up = top, top.parent
    parts = [c for c in top.children if isinstance(c, Node) and not c.skip and c.held]
    if id(top) not in chosen:
        prune(top, parts, top.tag not in PAGE_ELEMENTS)
    elif top.tag in PAGE_ELEMENTS:
        prune(top, parts + [c for c in top.children if isinstance(c, Node) and c.told and not c.skip
                            and (c.tag not in CONTAINERS or c.tag == "blockquote")], False)
    line = []
    while up is not None:
        line.append(up)
        up = up.parent
    named = max((i for i, n in enumerate(line) if n.good and n.tag not in PAGE_ELEMENTS), default=-1)
    for i, node in enumerate(line):
        prune(node, [around], i <= named)
        around = node


def skip_menus(top: Node, best: Node) -> None:
    """Skip lists of nothing but links that lie in top beside the best container."""
    around, up = set(), best
    while up is not None:
        around.add(id(up))
        up = up.parent
    stack = [top]
    while stack:
        for child in stack.pop().children:
            if not isinstance(child, Node) or child.skip or child is best:
                continue
            if (id(child) not in around and child.tag in BLOCKS and child.links > 1 and not child.told
                    and child.link_chars >= MENU_LINKS * child.chars):
                child.skip = True
            else:
                stack.append(child)


def main_text(page: str | None) -> str:
    """All blocks of the article around the best container."""
    if not page:
        return ""
    root = tree_of(page)
    keep_article(root)
    containers = score(root)
    if not containers:
        return " ".join(text_blocks(root))
    best = max(containers, key=discounted)
    # An article or main element around the best container is the article as a whole.
    marked = outermost(best)
    if marked is not None:
        limit = SIBLING_SHARE * discounted(marked)
        return " ".join(text for n in containers if n is marked or (
            n.tag == marked.tag and discounted(n) >= limit and outermost(n) is n) for text in text_blocks(n))
    skip_menus(root, best)
    keep_parts(root, containers)
    return " ".join(text_blocks(root))


EXTRACTED = "page_id long, url string, text string, n_chars long"


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, main text and its code points for every page (page_id, url, html)."""
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                texts = [main_text(page) for page in rows.column(2).to_pylist()]
                yield pa.record_batch([rows.column(0), rows.column(1), pa.array(texts, pa.string()),
                                       pa.array([len(t) for t in texts], pa.int64())],
                                      names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(extract, EXTRACTED)
