"""Main text of web pages by tree scoring.

Each block of text gives points for its length and its commas to the container that holds it, and falling shares of them to
the ancestors.  A container's score is its points, discounted by its share of link text; an article element counts a
quarter more.  The container of the best score is kept, and on the way up from it, to an article, main or body, every
sibling that isn't mostly links; an article beside it needs a fifth of its score.  Beside a best article, other articles
with that score stay and nothing else.

What the page marks as menu, header, footer, sidebar, notice, advert, form or comment (by element, class, id or role) is left
out first, unless it wraps the page's text: nothing that holds main, an article with more points than lie outside all
marks, or ten times as many points as lie outside.  A name of which only a part is such a word ("acme-comments") is a hint: what
it marks goes if it has less than a quarter of the points outside.  Paragraphs and headings are never left out for a name
alone, only if they are mostly links.  Hidden elements go.

Time is linear in the page: tags that are never closed, end tags without a start and deep nesting cost no more than others.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements whose content is raw text up to their end tag, and no text of the page.
RAW = "script style title textarea iframe noscript".split()
#: Other elements without text of the page.
SILENT = frozenset("head template svg select canvas object audio video".split())
#: Elements that belong to the page and not to its article.
ASIDE = frozenset("nav footer aside form header menu dialog button fieldset".split())
BLOCKS = frozenset(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption"
    " blockquote pre figure figcaption address hr details summary center nav footer aside form header dialog fieldset".split()
)
#: Blocks that hold other blocks; the points of all others go to the nearest of these.
CONTAINERS = frozenset("html body main article section div td blockquote ul ol dl table tbody center details form header footer aside nav fieldset figure".split())
#: Share of the best score that an article beside it needs.
LEVEL = 0.2
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Start tags that end an open element of these names.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("td", "th", "tr"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPES = frozenset("ul ol dl table div article section main body html td th".split())
#: Words in class, id or role that mark what is no article text.
ASIDE_WORDS = frozenset(
    "ad ads advert advertisement adverts sponsor sponsored promo promotion banner sidebar menu nav navbar navigation footer header masthead comment comments commentlist"
    " discussion replies respond cookie cookies consent notice notification alert popup modal overlay share sharing social related recommended breadcrumb breadcrumbs newsletter"
    " subscribe signup login pagination pager toolbar widget search skip feedback".split()
)
#: Of these, the words that hint at such a part also inside a longer name.
HINT_WORDS = frozenset(
    "advert advertisement sponsor sponsored sidebar menu nav navbar navigation footer comment comments commentlist discussion replies respond feedback cookie cookies consent"
    " breadcrumb breadcrumbs newsletter subscribe pagination".split()
)
#: Elements that are an article's own text whatever their names say.
TEXT = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
_TOKENS = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?:" + "|".join(RAW) + r")(?:\s[^<>]*)?/>|<(" + "|".join(RAW) + r")(?=[\s/>]).*?(?:</\1\s*>|\Z)|</([a-z][^\s<>/]*)[^<>]*>"
    r"|<([a-z][^\s<>/]*)((?:[^<>\"']++|\"[^\"]*\"|'[^']*')*+)>|<[!?][^<>]*>",
    re.I | re.S,
)
_CLOSED = re.compile(r"(?:^|[\s\"'])/$")
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
#: Words that may stand beside them in a hyphenated name: "site-header" marks a header, "with-sidebar" marks nothing.
PLACE_WORDS = frozenset("site page main top bottom left right upper lower list box bar area block container wrapper inner outer slot section item items group links link text primary secondary global sticky reader readers user users visitor visitors".split())
_WORD = re.compile(r"[a-z]+")
_QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
_HIDDEN = re.compile(r"(?<![\w-])hidden(?![\w-])", re.I)
_STYLE = re.compile(r"\bstyle\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_UNSEEN = re.compile(r"(?:^|[;\"'\s])(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)
NO, HINT, YES = 0, 1, 2


class Node:
    __slots__ = ("name", "parent", "children", "silent", "marked", "own", "passed", "chars", "linked")

    def __init__(self, name: str, parent: Node | None, silent: bool, marked: int = NO):
        self.name, self.parent, self.silent, self.marked = name, parent, silent, marked
        self.children: list[Node | str] = []
        self.own = self.passed = 0.0
        self.chars = self.linked = 0

    def score(self) -> float:
        bonus = 1.25 if self.name == "article" else 1.0
        return bonus * (self.own + self.passed) * (1 - self.linked / self.chars) if self.chars else 0.0

    def link_list(self) -> bool:
        return 2 * self.linked > self.chars


def _known(word: str) -> tuple[bool, bool]:
    """Whether a word of a name is one of the lists' words or two of them in one, and whether one of them marks."""
    if word in ASIDE_WORDS:
        return True, True
    if word in PLACE_WORDS or len(word) <= 2:  # a prefix of one or two letters says nothing
        return True, False
    for k in range(3, len(word) - 1):
        first, second = word[:k], word[k:]
        if first in PLACE_WORDS and second in ASIDE_WORDS or first in ASIDE_WORDS and second in PLACE_WORDS:
            return True, True
    return False, False


def _marked(name: str, attributes: str) -> int:
    if name in ("html", "body", "article", "main"):
        return NO
    found = NO
    for m in _NAMES.finditer(attributes):
        for one in m[1].lower().split():
            words = _WORD.findall(one)
            known = [_known(w) for w in words]
            if any(marks for _, marks in known):
                if all(there for there, _ in known):
                    return YES
                found = HINT if any(w in HINT_WORDS for w in words) else found
    return found


def _hidden(name: str, attributes: str) -> bool:
    if not attributes or name in ("html", "body", "article", "main"):
        return False
    style = _STYLE.search(attributes)
    return bool(_HIDDEN.search(_QUOTED.sub("", attributes)) or style and _UNSEEN.search(style[1]))


def parse(html: str) -> list[Node]:
    """The elements of a page, parents before children, the root first; unclosed, unopened and crossed tags are tolerated."""
    root = node = Node("html", None, False)
    nodes, articles = [root], 0
    opened: Counter[str] = Counter()

    def close(names: tuple[str, ...], scopes: frozenset[str]) -> None:
        nonlocal node, articles
        if not any(opened[name] for name in names):
            return  # nothing to look for
        at = node
        while at is not root and at.name not in names:
            if at.name in scopes:
                return
            at = at.parent
        if at is not root:
            while node is not at.parent:
                articles -= node.name in ("article", "main")
                opened[node.name] -= 1
                node = node.parent

    place = 0
    for m in _TOKENS.finditer(html):
        if m.start() > place:
            node.children.append(html[place:m.start()])
        place = m.end()
        if m[3]:
            name, closed = m[3].lower(), _CLOSED.search(m[4])
            if name in VOID:
                if name in ("br", "hr"):
                    node.children.append("\n" if name == "br" else Node(name, node, False))
                continue
            if name in BLOCKS:
                close(("p",), _SCOPES)
            if name in CLOSES:
                close(CLOSES[name], _SCOPES - set(CLOSES[name]))
            # an article's own header has its title
            aside = name in ASIDE and not (name == "header" and articles)
            child = Node(name, node, name in SILENT or _hidden(name, m[4]), YES if aside else _marked(name, m[4]))
            node.children.append(child)
            nodes.append(child)
            if not closed or name in BLOCKS:
                node = child
                opened[name] += 1
                articles += name in ("article", "main")
        elif m[2]:
            close((m[2].lower(),), frozenset())
    if place < len(html):
        node.children.append(html[place:])
    return nodes


def _blocks(top: Node) -> Iterator[tuple[Node, str, int]]:
    """Innermost block element, text and link characters of each block of text below a node, in page order."""
    own: list[str] = []
    linked = 0
    holder = top

    def flush() -> Iterator[tuple[Node, str, int]]:
        nonlocal linked
        text = " ".join(unescape("".join(own)).split())
        if text:
            yield holder, text, min(linked, len(text))
        own.clear()
        linked = 0

    stack: list[tuple[Node, int, bool, Node]] = [(top, 0, False, top)]
    while stack:
        node, at, in_link, block = stack.pop()
        if at == 0 and node.name in BLOCKS:
            yield from flush()
        holder = block
        while at < len(node.children):
            child = node.children[at]
            at += 1
            if isinstance(child, str):
                own.append(child)
                if in_link:
                    linked += len(child)
            elif not child.silent:
                stack.append((node, at, in_link, block))
                stack.append((child, 0, in_link or child.name == "a", child if child.name in BLOCKS else block))
                break
            elif child.name in BLOCKS:
                yield from flush()
        else:
            if node.name in BLOCKS:
                yield from flush()
    yield from flush()


def points(text: str, linked: int) -> float:
    """What a block of text is worth: one, its commas, its length up to three hundred characters, less its share of links."""
    return (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - linked / len(text))


def _spare_text(nodes: list[Node], found: list[tuple[Node, str, int]]) -> None:
    """Take the marks from paragraphs and headings that aren't mostly links."""
    if not any(n.marked and n.name in TEXT for n in nodes):
        return
    for holder, text, linked in found:
        holder.chars += len(text)
        holder.linked += linked
    for node in nodes:
        if node.name in TEXT and not node.link_list():
            node.marked = NO
        node.chars = node.linked = 0


def _drop_marked(nodes: list[Node], found: list[tuple[Node, str, int]]) -> None:
    """Silence the marked elements, but not those that wrap the page's text."""
    root = nodes[0]
    # nearest mark of every element, and whether an article lies between
    mark: dict[Node, Node] = {root: root}
    article: dict[Node, bool] = {root: False}
    for node in nodes[1:]:
        mark[node] = node if node.marked else mark[node.parent]
        article[node] = not node.marked and (node.name == "article" or article[node.parent])
    own: dict[Node, float] = {}
    in_article: dict[Node, float] = {}
    for holder, text, linked in found:
        worth, at = points(text, linked), mark[holder]
        own[at] = own.get(at, 0.0) + worth
        if article[holder]:
            in_article[at] = in_article.get(at, 0.0) + worth
    inside, mains = dict(own), set()
    for node in reversed(nodes):
        if node.name == "main" or node in mains:
            mains.add(node.parent)
        if node.marked:
            above = mark[node.parent]
            inside[above] = inside.get(above, 0.0) + inside.get(node, 0.0)
            held = inside.get(node, 0.0) if article[node.parent] else in_article.get(node, 0.0)
            in_article[above] = in_article.get(above, 0.0) + held
    # an outer wrapper is opened before what it holds is judged
    outside = own.get(root, 0.0)
    for node in nodes:
        if node.marked and not mark[node.parent].silent:
            held = inside.get(node, 0.0)
            if node in mains or in_article.get(node, 0.0) > outside or (held > 10 * outside if node.marked == YES else 4 * held >= outside):
                outside += own.get(node, 0.0)
            else:
                node.silent = True
        elif node.marked:
            node.silent = True


def main_text(html: str | None) -> str:
    """Blocks of the article joined by two newlines; empty if the page has none."""
    if not html:
        return ""
    nodes = parse(html)
    found = list(_blocks(nodes[0]))
    _spare_text(nodes, found)
    _drop_marked(nodes, found)
    best = best_container(nodes)
    if best is None:
        return ""
    return "\n\n".join(text for _, text, _ in _chosen(best))


def best_container(nodes: list[Node]) -> Node | None:
    """The container of the best score; fills in points, characters and link characters of all elements."""
    for holder, text, linked in _blocks(nodes[0]):
        node = holder
        while node.name not in CONTAINERS and node.parent is not None:
            node = node.parent
        holder.chars += len(text)
        holder.linked += linked
        node.own += points(text, linked)
    for node in reversed(nodes):  # half of its own points to a parent, two thirds of what has come up to it
        above = node.parent
        if above is not None:
            above.passed += node.own / 2 + node.passed * 2 / 3
            above.chars += node.chars
            above.linked += node.linked
    return max((n for n in nodes if n.chars and n.name in CONTAINERS), key=Node.score, default=None)


def _chosen(best: Node) -> Iterator[tuple[Node, str, int]]:
    """The blocks of the best container and of what belongs to it around it."""
    top = best
    if best.name in ("main", "body", "html"):
        for child in best.children:
            if isinstance(child, Node) and child.name in CONTAINERS:
                child.silent = child.silent or child.link_list()
    while top.name not in ("article", "main", "body", "html") and top.parent is not None:
        for child in top.parent.children:
            if isinstance(child, Node) and child is not top and child.name in BLOCKS:
                teaser = child.name == "article" and child.score() < LEVEL * top.score()
                child.silent = child.silent or child.link_list() or teaser
        top = top.parent
    if top.name != "article":
        yield from _blocks(top)
        return
    for child in top.parent.children:
        if child is top or isinstance(child, Node) and child.name == "article" and not child.silent and child.score() >= LEVEL * top.score():
            yield from _blocks(child)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, 500):
            part = batch.slice(a, 500)
            texts = [main_text(h) for h in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row: page_id, url, text, n_chars (code points).

    White space inside a block becomes one space, character references are decoded, blocks are joined by two newlines.
    Null, empty and text-free pages have an empty text.  Nothing is cut, however long.  Repeated rows get equal texts, null
    ids and urls are kept, an empty table gives no rows, other columns are ignored.
    """
    chosen = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return chosen.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
