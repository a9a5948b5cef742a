"""Vectorized helpers that turn archived pages into rows: the only per-page Python of the library."""

from __future__ import annotations

from collections.abc import Iterator
from html import escape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote center content details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
ENDS = {"li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}}

EVENTS = (
    "array<struct<seq:int,kind:string,class_name:string,text:string,tables:array<array<array<string>>>,"
    "figures:array<struct<src:string,alt:string,width:string,height:string>>,refs:array<string>,raw:string>>"
)
PAGE = f"id string, has_container boolean, events {EVENTS}, notes map<string,string>, court_summary string"
CARD = "pos int, href string, case_name string, citation string, date_attribute string, date_text string, case_numbers array<string>, catchwords array<string>"


class Element:
    __slots__ = ("name", "attrs", "parent", "children")

    def __init__(self, name: str, attrs: dict[str, str], parent: Element | None):
        self.name, self.attrs, self.parent, self.children = name, attrs, parent, []

    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def walk(self) -> Iterator[Element]:
        """Elements below this one in document order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Element)]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Element))

    def text(self, join: str = " ", without: tuple[str, ...] = ()) -> str:
        """Text nodes, each stripped, empty ones dropped."""
        out, stack = [], [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                if piece := node.strip():
                    out.append(piece)
            elif node is self or node.name not in without and node.name not in ("script", "style"):
                stack.extend(reversed(node.children))
        return join.join(out)

    def markup(self) -> str:
        """HTML of this element; text and attributes escaped, so that it parses to the same tree."""
        out: list[str] = []
        stack: list[Element | str] = [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                out.append(node)
                continue
            attrs = "".join(f' {k}="{escape(v)}"' for k, v in node.attrs.items())
            if node.name in VOID:
                out.append(f"<{node.name}{attrs}/>")
                continue
            out.append(f"<{node.name}{attrs}>")
            raw = node.name in ("script", "style")
            stack.append(f"</{node.name}>")
            stack += [c if raw or isinstance(c, Element) else escape(c, quote=False) for c in reversed(node.children)]
        return "".join(out)


class Builder(HTMLParser):
    """A tolerant tree: void elements, implied ends, stray end tags ignored."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("", {}, None)

    def _end(self, names: set[str], scopes: set[str]) -> None:
        node = self.at
        while node.parent is not None and node.name not in scopes:
            if node.name in names:
                self.at = node.parent
                return
            node = node.parent

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self._end({"p"}, {"div", "table", "td", "th", "body", "section", "article"})
        while tag in ENDS:
            before = self.at
            self._end(ENDS[tag], SCOPES[tag])
            if self.at is before:
                break
        node = Element(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None:
            if node.name == tag:
                self.at = node.parent
                return
            node = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def tree(html: str | None) -> Element:
    builder = Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def _find(top: Element, **attrs: str) -> Element | None:
    return next((e for e in top.walk() if all(e.attrs.get(k) == v for k, v in attrs.items())), None)


def _kind(node: Element, prefix: str, heading: str, excluded: tuple[str, ...]) -> tuple[str | None, str | None]:
    own = [c for c in node.classes() if c.startswith(prefix)]
    for c in own:
        if c.startswith(heading):
            return "heading", c
    return next((("paragraph", c) for c in own if c not in excluded), (None, None))


def _table(node: Element) -> list[list[str]]:
    return [[c.text() for c in row.walk() if c.name in ("td", "th")] for row in node.walk() if row.name == "tr"]


def _figure(node: Element) -> dict:
    return {k: node.attrs.get(k, "") for k in ("src", "alt", "width", "height")}


def _refs(node: Element) -> list[str]:
    out: list[str] = []
    for sup in (e for e in node.walk() if e.name == "sup"):
        for link in (e for e in sup.walk() if e.name in ("a", "button")):
            target = (link.attrs.get("data-target") or link.attrs.get("href") or "").strip()
            if target.startswith("#fn") and target[1:] not in out:
                out.append(target[1:])
    return out


def page_events(html: str | None, container: str, summary: str, prefix: str, heading: str, excluded: tuple[str, ...]) -> dict:
    """H2-H5 in one pass: events below the container, footnotes, court summary, whether the container is there."""
    root = tree(html)
    top = _find(root, id=container)
    events = []
    stack = [c for c in reversed(top.children) if isinstance(c, Element)] if top else []
    while stack:
        node = stack.pop()
        kind, name = _kind(node, prefix, heading, excluded)
        if kind is None and node.name not in ("table", "img"):
            stack.extend(c for c in reversed(node.children) if isinstance(c, Element))
            continue
        if kind is None:
            kind = "table" if node.name == "table" else "figure"
        inside = [node, *node.walk()] if kind in ("table", "figure") else list(node.walk())
        tables = [_table(e) for e in inside if e.name == "table"][: 1 if kind == "table" else None]
        figures = [_figure(e) for e in inside if e.name == "img"] if kind != "table" else []
        text = node.text(without=("table", "img")) if kind in ("heading", "paragraph") else ""
        events.append({"seq": len(events), "kind": kind, "class_name": name, "text": text, "tables": tables, "figures": figures, "refs": _refs(node), "raw": node.markup()})
    notes = {}
    for e in root.walk():
        if e.name == "div" and e.attrs.get("id", "").startswith("fn"):
            if text := e.text():
                notes[e.attrs["id"]] = text
    court = _find(root, id=summary)
    return {"has_container": top is not None, "events": events, "notes": notes, "court_summary": court.text() if court else ""}


def pages(archive: DataFrame, container: str = "divJudgement", summary: str = "divCaseSummary", prefix: str = "Judg-", heading: str = "Judg-Heading-", excluded: tuple[str, ...] = ("Judg-EOF",)) -> DataFrame:
    """Parsed pages (id, has_container, events, notes, court_summary) of an archive (id, html)."""

    def parse(batches):
        for pdf in batches:
            for a in range(0, len(pdf), 100):
                part = pdf.iloc[a:a + 100]
                rows = [page_events(h, container, summary, prefix, heading, excluded) for h in part["html"]]
                out = pd.DataFrame(rows, columns=["has_container", "events", "notes", "court_summary"])
                out.insert(0, "id", part["id"].to_numpy())
                yield out

    return archive.select("id", "html").mapInPandas(parse, PAGE)


def page_cards(html: str | None) -> list[dict]:
    """H1: the cards of a listing page that have a link."""
    out = []
    for card in (e for e in tree(html).walk() if e.name == "div" and {"card", "col-12"} <= set(e.classes())):
        links = [e for e in card.walk() if e.name == "a"]
        of = lambda name, links=links: [e for e in links if name in e.classes()]
        title = next(iter(of("gd-heardertext")), None)
        spans = [s for a in of("citation-num-link") for s in a.walk() if s.name == "span" and "gd-addinfo-text" in s.classes()]
        date = next(iter(of("decision-date-link")), None)
        words = [a for box in card.walk() if "gd-catchword-container" in box.classes() for a in box.walk() if a.name == "a" and "gd-cw" in a.classes()]
        out.append({
            "pos": len(out), "href": title.attrs.get("href") if title else None, "case_name": title.text("") if title else None, "citation": spans[0].text("") if spans else "",
            "date_attribute": date.attrs.get("data-searchparam", "") if date else None, "date_text": date.text() if date else None,
            "case_numbers": [a.text("") for a in of("case-num-link")], "catchwords": [a.text("") for a in words],
        })
    return out


def listing_cards(listing: DataFrame) -> DataFrame:
    """One row per card of listing pages (page, html), with the page's link to the last page: H1."""

    def parse(batches):
        for pdf in batches:
            rows = []
            for page, html in zip(pdf["page"], pdf["html"], strict=True):
                last = next((a.attrs.get("href") for li in tree(html).walk() if "PagedList-skipToLast" in li.classes() for a in li.walk() if a.name == "a"), None)
                rows += [{"page": page, "last_link": last, **card} for card in page_cards(html)]
            yield pd.DataFrame(rows, columns=["page", "last_link", *(c.split()[0] for c in CARD.split(", "))])

    return listing.select(F.col("page").cast("long").alias("page"), "html").mapInPandas(parse, f"page long, last_link string, {CARD}")
