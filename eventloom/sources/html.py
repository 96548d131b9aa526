"""Page parsers: links, images, listing cards, calendars, folder views and feeds, as table functions over pages."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin, urlparse

import pandas as pd
from pyspark.sql import DataFrame

from ..functions import fixed

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


class Node:
    """An element, with its children in order (texts are strings)."""

    def __init__(self, name: str, attrs: dict[str, str], parent: Node | None) -> None:
        self.name, self.attrs, self.parent = name, attrs, parent
        self.children: list[Node | str] = []

    def walk(self) -> Iterator[Node]:
        """Elements below this one in document order."""
        todo = list(reversed([c for c in self.children if isinstance(c, Node)]))
        while todo:
            n = todo.pop()
            yield n
            todo += reversed([c for c in n.children if isinstance(c, Node)])

    def texts(self) -> Iterator[str]:
        todo: list[Node | str] = list(reversed(self.children))
        while todo:
            c = todo.pop()
            if isinstance(c, str):
                yield c
            else:
                todo += reversed(c.children)

    def text(self, between: str = "") -> str:
        """Stripped texts, joined."""
        return between.join(t for t in (x.strip() for x in self.texts()) if t)

    def first(self, rule: Callable[[Node], bool]) -> Node | None:
        return next((n for n in self.walk() if rule(n)), None)

    def all(self, rule: Callable[[Node], bool]) -> list[Node]:
        return [n for n in self.walk() if rule(n)]

    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag: str) -> None:
        n: Node | None = self.at
        while n is not None and n.name != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.at = n.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str) -> Node:
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


def has_class(pattern: str) -> Callable[[Node], bool]:
    """Whether a class, or all of them together, match a pattern whatever the case."""
    p = re.compile(pattern, re.I)
    return lambda n: "class" in n.attrs and (any(p.search(c) for c in n.classes()) or bool(p.search(n.attrs["class"])))


def aid(value: str) -> Callable[[Node], bool]:
    return lambda n: n.attrs.get("data-aid") == value


def address(base: str, href: str) -> str | None:
    """href on a page at base; None for one that is no address."""
    try:
        return urljoin(base, href)
    except ValueError:
        return None


def suffix(url: str | None) -> str:
    try:
        path = urlparse(url or "").path
    except ValueError:
        return ""
    last = path.rstrip("/").rpartition("/")[2]
    stem, dot, end = last.rpartition(".")
    return f".{end.lower()}" if dot and stem and end else ""


def links(url: str, html: str) -> Iterator[dict]:
    """Anchors with an address: ord, href (absolute; None if it is no address), text."""
    for n, a in enumerate(x for x in parse(html).walk() if x.name == "a" and "href" in x.attrs):
        yield {"ord": n, "href": address(url, a.attrs["href"]), "text": a.text()}


def images(url: str, html: str, least: int = fixed.MIN_IMAGE_SIDE, flyer_links: bool = False) -> Iterator[dict]:
    """Images of a page: ord, href. Those whose known sides are too small, or of other kinds, are left out.

    flyer_links adds anchors that lead to an image and speak of a flyer.
    """
    out, root = [], parse(html)
    for n in root.walk():
        if n.name == "img":
            src = n.attrs.get("src") or n.attrs.get("data-src") or n.attrs.get("data-lazy-src")
            if not src or suffix(address(url, src)) not in fixed.CRAWL_IMAGES:
                continue
            try:
                sides = [int(n.attrs.get(k, 0)) for k in ("width", "height")]
                if all(sides) and min(sides) < least:
                    continue
            except ValueError:
                pass
            out.append(address(url, src))
    if flyer_links:
        for n in root.walk():
            if n.name == "a" and "href" in n.attrs:
                href = address(url, n.attrs["href"])
                if href and suffix(href) in fixed.CRAWL_IMAGES and "flyer" in (href + "".join(n.texts())).lower():
                    out.append(href)
    return ({"ord": k, "href": h} for k, h in enumerate(out))


def cards(url: str, html: str, *, source: str, select: tuple[str, ...] = (), fallback: str = "event|listing|card", fields: dict[str, str] | None = None) -> Iterator[dict]:
    """Listing cards: ord, title, a text for each of fields (name -> class pattern), source_url, source.

    select holds tag names and .classes; where none matches, classes like fallback are cards.
    """
    root = parse(html)
    chosen = root.all(lambda n: any(s[1:] in n.classes() if s[0] == "." else n.name == s for s in select)) if select else []
    for k, card in enumerate(chosen or root.all(has_class(fallback))):
        head = card.first(lambda n: n.name in ("h2", "h3", "h4", "a"))
        link = card.first(lambda n: n.name == "a" and "href" in n.attrs)
        found = {f: card.first(has_class(p)) for f, p in (fields or {}).items()}
        yield {"ord": k, "title": head.text() if head else "", **{f: n.text() if n else None for f, n in found.items()}, "source_url": address(url, link.attrs["href"]) if link else url, "source": source}


#: Card pages by strategy.
CARD_PAGES = {
    "racingjunk": {"source": "RacingJunk", "select": (".event-listing", ".event-card", "article", ".listing-item"), "fallback": "event|listing|card", "fields": {"date_text": "date|time", "location_text": "location|venue|city"}},
    "myracepass": {"source": "MyRacePass", "fallback": "event|card|listing|schedule", "fields": {"date_text": "date|time", "event_type_text": "type|category|kind"}},
}


def calendar(url: str, html: str) -> Iterator[dict]:
    """Cards of a calendar page: ord, title, date_text, time_text, location_text, description. Wide ones if there are any, else narrow ones."""
    root = parse(html)
    found = root.all(aid(fixed.CALENDAR_WIDE)) or root.all(aid(fixed.CALENDAR_NARROW))
    for k, card in enumerate(found):
        part = {f: card.first(aid(name)) for f, name in fixed.CALENDAR_PARTS.items()}
        if not part["day"] or not part["title"]:
            continue
        title, day = part["title"].text(" "), part["day"].text(" ")
        if not title or not day or any(w in title.strip().lower() for w in fixed.OUT_OF_SCOPE):
            continue
        time, place = part["time"], None
        times: list[str] = []
        if time:
            times = [t for t in (n.text(" ") for n in time.all(lambda n: n.name == "h4")) if t]
            inline = time.first(lambda n: n.name == "p")
            if inline:
                place = inline.text(" ") or None
            elif time.parent:
                after = time.parent.children[time.parent.children.index(time) + 1 :]
                p = next((n for n in after if isinstance(n, Node) and n.name == "p"), None)
                place = (p.text(" ") or None) if p else None
        at = f"{times[0]} - {times[2]}" if len(times) >= 3 and times[1] == "-" else " ".join(times) or None
        yield {"ord": k, "title": title, "date_text": day, "time_text": at, "location_text": place, "description": part["text"].text("\n") if part["text"] else None}


def folder(url: str, html: str) -> Iterator[dict]:
    """Entries of a shared folder's page: ord, file_id, title, view_url."""
    k = 0
    for entry in parse(html).all(lambda n: "flip-entry" in n.classes()):
        link, title = entry.first(lambda n: n.name == "a" and "href" in n.attrs), entry.first(lambda n: "flip-entry-title" in n.classes())
        name = entry.attrs.get("id", "")
        if name.startswith("entry-") and len(name) > 6 and link and title:
            yield {"ord": k, "file_id": name[6:], "title": title.text(), "view_url": link.attrs["href"]}
            k += 1


def feed(url: str, xml: str) -> Iterator[dict]:
    """Items of an RSS or Atom feed: ord, title, published, summary, source_url. A text that is no XML has none."""
    try:
        root = ET.fromstring(xml or "")
    except ET.ParseError:
        return
    local = lambda e: e.tag.rpartition("}")[2]
    for k, item in enumerate(e for e in root.iter() if local(e) in ("item", "entry")):
        part: dict[str, str] = {}
        for e in item:
            part.setdefault(local(e), (e.text or "").strip() or e.attrib.get("href", ""))
        yield {"ord": k, "title": part.get("title", ""), "published": part.get("pubDate", part.get("published", "")), "summary": part.get("description", part.get("summary", "")), "source_url": part.get("link", "")}


#: Columns that each parser gives, after the page's url.
COLUMNS = {
    "links": "ord int, href string, text string",
    "images": "ord int, href string",
    "calendar": "ord int, title string, date_text string, time_text string, location_text string, description string",
    "folder": "ord int, file_id string, title string, view_url string",
    "feed": "ord int, title string, published string, summary string, source_url string",
}


def parse_pages(pages: DataFrame, parser: Callable[[str, str], Iterator[dict]], columns: str, *, url: str = "url", html: str = "html") -> DataFrame:
    """url and the columns of what a parser finds in each page; null pages hold nothing. No shuffle."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["url", *[c.split()[0] for c in columns.split(", ")]]
        for f in frames:
            rows = [{"url": u, **r} for u, h in zip(f[url], f[html]) if h is not None for r in parser(u or "", h)]
            yield pd.DataFrame(rows, columns=names)

    return pages.select(url, html).mapInPandas(run, f"url string, {columns}")
