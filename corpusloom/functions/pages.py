"""Titles, texts and links of HTML pages, with the standard library's parser in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame

from corpusloom.session import ship_package

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
DROPPED = {"script", "style", "nav", "footer", "header"}
#: Where the text is, best first: a tag, a class or a role.
TEXT_PLACES = [("tag", "article"), ("class", "kb-article-content"), ("class", "article-content"), ("tag", "main"), ("role", "main"), ("class", "content"), ("tag", "body")]
#: Where the title is, best first.
TITLE_PLACES = ["h1.article-title", "h1[data-kb-title]", ".kb-article-title", "article h1", "h1", "title"]


class Page(HTMLParser):
    """One pass over a page: text under each place, title candidates, links, and metadata."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, list[str], list[str]]] = []
        self.text: dict[int, list[str]] = {}
        self.done: set[int] = set()
        self.titles: dict[str, str] = {}
        self.links: list[str] = []
        self.number, self.date = None, None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        a = dict(attrs)
        classes = (a.get("class") or "").split()
        if tag == "a" and a.get("href"):
            self.links.append(a["href"])
        if a.get("data-article-number") and self.number is None:
            self.number = a["data-article-number"]
        if tag in VOID:
            return
        places = [str(i) for i, (kind, what) in enumerate(TEXT_PLACES) if i not in self.text and ((kind == "tag" and tag == what) or (kind == "class" and what in classes) or (kind == "role" and a.get("role") == what))]
        for p in places:
            self.text[int(p)] = []
        heads = []
        if tag == "h1":
            heads += ["h1"] + ["h1.article-title"] * ("article-title" in classes) + ["h1[data-kb-title]"] * ("data-kb-title" in a) + ["article h1"] * any(t == "article" for t, _, _ in self.open)
        if "kb-article-title" in classes:
            heads.append(".kb-article-title")
        if tag == "title":
            heads.append("title")
        if tag == "time" or {"article-date", "updated-date"} & set(classes):
            heads.append("date")
        heads = [h for h in heads if h not in self.titles]
        for h in heads:
            self.titles[h] = ""
        self.open.append((tag, places, heads))

    def handle_endtag(self, tag: str) -> None:
        if any(t == tag for t, _, _ in self.open):
            while self.open:
                if self.open.pop()[0] == tag:
                    break

    def handle_data(self, data: str) -> None:
        dropped = any(t in DROPPED for t, _, _ in self.open)
        s = data.strip()
        for _, places, heads in self.open:
            for h in heads:
                self.titles[h] += data
            if s and not dropped:
                for p in places:
                    self.text[int(p)].append(s)


def parse(html: str, base: str) -> tuple[str, str, list[str], str | None, str | None]:
    """Title, text, distinct absolute links, number and date of a page; `Untitled Article` without a title."""
    page = Page()
    page.feed(html)
    page.close()
    title = next((t.strip() for p in TITLE_PLACES if (t := page.titles.get(p)) and t.strip()), "Untitled Article")
    text = next(("\n".join(page.text[i]) for i in range(len(TEXT_PLACES)) if i in page.text), "")
    links = [absolute(base, href) for href in page.links]
    return title, text, sorted({x for x in links if x}), page.number, (page.titles.get("date") or "").strip() or None


def absolute(base: str, href: str) -> str:
    """A link seen from its page: empty for none and for anchors, itself if absolute, else joined to the base."""
    if not href or href.startswith("#"):
        return ""
    try:
        return href if href.startswith("http") else urljoin(base, href)
    except ValueError:
        return ""


def parse_pages(pages: DataFrame) -> DataFrame:
    """(id, title, content, links, number, date) of `pages` (id, url, html); null html gives an untitled, empty page."""
    ship_package(pages.sparkSession)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [parse(h or "", u or "") for h, u in zip(b.column("html").to_pylist(), b.column("url").to_pylist())]
            cols = list(zip(*rows)) if rows else [[], [], [], [], []]
            kinds = [pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([b.column("id"), *[pa.array(list(c), k) for c, k in zip(cols, kinds)]], names=["id", "title", "content", "links", "number", "date"])

    kind = pages.schema["id"].dataType.simpleString()
    return pages.select("id", "url", "html").mapInArrow(go, f"id {kind}, title string, content string, links array<string>, number string, date string")
