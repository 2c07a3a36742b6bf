"""Typed records with arrays from list and detail pages, in one Arrow pass over a page column.

Pages are read into a light element tree (standard HTML parser, no recursion), and fields are found by walking it:
header cell -> row after it -> cells -> marked items.  A page that is no such page gives null fields
and a reason, it never ends the job.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from ..session import shuffle_partitions

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: A start tag closes these open elements, unless one of the second set lies between.
CLOSES = {"td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}), "li": ({"li"}, {"ul", "ol"}), "p": ({"p"}, {"td", "div", "article"})}


class Node:
    __slots__ = ("tag", "attrs", "parent", "children")

    def __init__(self, tag: str, attrs: dict, parent: Node | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def walk(self) -> Iterator[Node | str]:
        """Everything below, in page order."""
        stack = list(reversed(self.children))
        while stack:
            n = stack.pop()
            yield n
            if isinstance(n, Node):
                stack.extend(reversed(n.children))

    def all(self, *tags: str, cls: str | None = None) -> Iterator[Node]:
        return (n for n in self.walk() if isinstance(n, Node) and n.tag in tags and (cls is None or cls in (n.attrs.get("class") or "").split()))

    def first(self, *tags: str) -> Node | None:
        return next(self.all(*tags), None)

    def up(self, tag: str) -> Node | None:
        n = self.parent
        while n is not None and n.tag != tag:
            n = n.parent
        return n

    def next(self, tag: str) -> Node | None:
        """The next sibling element of that tag."""
        after = False
        for n in self.parent.children if self.parent else []:
            if after and isinstance(n, Node) and n.tag == tag:
                return n
            after = after or n is self
        return None

    def text(self, between: str = "") -> str:
        """All texts below, each trimmed, joined."""
        return between.join(t for n in self.walk() if isinstance(n, str) and (t := n.strip()))


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)
        self.open: Counter = Counter()      # open elements by tag: an end tag that closes none costs no walk

    def updatepos(self, i, j):
        """Lines and columns of the text are not asked for: they aren't counted."""
        return j

    def _leave(self, node: Node) -> None:
        while self.at is not node.parent:
            self.open[self.at.tag] -= 1
            self.at = self.at.parent

    def handle_starttag(self, tag, attrs):
        closing, walls = CLOSES.get(tag, ((), ()))
        if any(self.open[c] for c in closing):
            n = self.at
            while n is not None and n.tag not in walls:
                if n.tag in closing:
                    self._leave(n)
                    break
                n = n.parent
        node = Node(tag, dict(attrs), self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node
            self.open[tag] += 1

    def handle_endtag(self, tag):
        n = self.at
        while self.open[tag] and n is not None:
            if n.tag == tag:
                return self._leave(n)
            if n.tag == "table":
                return
            n = n.parent

    def handle_data(self, data):
        self.at.children.append(data)


def tree(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def distinct(values: list[str]) -> list[str]:
    return list(dict.fromkeys(v for v in values if v))


# ------------------------------------------------------------------ detail pages
HEADING = re.compile(r"#\s*(\d+)\s+(.+)")
LABEL = "Specialty"
DETAIL = "page_id long, name string, num string, specialties array<string>, ideal_habitat string, favorites array<string>, problem string"


def detail(html: str | None) -> tuple:
    """(name, num, specialties, ideal habitat, favorites, problem) of a detail page.

    The heading is `# number name`; the values stand in the row after the one with the header cell: first cell
    a table of underlined specialties (each once), second the habitat, third the favorites."""
    if html is None:
        return None, None, None, None, None, "no page"
    page = tree(html)
    h1 = page.first("h1")
    heading = HEADING.match(h1.text(" ")) if h1 else None
    if not heading:
        return None, None, None, None, None, "unexpected heading" if h1 else "no heading"
    specialties, habitat, favorites = [], "", []
    header = next((td for td in page.all("td", cls="foo") if td.text() == LABEL), None)
    row = header.up("tr").next("tr") if header and header.up("tr") else None
    cells = list(row.all("td", cls="cen"))[:3] if row else []
    if len(cells) == 3:
        specialties = distinct([u.text() for t in cells[0].all("table") for u in t.all("u")])
        first = cells[1].first("u")
        habitat = first.text() if first else ""
        favorites = [t for u in cells[2].all("u") if (t := u.text())]
    return heading[2].strip(), f"{int(heading[1]):03d}", specialties, habitat or None, favorites, None


def _pass(extract, columns: list[pa.Field]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [extract(h) for h in batch.column(1).to_pylist()]
            cells = list(zip(*rows)) if rows else [[] for _ in columns]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(list(c), f.type) for c, f in zip(cells, columns))], names=["page_id", *(f.name for f in columns)])
    return run


def spread(pages: DataFrame) -> DataFrame:
    """Pages dealt out by id: a small file of them is a long task in Python, and file splits don't tell."""
    return pages.select("page_id", "html").repartition(max(shuffle_partitions(pages.sparkSession), pages.sparkSession.sparkContext.defaultParallelism), "page_id")


def detail_records(pages: DataFrame) -> DataFrame:
    """One record per page (page_id, html): arrays are empty where the page has no such row; all fields but
    ``problem`` are null where it is no detail page."""
    text, many = pa.string(), pa.list_(pa.string())
    fields = [pa.field("name", text), pa.field("num", text), pa.field("specialties", many), pa.field("ideal_habitat", text), pa.field("favorites", many), pa.field("problem", text)]
    return spread(pages).mapInArrow(_pass(detail, fields), DETAIL)


# ------------------------------------------------------------------ list pages
SLUG = re.compile(r"^/species/([^/]+)\.shtml$")
TITLE = re.compile(r"List of Available", re.I)


def listed(html: str | None, slug: re.Pattern = SLUG) -> tuple:
    """(slugs in first-seen order, problem) of the table after the heading: link of each row's third cell."""
    found: list[str] = []
    heading = table = None
    for n in tree(html or "").walk():
        if isinstance(n, Node) and heading is None and n.tag == "h2" and TITLE.search(n.text(" ")):
            heading = n
        elif isinstance(n, Node) and heading is not None and n.tag == "table":
            table = n
            break
    if table is None:
        return [], "no list" if heading is None else "no table"
    for tr in table.all("tr"):
        cells = [c for c in tr.children if isinstance(c, Node) and c.tag == "td"]
        link = next((a for a in cells[2].all("a") if a.attrs.get("href") is not None), None) if len(cells) >= 3 else None
        if link is not None and (m := slug.match(link.attrs["href"])):
            found.append(m[1])
    return distinct(found), None


def listed_slugs(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "html").mapInArrow(_pass(listed, [pa.field("slugs", pa.list_(pa.string())), pa.field("problem", pa.string())]), "page_id long, slugs array<string>, problem string")


# ------------------------------------------------------------------ raw pages
def summary(html: str | None) -> tuple:
    """(lang, title, headings, hrefs and labels of the navigation list) of any page."""
    page = tree(html or "")
    root, title = page.first("html"), page.first("title")
    links = [a for nav in page.all("nav") for a in nav.all("a") if a.attrs.get("href") is not None]
    return ((root.attrs.get("lang") if root else None) or None, title.text() or None if title else None, [h.text() for h in page.all("h1", "h2", "h3")],
            [a.attrs["href"] for a in links], [a.text() for a in links])


def page_records(pages: DataFrame) -> DataFrame:
    text, many = pa.string(), pa.list_(pa.string())
    fields = [pa.field("lang", text), pa.field("title", text), pa.field("headings", many), pa.field("nav_hrefs", many), pa.field("nav_labels", many)]
    return pages.select("page_id", "html").mapInArrow(_pass(summary, fields), "page_id long, lang string, title string, headings array<string>, nav_hrefs array<string>, nav_labels array<string>")
