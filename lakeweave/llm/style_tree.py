"""Main text of web pages by a site style tree.

The pages of a host are merged by the paths of their elements (tag, and class or
id without digits).  For every path of a host the tree knows on how many pages it
stands, with which child styles (presentation) and which text features (content).
Both get an importance from their entropy over the pages: what is spread evenly over
the pages of a site, as menus and notices are, tells little.  A branch is removed
from each page when its importance is low.

A page of few or of one on its host has no entropy to go by, and reader comments are
new on every page, so names and structure decide besides: furniture tags; names that say what a
branch is (``STRONG``: adverts, comments, cookie notices, menus ..), unless it holds an article, a main element or a first
heading; vague names (``WEAK``), when the branch's importance is low for ``NAMED`` times the threshold or most of its text is links.
Names inside words of state (``with-sidebar``, ``no-ads``) say nothing, nor do header names inside an article; a
notice or a footer inside an article is a vague name.

Which part of the rest is the article the text decides: article and main elements that hold at least half as much text as stands
outside them are the article; when they hold less than a quarter they are teasers, and the outside is it; between, both stay.

importance(E) = (1 - g**l) * presentation(E) + g**l * content(E), with l child styles of
E, content as the mean over the text features below E of 1 - H(feature), and H in
logarithms of the number of pages.  A host with few pages says little, so its
importance is mixed with that of the same path on all hosts by m / (m + PRIOR).
Pages with equal articles count once, so copies don't make an article look like a menu.

Defined cases: null and empty html has the empty text; null urls form one host; repeated
rows give repeated rows; of equal articles the page with the smallest page_id counts; an empty table has no rows;
pages take time in proportion to their length, elements nested deeper than ``DEPTH`` belong to the tree node of their ancestor there
(their text is read like any other); other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import column, sized, stored, table, tuned
from .words import pieces

THRESHOLD = 0.3
GAMMA = 0.9
#: The importance of a branch with a telling name counts this many times less.
NAMED = 2
#: Levels of the style tree.
DEPTH = 64
ROOT_NODE = 0
#: Pages at which a host's own statistics weigh as much as those of all hosts.
PRIOR = 20
#: Pages on which a path must stand before its entropy can remove it.
LEAST_PAGES = 8

# Tags and names of page furniture, tags that end a block, tags without content.
FURNITURE = frozenset("nav footer aside form header menu dialog button select option input textarea label iframe object embed svg canvas map".split())
SILENT = frozenset("head script style noscript template title".split())
RAW = frozenset("script style textarea title noscript template xmp iframe".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul title script style noscript template textarea button iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ROOT = frozenset("article main".split())
# Names that say what a branch is, and names that may mean anything.
STRONG = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo promos promotion outbrain taboola "
    "nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars footer cookie cookies consent gdpr notice notices popup modal newsletter subscribe subscription "
    "comment comments commentlist commentform disqus respond replies reply share sharing social related recommended recommendations teaser teasers pagination pager login signup copyright disclaimer banner masthead".split())
WEAK = frozenset("side header search skip toolbar widget widgets card cards preview meta tags".split())
#: Words of state before a name: the element has it or not, it isn't it.
STATE = frozenset("with has have no not without is hide hides show shows hidden toggle".split())
HEADERS = frozenset("header masthead banner".split())
#: Inside an article these may name a part of it.
VAGUE_INSIDE = frozenset("notice notices footer sidebar sidebars menu menus disclaimer copyright reply".split())
_TAG = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([A-Za-z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*(?:>|$)|[^>]*(?:>|$))", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|$)", re.I) for tag in RAW}
#: What a start tag ends: elements of a kind, up to the nearest of the bounds.
_ENDS = {
    "li": (("li", ("ul", "ol", "menu")),), "dt": (("dt", ("dl",)), ("dd", ("dl",))), "dd": (("dd", ("dl",)), ("dt", ("dl",))), "tr": (("tr", ("table",)),),
    "td": (("td", ("tr", "table")), ("th", ("tr", "table"))), "th": (("th", ("tr", "table")), ("td", ("tr", "table"))), "option": (("option", ("select",)),)}
_WORDS = re.compile(r"[\W_]+")
_PIECE = re.compile(r"[|·•»›–—]")
_SPACE = re.compile(r"\s+")


def named(classes: str, article: bool) -> int:
    """2: the words of a class, id or role say what the element is; 1: they may; 0: they don't."""
    found = 0
    for token in classes.lower().split():
        words = [w for w in _WORDS.split(token) if w]
        if not words or words[0] in STATE or len(words) > 1 and words[-2] in STATE:
            continue
        for w in {words[0], words[-1]}:
            if not (article and w in HEADERS):
                found = max(found, 1 if w in WEAK or article and w in VAGUE_INSIDE else 2 if w in STRONG else 0)
    return found


class Page:
    """A page's blocks and what the tree needs of its elements; every step costs the same however deep it stands.

    elements: [tree node, parent, furniture or hidden, name (0 to 2), letters, letters in links, holds the main part]
    blocks: (element, text, outermost article element or -1)
    children: the child styles of every tree node
    """

    def __init__(self, html: str):
        self.elements: list[list] = [[ROOT_NODE, -1, False, 0, 0, 0, False]]
        self.blocks: list[tuple[int, str, int]] = []
        self.children: dict[int, dict[str, None]] = {ROOT_NODE: {}}
        self._around: dict[int, int] = {}
        self._stack: list[tuple[str, int]] = [("", 0)]  # open block elements
        self._open_tags: Counter = Counter()
        self._text: list[str] = []
        self._articles: list[int] = []
        self._silent = 0
        self._link = False
        self._links = 0
        at, n = 0, len(html)
        while at < n:
            m = _TAG.search(html, at)
            if m is None:
                self._text.append(html[at:])
                break
            if m.start() > at:
                self._text.append(html[at:m.start()])
                if self._link:
                    self._links += len("".join(unescape(html[at:m.start()]).split()))
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            attributes = m[3].removesuffix(">")
            if tag == "a":
                self._link = not m[1]
            if m[1]:
                self._close(tag)
                continue
            self._open(tag, attributes)
            if tag in RAW and not attributes.endswith("/"):
                end = _RAW_END[tag].search(html, at)
                self._text.append(html[at:end.start() if end else n])
                at = end.start() if end else n
        self._block()
        while len(self._stack) > 1:
            self._pop()

    def _block(self) -> None:
        """Ends the block at hand."""
        if self._text:
            if not self._silent and (text := _SPACE.sub(" ", unescape("".join(self._text))).strip()):
                k = self._stack[-1][1]
                letters = len(text) - text.count(" ")
                self.blocks.append((k, text, self._articles[0] if self._articles else -1))
                self.elements[k][4] += letters
                self.elements[k][5] += min(letters, self._links)
            self._text.clear()
        self._links = 0

    def _push(self, tag: str, style: str, noise: bool, name: int) -> None:
        k, above = len(self.elements), self._stack[-1][1]
        at = self.elements[above][0]
        self.children[at][style] = None
        if len(self._stack) <= DEPTH:
            at = xxhash.xxh3_64_intdigest(at.to_bytes(8, "little", signed=True) + style.encode("utf-8", "surrogatepass")) - (1 << 63)
            self.children.setdefault(at, {})
            self._around[at] = self.elements[above][0]
        self.elements.append([at, above, noise, name, 0, 0, False])
        self._stack.append((tag, k))
        self._open_tags[tag] += 1
        if tag in ROOT:
            self._articles.append(k)
        # a first heading outside any article marks the main part as well; a teaser or a comment is no main part
        if tag in ROOT and name < 2 and not noise or tag == "h1":
            self.elements[above][6] = True
        self._silent += tag in SILENT

    def _pop(self) -> str:
        tag, k = self._stack.pop()
        self._open_tags[tag] -= 1
        _, above, _, _, letters, links, main = self.elements[k]
        self.elements[above][4] += letters
        self.elements[above][5] += links
        self.elements[above][6] |= main
        if tag in ROOT:
            self._articles.pop()
        self._silent -= tag in SILENT
        return tag

    def _open(self, tag: str, attributes: str) -> None:
        if tag not in BLOCK:
            if tag == "br" or tag == "img":
                self._text.append(" ")
            return
        self._block()
        if tag == "hr":
            return
        # a paragraph, an item or a cell ends where the next block of its kind begins
        if self._open_tags["p"]:
            self._until("p")
        for kind, bounds in _ENDS.get(tag, ()):
            if self._open_tags[kind]:
                for t, _ in reversed(self._stack):
                    if t in bounds:
                        break
                    if t == kind:
                        self._until(kind)
                        break
        names, hidden = [], False
        if attributes:
            for key, value in _ATTRIBUTE.findall(attributes):
                if key.lower() == "hidden":
                    hidden = True
                else:
                    names.append(value.strip("\"'").lower())
        style = ".".join([tag, *sorted(re.sub(r"\d+", "#", x) for x in names)])
        inside = bool(self._articles)
        noise = hidden or tag in FURNITURE and not (tag == "header" and inside)
        plain = tag in ("html", "body", "main")
        self._push(tag, style, noise, 0 if plain else named(" ".join(names), inside))

    def _until(self, tag: str) -> None:
        while len(self._stack) > 1 and self._pop() != tag:
            pass

    def _close(self, tag: str) -> None:
        if tag in BLOCK:
            self._block()
            if self._open_tags[tag]:
                self._until(tag)

    def _main(self, gone: list[bool]) -> list[tuple[int, str, int]]:
        """The blocks of the article among those that are not gone; the text decides which part that is."""
        left = [b for b in self.blocks if not gone[b[0]]]
        size: Counter = Counter()
        for _, text, article in left:
            size[article] += len(text) - text.count(" ")
        outside = size.pop(-1, 0)
        best = max(size.values(), default=0)
        if best and 2 * best >= outside:
            return [b for b in left if b[2] >= 0]
        return [b for b in left if b[2] < 0] if 4 * best < outside else left

    def _gone(self, low: frozenset[int] = frozenset(), named_low: frozenset[int] = frozenset(), names: bool = True) -> list[bool]:
        gone: list[bool] = []
        for at, above, noise, name, letters, links, main in self.elements:
            by_name = names and name and not main and (name == 2 or 2 * links > letters or at in named_low)
            gone.append(above >= 0 and (gone[above] or noise or at in low or by_name))
        return gone

    def unnamed(self) -> list[tuple[int, str]]:
        """(tree node, text) of the blocks that neither tag nor name calls page furniture (all that no tag does, if there are none)."""
        own = self._main(self._gone()) or self._main(self._gone(names=False))
        return [(self.elements[k][0], text) for k, text, _ in own]

    def content(self, low: frozenset[int] = frozenset(), named_low: frozenset[int] = frozenset()) -> list[str]:
        """The main text: without furniture, the nodes in ``low`` and named branches."""
        return [text for _, text, _ in self._main(self._gone(low, named_low))]

    def above(self, at: int) -> list[int]:
        """A tree node and those around it, at most DEPTH."""
        out = []
        while at != ROOT_NODE:
            out.append(at)
            at = self._around[at]
        return out


def _describe():
    """Per page: its host's tree nodes, with child styles, and the text features of its blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, "html"):
                digests, nodes, features = [], [], []
                for html in texts.to_pylist():
                    page = Page(html)
                    digest = xxhash.xxh3_64()
                    for at, text in page.unnamed():
                        digest.update(f"{at}\n{text}\n")
                    digests.append(digest.intdigest() - (1 << 63))
                    nodes.append([{"node": at, "style": xxhash.xxh3_64_intdigest("/".join(styles)) - (1 << 63)} for at, styles in page.children.items()])
                    count: dict[tuple[int, str], int] = {}
                    for k, text, _ in page.blocks:
                        at = page.elements[k][0]
                        for piece in _PIECE.split(text.lower()):
                            key = (at, piece.strip())
                            count[key] = count.get(key, 0) + 1
                    around = {at: page.above(at) for at, _ in count}
                    features.append([{"above": around[at], "feature": xxhash.xxh3_64_intdigest(piece) - (1 << 63), "n": n} for (at, piece), n in count.items()])
                yield pa.RecordBatch.from_arrays([
                    column(part, "page_id"), column(part, "host"), pa.array(digests, pa.int64()),
                    pa.array(nodes, pa.list_(pa.struct([("node", pa.int64()), ("style", pa.int64())]))),
                    pa.array(features, pa.list_(pa.struct([("above", pa.list_(pa.int64())), ("feature", pa.int64()), ("n", pa.int64())])))],
                    names=["page_id", "host", "digest", "nodes", "features"])
    return run


def _importance(per: DataFrame, pages: DataFrame, keys: list[str], gamma: float) -> DataFrame:
    """(keys, node, m, importance) from features (keys, leaf, above, feature, pages p, total t, sum of c log c) and styles."""
    features, styles = per, pages
    over = lambda total, weighted: F.log(total) - weighted / total  # noqa: E731  entropy of a spread, in natural logarithms
    m = styles.groupBy(*keys, "node").agg(F.sum("p").alias("m"), F.count(F.lit(1)).alias("l"), F.sum(F.col("p") * F.log("p")).alias("w"))
    shown = m.withColumn("presentation", F.when(F.col("m") > 1, over(F.col("m"), F.col("w")) / F.log("m")).otherwise(1.0))
    below = features.withColumn("node", F.explode("above")).groupBy(*keys, "node", "feature").agg(F.sum("t").alias("t"), F.sum("w").alias("w"))
    spread = below.join(shown.select(*keys, "node", "m"), [*keys, "node"]).withColumn(
        "h", F.when(F.col("m") > 1, F.least(F.lit(1.0), F.greatest(F.lit(0.0), over(F.col("t"), F.col("w")) / F.log("m")))).otherwise(0.0))
    content = spread.groupBy(*keys, "node").agg(F.avg(1 - F.col("h")).alias("content"))
    share = F.pow(F.lit(gamma), F.col("l"))
    return shown.join(content, [*keys, "node"]).select(*keys, "node", "m", ((1 - share) * F.col("presentation") + share * F.col("content")).alias("importance"))


def branches(pages: DataFrame, gamma: float = GAMMA) -> DataFrame:
    """(host, node, m, importance): the style tree of every host, mixed with that of all hosts."""
    tuned(pages.sparkSession)
    described = stored(_hosted(pages).mapInArrow(_describe(), (
        "page_id long, host string, digest long, nodes array<struct<node: long, style: long>>, features array<struct<above: array<long>, feature: long, n: long>>")), "pages")
    once = described.groupBy("host", "digest").agg(F.min_by(F.struct("nodes", "features"), F.struct("page_id", F.xxhash64("nodes", "features"))).alias("p")).select("host", "p.*")
    once = stored(once, "once")
    features = once.select("host", F.explode("features").alias("f")).select("host", "f.*").groupBy("host", "above", "feature").agg(
        F.sum("n").alias("t"), F.sum(F.col("n") * F.log("n")).alias("w"))
    styles = once.select("host", F.explode("nodes").alias("x")).groupBy("host", "x.node", "x.style").agg(F.count(F.lit(1)).alias("p"))
    styles, features = stored(styles, "styles"), stored(features, "features")
    own = _importance(features, styles, ["host"], gamma)
    everywhere = _importance(
        features.groupBy("above", "feature").agg(F.sum("t").alias("t"), F.sum("w").alias("w")),
        styles.groupBy("node", "style").agg(F.sum("p").alias("p")), [], gamma)
    weight = F.col("m") / (F.col("m") + F.lit(PRIOR))
    return own.join(everywhere.select("node", F.col("importance").alias("general"), F.col("m").alias("all_m")), "node").select(
        "host", "node", F.col("all_m").alias("m"), (weight * F.col("importance") + (1 - weight) * F.col("general")).alias("importance"))


def _hosted(pages: DataFrame) -> DataFrame:
    host: Column = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("host", host)


def _extract():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, "html"):
                out = []
                for html, low, named in zip(texts.to_pylist(), column(part, "low").to_pylist(), column(part, "named").to_pylist()):
                    out.append("\n".join(Page(html).content(frozenset(low or ()), frozenset(named or ()))))
                yield pa.RecordBatch.from_arrays([
                    column(part, "page_id"), column(part, "url"), pa.array(out), pa.array([len(t) for t in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])
    return run


def main_text(pages: DataFrame, threshold: float = THRESHOLD, gamma: float = GAMMA, least_pages: int = LEAST_PAGES) -> DataFrame:
    """One row per page: page_id, url, text (blocks joined by line feeds) and n_chars."""
    tree = branches(pages, gamma)
    known = tree.where((F.col("importance") < NAMED * threshold) & (F.col("m") >= least_pages))
    low = stored(known.groupBy(F.col("host").alias("of")).agg(
        F.collect_set(F.when(F.col("importance") < threshold, F.col("node"))).alias("low"), F.collect_set("node").alias("named")), "low")
    return _hosted(pages).join(sized(low, 64, (F.size("low") + F.size("named")) * 8), F.col("host") == F.col("of"), "left").select("page_id", "url", "html", "low", "named").mapInArrow(
        _extract(), "page_id long, url string, text string, n_chars long")


def op7_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
