"""Main text of pages by contract: what names, structure, text and entropy decide, and the importance by a plain computation."""

import math
import random
import time
from collections import Counter, defaultdict

import pytest

from lakeweave.llm import style_tree
from lakeweave.llm.style_tree import Page

PAGES = "page_id long, url string, html string, host string, digest string, low string"


def say(r, n):
    return " ".join(f"w{r.randrange(10**6)}" for _ in range(n))


def texts(spark, rows):
    df = spark.createDataFrame([(i, url, html, "h", "d", "l") for i, url, html in rows], PAGES).repartition(3)
    return {x["page_id"]: x["text"] for x in style_tree.main_text(df).collect()}


def test_a_teaser_is_not_the_article(spark):
    r = random.Random(1)
    rows, want = [], {}
    for i in range(60):
        a, b = say(r, 30), say(r, 40)
        side = f"<div class=side-box><article class=teaser><h3>{say(r, 4)}</h3><p>{say(r, 6)}</p></article></div>"
        plain = f"<div class=box9><article><p>{say(r, 6)}</p></article></div>"  # no name gives it away: its size does
        rows.append((i, f"http://t{i % 2}.example/{i}", f"<body><div class=content><h1>{say(r, 2)} t{i}</h1><p>{a}</p><p>{b}</p></div>{side if i % 2 else plain}</body>"))
        want[i] = f"{a}\n{b}"
    got = texts(spark, rows)
    assert {i: t.split("\n", 1)[1] for i, t in got.items()} == want


def test_comments_notices_and_adverts_with_words_of_their_own_go(spark):
    r = random.Random(2)
    rows, want = [], {}
    for i in range(61):
        a, b = say(r, 20), say(r, 30)
        notice = f"<div class='cookie-notice'>{say(r, 15)}</div>" if i < 60 else ""
        comments = "".join(f"<div class=comment><p>{say(r, 25)}</p></div>" for _ in range(5))
        rows.append((i, f"http://c.example/{i}" if i else "http://alone.example/", f"<body>{notice}<div class=post><h1>{say(r, 3)} {i}</h1><p>{a}</p><div class=advert>BUY {say(r, 3)}</div><p>{b}</p></div><div class=comments><h2>Comments</h2>{comments}</div></body>"))
        want[i] = f"{a}\n{b}"
    got = texts(spark, rows)
    assert {i: t.split("\n", 1)[1] for i, t in got.items()} == want


@pytest.mark.parametrize("html, want", [
    ("<div class='content has-sidebar no-ads'><p>kept text here</p></div><div class=sidebar><p>gone</p></div>", "kept text here"),
    ("<div id=comments-wrap><article><h1>Title</h1><p>The article stands inside</p></article></div>", "Title\nThe article stands inside"),
    ("<article><p>The body of it all</p><article class=comment><p>A reader says something</p></article></article>", "The body of it all"),
    ("<main><h1>A</h1><p>one two three</p></main><div class=commentlist><p>" + "long reader words " * 50 + "</p></div>", "A\none two three"),
    ("<div class=article-body><p>text</p></div><section id=respond><form>x</form><p>Leave a reply</p></section>", "text"),
    ("<p><a title='it\">link</a> after", "link after"),
    ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
    ("<div class=widget><p>only this</p></div>", "only this"),
    ("<article><div class=notice><p>Mind the step, says the author</p></div><p>more words of it</p></article>", "Mind the step, says the author\nmore words of it"),
])
def test_one_page_by_itself(spark, html, want):
    assert "\n".join(Page(html).content()) == want


def test_depth_and_length_cost_in_proportion():
    def spent(html):
        t = time.process_time()
        page = Page(html)
        page.content(), page.unnamed(), [page.above(page.elements[k][0]) for k, _, _ in page.blocks]
        return time.process_time() - t

    spent("<div>x" * 100)
    base = spent("<div class=ad>text" * 5000)
    assert spent("<div class=ad>text" * 20_000) < 12 * base + 0.5
    assert spent("<ul><li><p>a<td>" * 20_000 + "</table>" * 20_000) < 10
    assert spent("<a href='x>" * 3000 + "<p>" * 50_000) < 10
    assert Page("<div>text " * 5000).content() == ["text"] * 5000


def plain_importance(pages, gamma):
    """(host, node) -> (m, importance) over one host's pages, each (styles by node, features: (leaf's chain, feature) -> count)."""
    out = {}
    nodes = {n for styles, _ in pages for n in styles}
    for n in nodes:
        seen = [styles[n] for styles, _ in pages if n in styles]
        m, kinds = len(seen), Counter(seen)
        show = -sum(c / m * math.log(c / m, m) for c in kinds.values()) if m > 1 else 1.0
        counts = defaultdict(list)
        for _, features in pages:
            for (chain, feature), c in features.items():
                if n in chain:
                    counts[feature].append(c)
        if not counts:
            continue
        h = [min(1.0, max(0.0, -sum(c / sum(cs) * math.log(c / sum(cs), m) for c in cs))) if m > 1 else 0.0 for cs in counts.values()]
        content = sum(1 - x for x in h) / len(h)
        share = gamma ** len(kinds)
        out[n] = (m, (1 - share) * show + share * content)
    return out


def test_importance_is_that_of_a_plain_computation(spark):
    r = random.Random(3)
    parts = ["<nav><a href=/>Home</a></nav>", "<div class=box>same words</div>", "<div class=box><p>{0}</p></div>", "<p>{0}</p>", "<div><p>{0}<div>{0}</div></div>"]
    rows = []
    for i in range(40):
        body = "".join(r.choice(parts).format(r.choice(["one", "two", say(r, 2)])) for _ in range(5))
        rows.append((i, f"http://p{i % 3}.example/", f"<body>{body}</body>"))
    df = spark.createDataFrame([(*x, "h", "d", "l") for x in rows], PAGES)
    got = {(x["host"], x["node"]): x["importance"] for x in style_tree.branches(df).collect()}
    hosts = defaultdict(list)
    seen = set()
    for _, url, html in rows:
        page = Page(html)
        key = (url, tuple(page.unnamed()))
        if key in seen:  # equal articles of a host count once
            continue
        seen.add(key)
        features = Counter()
        for k, text, _ in page.blocks:
            chain = tuple(page.above(page.elements[k][0]))
            for piece in text.lower().split("|"):
                features[chain, piece.strip()] += 1
        hosts[url[7:-1]].append(({n: "/".join(s) for n, s in page.children.items()}, features))
    every = plain_importance([p for pages in hosts.values() for p in pages], style_tree.GAMMA)
    want = {}
    for host, pages in hosts.items():
        for n, (m, own) in plain_importance(pages, style_tree.GAMMA).items():
            weight = m / (m + style_tree.PRIOR)
            want[host, n] = weight * own + (1 - weight) * every[n][1]
    assert got.keys() == want.keys()
    assert max(abs(got[k] - want[k]) for k in want) < 1e-9
