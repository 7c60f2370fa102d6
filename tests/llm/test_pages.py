import random
import time
import tracemalloc
import xml.etree.ElementTree as ET
from collections import defaultdict

import pytest

from skyroll.llm import pages

ARTICLE = "<h1>Title &amp; more</h1><p>One  two\n<b>three</b>, four five six seven eight.<br>nine<p>Second paragraph, with a few more words.</p>"
FRAME = (
    "<!DOCTYPE html><html><head><title>no</title><style>p{{}}</style><script>var x='</p><article>';</script></head><body class=x><header>Site</header>"
    "<nav><ul><li><a href='/'>Home page of the site, and much more of it than anyone reads</a></ul></nav><!-- <p>gone -->"
    "<div class='ad-box'>Buy, buy, buy this very good product that we have, now</div>{}"
    "<aside>Side</aside><div id=comments><p>A long comment by a reader, longer than most.</p></div><form><p>Name</p></form><footer>End</footer></body></html>"
)
WANT = "Title & more\nOne two three, four five six seven eight. nine\nSecond paragraph, with a few more words."


def text(html, path=None):
    return pages.extract(pages.parse(html), path)


def test_article():
    assert text(FRAME.format(f"<article>{ARTICLE}</article>")) == WANT
    assert text(FRAME.format(f"<div class='post-12 entry'>{ARTICLE}</div>")) == WANT
    assert text(FRAME.format(f"<div class='post-12 entry'>{ARTICLE}</div>"), "/html/body.x/div.entry.post-#") == WANT


def test_broken_markup():
    assert text(FRAME.format(f"<article>{ARTICLE}<p><b>open")[:-40]).startswith(WANT)
    for bad in ("", "<", "<p", "a < b", "<p title='x>unclosed", "</div></div>x", "<script>never closed", "<!-- never closed", "&am <b>", "<ul><li>a<li>b"):
        text(bad)
    assert text("<p>just a paragraph") == "just a paragraph"


def test_numbered_classes_agree():
    paths = {pages.parse(f"<div class='b{i} a{i}x'><p>t</p></div>").paths[1] for i in range(3)}
    assert paths == {"/div.a#x.b#"}


def test_host_votes(spark):
    short = "<html><body><div class='teaser'><p>{0}, a, longer, text, with, commas, than, the, article, itself, has, in, it</p></div><div class='main-{1}'><p>Short {1}.</p></div></body></html>"
    long = "<html><body><div class='teaser'><p>Little.</p></div><div class='main-{0}'><p>{1}</p></div></body></html>"
    rows = [(i, f"https://u@Host.example:80/{i}", long.format(i, "Words of the article, many of them. " * 9)) for i in range(5)]
    rows += [(10, "https://host.example/10?q", short.format("x", 10)), (11, None, None), (12, "https://other.example/", ""), (None, "bad url", "<p>hi there</p>")]
    rows += [rows[0]]
    df = spark.createDataFrame([(*r, "z", 1) for r in rows], "page_id long, url string, html string, _host string, n_chars int")
    got = pages.main_text(df).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by = {r.page_id: r.text for r in got}
    assert by[10] == "Short 10." and by[11] == by[12] == "" and by[None] == "hi there" and by[0].startswith("Words of")
    assert pages.main_text(df.limit(0)).count() == 0


def test_host_in_both_forms(spark):
    from pyspark.sql import functions as F

    urls = ["https://u:p@A.b.C:80/x", "//h/x", "h/x", "", "http://", "ftp://x?y", "HTTPS://Q#z"]
    got = pages.main_text(spark.createDataFrame([(i, u, "<p>words</p>") for i, u in enumerate(urls)], "page_id long, url string, html string"))
    assert got.agg(F.count("*")).first()[0] == len(urls)
    assert [pages.host_of(u) for u in urls] == ["a.b.c", "h", "", "", "", "x", "q"]


PROSE = "".join(f"<p>Paragraph {i} of the article, with more words to read in it.</p>" for i in range(5))


@pytest.mark.parametrize(
    "name", ["layout-sidebar-right", "page-share", "post-related-news", "skip-link-target", "content ad-free", "login-required", "article-comment-enabled", "product-banner-page"]
)
def test_a_name_alone_rules_nothing_out(name):
    page = pages.parse(f"<html><body><nav><a href='/'>Home</a></nav><div class='{name}'>{PROSE}</div><div class='comments'><p>By a reader.</p></div></body></html>")
    assert pages.extract(page, None) == "\n".join(f"Paragraph {i} of the article, with more words to read in it." for i in range(5))
    assert pages.extract(page, page.path(pages.best(page)[0])) == pages.extract(page, None)


def test_names_inside_the_article():
    inner = "<div class='comments'><p>By a reader.</p></div><div class='post-related-news'><p>Also, this.</p></div><p class='notice-board'>Kept.</p><p class='notice'>Gone.</p>"
    got = text(f"<article>{PROSE}{inner}</article>")
    assert got.endswith("read in it.\nKept.") and "reader" not in got and "Also" not in got
    assert text(f"<main><h1>T</h1><div class='content ad-free'>{PROSE}</div></main>", "/main").startswith("T\nParagraph 0")
    assert text("<p>So <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> holds.</p>") == "So x=1 holds."
    assert text(f"<form id='aspnetForm'>{PROSE * 5}</form>").startswith("Paragraph 0")
    assert text("<div class='cookie-notice'><p>We use cookies.</p></div><nav>Home</nav>") == ""


def test_steps_with_slashes():
    page = pages.parse(f"<div class='w-1/2'><div class='b'>{PROSE}</div></div>")
    assert page.paths == ["", "/div.w-#%2F#", "/div.w-#%2F#/div.b"] and page.at(page.paths[2]) == [2] and page.at("/div") == []


N = 1 << 20
HOSTILE = {
    "deep": "<div>" * (N // 5),
    "deep with classes": "<div class='a b'>x" * (N // 18),
    "closed by others": "<div>" * (N // 10) + "</section>" * (N // 20),
    "quotes": "<a 'b " * (N // 6),
    "open values": "<a x='" * (N // 6),
    "open and other values": "<a x='y\" z=\"" * (N // 12),
    "no ends": "<p " * (N // 3),
    "open raw": "<svg>" * (N // 5),
    "half closed raw": "<svg></svg " * (N // 11),
    "declarations": "<!" * (N // 2),
    "comments": "<!--" * (N // 4),
    "attributes": "<div " + "a= " * (N // 3) + ">",
    "spaces": "<div a" + " " * N + "b" + " " * N + "=>",
    "equals": "<div " + "= " * (N // 2) + ">x",
    "references": "&" * N,
    "hidden spans": "<span class=ad>" * (N // 15),
}


@pytest.mark.parametrize("name", HOSTILE)
def test_long_bad_pages_end(name):
    start = time.process_time()
    page = pages.parse(HOSTILE[name])
    pages.extract(page, page.path(pages.best(page)[0]))
    assert time.process_time() - start < 20  # quadratic work takes from minutes to an hour


def test_deep_pages_stay_small():
    tracemalloc.start()
    pages.parse("<div class=x>" * 20_000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 << 20


# ---- brute force: well-formed pages of known marks, scored, voted on and extracted over an element tree

KINDS = {"story": 0, "b12 col": 0, "post-related-news": 1, "page-share-wide": 1, "sidebar": 2, "comment-list": 2, "nav": 3}


def random_page(rng):
    def part(depth):
        name = rng.choice(list(KINDS)) if depth else "story"
        inner = ""
        for _ in range(rng.randint(1, 4)):
            if depth < 4 and rng.random() < 0.45:
                inner += part(depth + 1)
            else:
                plain = " ".join(rng.choice(["word", "some, more", "longer text", "end."]) for _ in range(rng.randint(1, 60)))
                linked = " ".join("link" for _ in range(rng.choice([0, 0, 0, 3, 30])))
                inner += f"<p>{plain}<a>{linked}</a></p>"
        tag = "nav" if name == "nav" else rng.choice(["div", "section"]) if rng.random() < 0.9 else "article"
        return f"<{tag} class='{name}'>{inner}</{tag}>"

    return f"<html><body>{part(0)}{part(1)}</body></html>"


def plain_tree(html):
    """Containers (path, own mark, mark with those around, parent, blocks in page order as (container, text, points))."""
    nodes, blocks = [("", 0, 0, -1, "")], []

    def walk(e, up):
        if e.tag == "p":
            body, link = "".join(e.itertext()).strip(), len(e.find("a").text or "")
            blocks.append((up, body, min(max(0, len(body) - 2 * link), 400) + 20 * min(body.count(","), 10) + 10))
            return
        name = e.get("class", "")
        own = 0 if e.tag in ("html", "body", "article") else KINDS[name]
        step = ".".join([e.tag, *sorted("".join("#" if c.isdigit() else c for c in n).replace("##", "#") for n in name.split())])
        nodes.append((f"{nodes[up][0]}/{step}", own, max(own, nodes[up][2]), up, e.tag))
        here = len(nodes) - 1
        for child in e:
            walk(child, here)

    walk(ET.fromstring(html), 0)
    return nodes, blocks


def plain_best(nodes, blocks):
    top = (0, 0)
    for i, (_, _, mark, _, _) in enumerate(nodes):
        score = sum(points for at, _, points in blocks if at == i)
        score += sum(points // 2 for at, _, points in blocks if nodes[at][3] == i and nodes[at][2] == mark and nodes[at][4] != "article")
        score = 0 if mark == 3 or score < [1, 200, 1000][mark] else score // [1, 2, 32][mark]
        top = max(top, (score, -i))
    return -top[1], top[0]


def plain_extract(nodes, blocks, path):
    def around(i):
        while i > 0:
            yield i
            i = nodes[i][3]

    def prose(i):
        return sum(points for at, _, points in blocks if i in (up := list(around(at))) and all(nodes[j][1] < 2 for j in up[: up.index(i)]))

    chosen = [i for i, n in enumerate(nodes) if n[0] == path and n[2] < 3]
    if not chosen:
        top, score = plain_best(nodes, blocks)
        chosen = [top] if score else []
    kept = []
    for at, body, _ in blocks:
        inside = list(around(at))
        root = next((i for i in inside if i in chosen), None)
        if root is not None and all(nodes[i][1] == 0 or nodes[i][1] == 1 and 2 * prose(i) > prose(root) for i in inside[: inside.index(root)]):
            kept.append(body)
    return "\n".join(kept)


def test_against_brute_force(spark):
    rng = random.Random(5)
    shapes = [random_page(rng) for _ in range(60)]
    rows = [(i, f"http://h{i % 7}/{i}", rng.choice(shapes[i % 7 :: 7]) if rng.random() < 0.7 else random_page(rng)) for i in range(300)]
    trees = {i: plain_tree(h) for i, _, h in rows}
    votes = defaultdict(lambda: [0, 0])
    for i, u, _ in rows:
        top, score = plain_best(*trees[i])
        if score:
            votes[u.split("/")[2], trees[i][0][top][0]][0] += 1
            votes[u.split("/")[2], trees[i][0][top][0]][1] += score
    winner = {}
    for (host, path), (count, score) in sorted(votes.items(), key=lambda v: (-v[1][0], -v[1][1], v[0][1])):
        winner.setdefault(host, path)
    want = {i: plain_extract(*trees[i], winner.get(u.split("/")[2])) for i, u, _ in rows}
    got = {r.page_id: r.text for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == want and sum(bool(t) for t in want.values()) > 250
