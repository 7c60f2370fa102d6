"""Operator 9, main text of web pages by consensus host paths.

Each page scores its own containers and votes for the best one's path: its tags
with their classes, generalised so that numbered classes agree. Spark counts
the votes per host, and every page is then extracted from the containers at its
host's winning path. A page without that path uses its own best container.

Names of classes and ids are evidence, not a verdict: they lower a container's
score, and the container that wins, with all around it, is taken whatever it is
called. Only inside of it names decide: a part called a menu, notice, advert or
comments goes; a part that has such a word beside unknown ones goes unless it
holds most of the prose. A page is read once, left to right, in time and memory
in proportion to its length, however deep or badly closed it is.
"""

from __future__ import annotations

import re
import sys
from collections import defaultdict
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyroll.llm.common import checkpointed, join_small, ship, table
from skyroll.llm.quality import slices

#: What a tag begins with; its end is looked for by ``Tags``.
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)|<!--|<[!?]")
#: In a tag, its end or the start of a quoted value.
IN_TAG = re.compile(r">|=\s*+([\"'])")
ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+)))?")
#: Elements whose content is no markup, or nothing a reader sees.
RAW = frozenset("script style textarea title noscript template iframe svg object select option canvas video audio annotation annotation-xml".split())
#: Elements that end a block; those of CONTAINERS also hold others and can be an article.
CONTAINERS = frozenset(
    "html body main article section div center blockquote td table tbody ul ol dl figure details"
    " nav header footer aside form fieldset menu dialog".split()
)
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dd dt pre hr address figcaption hgroup legend summary caption thead tfoot tr dir".split())
SPACES = frozenset(("br", "th"))
#: Elements, roles and words of classes or ids that mark what isn't the article.
OTHER_TAGS = frozenset("nav header footer aside fieldset menu dialog button".split())
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
OTHER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation"
    " breadcrumb breadcrumbs sidebar aside header masthead footer cookie cookies consent gdpr notice notices popup modal"
    " newsletter subscribe subscription signup login share sharing social comment comments reply replies disqus discussion"
    " related recommended recommendations widget toolbar pagination pager skip".split()
)
#: Words beside them that leave no doubt what a name means.
PLAIN_WORDS = frozenset(
    "list box bar item items link links button buttons icon icons count label text title wrap wrapper container area section"
    " block site top bottom left right user reader form panel slot unit inner outer".split()
)
#: Elements that a page is never without, whatever they are called.
KEPT_TAGS = frozenset(("html", "body", "main", "article"))

#: How surely something isn't the article: a name with such a word, such a name as a whole, what the markup itself says.
PERHAPS, NAMED, CERTAIN = 1, 2, 3
#: By that: what a score is divided by, and the least score before it that counts.
DIVISORS = (1, 2, 32)
LEAST_SCORES = (1, 200, 1000)


class Block(NamedTuple):
    text: str
    inside: int  # number of the container
    linked: int  # characters within links

    @property
    def points(self) -> int:
        prose = max(0, len(self.text) - 2 * self.linked)
        return min(prose, 400) + 20 * min(self.text.count(","), 10) + 10


class Page(NamedTuple):
    """Containers in page order, each with its last step only, so that deep pages stay small."""

    steps: list[str]
    parents: list[int]
    marks: list[int]  # how surely the container itself isn't part of an article
    blocks: list[Block]

    def path(self, i: int) -> str:
        steps = []
        while i >= 0:
            steps.append(self.steps[i])
            i = self.parents[i]
        return "/".join(reversed(steps))

    @property
    def paths(self) -> list[str]:
        return [self.path(i) for i in range(len(self.steps))]

    def at(self, path: str) -> list[int]:
        """Containers at a path, each step compared once."""
        steps, depths = path.split("/"), [-1] * len(self.steps)  # depth of containers on the way, -1 off it
        found = []
        for i, (step, up) in enumerate(zip(self.steps, self.parents, strict=True)):
            depth = depths[up] + 1 if up >= 0 else 0
            if (up < 0 or depths[up] >= 0) and depth < len(steps) and steps[depth] == step:
                depths[i] = depth
                if depth == len(steps) - 1:
                    found.append(i)
        return found


def generalised(tag: str, classes: str) -> str:
    """Tag and class names without numbers, in order of name."""
    names = {re.sub(r"\d+", "#", c.lower()) for c in classes.split()}
    return ".".join([tag, *sorted(names)]).replace("/", "%2F")


def mark(tag: str, attributes: dict[str, str], in_article: bool) -> int:
    """How surely an element isn't part of an article; 0 if nothing says so."""
    if tag in OTHER_TAGS and not (tag == "header" and in_article):
        return CERTAIN
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attributes.get("style", "")):
        return CERTAIN
    if tag in KEPT_TAGS:
        return 0
    if attributes.get("role", "").lower() in OTHER_ROLES:
        return CERTAIN
    found = NAMED if tag == "form" or attributes.get("role", "").lower() == "form" else 0
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        words = re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower())
        if words and words[0] not in ("has", "no", "with") and OTHER_WORDS.intersection(words) and not (in_article and "header" in words):
            found = max(found, NAMED if all(w in OTHER_WORDS or w in PLAIN_WORDS for w in words) else PERHAPS)
    return found


class Tags:
    """Tags of a page in order. What has no end is searched for once, not again for each tag."""

    def __init__(self, html: str):
        self.html = html
        self.missing: dict[str, int] = {}  # from where on a text isn't found any more
        self.quotes = True  # False after a tag whose quoted values leave it without an end

    def find(self, what: str, at: int) -> int:
        """Next place of ``what``, or -1."""
        if at >= self.missing.get(what, len(self.html) + 1):
            return -1
        found = self.html.find(what, at)
        if found < 0:
            self.missing[what] = at
        return found

    def end(self, at: int) -> int:
        """Place after the ``>`` that ends a tag, or -1; a ``>`` in a quoted value doesn't."""
        start = at
        while self.quotes:
            m = IN_TAG.search(self.html, at)
            if not m:
                self.quotes = False
            elif not m[1]:
                return m.end()
            else:
                closed = self.find(m[1], m.end())
                at = m.end() if closed < 0 else closed + 1
        return self.find(">", start) + 1 or -1

    def close(self, tag: str, at: int) -> int:
        """Place after an element's closing tag, or -1."""
        key = f"</{tag}"
        if at >= self.missing.get(key, len(self.html) + 1):
            return -1
        m = re.compile(rf"{re.escape(key)}(?=[\s/>]|\Z)", re.IGNORECASE).search(self.html, at)
        if not m:
            self.missing[key] = at
            return -1
        end = self.find(">", m.end())
        return end + 1 if end >= 0 else len(self.html)


def parse(html: str) -> Page:
    """Containers and text blocks of a page, however badly closed it is."""
    page = Page([""], [-1], [0], [])
    stack: list[tuple[str, int]] = [("", 0)]
    open_at: dict[str, list[int]] = defaultdict(list)  # places in the stack, by tag
    inline_other: list[str] = []  # open inline elements that hold nothing of the article
    text: list[str] = []
    tags = Tags(html)
    links, linked = 0, 0

    def flush() -> None:
        nonlocal linked
        if text:
            words = " ".join(unescape("".join(text)).split())
            if words:
                page.blocks.append(Block(words, stack[-1][1], linked))
            text.clear()
        linked = 0

    def in_article() -> bool:
        return bool(open_at["article"] or open_at["main"])

    def read(start: int, end: int) -> None:
        nonlocal linked
        if end > start and not inline_other:
            text.append(html[start:end])
            linked += (end - start) if links else 0

    at, n = 0, len(html)
    while at < n:
        m = TAG.search(html, at)
        read(at, m.start() if m else n)
        if not m:
            break
        if not m[2]:
            end = tags.find("-->", m.end()) if m[0] == "<!--" else tags.find(">", m.end())
            if end < 0 and m[0] != "<!--":
                read(m.start(), m.end())
                at = m.end()
            else:
                at = n if end < 0 else end + (3 if m[0] == "<!--" else 1)
            continue
        at = tags.end(m.end())
        if at < 0:  # no tag ends any more: the rest is text
            read(m.start(), n)
            break
        tag, closing, source = m[2].lower(), bool(m[1]), html[m.end() : at - 1]
        if tag in RAW:
            if not closing and not source.endswith("/"):
                close = tags.close(tag, at)
                at = close if close >= 0 else n if tag in ("script", "style") else at
            continue
        if tag in SPACES:
            text.append(" ")
        elif tag == "a":
            links = 0 if closing else 1
        elif tag not in BLOCKS:
            if closing:
                if inline_other and inline_other[-1] == tag:
                    inline_other.pop()
            elif inline_other:
                if inline_other[-1] == tag:
                    inline_other.append(tag)
            elif source and not source.endswith("/") and tag in ("span", "button", "ins", "label") or tag == "button":
                if mark(tag, attributes_of(source), in_article()) >= NAMED:
                    inline_other.append(tag)
        else:
            flush()
            inline_other.clear()
            links = 0
            if tag not in CONTAINERS:
                if not closing and source.strip():
                    if mark(tag, attributes_of(source), in_article()) >= NAMED:
                        inline_other.append(tag)  # a paragraph of it, up to the next block
                continue
            if closing:
                if open_at[tag]:
                    depth = open_at[tag][-1]
                    for t, _ in stack[depth:]:
                        open_at[t].pop()
                    del stack[depth:]
            elif not (tag in ("html", "body") and open_at[tag]):
                attributes = attributes_of(source) if source else {}
                page.steps.append(sys.intern(generalised(tag, attributes.get("class", ""))))
                page.parents.append(stack[-1][1])
                page.marks.append(mark(tag, attributes, in_article()))
                open_at[tag].append(len(stack))
                stack.append((tag, len(page.steps) - 1))
    flush()
    return page


def attributes_of(source: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(source)}


def best(page: Page) -> tuple[int, int]:
    """Container with the highest score, and the score: whole points for its own blocks, half for those one step below.

    A mark, the container's own or one around it, divides the score; blocks
    count for the container around only if that isn't marked less.
    """
    marks = list(page.marks)
    for i in range(1, len(marks)):
        marks[i] = max(marks[i], marks[page.parents[i]])
    scores = [0] * len(marks)
    for b in page.blocks:
        i, up = b.inside, page.parents[b.inside]
        scores[i] += b.points
        if up >= 0 and marks[up] == marks[i] and page.steps[i].split(".")[0] not in ("article", "main"):
            scores[up] += b.points // 2
    for i, m in enumerate(marks):
        scores[i] = scores[i] // DIVISORS[m] if m < CERTAIN and scores[i] >= LEAST_SCORES[m] else 0
    top = max(range(len(scores)), key=lambda i: (scores[i], -i))
    return top, scores[top]


def extract(page: Page, path: str | None) -> str:
    """Text of all containers at ``path``, or else of the page's best one."""
    certain = [m == CERTAIN for m in page.marks]
    for i in range(1, len(certain)):
        certain[i] = certain[i] or certain[page.parents[i]]
    chosen = [] if path is None else [i for i in page.at(path) if not certain[i]]
    if not chosen:
        top, score = best(page)
        chosen = [top] if score > 0 else []
    prose = [0] * len(certain)  # of a container with all that isn't surely something else within
    for b in page.blocks:
        prose[b.inside] += b.points
    for i in range(len(prose) - 1, 0, -1):
        if page.marks[i] < NAMED:
            prose[page.parents[i]] += prose[i]
    roots = [-1] * len(certain)  # the chosen container that each kept one belongs to
    for i in chosen:
        roots[i] = i
    for i in range(1, len(certain)):
        root = roots[page.parents[i]]
        if roots[i] < 0 <= root and (page.marks[i] == 0 or page.marks[i] == PERHAPS and 2 * prose[i] > prose[root]):
            roots[i] = root
    return "\n".join(b.text for b in page.blocks if roots[b.inside] >= 0)


def host_of(url: str | None) -> str:
    """Host of a URL in lower case, without user and port; empty if there is none."""
    m = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def winning_paths(df: DataFrame, url: str, html: str) -> DataFrame:
    """Winning path of each host: most votes, then highest score, then first by name."""
    rows = df.select(df[url].cast("string").alias("_url"), df[html].cast("string").alias("_html"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                hosts, paths, scores = [], [], []
                for u, h in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    page = parse(h or "")
                    top, score = best(page)
                    if score > 0:
                        hosts.append(host_of(u))
                        paths.append(page.path(top))
                        scores.append(score)
                yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(scores, pa.int64())], names=["_host", "_path", "_score"])

    votes = rows.mapInArrow(vote, "_host string, _path string, _score long")
    counted = votes.groupBy("_host", "_path").agg(F.count(F.lit(1)).alias("_votes"), F.sum("_score").alias("_score"))
    first = F.struct(-F.col("_votes"), -F.col("_score"), F.col("_path").alias("path"))
    return counted.groupBy("_host").agg(F.min(first)["path"].alias("_path"))


def main_text(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: ``key``, ``url``, text, n_chars.

    A null or empty page, and one without prose, has an empty text. Pages
    without a host in their URL vote together. Repeated rows are extracted
    alike (each votes); other columns are ignored; an empty table gives none.
    """
    ship(df.sparkSession)
    winners = checkpointed(winning_paths(df, url, html))
    host = F.lower(F.regexp_extract(F.coalesce(df[url].cast("string"), F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = df.select(df[key].alias("_key"), df[url].alias("_url"), host.alias("_host"), df[html].cast("string").alias("_html"))
    joined = join_small(rows, winners, ["_host"], "left").select("_key", "_url", "_path", "_html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = [extract(parse(h or ""), p) for p, h in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)]
                lengths = pa.array(map(len, texts), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), lengths], names=["_key", "_url", "text", "n_chars"])

    kinds = [joined.schema[c].dataType.simpleString() for c in ("_key", "_url")]
    out = joined.mapInArrow(run, f"_key {kinds[0]}, _url {kinds[1]}, text string, n_chars long")
    return out.withColumnsRenamed({"_key": key, "_url": url})


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return main_text(table(spark, sf_dir, "pages"))
