"""Main text of web pages by consensus of a host's pages on the container that holds it.

A page is read as a tree of its block elements, forgiving of what is left open or cut off. Each container gets a score:
the characters of its blocks outside links, in full for the container they stand in and by ``FADE`` less for each level
above, none of boilerplate, twice where its tag or class says article. The best container votes for its generalised
path: the tags from the root down with their class and id, digits made ``#`` so that numbered names of different pages
agree. Votes are added up by host in Spark; paths with at least ``SHARE`` of a host's votes win, so at most 1 /
``SHARE`` of them. Every page is then extracted again, from the first winning path of its host that it has, or from its
own best container where it has none of them. Within the container, elements that are boilerplate by tag, role, class
or id are left out, nested ones too: menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
reader comments.

A host may hold any share of all pages: votes are combined before they are shuffled, and the winners (a row a host, of
bounded length) are broadcast if small; else pages are joined by host and a part of the page, which spreads a hot host.

Defined results: null or empty html has an empty text; a page whose url names no host isn't voted on and uses its own
best container; pages without a container of the article fall back to ``body`` without boilerplate; character
references are decoded once, cut ones stay as they are; a tag cut off at the end of a page is dropped; a form that
holds most of a page's text is no boilerplate; white space in a block becomes one space, blocks are joined by a line
feed; ties between containers go to the outer one, between paths to the smaller; pages that repeat an id are extracted
each for itself; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from terroir.llm.common import small, written

#: What a level further up keeps of a block's score, and the share of a host's votes with which a path wins.
FADE, SHARE = 0.8, 0.05
#: Parts of a host's pages where the winners aren't broadcast.
PARTS = 64

#: Elements of HTML by how they are laid out.
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html "
    "legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
VOID = {"hr", "br", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
#: Elements whose content is never text of the page.
RAW = {"script", "style", "noscript", "template", "svg", "iframe", "object", "video", "audio", "canvas", "title", "textarea"}
#: Elements whose content is boilerplate.
ASIDE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "fieldset"}
#: An open element on the left is closed by the start of one on the right.
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot", "thead"}, "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"}, "option": {"option", "optgroup"}}
#: Elements that are parts of a text rather than containers of one.
PARTS_OF_TEXT = {"p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "td", "th", "tr", "dd", "dt"}
#: Elements beyond which an end tag, or a start that closes another, doesn't reach.
WALLS = {"html", "body", "table", "td", "th", "ul", "ol", "dl", "article", "section", "div", "aside", "nav", "header", "footer", "main", "form", "blockquote"}

#: Words of a class, id or role that say what an element is.
BAD_WORDS = set(
    "ad ads adv advert adverts advertisement advertising banner banners sponsor sponsored promo promotion outbrain taboola breadcrumb breadcrumbs comment comments commentlist "
    "disqus discussion replies respond cookie cookies consent gdpr notice notices notification notifications alert disclaimer popup modal overlay newsletter subscribe subscription signup login "
    "footer header masthead topbar navbar nav navigation menu menus submenu sidebar sidebars widget widgets related recommended recommendations share sharing social "
    "pagination pager toolbar search searchform contentinfo complementary dialog form".split()
)
GOOD_WORDS = set("article articlebody body content entry main mainbody post postbody story storybody text".split())

#: A class with one of these before says what its element is next to.
NEXT_TO = {"has", "with", "without", "no", "not"}

#: A quote opens a value only after the sign before it; whatever is open at the end of a page ends there.
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z))?)*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
WORD = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


class Node:
    """An element laid out as a block: its tag, generalised name, kind, and content in page order."""

    __slots__ = ("tag", "name", "up", "bad", "good", "content", "linked")

    def __init__(self, tag: str, attributes: str, up: Node | None) -> None:
        self.tag, self.up, self.content, self.linked = tag, up, [], 0
        given = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)} if attributes.strip() else {}
        labels = [WORD.findall(CAMEL.sub(" ", x).lower()) for k in ("class", "id", "role") for x in given.get(k, "").split()]
        words = {w for x in labels if x and x[0] not in NEXT_TO for w in x}
        self.good = tag in ("article", "main") or bool(words & GOOD_WORDS)
        hides = "hidden" in given or given.get("aria-hidden", "") == "true" or "display:none" in given.get("style", "").replace(" ", "")
        self.bad = tag in ASIDE or hides or bool(words & BAD_WORDS) and tag not in ("html", "body", "article", "main")
        name = ".".join([tag, *sorted(set(given.get("class", "").split()))]) + (f"@{given['id']}" if given.get("id") else "")
        self.name = re.sub(r"\d+", "#", name).replace(">", " ")

    def path(self) -> str:
        names, node = [], self
        while node:
            names.append(node.name)
            node = node.up
        return ">".join(reversed(names))


def tree(page: str) -> Node:
    """The blocks of a page. Inline elements only leave their text; a text run between two blocks is a block of its own."""
    root = top = Node("html", "", None)
    at, links, text, end, forms = 0, 0, [], len(page), []

    def flush() -> None:
        if text:
            run = " ".join("".join(text).split())
            if run:
                top.content.append(run)
                top.linked += min(links, len(run))
        text.clear()

    in_link = False
    while at < end:
        m = TAG.search(page, at)
        piece = page[at : m.start() if m else end]
        if piece:
            text.append(html.unescape(piece) if "&" in piece else piece)
            links += len(piece) if in_link else 0
        if not m:
            break
        at, closing, tag, attributes = m.end(), m[1], (m[2] or "").lower(), m[3] or ""
        if not tag or page[at - 1] != ">":
            continue  # a comment, a declaration, or a tag that is cut off
        if tag in RAW:
            if not closing and not attributes.rstrip().endswith("/"):
                close = re.compile(rf"</{tag}(?:\s[^>]*)?(?:>|\Z)", re.I).search(page, at)
                at = close.end() if close else end if tag in ("script", "style", "title", "textarea") else at
            continue
        if tag == "a":
            in_link = not closing
        elif tag == "br":
            text.append(" ")
        if tag not in BLOCKS:
            continue
        flush()
        links = 0
        if tag in ("html", "body") and (closing or tag == "html"):
            continue
        if closing:
            node = top
            while node.up and node.tag != tag and not (tag in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6") and node.tag in WALLS):
                node = node.up
            top = node.up if node.tag == tag and node.up else top
            continue
        if top.tag == "p":
            top = top.up  # a paragraph ends where another block begins
        node = top
        while node.up and tag not in CLOSED_BY.get(node.tag, ()) and not (node.tag in WALLS and node.tag not in ("td", "th")):
            node = node.up
        if node.up and tag in CLOSED_BY.get(node.tag, ()):
            top = node.up
        made = Node(tag, attributes, top)
        top.content.append(made)
        if tag not in VOID:
            top = made
        if tag == "form":
            forms.append(made)
    flush()
    for form in forms:
        form.bad = 2 * length(form) < length(root)
    return root


def length(node: Node) -> int:
    """Characters of all text in an element, boilerplate too."""
    total, stack = 0, [node]
    while stack:
        for x in stack.pop().content:
            if isinstance(x, str):
                total += len(x)
            else:
                stack.append(x)
    return total


def blocks(node: Node) -> Iterator[str]:
    """Texts of the blocks in an element, those of boilerplate inside it left out."""
    stack = [iter(node.content)]
    while stack:
        for x in stack[-1]:
            if isinstance(x, str):
                yield x
            elif not x.bad:
                stack.append(iter(x.content))
                break
        else:
            stack.pop()


def nodes(root: Node) -> Iterator[tuple[Node, int]]:
    """Elements outside boilerplate in page order, each with a number for its path, which ``number`` gives too."""
    stack = [(root, hash((0, root.name)))]
    while stack:
        node, path = stack.pop()
        yield node, path
        stack += [(x, hash((path, x.name))) for x in reversed(node.content) if not isinstance(x, str) and not x.bad]


def number(path: str) -> int:
    return functools.reduce(lambda before, name: hash((before, name)), path.split(">"), 0)


def best(root: Node) -> tuple[Node, float]:
    """The container with the highest score."""
    found = [node for node, _ in nodes(root)]
    score = dict.fromkeys(map(id, found), 0.0)
    for node in found:
        own = float(sum(len(x) for x in node.content if isinstance(x, str)) - 2 * node.linked)
        holder = node.up if node.tag in PARTS_OF_TEXT and node.up else node
        while holder and abs(own) > 0.01:
            score[id(holder)] += own
            own, holder = own * FADE, holder.up
    top, most = root, float("-inf")
    for node in found:
        value = score[id(node)] * (2 if node.good else 1)
        if value > most and node.tag not in PARTS_OF_TEXT:
            top, most = node, value
    return top, most


def main_text(page: str, paths: list[str] = ()) -> str:
    """Text of the first of ``paths`` that the page has with any text, else of its best container."""
    root, wanted = tree(page), {number(path): [] for path in paths}
    for node, path in nodes(root) if wanted else ():
        if path in wanted:
            wanted[path].append(node)
    for found in wanted.values():
        text = "\n".join(x for node in found for x in blocks(node))
        if text:
            return text
    return "\n".join(blocks(best(root)[0]))


def votes(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """host, path, score: the vote of each page that has a host and any text."""

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [best(tree(x)) for x in batch["page"]]
            yield pd.DataFrame({"host": batch["host"], "path": [f[0].path() for f in found], "score": [f[1] for f in found]})

    rows = pages.select(F.lower(F.regexp_extract(url_col, HOST, 1)).alias("host"), F.col(html_col).alias("page"))
    return rows.filter("host <> '' and page <> ''").mapInPandas(vote, "host string, path string, score double").filter("score > 0")


def winners(pages: DataFrame, url_col: str = "url", html_col: str = "html", share: float = SHARE) -> DataFrame:
    """host, paths: its winning paths, most votes first."""
    summed = votes(pages, url_col, html_col).groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes"))
    of_host = summed.withColumn("all", F.sum("votes").over(W.partitionBy("host")))
    return of_host.filter(F.col("votes") >= share * F.col("all")).groupBy("host").agg(F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("v"), "path"))).alias("won")).select("host", F.col("won.path").alias("paths"))


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` with its main text in ``text_col`` instead of ``html_col``."""
    won = written(winners(pages, url_col, html_col))
    kept = [c for c in pages.columns if c not in (html_col, text_col)]
    rows = pages.select(F.struct(*kept).alias("kept"), F.lower(F.regexp_extract(F.coalesce(url_col, F.lit("")), HOST, 1)).alias("host"), F.coalesce(html_col, F.lit("")).alias("page"))
    if small(won):
        joined = rows.join(F.broadcast(won), "host", "left")
    else:
        parts = won.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
        joined = rows.withColumn("part", F.pmod(F.xxhash64("page"), F.lit(PARTS)).cast("int")).join(parts, ["host", "part"], "left")
    packed = joined.select("kept", F.struct("page", "paths").alias("todo"))

    @F.pandas_udf(T.StringType())
    def texts(todo: pd.DataFrame) -> pd.Series:
        return pd.Series([main_text(p, [] if w is None else list(w)) for p, w in zip(todo["page"], todo["paths"], strict=True)], dtype=object)

    return packed.select("kept.*", texts("todo").alias(text_col))


def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


#: The given pages hold their text in one ``article`` of headings and paragraphs, which plain patterns can take out.
SQL = r"""
with a as (select page_id, url, coalesce(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '') as article from pages),
b as (select page_id, url, list_transform(regexp_split_to_array(article, '</?(?:p|h1)>'), lambda x: trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, '<[^>]*>', '', 'g'),
             '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '[\x09-\x0D\x20\x{85}\x{A0}]+', ' ', 'g'))) as parts from a),
t as (select page_id, url, array_to_string(list_filter(parts, lambda x: x <> ''), chr(10)) as text from b)
select page_id, url, text, length(text) as n_chars from t
"""
