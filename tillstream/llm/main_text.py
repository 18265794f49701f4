"""The main text of a web page by tree scoring.

The page is parsed into a tree (tolerating unclosed, misnested and cut-off tags). Parts that are
never text, or whose tag, role, class or id says they are page furniture, are taken out. Every
paragraph then gives points for its length and its commas to its ancestors, less with each level, and
a container's points are discounted by the share of its text that is in links. The best container is
kept with those of its siblings that belong to the text.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.registry import query, table

# Tags as the HTML standard has them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var img br wbr".split()
)
PARAGRAPHS = frozenset("p pre td th li blockquote dd dt h1 h2 h3 h4 h5 h6 figcaption caption".split())
#: start tags that end an open element of the same list
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: elements that an end tag or an implied end does not reach through
SCOPES = frozenset("article body main section div table ul ol dl td th blockquote nav aside footer header form".split())
#: never text, or page furniture wherever they stand
FURNITURE = RAW | frozenset("head nav aside footer form button select option input dialog menu object canvas audio video".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: words of a class or id that mark page furniture
NAMES = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promotion banner billboard"
    " cookie cookies consent gdpr notice notices notification alert popup modal overlay paywall disclaimer"
    " nav navbar navigation menu menus breadcrumb breadcrumbs pager pagination skip topbar toolbar masthead"
    " header footer sidebar rail aside widget widgets related recommended recommendations trending popular"
    " comment comments commentlist reply replies respond disqus discussion share sharing social follow"
    " newsletter subscribe subscription signup login search form copyright hidden".split()
)
#: tags whose header and names are judged by the article, not by the page
TEXT_TAGS = frozenset("article main".split())

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<(?:!|\?)[^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"'=]|=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|[\"'=])*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?:^|[\s/\"'])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s\"'>]+)))?(?=[\s/>]|$)", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
#: characters that give a paragraph one point, and the most points its length can give
POINT_CHARS, MOST_POINTS = 100, 3
#: siblings below this share of the best container's points are not taken for their points alone
SIBLING_SHARE = 0.2
MOST_LINKS = 0.33


@dataclass(slots=True)
class Node:
    tag: str
    parent: Node | None
    furniture: bool = False
    children: list[Node | str] = field(default_factory=list)
    score: float = 0.0
    chars: int = 0
    linked: int = 0

    def link_share(self) -> float:
        return self.linked / self.chars if self.chars else 0.0


def _is_furniture(tag: str, attributes: str, parents: list[Node]) -> bool:
    if tag in FURNITURE:
        return True
    if not attributes and tag != "header":
        return False
    inside = any(n.tag in TEXT_TAGS for n in parents)
    if tag == "header" and not inside:
        return True
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), entities.unescape(values[0] or values[1] or values[2])
        if name == "hidden" or (name == "aria-hidden" and value.strip().lower() == "true"):
            return True
        if name == "role" and ROLES & set(value.lower().split()):
            return True
        if name in ("class", "id") and tag not in ("html", "body"):
            words = {w.lower() for w in _NAME.findall(value)}
            if inside:
                words.discard("header")
            if words & NAMES and not (tag in TEXT_TAGS and not words & {"comment", "comments", "reply"}):
                return True
    return False


def parse(source: str) -> Node:
    """The tree of a page. A cut-off tag or comment at the end is dropped."""
    root = Node("html", None)
    stack, at = [root], 0

    def text(raw: str) -> None:
        if raw:
            stack[-1].children.append(entities.unescape(raw) if "&" in raw else raw)

    def close(tags: frozenset | set, bounds: frozenset | set) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                del stack[i:]
                return
            if stack[i].tag in bounds:
                return

    while True:
        found = _TOKEN.search(source, at)
        if found is None:
            text(source[at:])
            return root
        text(source[at : found.start()])
        at = found.end()
        end, tag, attributes = found.group(1), found.group(2), found.group(3)
        if end:
            name = end.lower()
            close({name}, frozenset() if name in SCOPES else SCOPES - {name})
        elif tag:
            name = tag.lower()
            if name not in INLINE:
                close({"p"}, SCOPES)
            if name in SIBLINGS:
                close(SIBLINGS[name], {"ul", "ol", "dl", "table", "select"})
            node = Node(name, stack[-1], _is_furniture(name, attributes, stack))
            stack[-1].children.append(node)
            if name in RAW and not attributes.rstrip().endswith("/"):
                # Raw text ends only at its own end tag.
                stop = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, at)
                at = stop.end() if stop else len(source)
            elif name not in VOID:
                stack.append(node)


def _measure(root: Node) -> list[Node]:
    """Characters and linked characters of every node, and the nodes in page order; furniture is left out."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [c for c in reversed(node.children) if isinstance(c, Node) and not c.furniture]
    for node in reversed(order):
        own = sum(len(" ".join(c.split())) for c in node.children if isinstance(c, str))
        node.chars += own
        if node.tag == "a":
            node.linked = node.chars
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.linked += node.linked
    return order


def _text(node: Node) -> str:
    """All text below a node that is not furniture."""
    out, todo = [], [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        elif not x.furniture:
            todo += reversed(x.children)
    return "".join(out)


def _score(order: list[Node]) -> None:
    for node in order:
        loose = node.tag not in INLINE and node.tag not in PARAGRAPHS and any(isinstance(c, str) and c.strip() for c in node.children)
        if node.tag not in PARAGRAPHS and not loose:
            continue
        own = _text(node) if not loose else "".join(c for c in node.children if isinstance(c, str))
        words = " ".join(own.split())
        if not words:
            continue
        points = (1 + words.count(",") + min(len(words) / POINT_CHARS, MOST_POINTS)) * (1 - node.link_share())
        share, up = 1.0, node if loose else node.parent
        while up is not None:
            up.score += points * share
            # The parent gets all, the grandparent half, those above a third, a quarter and so on.
            share = 1 / (1 / share + 1)
            up = up.parent


def _blocks(nodes: list[Node]) -> list[str]:
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        words = " ".join("".join(run).split())
        run.clear()
        if words:
            out.append(words)

    todo: list[Node | str | None] = list(reversed(nodes))
    while todo:
        x = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            run.append(x)
        elif x.furniture:
            continue
        elif x.tag == "br":
            run.append(" ")
        elif x.tag in INLINE:
            todo += reversed(x.children)
        else:
            flush()
            todo.append(None)
            todo += reversed(x.children)
    flush()
    return out


def main_blocks(source: str | None) -> list[str]:
    """The blocks of the main text in page order; none for a null or empty page."""
    if not source:
        return []
    root = parse(source)
    order = _measure(root)
    _score(order)
    containers = [n for n in order if n.tag not in INLINE and n.tag not in PARAGRAPHS and n.score > 0]
    if not containers:
        return _blocks([root])
    best = max(containers, key=lambda n: n.score * (1 - n.link_share()))
    # A part of a marked-up article stands for all of it.
    up = best
    while up is not None:
        if up.tag in TEXT_TAGS:
            return _blocks([up])
        up = up.parent
    if best.parent is None or best.tag == "body":
        return _blocks([best])
    limit = best.score * SIBLING_SHARE
    kept = []
    for node in best.parent.children:
        if node is best:
            kept.append(node)
        elif isinstance(node, Node) and not node.furniture and node.chars and node.link_share() < MOST_LINKS:
            if node.score >= limit or node.tag in ("p", "h1", "blockquote", "pre") or node.tag == best.tag == "section":
                kept.append(node)
    return _blocks(kept)


def extracted(source: Column | str) -> Column:
    """The blocks of the main text of an html column as array<string>."""

    @F.arrow_udf("array<string>")
    def extract(pages: pa.Array) -> pa.Array:
        return pa.array([main_blocks(p.as_py()) for p in pages], type=pa.list_(pa.string()))

    return extract(source)


def extract_pages(pages: DataFrame) -> DataFrame:
    """Adds `blocks` and `text` (the blocks joined by line breaks) to every page; columns of these names are
    replaced. A null or empty page, or one without text, has no blocks and an empty text."""
    return pages.withColumn("blocks", extracted("html")).withColumn("text", F.array_join("blocks", "\n"))


@query("op4_html_extraction")
def op4_html_extraction(spark, sf_dir):
    """The main text of every page."""
    found = extract_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
