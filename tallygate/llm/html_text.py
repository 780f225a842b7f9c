"""Main text of web pages, with site templates removed by recurring subtrees.

1. Tasks parse each page, drop what is structurally no article (menus, forms, adverts, ...), and
   hash every remaining block subtree: its tag, its text and its children.
2. Spark counts, per host, in how many different pages a subtree occurs.  Pages with the same main
   text count once, so a copied page does not turn its paragraphs into a template.
3. Subtrees on at least ``share`` of a host's different pages (and ``least_pages``) are templates;
   a host has at most (blocks a page / share) of them.  Pages are parsed again and those subtrees
   deleted before the text is written.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygate.llm.common import text_or_empty, written


@dataclass(frozen=True)
class Template:
    share: float = 0.4
    least_pages: int = 5


_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>"
    r"|<[!?/][^>]*+>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[a-z]+")

# Elements of the HTML vocabulary by their role here.
_RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes template".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p "
    "pre section summary table tbody td tfoot th thead tr ul".split()
)
_CLOSES_P = _BLOCKS - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "dd", "dt",
                       "li", "legend"}
_DROPPED = frozenset(
    "nav header footer aside form script style title textarea noscript iframe template svg canvas "
    "object embed button select option datalist dialog menu head math audio video map xmp noembed "
    "noframes input label fieldset".split()
)
#: A new element of the key ends an open one of the values, up to an element of _SCOPES.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
         "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPES = frozenset("table ul ol dl article main section div body html menu select".split())
#: Words of a class, id or role that mark an element as no part of the article.
_MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "cookie cookies consent gdpr notice notices alert newsletter subscribe subscription signup "
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer header "
    "masthead share sharing social related recommended comment comments reply replies respond "
    "disqus popup modal overlay widget toolbar skip search contentinfo complementary".split()
)
#: Beside one of these in a class, a word above tells how a page looks (no-sidebar, header-fixed).
_STATES = frozenset("no not non without with has free fixed".split())
_WHOLE = ("html", "body")
_ARTICLES = ("article", "main")


@dataclass
class Node:
    tag: str
    dropped: bool
    marked: bool = False  # dropped for its class, id or role alone
    items: list = field(default_factory=list)  # Node or text
    digest: bytes = b""
    has_text: bool = False


def _marks_out(attributes: str) -> bool:
    for name, *values in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name in ("class", "id", "role"):
            for token in "".join(values).lower().split():
                words = _WORD.findall(token)
                if not _MARKS.isdisjoint(words) and _STATES.isdisjoint(words):
                    return True
    return False


def _hidden(attributes: str) -> bool:
    return "hidden" in attributes.lower() and any(
        name.lower() == "hidden" for name, *_ in _ATTRIBUTE.findall(attributes))


def parse(page: str) -> Node:
    """The element tree; unclosed and misnested elements are closed as browsers do for blocks."""
    root = Node("html", False)
    stack = [root]
    at, size = 0, len(page)

    def close(to: int) -> None:
        del stack[to:]

    def opened(tags: tuple[str, ...], scopes: frozenset[str]) -> int:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                return i
            if stack[i].tag in scopes:
                return 0
        return 0

    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            stack[-1].items.append(page[at:])
            break
        if m.start() > at:
            stack[-1].items.append(page[at : m.start()])
        at = m.end()
        tag = m.group(2) or m.group(5)
        if tag is None:
            continue
        tag = tag.lower()
        if m.group(1) or m.group(4):
            found = opened((tag,), frozenset())
            if found and (tag in _BLOCKS or tag not in ("b", "i")):
                inner = any(n.tag in ("article", "main", "body") for n in stack[found + 1 :])
                if not inner or tag in ("article", "main", "body", "html"):
                    close(found)
            elif found and not any(n.tag in _BLOCKS for n in stack[found + 1 :]):
                close(found)
            continue
        attributes = m.group(3) if m.group(2) else m.group(6)
        if tag in _CLOSES_P and (found := opened(("p",), _SCOPES | {"td", "th", "li"})):
            close(found)
        if tag in _ENDS and (found := opened(_ENDS[tag], _SCOPES)):
            close(found)
        node = Node(tag, tag in _DROPPED or bool(attributes and _hidden(attributes)))
        if attributes and not node.dropped and tag not in _WHOLE and _marks_out(attributes):
            node.dropped = node.marked = True
        stack[-1].items.append(node)
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*/?>", re.I).search(page, at)
            at = end.end() if end else size
        elif tag not in _VOID and not attributes.endswith("/"):
            stack.append(node)
        elif tag in ("svg", "math"):
            continue
    _restore(root)
    return root


def _restore(root: Node) -> None:
    """An article behind a mark comes back if it alone has more text than all that is kept."""
    behind: list[tuple[Node, ...]] = []  # marked elements on the way to an article, and the article
    pending: list[tuple[Node, tuple[Node, ...]]] = [(root, ())]
    while pending:
        node, way = pending.pop()
        if node.marked:
            way = (*way, node)
        elif node.dropped:
            continue
        if way and node.tag in _ARTICLES:
            behind.append((*way, node))
        elif way or node.tag not in _ARTICLES:
            pending.extend((x, way) for x in node.items if isinstance(x, Node))
    if not behind:
        return

    def size(parts: list[Node]) -> int:
        return len(text_of(parts))

    def alone(way: tuple[Node, ...]) -> int:
        # seen from the inside, where its own mark does not count
        return size([Node("article", False, items=way[-1].items)])

    longest = max(behind, key=alone)
    if alone(longest) > size(main_parts(root)):
        for node in longest:
            node.dropped = node.marked = False


def main_parts(root: Node) -> list[Node]:
    """The outermost article elements, else main elements, else the whole page."""
    for wanted in ("article", "main"):
        found: list[Node] = []
        pending = [root]
        while pending:
            node = pending.pop()
            if node.dropped:
                continue
            if node.tag == wanted:
                found.append(node)
            else:
                pending.extend(x for x in reversed(node.items) if isinstance(x, Node))
        if found:
            return found
    return [root]


def _ordered(part: Node) -> list[Node]:
    """Kept nodes, parents before children."""
    out, pending = [], [part]
    while pending:
        node = pending.pop()
        out.append(node)
        pending.extend(x for x in node.items if isinstance(x, Node) and not x.dropped)
    return out


def digest(part: Node) -> None:
    """Give every kept node the digest of its subtree (children first)."""
    for node in reversed(_ordered(part)):
        h = hashlib.blake2b(node.tag.encode(), digest_size=8)
        for x in node.items:
            if isinstance(x, str):
                words = html.unescape(x).split()
                if words:
                    node.has_text = True
                    h.update(b"\0" + " ".join(words).encode("utf-8", "surrogatepass"))
            elif not x.dropped:
                h.update(b"\1" + x.digest)
                node.has_text |= x.has_text
        node.digest = h.digest()


def _number(value: bytes) -> int:
    return int.from_bytes(value, "little", signed=True)


def text_of(parts: list[Node], deleted: frozenset[int] = frozenset()) -> str:
    """Blocks in page order, one a line."""
    blocks: list[str] = []
    current: list[str] = []

    def end() -> None:
        words = "".join(current).split()
        if words:
            blocks.append(" ".join(words))
        current.clear()

    for part in parts:
        pending: list = [part]
        while pending:
            x = pending.pop()
            if x is None:
                end()
            elif isinstance(x, str):
                current.append(html.unescape(x))
            elif x.dropped or (deleted and _number(x.digest) in deleted):
                if x.tag in _BLOCKS:
                    end()
            elif x.tag == "br":
                current.append(" ")
            else:
                if x.tag in _BLOCKS:
                    end()
                    pending.append(None)
                pending.extend(reversed(x.items))
        end()
    return "\n".join(blocks)


# ------------------------------------------------------------------------------------- tasks


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, trees, contexts = [], [], []
        pages = zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True)
        for host, page in pages:
            if not host:
                continue
            parts = main_parts(parse(page))
            text = text_of(parts)
            context = _number(hashlib.blake2b(text.encode("utf-8", "surrogatepass"),
                                              digest_size=8).digest())
            found = {0}  # stands for the page itself
            for part in parts:
                digest(part)
                found.update(_number(n.digest) for n in _ordered(part)[1:]
                             if n.has_text and n.tag in _BLOCKS)
            hosts.extend([host] * len(found))
            contexts.extend([context] * len(found))
            trees.extend(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(trees, pa.int64()),
             pa.array(contexts, pa.int64())], ["host", "subtree", "context"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        pages = zip(batch.column("html").to_pylist(), batch.column("templates").to_pylist(),
                    strict=True)
        for page, templates in pages:
            parts = main_parts(parse(page))
            if templates:
                for part in parts:
                    digest(part)
            out.append(text_of(parts, frozenset(templates or ())))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())],
            ["page_id", "url", "text"])


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def templates(pages: DataFrame, how: Template = Template()) -> DataFrame:
    """(host, templates): the digests of each host's recurring subtrees.  Runs jobs."""
    rows = pages.mapInArrow(_subtrees, "host string, subtree long, context long")
    counted = rows.distinct().groupBy("host", "subtree").agg(F.count("*").alias("n"))
    # written, so both readers below use one parse, and the result's size is known to its join
    many = written(counted.where(F.col("n") >= how.least_pages), "subtrees")
    hosts = many.where("subtree = 0").select("host", F.col("n").alias("pages"))
    found = many.where("subtree <> 0").join(hosts, "host").where(
        F.col("n") >= F.col("pages") * how.share
    ).groupBy("host").agg(F.sort_array(F.collect_list("subtree")).alias("templates"))
    return written(found, "templates")


def extract(pages: DataFrame, how: Template = Template()) -> DataFrame:
    """One row per page: page_id, url, text.  Runs the jobs that find the templates.

    Defined results: a null or empty page gives an empty text; a page whose url is null or names no
    host belongs to no site, so only its structure decides; repeated pages each get the same text
    and count once as evidence of a template; other columns are ignored; an empty table gives an
    empty result.
    """
    source = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        text_or_empty("html").alias("html"),
    ).withColumn("host", F.coalesce(host_of(F.col("url")), F.lit("")))
    found = templates(source.select("host", "html"), how)
    return source.join(found, "host", "left").select(
        "page_id", "url", "html", "templates"
    ).mapInArrow(_texts, "page_id long, url string, text string")
