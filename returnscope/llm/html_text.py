"""Main text of web pages by consensus paths of a host.

1. Each page is read into blocks of text, each with the path of its containers: tags with their
   classes, numbers in them generalised. Containers are scored by their prose, the text of the blocks
   in them less the text in links; a container whose tag or name marks it as something else (menu,
   header, footer, advert, form, comments, ...) scores nothing. Each page proposes the innermost
   container with nine tenths of its prose.
2. Pages vote in Spark: a host's winning path is the one that most of its pages propose.
3. Pages are read again with their host's winning path. A page on which containers with that path miss
   any prose uses its own innermost container that holds all of it. So no score, vote or threshold
   drops prose: what is left out is marked as something else, or is links outside the container.

Votes are counted on the map side and are one row per host and path; a hot host's pages meet their
one winning path by a salted join.

Names set only containers apart, not headings, paragraphs or spans. Words that can also name a part of an
article (share, legal, discussion, ...) do so only as a whole name, and in ids, which may be anchors, only
for containers that are mostly links. Captions and formulas are text; the source of a formula, which
browsers don't show, is not.

Cases: null, empty and text-free html give an empty text; a null url has the empty host. Broken
markup is read as far as it makes sense: open tags end with the page, stray ends are dropped; a head
ends where text or a tag begins that it can't hold, and an unclosed select, svg, object, noscript,
iframe and the like at the next tag of a block. An unclosed script or style takes the rest. Ties go
to the outer container on a page and to the smaller path of a host. Repeated rows each get a row.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from returnscope.llm.common import hot_keys, salted_join
from returnscope.llm.url_filter import host_of
from returnscope.sources.tables import stage

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg", "annotation", "annotation-xml", "object", "select", "title"}
NESTED = {"svg", "object", "template"}  # raw elements that may hold one of their kind
IN_HEAD = {"html", "head", "title", "meta", "link", "base", "script", "style", "noscript", "template"}
BLOCK = re.compile(
    r"</?(?:body|html|head|main|article|section|aside|nav|header|footer|div|p|h[1-6]|ul|ol|li|dl|dt|dd|table|tr|td|th|form|fieldset|blockquote|pre|figure|figcaption|hr|address)(?=[\s/>])", re.I
)
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr", "param"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q",
    "ruby", "rt", "rp", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "img", "wbr",
    "math", "semantics", "annotation", "annotation-xml", "mi", "mn", "mo", "ms", "mtext", "mspace", "mrow", "mfrac", "msqrt", "mroot", "mstyle", "merror", "mpadded", "mphantom",
    "mfenced", "menclose", "msub", "msup", "msubsup", "munder", "mover", "munderover", "mmultiscripts", "mprescripts", "none", "mtable", "mtr", "mlabeledtr", "mtd", "maction",
}
# An open one ends where one of these begins.
CLOSED_BY = {
    "p": {"p", "div", "ul", "ol", "dl", "table", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "blockquote", "article", "section", "aside", "nav", "header", "footer", "form", "main", "figure", "hr"},
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"},
}
BOUNDARY = {"div", "article", "section", "main", "body", "table", "ul", "ol", "dl", "td", "aside", "nav", "form", "header", "footer", "blockquote"}
APART = {"nav", "header", "footer", "aside", "form", "button", "menu", "dialog", "fieldset", "head"} | RAW
# Only these are set apart by name. A name is parted at - and _.
NAMED = {"div", "section", "table", "td", "ul", "ol", "dl"}
# Set apart by any part of a class or role,
CLEAR = re.compile(
    r"ads?|advert|advertis\w+|nav|navbar|navigation|sidebar|masthead|footer|breadcrumbs?|cookies?|popup|newsletter|disqus|toolbar|pagination|pager|contentinfo|complementary"
)
# by a class or role, or an id of two such parts, that has no parts but these, those above and those below,
VAGUE = re.compile(
    r"sponsor\w*|promo\w*|banner|menus?|side|rail|header|foot|consent|notices?|notification|alert|modal|overlay|subscri\w+|signup|login|share|sharing|social|"
    r"related|recommend\w*|comments?|replies|reply|respond|discussion|widget|tags|legal|copyright|hidden|sr|skip\w*"
)
FILLERS = set("area bar block box btn bottom buttons container content form group holder icons inner item items left link links list main outer page panel posts right row section site slot top unit wrap wrapper only".split())
# by these as a whole id,
IDS = {"nav", "navbar", "navigation", "sidebar", "masthead", "footer", "header", "menu", "breadcrumb", "breadcrumbs", "comments", "ads", "ad", "disqus_thread", "pagination", "toolbar", "newsletter"}
# and by any other name with such a part where at least this share of the text is links.
LINK_SHARE = 0.5
CONTAINERS = {"article", "main", "section", "div", "body", "td", "html"}
SPACE = re.compile(r"\s+")
WORD = re.compile(r"\w")
LINKS = re.compile(r"(?:^|[\s\"'/])href\s*=", re.I)
DIGITS = re.compile(r"\d+")


@dataclass
class Node:
    """A container; ``text`` and ``prose`` count the characters below it that may be main text, with and without links."""

    path: str
    tag: str
    apart: bool
    parent: Node | None
    suspect: bool = False
    text: int = 0
    prose: int = 0


@dataclass
class Page:
    blocks: list[tuple[Node, str]] = field(default_factory=list)
    nodes: list[Node] = field(default_factory=list)


def _names(attributes: str) -> tuple[str, list[str], list[str], bool]:
    """Class, id and role as one generalised name; classes and roles; ids; whether it is hidden."""
    classes, ids, hidden = [], [], False
    for key, a, b, c in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), a or b or c
        if key in ("class", "role"):
            classes += value.lower().split()
        elif key == "id":
            ids += value.lower().split()
        elif key == "hidden" or (key == "style" and "display:none" in value.replace(" ", "").lower()) or (key == "aria-hidden" and value.lower() == "true"):
            hidden = True
    return ".".join(sorted({DIGITS.sub("#", n) for n in classes + ids})), classes, ids, hidden


@lru_cache(100_000)
def _marks(name: str) -> tuple[int, int, bool]:
    """Clear parts, clear and vague parts, and whether there are fillers at most besides."""
    parts = [x for x in re.split(r"[-_\d]+", name) if x]
    clear = sum(CLEAR.fullmatch(x) is not None for x in parts)
    known = clear + sum(VAGUE.fullmatch(x) is not None for x in parts)
    fillers = sum(x in FILLERS and not (CLEAR.fullmatch(x) or VAGUE.fullmatch(x)) for x in parts)
    return clear, known, known > 0 and known + fillers == len(parts)


def _marked(tag: str, classes: list[str], ids: list[str]) -> tuple[bool, bool]:
    """Whether names set a container apart, and whether they would if it held mostly links."""
    if tag not in NAMED or not (classes or ids):
        return False, False
    found = [_marks(n) for n in classes]
    anchors = [_marks(n) for n in ids]
    apart = any(clear or whole for clear, _, whole in found) or any(n in IDS for n in ids if tag != "section" or n == "comments")
    apart = apart or any(known > 1 and whole for _, known, whole in anchors)
    return apart, any(known for _, known, _ in found + anchors)


@lru_cache(100)
def _tags_of(tag: str) -> re.Pattern:
    return re.compile(rf"<(/?){tag}(?=[\s/>])[^>]*?(/?)>", re.I)


def _raw_end(source: str, at: int, tag: str) -> int:
    """Where a raw element whose start tag ends at ``at`` ends: after its end tag, or unclosed, at the next block."""
    depth = 1
    for m in _tags_of(tag).finditer(source, at):
        if m[1]:
            depth -= 1
            if not depth:
                return m.end()
        elif tag in ("script", "style"):
            continue
        elif tag not in NESTED:
            break
        elif not m[2]:
            depth += 1
    block = None if tag in ("script", "style") else BLOCK.search(source, at)
    return block.start() if block else len(source)


def parse(source: str | None) -> Page:
    page, root = Page(), Node("", "html", False, None)
    page.nodes.append(root)
    stack, parts, free = [("html", root)], [], []  # parts of the open block; those outside links
    link = 0  # size of the stack where the open link began

    def count(node: Node | None, text: int, prose: int) -> None:
        while node is not None:
            node.text += text
            node.prose += prose
            node = node.parent

    def flush() -> None:
        text = SPACE.sub(" ", html.unescape("".join(parts))).strip()
        if text:
            node = stack[-1][1]
            page.blocks.append((node, text))
            if not node.apart:
                prose = len(text)
                if len(free) < len(parts):
                    rest = SPACE.sub(" ", html.unescape("".join(free))).strip()
                    prose = len(rest) if WORD.search(rest) else 0  # what only parts links is no prose
                count(node, len(text), prose)
        parts.clear()
        free.clear()

    def close(index: int) -> None:
        nonlocal link
        del stack[index:]
        if len(stack) < link:
            link = 0

    def leave_head() -> None:
        if any(t == "head" for t, _ in stack):
            flush()
            close(next(i for i, (t, _) in enumerate(stack) if t == "head"))

    at, source = 0, source or ""
    while m := TOKEN.search(source, at):
        start = m.start()
        if start > at:
            piece = source[at:start]
            if stack[-1][0] == "head" and not piece.isspace():
                leave_head()
            parts.append(piece)
            if not link:
                free.append(piece)
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag, ending = tag.lower(), bool(m[1])
        if not ending and tag not in IN_HEAD:
            leave_head()
        if tag == "a":
            link = len(stack) if not ending and LINKS.search(m[3]) else 0
        if not ending and tag in RAW:
            if tag not in INLINE:
                flush()
            if not m[3].rstrip().endswith("/"):
                at = _raw_end(source, at, tag)
            continue
        if tag in INLINE and tag != "span":
            continue
        names, classes, ids, hidden = ("", [], [], False) if ending or not m[3] else _names(m[3])
        if tag == "span" and not hidden and not any(t == "span" for t, _ in stack):
            continue
        flush()
        if tag in VOID:
            continue
        if ending:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    close(i)
                    break
                if stack[i][0] in BOUNDARY and tag not in BOUNDARY:
                    break
            continue
        for i in range(len(stack) - 1, 0, -1):
            if tag in CLOSED_BY.get(stack[i][0], ()):
                close(i)
                break
            if stack[i][0] in BOUNDARY:
                break
        above = stack[-1][1]
        named, suspect = _marked(tag, classes, ids)
        apart = above.apart or hidden or named or _is_apart(tag, above)
        node = Node(f"{above.path}/{tag}.{names}" if names else f"{above.path}/{tag}", tag, apart, above, suspect and not apart)
        page.nodes.append(node)
        stack.append((tag, node))
    if at < len(source):
        rest = source[at:]
        if stack[-1][0] == "head" and not rest.isspace():
            leave_head()
        cut = re.search(r"<(?:[a-zA-Z/!?])[^>]*\Z", rest)  # a tag that the page's end cuts off
        parts.append(rest[: cut.start()] if cut else rest)
        if not link:
            free.append(parts[-1])
    flush()
    for node in page.nodes:
        if node.parent is not None and node.parent.apart:
            node.apart = True
        elif node.suspect and node.text and node.text - node.prose >= LINK_SHARE * node.text:
            node.apart = True
            count(node.parent, -node.text, -node.prose)
    return page


def _is_apart(tag: str, above: Node) -> bool:
    if tag == "header" and (above.tag in ("article", "main", "section")):
        return False  # an article's own heading
    return tag in APART


def best_container(page: Page, share: float = 0.9) -> Node | None:
    """The innermost container with ``share`` of the page's prose; the page where nothing but links has text."""
    root = page.nodes[0]
    if not root.text:
        return None
    best = root
    for node in page.nodes[1:]:
        if not node.apart and node.tag in CONTAINERS and node.prose > 0 and node.prose >= share * root.prose:
            best = node
    return best


def _inside(node: Node | None, roots: set[int]) -> bool:
    while node is not None:
        if id(node) in roots:
            return True
        node = node.parent
    return False


def extract(source: str | None, path: str | None) -> str:
    """Blocks, in page order, of all containers with ``path``; of the page's own if those miss any prose."""
    page = parse(source)
    own = best_container(page, 1.0)
    if own is None:
        return ""
    chosen = [n for n in page.nodes if n.path == path and not n.apart]
    if not chosen or sum(n.prose for n in chosen) < own.prose:
        chosen = [n for n in page.nodes if n.path == own.path and not n.apart]
    roots = {id(n) for n in chosen}
    return "\n".join(text for node, text in page.blocks if not node.apart and _inside(node, roots))


def _propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        best = [best_container(parse(x)) for x in batch.column(1).to_pylist()]
        paths = pa.array([b.path if b is not None else None for b in best], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(0), paths], ["host", "path"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [extract(h, p) for h, p in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["id", "url", "text"])


def winning_paths(pages: DataFrame, url_column: str = "url", html_column: str = "html") -> DataFrame:
    """``host, path``: the path that most pages of a host propose."""
    rows = pages.select(host_of(F.col(url_column)).alias("host"), F.col(html_column).alias("html"))
    votes = rows.mapInArrow(_propose, "host string, path string").filter("path IS NOT NULL").groupBy("host", "path").agg(F.count("*").alias("n"))
    order = Window.partitionBy("host").orderBy(F.col("n").desc(), "path")
    return votes.withColumn("r", F.row_number().over(order)).filter("r = 1").select("host", "path")


def main_texts(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """``id, url, text`` of every page."""
    winners = stage(winning_paths(pages, url_column, html_column), "host_paths")
    rows = pages.select(
        F.col(id_column).alias("id"), F.col(url_column).alias("url"), host_of(F.col(url_column)).alias("host"), F.col(html_column).alias("html")
    )
    found = salted_join(rows, winners, "host", hot_keys(rows.select("host"), "host"), ["id"], "left")
    kind = pages.schema[id_column].dataType.simpleString()
    return found.select("id", "url", "html", "path").mapInArrow(_extract, f"id {kind}, url string, text string")
