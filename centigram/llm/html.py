"""Main text of web pages by composite text density.

Every node of a page's tree has its characters per tag, adjusted for links: text full of links
counts for little.  A node's density sum adds up its children's densities; the node with the
largest sum holds the article.  The least density on its path to the body is the threshold:
what hangs off that path and is at least so dense belongs to the article too.  Elements that
say what they are by tag, role or being hidden are left out.  A class or id that sounds like
no article (advert, comments, share) only lowers a block's standing: its density counts by
half, and by less the shorter its text outside links, in sums and against the threshold, and
within the article it must still reach a quarter of the article's density.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from centigram.llm.common import batch_of, prepare

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>"
    r"|<[!?/][^>]*>"
    r"|(?P<text>[^<]+|<)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?")
HIDING = re.compile(r"(?:^|;)\s*display\s*:\s*none\b")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template iframe object svg canvas audio video head title textarea".split())
RAW = frozenset("script style textarea title iframe noscript".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q s samp small span strike strong sub sup time tt u var wbr".split()
)
APART = frozenset("nav footer aside form button select menu dialog fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MAIN = frozenset(("article", "main"))
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
#: Words of a class or id that lower a block's standing.
APART_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense alert banner breadcrumb breadcrumbs comment comments consent cookie"
    " cookies discussion disqus foot footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices"
    " overlay pager pagination popup promo promotion recommended related replies reply respond search share sharing sidebar signup"
    " social sponsor sponsored subscribe subscription toolbar widget".split()
)
#: Characters outside links at which a marked block's standing is halved once more.
SHORT = 100
#: What an opening tag closes, and where looking for it ends.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
PARAGRAPH_ENDS = frozenset(
    "address article aside blockquote center dir div dl fieldset figure figcaption footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)


class Node:
    __slots__ = ("tag", "parent", "items", "apart", "chars", "tags", "link_chars", "link_tags", "density", "standing", "special", "marked", "within_marked")

    def __init__(self, tag: str, parent: Node | None, apart: bool) -> None:
        self.tag, self.parent, self.apart = tag, parent, apart
        self.items: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.standing = 0.0
        self.special = self.marked = self.within_marked = False


def attributes_of(text: str) -> dict[str, str]:
    """Values by lower-case name; the first of a repeated name stands, a bare name has none."""
    found: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), "".join(values))
    return found


def says_apart(tag: str, attributes: str, inside_main: bool) -> tuple[bool, bool, bool]:
    """(certainly no article text, none unless it holds the article, of lower standing) by tag and attributes."""
    if tag in SILENT or tag in APART or (tag == "header" and not inside_main):
        return True, False, False
    if tag in MAIN or tag in ("html", "body") or not attributes:
        return False, False, False
    named = attributes_of(attributes)
    if "hidden" in named or named.get("aria-hidden", "").strip().lower() == "true" or HIDING.search(named.get("style", "").lower()):
        return True, False, False
    special = named.get("role", "").strip().lower() in ROLES
    marked = False
    if tag not in INLINE and tag not in HEADINGS:
        marked = any(not APART_WORDS.isdisjoint(re.split(r"[^a-z]+", named.get(x, "").lower())) for x in ("class", "id"))
    return False, special, marked


def parse(page: str) -> tuple[Node, list[Node]]:
    """The root and all nodes in page order.  Open elements end with the page."""
    root = Node("html", None, False)
    nodes, at, here, inside, at_end = [root], 0, root, 0, len(page)
    while at < at_end:
        m = TOKEN.match(page, at)
        if m is None:  # a tag with an open quote: up to the next bracket
            close = page.find(">", at)
            at = at_end if close < 0 else close + 1
            continue
        at = m.end()
        if m["text"] is not None:
            piece = m["text"]
            here.items.append(html.unescape(piece) if "&" in piece else piece)
            continue
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["end"]:
            node = here
            while node is not None and node.tag != tag:
                node = node.parent
            if node is not None and node.parent is not None:
                while here is not node.parent:
                    inside -= here.tag in MAIN
                    here = here.parent
            continue
        if tag == "html":
            continue
        closes, stops = CLOSES.get(tag, ((), ()))
        if tag in PARAGRAPH_ENDS:
            closes, stops = ("p",), PARAGRAPH_ENDS - {"p"}
        if closes:
            node, found = here, None
            while node is not None and node.tag not in stops:
                if node.tag in closes:
                    found = node
                node = node.parent
            if found is not None and found.parent is not None:
                here = found.parent
        apart, special, marked = says_apart(tag, m["attributes"], inside > 0)
        node = Node(tag, here, apart)
        node.special, node.marked = special, marked
        here.items.append(node)
        nodes.append(node)
        if tag in RAW and not m["attributes"].rstrip().endswith("/"):
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            at = end.end() if end else at_end
        elif tag not in VOID and not (m["attributes"].rstrip().endswith("/") and tag not in INLINE and tag not in PARAGRAPH_ENDS):
            here = node
            inside += tag in MAIN
    return root, nodes


def measure(nodes: list[Node]) -> None:
    """Counts and densities, children before parents."""
    holds_main: set[int] = set()
    for node in reversed(nodes):
        main = node.tag in MAIN or node.tag == "h1"
        for item in node.items:
            if isinstance(item, str):
                node.chars += len(item.strip())
            elif item.tag not in SILENT:
                node.chars += item.chars
                node.tags += item.tags + 1
                node.link_chars += item.link_chars
                node.link_tags += item.link_tags + (item.tag == "a")
                main |= id(item) in holds_main
        if node.tag == "a":
            node.link_chars = node.chars
        if main:
            holds_main.add(id(node))
            node.marked = False
        elif node.special:
            node.apart = True
    body = next((n for n in nodes if n.tag == "body"), nodes[0])
    ratio = body.link_chars / max(1, body.chars)
    for node in nodes:
        c, t = node.chars, max(1, node.tags)
        if not c:
            continue
        free = max(1, c - node.link_chars)
        base = math.log(math.log(c * node.link_chars / free + ratio * c + math.e) + 1e-9)
        links = c / max(1, node.link_chars) * t / max(1, node.link_tags)
        node.density = node.standing = c / t * (math.log(max(links, 1e-9)) / base if base > 1e-6 else 1.0)
        if node.marked:
            free = c - node.link_chars
            node.standing *= free / (free + SHORT) / 2
    for node in nodes:
        node.within_marked = node.marked
        if node.parent is not None:
            node.apart |= node.parent.apart
            node.within_marked |= node.parent.within_marked


def chosen(root: Node, nodes: list[Node]) -> set[int]:
    """Nodes whose subtrees are the article; marked blocks of too low a standing become apart."""
    best, most = None, -math.inf
    for node in nodes:
        if node.apart or node.within_marked or node.tag in VOID or not node.chars:
            continue
        own = sum(x.standing for x in node.items if isinstance(x, Node) and not x.apart)
        loose = sum(len(x.strip()) for x in node.items if isinstance(x, str))
        total = own + loose
        if total > most:
            best, most = node, total
    if best is None:
        return set()
    path, node = [], best
    while node is not None:
        path.append(node)
        node = node.parent
    within = [k for k, n in enumerate(path) if n.tag in MAIN]
    if within:  # the page itself says how far the article reaches
        path = path[within[-1] :]
    threshold = min((n.density for n in path if n.tag != "html"), default=0.0)
    for node in nodes:
        if node.marked and node.standing < path[0].density / 4:
            node.apart = True
    picked = {id(path[0])}
    if not within:
        for below, above in zip(path, path[1:], strict=False):
            for item in above.items:
                if isinstance(item, Node) and item is not below and not item.apart and item.chars and (item.standing >= threshold or item.tag == "h1"):
                    picked.add(id(item))
    return picked


def main_text(page: str) -> str:
    """The article's blocks, joined by one space, white space within a block made one space."""
    root, nodes = parse(page)
    measure(nodes)
    picked = chosen(root, nodes)
    out: list[str] = []
    todo: list[tuple[Node | str, bool]] = [(root, False)]
    while todo:
        item, taken = todo.pop()
        if isinstance(item, str):
            if taken:
                out.append(item)
            continue
        if item.apart:
            out.append(" ")
            continue
        taken = taken or id(item) in picked
        block = item.tag not in INLINE
        if block:
            out.append(" ")
            todo.append((" ", taken))
        todo.extend((x, taken) for x in reversed(item.items))
    return " ".join("".join(out).split())


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    Null and empty pages, and pages without any article text, have the empty text.  Markup
    that is cut off or wrongly nested is read as far as it goes.  Repeated rows give repeated
    results; an empty table gives an empty one.
    """
    prepare(pages.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [main_text(x or "") for x in batch.column("html").to_pylist()]
            schema = pa.schema(
                [pa.field("page_id", batch.column("page_id").type), pa.field("url", pa.string()), pa.field("text", pa.string()), pa.field("n_chars", pa.int64())]
            )
            yield batch_of({"page_id": batch.column("page_id"), "url": batch.column("url"), "text": rows, "n_chars": [len(r) for r in rows]}, schema)

    key = pages.schema["page_id"].dataType.simpleString()
    columns = pages.select("page_id", F.col("url").cast("string").alias("url"), "html")
    return columns.mapInArrow(each, f"page_id {key}, url string, text string, n_chars long")
