"""Main text of HTML pages by composite text density (Sun, Song and Liao, 2011).

The nodes are the block elements; inline elements (``b``, ``span``, ``math`` and so on) count as
part of their block, but for links and void elements, which count as tags. Every node gets its
characters C, tags T, link characters LC and link tags LT, and the link-adjusted density
``C / T * log_b((C / LC) * (T / LT))`` with ``b = ln(C / (C - LC) * LC + LC_body / C_body * C + e)``.
A node's density sum is the sum of its children's densities, where the text right in a node
counts as one more child; so a lone paragraph never outdoes what holds it. The node with the
largest sum is the content (the outermost of equals), whatever it is called. The least density
on its path up to and with the body is the threshold that a node beside that path must reach
to be taken with it; a heading goes with the block that follows it.

Elements that HTML or their class or id names as page furniture (menus, headers, footers,
sidebars, notices, adverts, forms, comments) count in their parents' densities but give no
text. Where a name is in doubt the densities decide:

* outside articles one such word in a class or id is enough; but if the name also has a word
  such as ``post`` or ``entry``, or the element (or a form or aside) holds an article, main or
  ``h1``, it is text if its largest density sum is over ``HELD`` times the largest one outside it;
* inside an article or main a class or id must be such a name as a whole, or more than half of
  the element's characters must be links; a section so named stays if it is at least half as
  dense as the article; headings are never judged by name.

Hidden elements are those with the attribute ``hidden``, ``aria-hidden=true`` or a style
``display: none``. Scripts, styles, ``noscript``, ``template``, ``iframe``, ``title`` and ``textarea``
never give text.

Defined cases: a null, empty or tagless page (tagless: its own text) works; unclosed and stray
tags follow the usual recovery (a block ends an open paragraph, an end tag closes what is open
inside); an unclosed comment, script or style runs to the end; very long pages are parsed whole,
one at a time; ties go to the outermost, then first node; repeated rows give repeated results;
an empty table gives an empty table; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.llm.shared import ship, table

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(?P<raw>script|style|noscript|template|textarea|iframe|title)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?>[^>\"']+|\"[^\"]*\"|'[^']*'|[\"'])*)>",
    re.S | re.I,
)
_ATTR = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center details dd dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul br option".split()
)
#: An open element of the second kind ends where one of the first starts.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table body html div article section main td th".split())
FURNITURE = frozenset("nav aside footer form button select menu dialog head input fieldset".split())
#: Such elements that may also wrap a whole page or article.
WRAPPERS = frozenset("aside form".split())
#: Words of a class, id or role that name page furniture.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored sponsors promo promotion promoted "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay paywall newsletter subscribe subscription signup "
    "sidebar sidebars aside rail menu menus nav navbar navigation breadcrumb breadcrumbs pagination pager toolbar topbar masthead "
    "header footer copyright legal comment comments commentlist disqus respond reply replies discussion "
    "share sharing social related recommended recommendations widget widgets login search contentinfo complementary".split()
)
#: What such a word may also head: the header of a text's own part.
CONTENT = frozenset("article post entry story content main".split())
KEEP = frozenset("body html article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
HELD = 4
#: What a name says of an element: text, furniture, or what the densities are to decide.
TEXT, DROP, SECTION, PARTLY, WRAPS, TITLED = range(6)


class Node:
    __slots__ = ("name", "parent", "children", "chars", "tags", "link_chars", "link_tags", "own", "block", "holds", "verdict", "skip", "text", "density", "total")

    def __init__(self, name: str, parent: Node | None, verdict: int):
        self.name, self.parent, self.verdict, self.skip = name, parent, verdict, verdict == DROP
        self.children: list[Node] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.own = [0, 0, 0, 0]  # characters, tags, link characters and link tags outside blocks
        self.block = name in BLOCK and name not in VOID or verdict != TEXT or parent is None
        self.holds = name in ("article", "main", "h1")
        self.text: list[tuple[int, str]] = []
        self.density = self.total = 0.0


def _verdict(name: str, attrs: str, inside: set[str]) -> int:
    """What the element's tag and attributes say of it."""
    text = bool(inside & {"article", "main"})
    if name in FURNITURE or (name == "header" and not text):
        return WRAPS if name in WRAPPERS and not text else DROP
    if name in KEEP or not attrs:
        return TEXT
    values: dict[str, str] = {}
    for m in _ATTR.finditer(attrs):
        values.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    if "hidden" in values and values["hidden"].strip().lower() != "until-found":
        return DROP
    if values.get("aria-hidden", "").strip().lower() == "true" or _NO_DISPLAY.search(values.get("style", "")):
        return DROP
    if name in HEADINGS:
        return TEXT
    found = TEXT
    for key in ("class", "id", "role"):
        for token in values.get(key, "").split():
            parts = set(re.split(r"[^a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", token).lower())) - {""}
            named = parts & NAMES
            if not named or (named == {"header"} and parts & CONTENT):
                continue
            if parts <= NAMES:
                return SECTION if text and name == "section" else DROP
            found = found or (PARTLY if text else TITLED if parts & CONTENT else WRAPS)
    return found


def parse(page: str) -> tuple[Node, list[Node]]:
    """The tree, and its nodes in page order. Text pieces carry their place in the page; a
    piece None marks a block's edge."""
    root = Node("#root", None, TEXT)
    nodes, stack, place = [root], [root], 0

    def put(text: str | None) -> None:
        nonlocal place
        place += 1
        stack[-1].text.append((place, text))

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            put(html.unescape(page[at : m.start()]))
        at = m.end()
        if m["raw"] is not None or m["name"] is None:
            if m[0].startswith("<![CDATA["):
                put(m[0][9:].removesuffix("]]>"))
            continue
        name = m["name"].lower()
        if m["end"]:
            k = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name), 0)
            if k:
                block = any(n.name in BLOCK for n in stack[k:])
                del stack[k:]
                if block:
                    put(None)
            elif name in ("p", "br"):
                put(None)
            continue
        if name in ("html", "body") and any(n.name == name for n in stack):
            continue
        if name in BLOCK:
            if name != "br":
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].name == "p" or stack[i].name in ENDS.get(name, ()):
                        del stack[i:]
                        break
                    if stack[i].name in SCOPE:
                        break
            put(None)
        node = Node(name, stack[-1], _verdict(name, m["attrs"], {n.name for n in stack}))
        stack[-1].children.append(node)
        nodes.append(node)
        if name not in VOID and not m["attrs"].rstrip().endswith("/"):
            stack.append(node)
            if name in BLOCK:
                put(None)
    if at < len(page):
        put(html.unescape(page[at:]))
    return root, nodes


def density(c: int, t: int, lc: int, lt: int, ratio: float) -> float:
    """Composite text density; ``ratio`` is the body's share of link characters."""
    if not c:
        return 0.0
    base = math.log(c / max(c - lc, 1) * lc + ratio * c + math.e)
    t, lt, lc = max(t, 1), max(lt, 1), max(lc, 1)
    return max(0.0, c / t * math.log(c / lc * t / lt) / math.log(base)) if base > 1 else c / t


def measure(nodes: list[Node]) -> None:
    """Counts, densities, density sums, and which nodes give no text."""
    for n in reversed(nodes):  # children before parents
        here = sum(len("".join(t.split())) for _, t in n.text if t)
        n.chars += here
        n.own[0] += here
        if n.name == "a":
            n.link_chars, n.link_tags = n.chars, n.link_tags + 1
            n.own[2], n.own[3] = n.own[0], n.own[3] + 1
        p = n.parent
        if p is None:
            continue
        tag = n.block or n.name == "a" or (n.name in VOID and n.name not in ("br", "wbr"))
        p.chars += n.chars
        p.tags += n.tags + tag
        p.link_chars += n.link_chars
        p.link_tags += n.link_tags
        p.block |= n.block and not n.skip  # an inline element around blocks is one
        p.holds |= n.holds
        if not n.block:
            p.own = [x + y for x, y in zip(p.own, (n.own[0], n.own[1] + tag, *n.own[2:]), strict=True)]
    body = next((n for n in nodes if n.name == "body"), nodes[0])
    ratio = body.link_chars / max(body.chars, 1)
    doubtful: dict[Node, None] = {}  # in page order
    for n in nodes:  # parents before children
        n.density = density(n.chars, n.tags, n.link_chars, n.link_tags, ratio)
        if n.verdict == SECTION:
            text = n.parent
            while text.name not in ("article", "main"):
                text = text.parent
            n.skip = n.density < text.density / 2
        elif n.verdict == PARTLY:
            n.skip = 2 * n.link_chars > n.chars
        elif n.verdict == TITLED or (n.verdict == WRAPS and n.holds):
            doubtful[n] = None
        elif n.verdict == WRAPS:
            n.skip = True
        n.skip = n.skip or (n.parent is not None and n.parent.skip)
    for n in nodes:
        if not n.skip and n.block:
            n.total = sum(x.density for x in n.children if x.block and not x.skip and x not in doubtful) + density(*n.own, ratio)
    _settle(nodes, {n: None for n in doubtful if not n.skip})


def _settle(nodes: list[Node], doubtful: dict[Node, None]) -> None:
    """Skip the doubtful elements whose largest density sum is at most HELD times the largest
    one around them, outermost first; sums do not yet have doubtful children in them."""
    if not doubtful:
        return
    around, most = {}, {}
    for n in nodes:  # the doubtful element (or None) that a node lies in
        around[n] = None if n.parent is None else n.parent if n.parent in doubtful else around[n.parent]
        scope = n if n in doubtful else around[n]
        most[scope] = max(most.get(scope, 0.0), n.total)
    deep = dict(most)  # with what lies in doubtful elements further in
    for d in reversed(doubtful):
        deep[around[d]] = max(deep.get(around[d], 0.0), deep[d])
    for d in doubtful:
        d.skip = d.parent.skip or deep[d] <= HELD * most.get(around[d], 0.0)
        if not d.skip:
            d.parent.total += d.density
    for n in nodes:
        n.skip = n.skip or (n.parent is not None and n.parent.skip)


def content(root: Node, nodes: list[Node]) -> list[Node]:
    """The roots of the chosen subtrees, the one with the largest density sum first."""
    body = next((n for n in nodes if n.name == "body"), root)
    able = [n for n in nodes if n.block and not n.skip and n.name != "html" and (n is not root or body is root)] or [root]
    best = max(able, key=lambda n: n.total)  # the first of equals
    path = [best]
    while path[-1] is not body and path[-1].parent is not None:
        path.append(path[-1].parent)
    threshold = min(n.density for n in path)
    chosen = [best]
    for n, above in zip(path, path[1:], strict=False):
        follows = False  # whether the block after a heading is taken
        for x in reversed(above.children):
            if x.skip or not x.chars:
                continue
            take = x is n or x.density >= threshold or (follows and x.name in HEADINGS)
            if take and x is not n:
                chosen.append(x)
            follows = take
    return chosen


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root, nodes = parse(page)
    measure(nodes)
    pieces, todo = [], [n for n in content(root, nodes)]
    while todo:
        n = todo.pop()
        if not n.skip:
            pieces += n.text
            todo += n.children
    pieces.sort(key=lambda x: x[0])
    return " ".join("".join(" " if t is None else t for _, t in pieces).split())


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The ``keep`` columns and ``text`` of every row, in the scan's own tasks."""
    ship(pages.sparkSession)
    rows = pages.select(*keep, F.col(html_col).alias("__html"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                texts = [main_text(x) for x in part.column(len(keep)).to_pylist()]
                yield pa.record_batch([*part.columns[: len(keep)], pa.array(texts, pa.string())], names=[*keep, "text"])

    from pyspark.sql import types as T

    return rows.mapInArrow(run, T.StructType([*(rows.schema[c] for c in keep), T.StructField("text", T.StringType())]))


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
