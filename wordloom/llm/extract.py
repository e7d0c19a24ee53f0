"""Main text of web pages: site templates removed by counting element subtrees per host.

A page is parsed into elements. What its markup names as no content goes first: scripts,
styles, forms, menus, and elements whose tag, role, class or id says header, footer, sidebar,
advert, notice or comments. Then come templates: every remaining element subtree is hashed
(tags and words), Spark counts the distinct pages of each host that hold it, and subtrees in
more than ``max_pages`` pages and ``max_share`` of the host's pages are deleted. Copies of an
article must not make it a template, so pages with the same longest block count as one, and
inside an element that the page itself marks as the article only boxes (sections, lists, tables)
and subtrees that are all links can be templates, not the article's own paragraphs and headings. What is left of the article (or of the body, where none is marked) is
written block by block.

Rows: a null or empty ``html`` gives an empty text; a null ``url`` is a host of its own;
repeated rows give a row each and count as one page; an empty table gives no row; broken
markup is read as browsers do, as far as elements go; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from wordloom.llm.common import stored, table

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[a-zA-Z/!?][^>]*+(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes".split())
BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol
    optgroup option p pre section summary table tbody tfoot thead tr ul""".split()
)
# A start tag ends these open elements, as far up as the second set.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Blocks that set their content apart; the others are the text of an article itself.
BOXES = frozenset("address center details div dl fieldset figure ol section table ul".split())
ENDS_PARAGRAPH = BLOCKS - {"body", "html", "caption", "option", "optgroup", "legend"}
PARAGRAPH_SCOPE = frozenset("button td th table".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

DROPPED_TAGS = frozenset(
    """head script style title noscript template nav footer aside form button select textarea
    input iframe svg canvas object embed audio video dialog menu noembed noframes map""".split()
)
DROPPED_ROLES = frozenset(
    """navigation banner contentinfo complementary search form dialog alert alertdialog menu
    menubar toolbar tablist status""".split()
)
DROPPED_NAMES = frozenset(
    """ad ads adv advert adverts advertisement advertising alert banner breadcrumb breadcrumbs
    comment comments consent cookie cookies discussion disqus footer gdpr login masthead menu
    modal nav navbar navigation newsletter notice notices notification overlay pager pagination
    popup promo promotion recommended related replies reply respond search share sharing
    sidebar signup social sponsor sponsored subscribe subscription toast toolbar widget
    widgets""".split()
)
HEADER_NAMES = frozenset({"header"})
UNLESS_AFTER = frozenset("has with no without".split())
CONTENT_NAMES = frozenset(
    "article articlebody story storybody post postbody entry maincontent".split()
)

TREES = pa.schema(
    [(n, pa.int64()) for n in ("page_id", "page", "shape")]
    + [("trees", pa.list_(pa.int64())), ("host", pa.string())]
)
TEXTS = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())]
    + [("n_chars", pa.int64())]
)


class Element:
    __slots__ = ("tag", "attrs", "kids", "marked")

    def __init__(self, tag: str, attrs: str = "") -> None:
        self.tag, self.attrs = tag, attrs
        self.kids: list[Element | str] = []
        self.marked = False  # holds or is an element that the page marks as its article


#: Elements nested deeper, as only broken pages have them, give their text to the one above.
DEEPEST = 256


def parse(html: str) -> Element:
    """The elements of a page; missing end tags are supplied. Text in elements beyond
    ``DEEPEST`` levels belongs to the element at that level."""
    root = Element("html")
    stack, at, end = [root], 0, len(html)
    opened = Counter()
    while at < end:
        found = TOKEN.search(html, at)
        if not found:
            stack[-1].kids.append(html[at:])
            break
        if found.start() > at:
            stack[-1].kids.append(html[at : found.start()])
        at = found.end()
        tag = found["tag"]
        if not tag:
            if found[0].startswith("<![CDATA["):
                stack[-1].kids.append(found[0][9:].removesuffix("]]>"))
            continue
        tag = tag.lower()
        if found["end"]:
            _close(stack, opened, {tag}, frozenset())
            continue
        if tag in ENDS_PARAGRAPH:
            _close(stack, opened, {"p"}, PARAGRAPH_SCOPE)
        if tag in CLOSES:
            _close(stack, opened, *CLOSES[tag])
        if tag in HEADINGS and stack[-1].tag in HEADINGS:
            _cut(stack, opened, len(stack) - 1)
        node = Element(tag, found["attrs"])
        if tag in ("html", "body"):  # one of each; repeated ones only add to the first
            node.attrs = ""
        if len(stack) > DEEPEST and tag not in RAW and tag not in VOID:
            node.kids = stack[-1].kids
        else:
            stack[-1].kids.append(node)
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\s*[^>]*>?", re.I).search(html, at)
            at = close.end() if close else end
        elif tag not in VOID:
            stack.append(node)
            opened[tag] += 1
    return root


def _cut(stack: list[Element], opened: Counter, i: int) -> None:
    opened.subtract(node.tag for node in stack[i:])
    del stack[i:]


def _close(
    stack: list[Element], opened: Counter, tags: set[str], scope: frozenset[str]
) -> None:
    """Close the innermost open element of ``tags``, unless one of ``scope`` is inside it."""
    if not any(opened[tag] for tag in tags):
        return
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in tags:
            _cut(stack, opened, i)
            return
        if stack[i].tag in scope:
            return


def attributes(node: Element) -> dict[str, str]:
    if not node.attrs:
        return {}
    return {
        m[1].lower(): unescape(m[2] or m[3] or m[4] or "")
        for m in ATTRIBUTE.finditer(node.attrs)
    }


def names(values: dict[str, str]) -> list[str]:
    """The parts of class and id, in lower case, cut at hyphens, underscores and humps."""
    both = f"{values.get('class', '')} {values.get('id', '')}"
    both = re.sub(r"([a-z0-9])([A-Z])", r"\1-\2", both)
    return [x for x in re.split(r"[^a-z0-9]+", both.lower()) if x]


def _named(parts: list[str], wanted: frozenset[str]) -> bool:
    return any(
        x in wanted and not (i and parts[i - 1] in UNLESS_AFTER) for i, x in enumerate(parts)
    )


def prune(node: Element, inside: bool = False) -> bool:
    """Drop what the markup names as no content. Tells whether ``node`` holds the article;
    such an element is not dropped for a class name."""
    kids: list[Element | str] = []
    for kid in node.kids:
        if isinstance(kid, str):
            kids.append(kid)
            continue
        if kid.tag in DROPPED_TAGS:
            if kid.tag in BLOCKS:  # still parts what stands before and after it
                kids.append(Element("hr"))
            continue
        values = attributes(kid)
        own = kid.tag in ("article", "main") or values.get("role") in ("main", "article")
        own = own or "articlebody" in values.get("itemprop", "").lower()
        parts = names(values) if "class" in values or "id" in values else []
        hidden = "hidden" in values or values.get("aria-hidden") == "true"
        hidden = hidden or "display:none" in values.get("style", "").replace(" ", "").lower()
        named = kid.tag not in ("html", "body") and _named(parts, DROPPED_NAMES)
        header = kid.tag == "header" or _named(parts, HEADER_NAMES)
        if hidden or values.get("role") in DROPPED_ROLES or (own and named):
            kids.append(Element("hr"))
            continue
        held = prune(kid, inside or own)
        kid.marked = own or held
        if not kid.marked and (named or header):
            # The header of an article holds its title.
            titles = _titles(kid) if header and not named and inside else []
            kids.extend([Element("hr"), *titles])
            continue
        kids.append(kid)
        node.marked = node.marked or kid.marked
    node.kids = kids
    return node.marked


def _titles(node: Element) -> list[Element]:
    found = []
    for kid in node.kids:
        if isinstance(kid, Element):
            found += [kid] if kid.tag in HEADINGS else _titles(kid)
    return found


def size(node: Element) -> int:
    return sum(len(k) if isinstance(k, str) else size(k) for k in node.kids)


def article(root: Element) -> tuple[Element, bool]:
    """The element that holds the main text, and whether the page marks it: the longest
    article, else the main element, else what its name says, else the page."""
    articles, mains, named = [], [], []

    def visit(node: Element, within: bool) -> None:
        for kid in node.kids:
            if isinstance(kid, str):
                continue
            values = attributes(kid)
            own = kid.tag == "article" or values.get("role") == "article"
            if own and not within:
                articles.append(kid)
            elif kid.tag == "main" or values.get("role") == "main":
                mains.append(kid)
            elif "articlebody" in values.get("itemprop", "").lower():
                articles.append(kid)
            elif kid.tag in ("div", "section", "td"):
                whole = "".join(names(values))
                if whole in CONTENT_NAMES or whole.endswith("content"):
                    named.append(kid)
            visit(kid, within or own)

    visit(root, False)
    for found in (articles, mains, named):
        if found:
            return max(found, key=size), True
    return root, False


def blocks(node: Element, gone: frozenset[int] = frozenset(), free: bool = True) -> list[str]:
    """The text of ``node`` by blocks, white space as one blank, without subtrees in ``gone``."""
    found: list[str] = []
    buffer: list[str] = []

    def flush() -> None:
        text = " ".join(unescape("".join(buffer)).split())
        buffer.clear()
        if text:
            found.append(text)

    def visit(node: Element) -> None:
        for kid in node.kids:
            if isinstance(kid, str):
                buffer.append(kid)
                continue
            block = kid.tag in BLOCKS
            if block:
                flush()
            elif kid.tag in ("br", "td", "th", "wbr"):
                buffer.append("" if kid.tag == "wbr" else " ")
            if not (gone and can_repeat(kid, free) and tree(kid) in gone):
                visit(kid)
            if block:
                flush()

    visit(node)
    flush()
    return found


def only_links(node: Element) -> bool:
    """Whether all words of ``node`` stand in links."""
    return all(
        not k.strip() if isinstance(k, str) else k.tag == "a" or only_links(k) for k in node.kids
    )


def can_repeat(node: Element, free: bool) -> bool:
    """Whether ``node`` can be a template: any block outside a marked article, inside one
    boxes and blocks of links; paragraphs that articles share are text."""
    if node.tag not in BLOCKS or node.marked:
        return False
    return free or node.tag in BOXES or only_links(node)


def tree(node: Element) -> int:
    """A hash of the subtree: its tags and words, attributes aside."""
    parts = [node.tag]
    for kid in node.kids:
        parts.append(" ".join(kid.split()) if isinstance(kid, str) else f"<{tree(kid)}>")
    return xxhash.xxh3_64_intdigest("\x00".join(parts)) - (1 << 63)


def trees(node: Element, free: bool) -> set[int]:
    """The subtrees of ``node`` with words that can be templates."""
    found: set[int] = set()
    for kid in node.kids:
        if isinstance(kid, Element):
            if can_repeat(kid, free) and size(kid):
                found.add(tree(kid))
            found |= trees(kid, free)
    return found


def page_trees(html: str) -> tuple[int, list[int]]:
    """The page's shape (a hash of its longest block) and its subtrees."""
    root = parse(html)
    prune(root)
    node, marked = article(root)
    longest = max(blocks(node), key=lambda b: (len(b), b), default="")
    shape = xxhash.xxh3_64_intdigest(longest) - (1 << 63)
    return shape, sorted(trees(node, not marked))


def main_text(html: str, gone: list[int] | None = None) -> str:
    """The main text of a page without the subtrees in ``gone``."""
    root = parse(html)
    prune(root)
    node, marked = article(root)
    return "\n".join(blocks(node, frozenset(gone or ()), not marked))


def host(url: F.Column) -> F.Column:
    name = F.regexp_extract(url, r"^[^/?#]*//(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.coalesce(F.lower(name), F.lit(""))


def extract(pages: DataFrame, max_pages: int = 10, max_share: float = 0.02) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    html = F.coalesce("html", F.lit(""))
    pages = pages.select(
        "page_id", "url", html.alias("html"), F.xxhash64("url", html).alias("page")
    )

    def hash_trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [page_trees(h) for h in batch.column("html").to_pylist()]
            yield table(
                TREES,
                page_id=batch.column("page_id"),
                page=batch.column("page"),
                shape=[r[0] for r in rows],
                trees=[r[1] for r in rows],
                host=batch.column("host"),
            )

    hashed = pages.select("page_id", "page", host(F.col("url")).alias("host"), "html").mapInArrow(
        hash_trees, "page_id long, page long, shape long, trees array<long>, host string"
    )
    hashed = stored(hashed, "page-trees")
    held = hashed.select("host", "shape", F.explode("trees").alias("tree")).distinct()
    hosts = hashed.select("host", "shape").distinct().groupBy("host").count()
    often = held.groupBy("host", "tree").agg(F.count(F.lit(1)).alias("n"))
    often = often.where(F.col("n") > max_pages).join(hosts, "host")
    often = often.where(F.col("n") > F.col("count") * F.lit(max_share)).select("host", "tree")
    own = hashed.select("page_id", "page", "host", F.explode("trees").alias("tree")).distinct()
    gone = own.join(often, ["host", "tree"]).groupBy("page_id", "page").agg(
        F.collect_list("tree").alias("gone")
    )
    same = pages["page_id"].eqNullSafe(gone["page_id"]) & (pages["page"] == gone["page"])
    met = pages.join(gone, same, "left").select(pages["page_id"], "url", "html", "gone")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = list(
                map(main_text, batch.column("html").to_pylist(), batch.column("gone").to_pylist())
            )
            yield table(
                TEXTS,
                page_id=batch.column("page_id"),
                url=batch.column("url"),
                text=texts,
                n_chars=list(map(len, texts)),
            )

    return met.mapInArrow(write, "page_id long, url string, text string, n_chars long")
