"""Main text of web pages by tree scoring.

Each paragraph gives points for its length and commas to its container, which passes half of its points to its parent, and so on; a container's
points are discounted by its share of linked text, and doubled if it calls itself the article or main part. The best container and those of its
siblings that carry comparable text are kept, and their blocks are joined in page order. Every pass over a page is linear.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talweg.llm.common import ready, table

_RAW = "script style noscript template textarea title iframe svg math object canvas select".split()
#: Attributes up to the tag's end. A value is quoted only after "=", and only if its quote is closed somewhere; else it ends at white space or the tag's end.
_ATTRIBUTES = r"""(?:[^>=]|=\s*(?:"[^"]*"|'[^']*'|[^\s"'>][^\s>]*)?)*"""
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<raw>{'|'.join(_RAW)})\b{_ATTRIBUTES}(?:>.*?(?:</(?P=raw)\s*>|\Z)|\Z)"
    rf"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>{_ATTRIBUTES})(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_DROPPED = frozenset("nav header footer aside form button dialog menu head input label".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
_MAIN = frozenset(("article", "main"))
#: What a start tag ends, if it is open, and where the search for it stops.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "body": ({"head"}, {"html"}),
}
#: Parts of class names and ids that mark what is not the article.
_UNLIKELY = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox sponsor sponsored promo promotion nav navbar navigation menu submenu "
    "sidebar sidenav aside footer header masthead topbar breadcrumb breadcrumbs comment comments commentlist discussion disqus reply replies "
    "respond cookie cookies consent gdpr notice notices notification alert banner popup modal overlay share sharing social related "
    "recommended newsletter subscribe subscription signup login search searchbox form widget toolbar pagination pager skip rss feedback".split()
)
_LIKELY = frozenset("article content body main post entry story text".split())
#: Those that mark reader comments, also on an article of its own.
_COMMENTS = frozenset("comment comments commentlist discussion disqus reply replies respond".split())
_STRONG = _COMMENTS | frozenset("ad ads sidebar footer nav menu related".split())
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
#: Share of its points that an element passes to its parent, bonus of an element that calls itself the main part, share of
#: the best points that a sibling needs, and share of linked text from which on a block or sibling is no prose.
PASSED, BONUS, SIBLING, LINKED = 0.5, 2.0, 0.2, 0.33
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_INNER = _HEADINGS | frozenset("p pre li blockquote".split())


class _Node:
    __slots__ = ("tag", "parent", "block", "dropped", "main", "points", "chars", "linked", "depth")

    def __init__(self, tag: str, parent: _Node | None, dropped: bool = False, main: bool = False):
        self.tag, self.parent, self.dropped, self.main = tag, parent, dropped, main
        #: The nearest block element, itself included.
        self.block: _Node = self if parent is None or tag in _BLOCK else parent.block
        self.points, self.chars, self.linked = 0.0, 0, 0
        self.depth = 0 if parent is None else parent.depth + 1


def _marks(tag: str, attrs: str) -> tuple[bool, bool]:
    """Whether an element is no part of an article, and whether it names itself the main part."""
    dropped, main = tag in _DROPPED, tag in _MAIN
    if not attrs or attrs == "/":
        return dropped, main
    for name, value in _ATTRIBUTE.findall(attrs):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id"):
            if tag in ("html", "body"):
                continue
            words = {w.lower() for w in _WORDS.findall(value)}
            if main:
                dropped |= bool(words & _COMMENTS)
            elif words & _UNLIKELY and not (words & _LIKELY and not words & _STRONG):
                dropped = True
        elif name == "role":
            dropped |= value.lower() in _ROLES
            main |= value.lower() in ("main", "article")
        elif name == "itemprop":
            main |= value == "articleBody"
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and "display:none" in value.replace(" ", "").lower():
            dropped = True
    return dropped, main


def _read(html: str) -> tuple[list[_Node], list[tuple[_Node, str, int]]]:
    """All elements, parents first, and the blocks in page order: innermost block element, text, characters of it in links."""
    root = _Node("#", None)
    nodes, blocks = [root], []
    node, links, at, linked, run = root, 0, 0, 0, []
    opened: dict[str, int] = {}  # open elements by tag

    def flush() -> None:
        nonlocal linked
        if run:
            text = "".join(run)
            text = " ".join((unescape(text) if "&" in text else text).split())
            if text:
                blocks.append((node.block, text, min(linked, len(text))))
            run.clear()
        linked = 0

    def pop_to(target: _Node) -> None:
        """Leave all elements down to and with the target."""
        nonlocal node, links
        while True:
            links -= node.tag == "a"
            opened[node.tag] -= 1
            left, node = node, node.parent
            if left is target:
                return

    for found in _TOKEN.finditer(html):
        start = found.start()
        if start > at and not node.dropped:
            run.append(html[at:start])
            if links:
                linked += start - at
        at = found.end()
        tag = found["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            if run:
                run.append(" ")
            continue
        if tag in _BLOCK:
            flush()
        if found["close"]:
            if opened.get(tag):
                target = node
                while target.tag != tag:
                    target = target.parent
                pop_to(target)
            continue
        if tag in _BLOCK and node.block.tag == "p":  # a paragraph ends where a block starts
            pop_to(node.block)
        if tag in _ENDS and any(opened.get(t) for t in _ENDS[tag][0]):
            ended, stop = _ENDS[tag]
            inner, last = node, None
            while inner is not root and inner.tag not in stop:
                if inner.tag in ended:
                    last = inner
                inner = inner.parent
            if last is not None:
                pop_to(last)
        if tag in _VOID:
            continue
        dropped, main = _marks(tag, found["attrs"])
        node = _Node(tag, node, dropped or node.dropped, main)
        nodes.append(node)
        opened[tag] = opened.get(tag, 0) + 1
        links += tag == "a"
    if at < len(html) and not node.dropped:
        run.append(html[at:])
    flush()
    return nodes, [b for b in blocks if not b[0].dropped]


def _score(nodes: list[_Node], blocks: list[tuple[_Node, str, int]]) -> None:
    """Points, characters and linked characters of every element, each added to its parent once."""
    for owner, text, linked in blocks:
        container = owner.parent if owner.tag in _INNER and owner.parent else owner
        container.points += (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - linked / len(text))
        owner.chars += len(text)
        owner.linked += linked
    for n in reversed(nodes):
        if n.parent is not None:
            n.parent.points += PASSED * n.points
            n.parent.chars += n.chars
            n.parent.linked += n.linked


def _rank(n: _Node) -> float:
    return n.points * (1 - n.linked / n.chars) * (BONUS if n.main else 1.0) if n.chars else 0.0


def extract(html: str | None) -> str:
    """The main text of a page; null, empty and textless pages give an empty one.

    Kept are the container that ranks best, siblings that rank comparably, and prose blocks beside it.
    """
    nodes, blocks = _read(html or "")
    if not blocks:
        return ""
    _score(nodes, blocks)
    best = max(nodes, key=lambda n: (_rank(n), n.depth))
    beside, least = best.parent, SIBLING * _rank(best)
    own = beside is not None and (beside.main or beside.tag not in ("body", "html", "#"))

    def prose(n: _Node) -> bool:
        """A heading or paragraph next to the best container; directly in the page's body only one of some length."""
        if not n.chars or n.linked / n.chars >= LINKED or n.tag not in _INNER:
            return False
        return n.chars >= 80 or own

    kept: dict[int, tuple[bool, bool]] = {}  # whether an element is kept, and whether it is inside a menu
    for n in nodes:
        inside, menu = kept[id(n.parent)] if n.parent else (False, False)
        if n is best:
            inside = True
        elif beside is not None and n.parent is beside and n.chars and n.linked / n.chars < LINKED:
            # Beside a part that calls itself the main one, only others that do so belong to it.
            inside = inside or (n.main or not best.main) and (_rank(n) >= max(3.0, least) or prose(n))
        menu = menu or n.tag in ("ul", "ol", "table", "dl") and n.chars > 0 and n.linked / n.chars > 0.6
        kept[id(n)] = inside, menu
    chosen = []
    for owner, text, linked in blocks:
        inside, menu = kept[id(owner)]
        # Text of the container's parent itself, in no element of its own.
        loose = owner is beside and own and linked / len(text) < LINKED
        if (inside or loose) and not menu:
            chosen.append(text)
    return "\n".join(chosen)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) for every row.

    Null or empty html gives an empty text; repeated rows stay; an empty table gives an empty
    result; other columns are ignored. Pages are independent, so nothing is shuffled.
    """

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(extracted, "page_id long, url string, text string, n_chars long")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_pages(table(spark, sf_dir, "pages"))


#: Enough for the given pages, whose articles stand in one element.
OP4_SQL = r"""
WITH parts AS (
  SELECT page_id, url, list_filter(list_transform(
    string_split(regexp_replace(regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1),
      '<br>', ' ', 'g'), '</?(p|h1)>', chr(1), 'g'), chr(1)),
    lambda s: trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(s, '<[^>]*>', '', 'g'),
      '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', chr(39)), '&amp;', '&'), '\s+', ' ', 'g'))),
    lambda s: s <> '') AS blocks
  FROM pages)
SELECT page_id, url, array_to_string(blocks, chr(10)) AS text, length(array_to_string(blocks, chr(10))) AS n_chars FROM parts
"""

QUERIES = {"op4_html_extraction": ready(op4_html_extraction)}
ORACLES = {"op4_html_extraction": OP4_SQL}
