"""Main text of web pages by scoring the element tree.

Pages are parsed in the tasks, one at a time. Elements that are no part of an
article by their tag or role (menus, headers, footers, sidebars, dialogs, scripts)
or unseen are left out of the tree. Those left out by class, id or as a form
(notices, adverts, comments) are scored first, and stay if they hold an article or
main element, or most of the page's points where there is no such element. Each paragraph gives
points for its length and commas to its parent, and half of them to its
grandparent; a container's points are discounted by the part of its text that
is in links. The best container counts, widened to the article or main element
around it with those siblings that score well themselves; on pages without such
elements, with all of its siblings and the bare text beside it but what is mostly links.

Defined results: null, empty and text-less pages give an empty text; unclosed
and stray tags are tolerated; a page is read once from front to end, so very long
pages take linear time; equal rows give equal results.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import col, ship

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg object canvas audio video".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead "
    "tr ul".split()
)
OUT_TAGS = frozenset("nav header footer aside menu dialog button select option label fieldset input head".split())
OUT_NAMES = frozenset(
    "ad ads adsbygoogle advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs header masthead footer sidebar aside rail widget widgets comment commentlist comments disqus replies respond "
    "notice notices cookie cookies consent gdpr alert popup modal overlay subscribe subscription newsletter signup login share "
    "sharing social related recommended pagination pager form search toolbar".split()
)
# a name with one of these says what a page has, or names a part of the article
LINKING = frozenset("has have is with without no not in on under over and or".split())
ARTICLE_PARTS = frozenset("post article entry story content section text title".split())
SIDES = frozenset("left right top bottom".split())
# what such a name may end with when it names a container of the thing or a part of it
HOLDERS = frozenset(
    "area bar block blocks box button buttons container content group holder icon icons inner item items links list outer panel row slot "
    "slots unit wrap wrapper zone".split()
)
#: So much of a page's points keeps an element that its name would leave out.
MOST = 0.6
OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
PARAGRAPHS = frozenset("p pre blockquote td li dd div section article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# an open element of the second kind ends where one of the first begins
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}

_TAG = re.compile(r"/?([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_LOOSE_TAG = re.compile(r"/?([A-Za-z][^\s/>]*)([^>]*+)>")
_ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    __slots__ = ("block", "children", "links", "named", "out", "parent", "points", "tag", "chars")

    def __init__(self, tag: str, parent: "Node | None", out: bool, named: bool = False):
        self.tag, self.parent, self.out, self.named = tag, parent, out, named
        self.children: list[Node | str] = []
        self.points, self.chars, self.links = 0.0, 0, 0
        # the nearest block that this element is or is in
        self.block: Node = self if tag in BLOCKS or parent is None else parent.block


def out_name(token: str) -> bool:
    """Whether a class or id names something outside the article: by its last part, as in reader-comments or comments-area."""
    parts = [w.lower() for w in _NAME.findall(token)]
    while len(parts) > 1 and (parts[-1] in SIDES or parts[-1] in HOLDERS):
        parts.pop()
    if not parts or parts[-1] not in OUT_NAMES or not LINKING.isdisjoint(parts):
        return False
    return parts[-1] not in ("header", "footer", "banner") or ARTICLE_PARTS.isdisjoint(parts)


def left_out(tag: str, attributes: str) -> tuple[bool, bool]:
    """(out whatever it holds, out by its name only)."""
    if tag in OUT_TAGS:
        return True, False
    named = tag == "form"
    if not attributes or tag in ("html", "body", "article", "main") and "comment" not in attributes.lower():
        return False, named
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and _UNSEEN.search(value):
            return True, False
        if name == "role":
            named = named or value.strip().lower() == "form"
            if value.strip().lower() in OUT_ROLES - {"form"}:
                return True, False
        elif name in ("class", "id") and not named:
            named = any(map(out_name, value.split()))
    return False, named


def parse(page: str) -> Node:
    """The element tree; text of elements left out isn't in it.

    ``opened`` counts the open elements of each tag, so that an end tag of none is passed over at once.
    """
    root, opened = Node("html", None, False), Counter()
    here, at, n = root, 0, len(page)
    while at < n:
        begin = page.find("<", at)
        if begin < 0:
            begin = n
        if begin > at and not here.out:
            here.children.append(page[at:begin])
        if begin == n:
            break
        if page.startswith("<!--", begin):
            end = page.find("-->", begin + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), begin):
            end = page.find(">", begin)
            at = n if end < 0 else end + 1
            continue
        m = _TAG.match(page, begin + 1) or _LOOSE_TAG.match(page, begin + 1)
        if not m:
            if page.find(">", begin) < 0 and re.match(r"/?[A-Za-z]", page[begin + 1 : begin + 3]):
                break  # a tag cut off by the page's end
            if not here.out:
                here.children.append("<")
            at = begin + 1
            continue
        at, tag = m.end(), m[1].lower()
        if page[begin + 1] == "/":
            if opened[tag]:
                up = here
                while up.tag != tag:
                    up = up.parent
                here = _back(here, up.parent, opened)
            if tag in BLOCKS and not here.out:
                here.children.append(Node("", here, False))
            continue
        if tag in VOID:
            if tag in ("br", "hr") and not here.out:
                here.children.append(Node("", here, False))
            continue
        if tag in RAW:
            if not m[2].endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}[\s>/]", re.I).search(page, at)
                end = page.find(">", close.start()) if close else -1
                at = n if end < 0 else end + 1
            continue
        here = _back(here, _parent_for(tag, here, opened), opened)
        out, named = (True, False) if here.out else left_out(tag, m[2])
        node = Node(tag, here, out, named)
        if not node.out:
            here.children.append(node)
        if not m[2].endswith("/") or tag in BLOCKS:
            here = node
            opened[tag] += 1
    return root


def _back(here: Node, to: Node, opened: Counter) -> Node:
    """Goes up from ``here``, which ends all elements below ``to``; each ends once, so all ways up are as long as the page."""
    while here is not to:
        opened[here.tag] -= 1
        here = here.parent
    return to


def _parent_for(tag: str, here: Node, opened: Counter) -> Node:
    """Where a new element goes, after the ends that HTML lets authors leave out."""
    if tag in BLOCKS and here.block.tag == "p":
        return here.block.parent
    if tag in ENDS and any(opened[t] for t in ENDS[tag]):
        up = here
        while up.parent and up.tag not in SCOPES.get(tag, ()):
            if up.tag in ENDS[tag]:
                return up.parent
            up = up.parent
    return here


def _flat(root: Node) -> list[Node]:
    """All elements, parents before children; a loop, since trees can be deep."""
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        found.append(node)
        todo.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return found


def measure(nodes: list[Node]) -> dict[int, float]:
    """The points of each paragraph; ``chars`` and ``links`` of all nodes are set."""
    own = {id(x): sum(len(c.split()) and len(c.strip()) for c in x.children if isinstance(c, str)) for x in nodes}
    commas = {id(x): sum(c.count(",") for c in x.children if isinstance(c, str)) for x in nodes}
    text, found = dict(own), dict(commas)
    for x in nodes:
        x.chars = x.links = 0
    for x in reversed(nodes):  # children first
        x.chars += own[id(x)]
        x.links = x.chars if x.tag == "a" else x.links
        if up := x.parent:
            up.chars += x.chars
            up.links += x.links
            if x.tag not in BLOCKS and x.tag:  # inline: part of its parent's paragraph
                text[id(up)] = text.get(id(up), 0) + text[id(x)]
                found[id(up)] = found.get(id(up), 0) + found[id(x)]
    return {id(x): 1 + found[id(x)] + min(text[id(x)] / 100, 3) for x in nodes if x.tag in PARAGRAPHS and text[id(x)]}


def score(nodes: list[Node]) -> None:
    points = measure(nodes)
    for x in nodes:
        if id(x) in points:
            takes = x if x.tag in ("div", "section", "article", "main") else x.parent
            if takes:
                takes.points += points[id(x)]
                if takes.parent:
                    takes.parent.points += points[id(x)] / 2


def without_named(root: Node, nodes: list[Node]) -> list[Node]:
    """Takes elements out by their name, unless they hold the article; those left, parents before children."""
    points = measure(nodes)
    held, anchors = {}, {}  # points but those of links, and article or main elements, with all below
    for x in reversed(nodes):
        own = points.get(id(x), 0.0) * (1 - x.links / x.chars if x.chars else 0)
        held[id(x)] = own + sum(held[id(c)] for c in x.children if isinstance(c, Node))
        anchor = x.tag in ("article", "main") and not x.named
        anchors[id(x)] = anchor + sum(anchors[id(c)] for c in x.children if isinstance(c, Node))
    gone: dict[int, tuple[Node, set[int]]] = {}
    for x in nodes:
        if x.named and x.parent:
            most = not anchors[id(root)] and held[id(x)] > MOST * held[id(root)]
            if not anchors[id(x)] and not most:
                gone.setdefault(id(x.parent), (x.parent, set()))[1].add(id(x))
    for up, lost in gone.values():
        up.children = [c for c in up.children if id(c) not in lost]
    return _flat(root)


def _beside(parent: Node, best: Node) -> list[Node | str]:
    """All children but those that are mostly links; bare text and inline elements in a row count as one."""
    keep: list[Node | str] = []
    row: list[Node | str] = []

    def close() -> None:
        chars = sum(len(x.strip()) if isinstance(x, str) else x.chars for x in row)
        if 2 * sum(x.links for x in row if isinstance(x, Node)) <= chars:
            keep.extend(row)
        row.clear()

    for x in parent.children:
        if isinstance(x, str) or x.tag and x.tag not in BLOCKS and x is not best:
            row.append(x)
            continue
        close()
        if x is best or 2 * x.links <= x.chars:
            keep.append(x)
    close()
    return keep


def main_nodes(root: Node) -> list[Node | str]:
    """The best container and the siblings kept with it, in page order."""
    nodes = _flat(root)
    if any(x.named for x in nodes):
        nodes = without_named(root, nodes)
    score(nodes)
    value = lambda x: x.points * (1 - x.links / x.chars if x.chars else 0)
    best = max(nodes, key=value)  # the first of equals
    if value(best) <= 0:
        return [root]
    up = best
    while up.parent:
        if up.tag in ("article", "main"):
            best = up
        up = up.parent
    if not best.parent:
        return [best]
    if best.tag not in ("article", "main"):
        return _beside(best.parent, best)
    least = 0.2 * value(best)
    keep = []
    for x in best.parent.children:
        if not isinstance(x, Node):
            continue
        dense = x.links / x.chars if x.chars else 1
        if x is best or value(x) >= max(least, 1) or x.tag in HEADINGS and dense < 0.3 or x.tag == "p" and x.chars > 80 and dense < 0.25:
            keep.append(x)
    return keep


def _blocks(nodes: list[Node | str]) -> Iterator[str]:
    line: list[str] = []
    todo: list[Node | str | None] = list(reversed(nodes))
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            line.append(x)
        elif x is None or not x.tag:
            yield "".join(line)
            line = []
        else:
            if x.tag in BLOCKS:
                yield "".join(line)
                line = []
                todo.append(None)
            todo.extend(reversed(x.children))
    yield "".join(line)


def main_text(page: str | None) -> str:
    if not page:
        return ""
    blocks = (" ".join(html.unescape(b).split()) for b in _blocks(main_nodes(parse(page))))
    return "\n".join(b for b in blocks if b)


def extract(pages: DataFrame, id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of each row of ``pages``."""
    schema = T.StructType(
        [T.StructField("id", pages.schema[id].dataType), T.StructField("url", pages.schema[url].dataType), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py()) for p in batch["page"]]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=schema.names
            )

    ship(pages.sparkSession)
    return pages.select(col(id).alias("id"), col(url).alias("url"), col(page).alias("page")).mapInArrow(run, schema)
