"""Main text of web pages by composite text density.

A page becomes a tree. What markup names as boilerplate (menus, headers,
footers, sidebars, notices, adverts, forms, comments of readers, scripts) is cut
off; a class or id does so only if all its words name a part of that kind, so that
those that tell the layout or a topic cut nothing, and a form that is wrapped around the page stays. Every remaining node gets its composite text density: characters per tag,
adjusted by how much of the text is link text. The densities of a node's
children are summed. The node with the largest sum is the core of the text; the
lowest density on its path up to the body is the threshold, and further
subtrees, each again the one of the largest sum, belong to the text if their
densities reach it. Text that lies bare beside blocks is a subtree of its own, and
a paragraph is never cut within. Densities choose on every page; a named article
(``<article>``, ``<main>``) that holds a chosen subtree is then taken whole, so
that its short paragraphs stay.

Defined results: a null or empty page, and one without text outside of
boilerplate, gives an empty text; repeated rows give equal texts, and an empty table an empty result; unclosed and stray tags are repaired as
browsers do; text without any markup is one block. Pages of any length and depth
are read whole; nothing recurses.
"""

from __future__ import annotations

import html as _html
import math
import re
from collections import Counter

from pyspark.sql import DataFrame

from stratalake.llm.common import map_texts

# Names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody "
    "tfoot thead tr ul".split()
)
INLINE_GAPS = frozenset("br td th option".split())
CELLS = INLINE_GAPS - {"br"}
CUT_TAGS = frozenset(
    "script style noscript template iframe object embed applet canvas svg math audio video map head title nav menu "
    "footer aside form button select textarea input label fieldset dialog search".split()
)
CUT_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar "
    "tablist status note".split()
)
# Words in class or id that name boilerplate.
CUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation "
    "menu menubar topbar header masthead footer sidebar sidebars side aside widget widgets breadcrumb breadcrumbs comment comments "
    "commentlist disqus respond reply replies cookie cookies consent gdpr notice notices notification popup modal overlay "
    "newsletter subscribe subscription signup login social share sharing related recommended pagination pager skip toolbar "
    "form search".split()
)
# Words beside them that say what a part is built as. A name with any other word speaks of its content, as "search-algorithms" does.
PART_WORDS = frozenset(
    "area aside bar block body bottom box btn button buttons card col column container content desktop el entry floating foot global "
    "group head holder icon icons inner item items js left line link links list main middle mobile module outer page panel post posts "
    "primary region right row secondary section site sticky tab text title top unit user view wrap wrapper wp".split()
)
# Words that make a name tell the layout, as "has-sidebar" does.
LAYOUT_WORDS = frozenset("no has have with without not non hide show padding padded margin gap spacing offset width layout".split())
MAIN_TAGS = frozenset(["article", "main"])
# A form with so much text, and with so many times the text outside of it, is wrapped around the page.
FORM_CHARS, FORM_TIMES = 200, 4
# The name of a run of bare text and inline elements that lies beside blocks.
RUN = ""
CLOSES_P = BLOCKS - {"body", "html", "caption", "tbody", "thead", "tfoot", "tr"}
# An opening tag ends an open element of these names, unless one of the second kind lies between.
ENDS_OPEN = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dd": (frozenset(["dd", "dt"]), frozenset(["dl"])),
    "dt": (frozenset(["dd", "dt"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "tbody": (frozenset(["tbody", "thead", "tfoot", "tr", "td", "th"]), frozenset(["table"])),
    "tfoot": (frozenset(["tbody", "thead", "tfoot", "tr", "td", "th"]), frozenset(["table"])),
}
# What a stray end tag or an implied end must not break out of.
NONE, P = frozenset(), frozenset(["p"])
SCOPE = frozenset("body html table td th caption button object article section main".split())

# A quote counts after an equals sign only, so that an apostrophe in a broken tag swallows nothing.
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_WORDS = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none")


class Node:
    """An element. children: nodes and pieces of text in page order."""

    __slots__ = ("tag", "parent", "children", "cut", "article", "chars", "tags", "link_chars", "link_tags", "density", "total", "blocky")

    def __init__(self, tag: str, parent: Node | None, cut: bool = False, article: bool = False):
        self.tag, self.parent, self.cut, self.article = tag, parent, cut, article
        self.children: list[Node | str] = []
        self.blocky = tag in BLOCKS or tag in CELLS  # or holds such an element


def _names_boilerplate(names: str) -> frozenset[str]:
    """The words of boilerplate in a class or id. Each name in it is judged by all its words."""
    found = set()
    for name in names.split():
        words = set(_WORDS.findall(name))
        if not words & LAYOUT_WORDS and words <= CUT_WORDS | PART_WORDS:
            found |= words & CUT_WORDS
    return frozenset(found)


def _is_cut(tag: str, attributes: str, inside: bool) -> tuple[bool, bool]:
    """(boilerplate by its markup, names the article). inside: within an article, where a header belongs to the text."""
    if tag in CUT_TAGS:
        return True, False
    named = tag in MAIN_TAGS
    cut = tag == "header" and not inside
    if "=" in attributes or "hidden" in attributes:
        for name, *values in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), "".join(values).lower()
            if name == "role":
                cut |= value in CUT_ROLES
                named |= value in ("main", "article")
            elif name in ("class", "id") and tag not in ("html", "body"):
                found = _names_boilerplate(value)
                cut |= bool(found) and tag != "main" and not (tag == "article" and found <= {"header", "side"})
        cut |= tag not in ("html", "body") and bool(_HIDDEN.search(attributes.lower()))
    return cut, named and not cut


def parse(page: str) -> Node:
    """The tree of a page. Its root is a body, whatever the page has."""
    root = node = Node("body", None)
    opened: Counter[str] = Counter()  # open elements by name: what isn't open needs no search
    at, end = 0, len(page)

    def up_to(outer: Node) -> Node:
        scan = node
        while scan is not outer:
            opened[scan.tag] -= 1
            scan = scan.parent
        return outer

    while at < end:
        m = _MARKUP.search(page, at)
        if m is None:
            node.children.append(page[at:])
            break
        if m.start() > at:
            node.children.append(page[at : m.start()])
        at = m.end()
        closing, tag, attributes = m[1], m[2], m[3]
        if not tag:
            continue
        tag = tag.lower()
        if tag in ("html", "body"):
            continue
        if closing:
            if tag == "br":
                node.children.append(Node("br", node))
            elif opened[tag] > 0:
                scan = node
                while scan.tag != tag and not (scan.tag in SCOPE and tag not in BLOCKS):
                    scan = scan.parent
                if scan.tag == tag:
                    node = up_to(scan.parent)
            continue
        ends, bounds = ENDS_OPEN.get(tag, (NONE, NONE))
        if tag in CLOSES_P:
            ends = ends | P
        if any(opened[x] > 0 for x in ends):
            scan, last = node, None
            while scan is not root:
                if scan.tag in ends:
                    last = scan
                    if tag not in ("tr", "tbody", "tfoot"):
                        break
                elif scan.tag in bounds or scan.tag in SCOPE:
                    break
                scan = scan.parent
            if last is not None:
                node = up_to(last.parent)
        inside = tag == "header" and any(opened[x] > 0 for x in MAIN_TAGS)
        cut, article = _is_cut(tag, attributes, inside)
        child = Node(tag, node, cut, article)
        node.children.append(child)
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, at)
            child.children.append(page[at : close.start()] if close else page[at:])
            child.cut = True
            at = close.end() if close else end
        elif tag not in VOID:
            opened[tag] += 1
            node = child
    _free_forms(root)
    _wrap_runs(root)
    return root


def _text_chars(root: Node) -> int:
    """Characters of kept text outside of links."""
    count, stack = 0, [root]
    while stack:
        for x in stack.pop().children:
            if isinstance(x, str):
                count += len(x.strip())
            elif not x.cut and x.tag != "a":
                stack.append(x)
    return count


def _free_forms(root: Node) -> None:
    """A form that holds nearly all of the page's text is no form of the page, but wrapped around it."""
    while True:
        forms = [x for node in _preorder(root) for x in node.children if isinstance(x, Node) and x.cut and x.tag == "form"]
        if not forms:
            return
        largest = max(forms, key=_text_chars)
        chars = _text_chars(largest)
        if chars < FORM_CHARS or chars < FORM_TIMES * _text_chars(root):
            return
        largest.cut = False


def _preorder(root: Node) -> list[Node]:
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(x for x in reversed(node.children) if isinstance(x, Node) and not x.cut)
    return out


def _wrap_runs(root: Node) -> None:
    """Marks what holds blocks, and makes a node of every run of text and inline elements that lies beside blocks."""
    for node in reversed(_preorder(root)):
        kids = [x for x in node.children if isinstance(x, Node) and not x.cut and x.blocky]
        node.blocky |= bool(kids)
        if not kids or not any(isinstance(x, str) and not x.isspace() for x in node.children):
            continue
        out: list[Node | str] = []
        run: list[Node | str] = []
        for x in [*node.children, None]:
            if x is not None and (isinstance(x, str) or not x.blocky):
                run.append(x)
                continue
            if any(isinstance(y, str) and not y.isspace() for y in run):
                made = Node(RUN, node)
                made.children = run
                for y in run:
                    if isinstance(y, Node):
                        y.parent = made
                out.append(made)
            else:
                out += run
            run = []
            if x is not None:
                out.append(x)
        node.children = out


def measure(root: Node) -> list[Node]:
    """All kept nodes in page order, with their densities and the sums over their children."""
    nodes = _preorder(root)
    for node in reversed(nodes):
        own = sum(len(" ".join(_html.unescape(x).split())) for x in node.children if isinstance(x, str))
        kids = [x for x in node.children if isinstance(x, Node) and not x.cut]
        node.chars = own + sum(x.chars for x in kids)
        node.tags = sum((x.tag != RUN) + x.tags for x in kids)
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, 1 + sum(x.link_tags for x in kids)
        else:
            node.link_chars, node.link_tags = sum(x.link_chars for x in kids), sum(x.link_tags for x in kids)
    link_share = root.link_chars / root.chars if root.chars else 0.0
    for node in nodes:
        c, t, lc, lt = node.chars, max(node.tags, 1), node.link_chars, node.link_tags
        if not c:
            node.density = 0.0
        elif not lc:
            node.density = c / t
        else:
            base = math.log(c / max(c - lc, 1) * lc + link_share * c + math.e)
            node.density = max(0.0, c / t * math.log(max(c / lc * t / max(lt, 1), 1.0)) / base)
    for node in reversed(nodes):
        # A run is no element: its children count as its parent's.
        node.total = sum(x.total if x.tag == RUN else x.density for x in node.children if isinstance(x, Node) and not x.cut)
        # Text that lies directly in a node counts as one child, else a paragraph would never be a core.
        own = sum(len(x.strip()) for x in node.children if isinstance(x, str))
        node.total += own if node.tag != "a" else 0
    return nodes


def select(root: Node) -> list[Node]:
    """The disjoint subtrees that make up the text, in page order."""
    nodes = measure(root)
    if not root.chars:
        return []
    # The node of the largest sum in each subtree, of equals the first one.
    top: dict[int, Node] = {}
    for node in reversed(nodes):
        found = [top[id(x)] for x in node.children if isinstance(x, Node) and not x.cut]
        top[id(node)] = max([node, *found], key=lambda n: n.total)
    core = top[id(root)]
    threshold, scan = core.density, core
    while scan is not None:
        threshold, scan = min(threshold, scan.density), scan.parent
    chosen: list[Node] = []
    stack = [root]
    while stack:
        node = stack.pop()
        if node.density < threshold or not node.chars:
            continue
        best = top[id(node)]
        # What is within a paragraph stands for the paragraph.
        while best is not node and best.tag != RUN and not best.blocky:
            best = best.parent
        chosen.append(best)
        # Siblings along the way down to the chosen subtree are judged on their own.
        scan = best
        while scan is not node:
            stack.extend(x for x in scan.parent.children if isinstance(x, Node) and not x.cut and x is not scan)
            scan = scan.parent
    # A named article that holds a chosen subtree is taken whole, the outermost one. The tree may be deep, so each is looked up once.
    article: dict[int, Node] = {}
    for node in nodes:
        above = article.get(id(node.parent))
        if above is not None or node.article:
            article[id(node)] = above or node
    wanted = {id(article.get(id(n), n)) for n in chosen}
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if id(node) in wanted:
            out.append(node)
        else:
            stack.extend(x for x in reversed(node.children) if isinstance(x, Node) and not x.cut)
    return out


def text_of(subtrees: list[Node]) -> str:
    """Blocks of the subtrees in page order, one per line."""
    blocks: list[str] = []
    pieces: list[str] = []

    def flush() -> None:
        if block := " ".join("".join(pieces).split()):
            blocks.append(block)
        pieces.clear()

    stack: list[Node | str | None] = []
    for tree in subtrees:
        flush()
        stack.append(tree)
        while stack:
            x = stack.pop()
            if x is None:
                flush()
            elif isinstance(x, str):
                pieces.append(_html.unescape(x))
            elif not x.cut:
                if x.tag in BLOCKS:
                    flush()
                    stack.append(None)
                elif x.tag in INLINE_GAPS:
                    pieces.append(" ")
                stack.extend(reversed(x.children))
    flush()
    return "\n".join(blocks)


def main_text(page: str | None) -> str:
    return text_of(select(parse(page))) if page else ""


def extract(pages: DataFrame, column: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with the main text of ``column`` in ``into``, which replaces a column of that name."""
    return map_texts(pages, column, {into: "string"}, lambda: lambda rows: [(main_text(page),) for page in rows])
