"""Main text of web pages by tree scoring.

A page becomes a tree. Paragraphs pass points for their length and commas to their ancestors, less the
farther away; a container's points are discounted by the share of its text that stands in links. The
best container, its article element if it has one, and siblings that look like it are kept. Menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are taken out
before, by element, role and the words of class and id. A form or wrapper stays, whatever it is called, if
it holds all the page's articles or, on a page without any, most of the prose; marked parts in it go. A name that only
begins with such a word, as notice-period does, is a hint that unlinked prose overrules, and never takes a heading.

The text: character references decoded, white space inside a block turned into one space, blocks in
page order joined by line ends. Nothing is capped.

Defined results: null or empty html, and pages without text, give the empty text; broken markup is
read as browsers read it (paragraphs end where a block begins, unknown end tags are ignored);
repeated rows give equal rows.

Scale: one scan, no shuffle. Scoring looks at five ancestors per paragraph and walks without
recursion, so a page costs time in proportion to its length, however deep it is nested.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from voltspan.llm.common import append_columns

# fixed values: element names and their kinds as HTML defines them
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp noscript".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option optgroup p pre search section summary "
    "table tbody td tfoot th thead tr ul".split()
)
# what ends an element whose end tag may be left out, up to the element that bounds the search
ENDED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
BLOCK_BUT_P = BLOCK - {"p"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# what isn't main text: by element, by role, by a word of class or id
DROPPED = frozenset(
    "head script style noscript template iframe object embed svg canvas nav footer aside select button textarea input "
    "datalist dialog menu search".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary dialog alertdialog alert search menu menubar toolbar form".split())
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox adslot sponsor sponsored promo promotion promoted "
    "sidebar sidebars aside nav navbar navigation menu menus breadcrumb breadcrumbs footer foot masthead topbar toolbar "
    "banner cookie cookies consent gdpr notice notices alert alerts notification popup modal overlay newsletter subscribe "
    "subscription signup signin login comment comments commentlist disqus respond replies reply discussion share sharing "
    "social related recommended recommendations widget widgets pagination pager skip hidden copyright paywall".split()
)
# parts with prose of their own, which may be longer than the main text
OWN_PROSE = frozenset(
    "comment comments commentlist disqus respond replies reply discussion cookie cookies consent gdpr notice notices "
    "alert alerts notification popup modal overlay newsletter subscribe subscription copyright".split()
)
# words that say nothing about what a part holds, so a name of these and dropped words is as plain as a dropped word
NEUTRAL_WORDS = frozenset(
    "area article articles bar block body bottom box button buttons btn col column container content cta desktop element field first form "
    "global group header heading here holder icon icons info inner item items js label last latest left link links list main message mobile "
    "module now outer page panel popular post posts primary recent region right row secondary section site slot story stories text this "
    "thread title toggle top unit us warning wrap wrapper you your".split()
)
ARTICLE_WORDS = frozenset("article articlebody post entry story hentry".split())
NOT_OWN = frozenset("with has no without is not".split())

# comments, other markup that isn't an element, and tags with their attributes; a quoted value may hold < and >,
# and a quote that is never closed counts as part of a name
_TAG = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|"
    r"<(/?)([a-zA-Z][^\s/>]*+)("
    r"(?:[\s/]++|(?:=[^\s/>=]*+|[^\s/>=]++)(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?)?)*+(?:>|\Z))",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z][\w:.-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_COMMA = re.compile("[,،、，﹐]")


class Node:
    __slots__ = ("tag", "parent", "parts", "attributes", "dropped", "inside", "bodies", "marked", "hinted", "whole", "prose", "clear", "chars", "linked", "points")

    def __init__(self, tag: str, parent: "Node | None", attributes: dict[str, str]):
        self.tag, self.parent, self.attributes = tag, parent, attributes
        self.parts: list[Node | str] = []
        self.inside = bool(parent) and (parent.inside or parent.tag in ("article", "main"))
        self.dropped, self.bodies, self.chars, self.linked, self.points = False, 0, 0, 0, 0.0
        self.marked, self.hinted, self.whole, self.prose, self.clear = False, False, 0, 0, 0

    def up(self):
        node = self.parent
        while node:
            yield node
            node = node.parent


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(raw)} if raw.strip(" />\n\t\r") else {}


class Open:
    """The open elements, with where those of each name and the blocks stand, so that no search looks back."""

    def __init__(self, root: Node):
        self.nodes, self.at = [root], defaultdict(list)
        self.blocks: list[int] = []
        self.but_p: list[int] = []

    def push(self, node: Node) -> None:
        at = len(self.nodes)
        self.nodes.append(node)
        self.at[node.tag].append(at)
        if node.tag in BLOCK:
            self.blocks.append(at)
            if node.tag != "p":
                self.but_p.append(at)

    def cut(self, at: int) -> None:
        """Ends the elements from ``at`` on."""
        for node in reversed(self.nodes[at:]):
            self.at[node.tag].pop()
        for places in (self.blocks, self.but_p):
            while places and places[-1] >= at:
                places.pop()
        del self.nodes[at:]

    def last(self, names) -> int:
        return max((self.at[n][-1] for n in names if self.at[n]), default=0)

    def end(self, name: str) -> None:
        """An end tag: the nearest such element ends, but an inline end tag doesn't end blocks."""
        at = self.last((name,))
        if at and (name in BLOCK or not self.blocks or self.blocks[-1] < at):
            self.cut(at)

    def close(self, name: str) -> None:
        """What the start of element ``name`` ends."""
        if name in BLOCK and self.last(("p",)) > (self.but_p[-1] if self.but_p else 0):
            self.cut(self.last(("p",)))
        if name in ENDED_BY:
            names, bounds = ENDED_BY[name]
            at = self.last(names)
            if at > self.last(bounds):
                self.cut(at)


def parse(page: str) -> tuple[Node, list[Node]]:
    """The tree of a page, and its elements in page order."""
    root = Node("html", None, {})
    open_, nodes, at = Open(root), [root], 0

    def say(text: str) -> None:
        if text:
            open_.nodes[-1].parts.append(html.unescape(text))

    while m := _TAG.search(page, at):
        say(page[at : m.start()])
        at, name = m.end(), (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            open_.end(name)
        elif name in ("html", "body"):
            root.attributes |= {k: v for k, v in _attributes(m[3][:-1]).items() if k == "lang"}
        else:
            open_.close(name)
            parent = open_.nodes[-1]
            node = Node(name, parent, _attributes(m[3][:-1]))
            parent.parts.append(node)
            nodes.append(node)
            if name in RAW:
                end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
                at = end.start() if end else len(page)
            if name not in VOID and not (m[3].endswith("/>") and name not in BLOCK):
                open_.push(node)
    say(page[at:])
    return root, nodes


def _names(node: Node) -> list[list[str]]:
    """The words of each name in class and id."""
    names = [[w.lower() for w in _WORD.findall(token)] for token in f"{node.attributes.get('class', '')} {node.attributes.get('id', '')}".split()]
    return [words for words in names if words and words[0] not in NOT_OWN]  # with-sidebar says that there is one elsewhere


def _words(node: Node) -> set[str]:
    return {w for words in _names(node) for w in words}


def _hinted(node: Node) -> bool:
    """Whether a dropped word stands in class and id, but only before a word that says something else."""

    def plain(words: list[str]) -> bool:
        named = [w for w in words if not w.isdigit() and w not in NEUTRAL_WORDS]
        return bool(named) and (named[-1] in DROPPED_WORDS)

    names = [words for words in _names(node) if not DROPPED_WORDS.isdisjoint(words)]
    return bool(names) and not any(plain(words) for words in names)


def _unseen(node: Node) -> bool:
    """Elements that are never main text, whatever they hold."""
    a = node.attributes
    return (
        node.tag in DROPPED
        or node.tag in RAW
        or "hidden" in a
        or a.get("aria-hidden") == "true"
        or bool(re.search(r"display:none|visibility:hidden", a.get("style", "").replace(" ", "").lower()))
    )


def _marked(node: Node, words: set[str]) -> bool:
    if node.attributes.get("role") in DROPPED_ROLES or words & DROPPED_WORDS:
        return True
    heading = node.tag in HEADINGS or words & ARTICLE_WORDS
    header = node.tag == "header" or node.tag not in ("article", "main") and "header" in words
    return node.tag == "form" or header and not node.inside and not heading


def _measure(nodes: list[Node]) -> None:
    """Notes how much text elements hold: ``whole``, unlinked but headings ``prose``, and outside marked parts ``clear``."""
    for node in reversed(nodes):
        if node.dropped:
            continue
        own = sum(len("".join(p.split())) for p in node.parts if isinstance(p, str))
        node.whole, node.prose, node.clear = node.whole + own, node.prose + own, node.clear + own
        if node.hinted:
            # prose overrules a name that only begins with a dropped word
            node.marked = node.tag not in HEADINGS and 2 * node.prose < node.whole
        if node.parent:
            node.parent.whole += node.whole
        if node.parent and node.tag != "a" and node.tag not in HEADINGS:
            node.parent.prose += node.prose
            node.parent.clear += 0 if node.marked else node.clear


def _drop(nodes: list[Node]) -> None:
    """Marks what isn't main text, with all it holds."""
    for node in nodes:
        node.dropped = bool(node.parent and node.parent.dropped) or _unseen(node)
        words = _words(node)
        node.marked = not node.dropped and _marked(node, words)
        node.hinted = node.marked and not words.isdisjoint(DROPPED_WORDS) and _hinted(node) and not _marked(node, words - DROPPED_WORDS)
    _measure(nodes)
    bodies = [n for n in nodes if n.tag in ("article", "main") and n.prose and not n.dropped and not (n.marked and _words(n) & DROPPED_WORDS)]
    for body in bodies:
        body.parent.bodies += 1
    for node in reversed(nodes[1:]):
        node.parent.bodies += node.bodies
    total, plain = nodes[0].prose, nodes[0].clear
    for node in nodes:
        if node.parent and node.parent.dropped:
            node.dropped = True
        elif not node.dropped and bodies:
            # a wrapper of all the page's articles is no such part, whatever it is called
            node.dropped = node.marked and node.bodies != len(bodies)
        elif not node.dropped and node.marked:
            # nor, on a page without articles, is a form or wrapper of most of its prose where little stands outside
            rest = 0 if _words(node) & OWN_PROSE else node.prose if node.tag == "form" else node.prose // 4
            node.dropped = 2 * node.prose <= total or plain > rest
            plain += 0 if node.dropped else node.clear
        elif node.tag == "label":
            node.dropped = any(u.tag == "form" for u in node.up())  # of a control


def _walk(node: Node):
    """(element, text): text parts in page order, and (element, None) where a block begins or ends."""
    stack: list[tuple[Node, int]] = [(node, 0)]
    while stack:
        node, i = stack.pop()
        if i == 0 and node.tag in BLOCK:
            yield node, None
        if i < len(node.parts):
            stack.append((node, i + 1))
            part = node.parts[i]
            if isinstance(part, str):
                yield node, part
            elif not part.dropped:
                if part.tag == "br":
                    yield node, " "
                stack.append((part, 0))
        elif node.tag in BLOCK:
            yield node, None


def blocks(node: Node) -> list[tuple[Node, str]]:
    """The text of an element, block by block, each with the block element it stands in."""
    out, words, owner = [], [], node
    for at, text in _walk(node):
        if text is None:
            joined = " ".join("".join(words).split())
            if joined:
                out.append((owner, joined))
            words = []
        else:
            if not words:
                owner = at
                while owner.tag not in BLOCK and owner.parent:
                    owner = owner.parent
            words.append(text)
    joined = " ".join("".join(words).split())
    return out + [(owner, joined)] if joined else out


def _score(root: Node, nodes: list[Node]) -> None:
    for node in reversed(nodes):  # children come after their parents
        if not node.dropped:
            own = sum(len("".join(p.split())) for p in node.parts if isinstance(p, str))
            node.chars += own
            if node.tag == "a":
                node.linked = node.chars
            if node.parent:
                node.parent.chars += node.chars
                node.parent.linked += node.linked
    for owner, text in blocks(root):
        if owner.tag in HEADINGS:
            continue
        points = 1 + len(_COMMA.findall(text)) + min(len(text) / 100, 3)
        # text that stands in a container itself counts for it, a paragraph's for its parent
        inner = owner if owner.tag in ("div", "section", "article", "main", "form", "html", "body") else owner.parent or owner
        for share, node in zip((1, 1 / 2, 1 / 6, 1 / 9, 1 / 12), (inner, *inner.up())):
            node.points += points * share


def _density(node: Node) -> float:
    return node.linked / node.chars if node.chars else 0.0


def main_nodes(root: Node, nodes: list[Node]) -> list[Node]:
    """The best container and what belongs to it, in page order."""
    _drop(nodes)
    _score(root, nodes)
    scored = [(n.points * (1 - _density(n)), n) for n in nodes if n.points and not n.dropped]
    if not scored:
        return [root]
    best, top = max(scored, key=lambda x: x[0])
    whole = [n for n in (top, *top.up()) if n.tag == "article" or _words(n) & ARTICLE_WORDS and n.tag in BLOCK]
    whole = whole or [n for n in (top, *top.up()) if n.tag == "main"]
    top = whole[-1] if whole and whole[-1].parent else top
    kept = {id(top)}
    if top.parent:
        before = True
        for part in top.parent.parts:
            if isinstance(part, str) or part.dropped:
                continue
            before = before and part is not top
            score = part.points * (1 - _density(part))
            alike = score >= max(10.0, 0.2 * best) and part.tag not in ("ul", "ol")
            prose = part.tag == "p" and _density(part) < 0.25 and (part.chars > 80 or top.tag != "article" and part.chars > 0)
            if alike or prose or part.tag in HEADINGS and (before or top.tag not in ("article", "main")):
                kept.add(id(part))
    # the page's title, where it stands above the container
    title = next((n for n in nodes if n.tag == "h1" and not n.dropped), None)
    order = {id(n): i for i, n in enumerate(nodes)}
    if title and order[id(title)] < order[id(top)]:
        kept.add(id(title))
    return [n for n in nodes if id(n) in kept and not any(id(u) in kept for u in n.up())]


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root, nodes = parse(page)
    return "\n".join(text for node in main_nodes(root, nodes) for _, text in blocks(node))


_ADDED = StructType([StructField("text", StringType()), StructField("n_chars", LongType())])


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (code points) from the whole ``html``."""

    def make(sources):
        for page in sources:
            text = main_text(page)
            yield text, len(text)

    return append_columns(pages, ["html"], _ADDED, make)


def extracted(pages: DataFrame) -> DataFrame:
    return extract(pages.select("page_id", "url", "html")).select("page_id", "url", F.col("text"), "n_chars")
