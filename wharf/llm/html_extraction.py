"""Main text of web pages by tree scoring.

Each page is parsed into a light element tree. A paragraph is worth points for its length and
commas, discounted by its share of link text; it passes them to its parent, half to the
grandparent, and less further up. The best container is kept, together with siblings that
score well themselves. Pages are independent rows, so the work is one narrow pass.

Names (class, id, role) only mark an element when the marking word is the head of a whole name:
``cookie-notice`` and ``sidebar-left`` do, ``has-sidebar`` and ``related-work`` do not. A marked
element stays if it holds the article, or most of the page's points where no article or main
element lies elsewhere; if nothing is left otherwise, the page is scored without marks. A form is
marked too, so a page that lies in one keeps its article. The work grows with the page, however
deeply its elements are nested.

Defined cases: null, empty or text-free html gives the empty string; broken, unclosed or cut
markup is read as far as it goes; repeated pages give repeated rows; other columns of the
input do not matter.
"""

from __future__ import annotations

import html as _html
import re
from bisect import bisect_right
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*')|=)*+)>"
    r"|<[!?/][^>]*>"
    r"|<[a-zA-Z/!?][^>]*\Z",
    re.S,
)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]*))?")
_WORDS = re.compile(r"[^a-z0-9]+")

# Element names by their role in the page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript iframe template noembed noframes xmp".split())
DROPPED = RAW | set(
    "head nav footer aside button select option dialog menu svg canvas object video audio map".split()
)
BLOCKS = set(
    "html body main article section header footer nav aside div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd "
    "table caption thead tbody tfoot tr td th blockquote pre figure figcaption address details summary "
    "hr center form fieldset legend dialog menu search hgroup".split()
)
PARAGRAPHS = set("p h1 h2 h3 h4 h5 h6 li dt dd td th pre blockquote figcaption caption summary".split())
# Elements that may lie in the head of a page; any other one ends it.
IN_HEAD = set("title base link meta style script noscript template".split())
SIBLING_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Words of class, id and role names that mark what surrounds an article.
BOILERPLATE = set(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside complementary footer contentinfo "
    "masthead topbar cookie cookies consent gdpr notice notices notification popup modal overlay alert dialog "
    "newsletter subscribe subscription signup login search social share sharing related recommended "
    "recommendations widget pagination pager toolbar skip paywall form".split()
)
COMMENTS = set("comment comments commentlist commentary disqus reply replies respond discussion".split())
# Parts after the head of a compound name, and parts that say what a page has or lacks.
NEUTRAL = set(
    "left right top bottom upper lower primary secondary wrapper wrap container inner outer area list item "
    "items block box section bar group body holder panel slot unit row col column links".split()
)
LACKING = set("has have no not non with without".split())
#: Levels above a paragraph that its points are passed to.
LEVELS = 5
UNMARKED = set("html body main h1 h2 h3 h4 h5 h6".split())


class _Node:
    __slots__ = ("name", "parent", "dropped", "mark", "marked", "comments", "score", "chars", "links")

    def __init__(self, name: str, parent: _Node | None, dropped: bool, mark: str = ""):
        self.name, self.parent, self.dropped, self.mark = name, parent, dropped, mark
        #: The nearest marked element around, itself included, and whether one of them holds comments.
        self.marked: _Node | None = self if mark else parent.marked if parent else None
        self.comments: bool = mark == "comments" or (parent is not None and parent.comments)
        self.score, self.chars, self.links = 0.0, 0, 0

    def outer_mark(self) -> _Node | None:
        """The next marked element around a marked one."""
        return self.parent.marked if self.parent else None


def _heads(value: str) -> set[str]:
    """The word that each name of a class, id or role value is headed by."""
    out = set()
    for name in value.split():
        parts = [p for p in _WORDS.split(name) if p]
        while len(parts) > 1 and (parts[-1] in NEUTRAL or not parts[-1].isalpha()):
            parts.pop()
        if parts and not LACKING & set(parts[:-1]):
            out.add(parts[-1])
    return out


def _boilerplate(name: str, attrs: str, in_article: bool) -> tuple[bool, str]:
    """Whether an element goes in any case, and the mark that its names give it."""
    if name in DROPPED:
        return True, ""
    if name == "header" and not in_article:
        return True, ""
    if name in ("html", "body", "main") or not attrs and name != "form":
        return False, ""
    words: set[str] = set()
    for key, value in _ATTR.findall(attrs):
        key, value = key.lower(), value.strip("\"'").lower()
        if key in ("class", "id", "role"):
            words |= _heads(value)
        elif key == "hidden" or key == "aria-hidden" and value == "true":
            return True, ""
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True, ""
    if name in UNMARKED:
        return False, ""
    if words & COMMENTS:
        return False, "comments"
    if name == "article":
        return False, ""
    if name == "form":
        return False, "around"
    marked = bool(words & BOILERPLATE) or ("header" in words and not in_article)
    return False, "around" if marked else ""


#: A text block as it is read: owning element, and pieces (text, element, whether in a link).
_Raw = tuple[_Node, list[tuple[str, _Node, bool]]]


def _texts(raw: list[_Raw], hidden: set[_Node]) -> list[tuple[_Node, str, int]]:
    """Blocks (owner, text, characters inside links) without what lies in a node of ``hidden``.

    ``hidden`` holds all marked elements that are gone or lie in one that is.
    """
    found = []
    for owner, pieces in raw:
        if hidden:
            pieces = [p for p in pieces if p[1].marked not in hidden]
        text = " ".join(_html.unescape("".join(p[0] for p in pieces)).split())
        if text:
            inside = len(" ".join(_html.unescape("".join(p[0] for p in pieces if p[2])).split()))
            found.append((owner, text, min(inside, len(text))))
    return found


def _outward(nodes: Iterable[_Node | None], seen: set[_Node]) -> set[_Node]:
    """``seen`` with the marked elements around ``nodes``; each chain is followed to a known one."""
    for node in nodes:
        at = node.marked if node else None
        while at is not None and at not in seen:
            seen.add(at)
            at = at.outer_mark()
    return seen


def _points(text: str, links: int) -> float:
    return (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - links / len(text))


def _surroundings(raw: list[_Raw], nodes: list[_Node]) -> set[_Node]:
    """The marked elements that hold neither the article nor most of the page, and all within them."""
    marked = _outward((p[1] for _, pieces in raw for p in pieces), set())
    if not marked:
        return marked
    total = said = clear = 0.0
    sums: dict[_Node, float] = {}
    paragraphs: dict[_Node, float] = {}
    for owner, text, links in _texts(raw, set()):
        points = _points(text, links)
        own = points if owner.name in PARAGRAPHS else 0.0
        total += points
        if not owner.comments:
            said += own
        if owner.marked is None:
            clear += points
        sums[owner] = sums.get(owner, 0.0) + points
        paragraphs[owner] = paragraphs.get(owner, 0.0) + own
    # Children come after their parents in the list.
    for node in reversed(nodes):
        if node in sums and node.parent is not None:
            sums[node.parent] = sums.get(node.parent, 0.0) + sums[node]
            paragraphs[node.parent] = paragraphs.get(node.parent, 0.0) + paragraphs[node]
    articles = [n for n in nodes if n in sums and n.name in ("article", "main") and not n.mark]
    holds = _outward((a for a in articles if a.name == "main" or sums[a] >= clear), set())
    outside = any(a.marked is None for a in articles)
    hidden: set[_Node] = set()
    for m in nodes:
        if m not in marked:
            continue
        # Long comments must not outweigh the paragraphs of a short article.
        most = 2 * paragraphs.get(m, 0.0) > said or 2 * sums.get(m, 0.0) > total
        gone = m not in holds and not (most and m.mark == "around" and not outside)
        if gone or m.outer_mark() in hidden:
            hidden.add(m)
    return hidden


def _blocks(source: str) -> tuple[list[tuple[_Node, str, int]], list[_Node]]:
    """The kept text blocks in page order (owning element, text, characters inside links), and the tree.

    The elements are in the order of their start tags.
    """
    raw, nodes = _read(source)
    return _texts(raw, _surroundings(raw, nodes)) or _texts(raw, set()), nodes


class _Stack:
    """The open elements, with the places of each name, so that no search walks through all."""

    def __init__(self) -> None:
        self.root = _Node("#", None, False)
        self.nodes = [self.root]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = [0]

    def push(self, node: _Node) -> None:
        at = len(self.nodes)
        self.nodes.append(node)
        self.places.setdefault(node.name, []).append(at)
        if node.name in BLOCKS:
            self.blocks.append(at)

    def cut(self, index: int) -> None:
        while len(self.nodes) > index:
            self.places[self.nodes.pop().name].pop()
        while self.blocks[-1] >= index:
            self.blocks.pop()

    def last(self, name: str) -> int:
        """Where the innermost element of a name is; 0 if none is open."""
        places = self.places.get(name)
        return places[-1] if places else 0

    def first_after(self, names: set[str], scope: set[str]) -> int:
        """The outermost of ``names`` inside the innermost of ``scope``; 0 if there is none."""
        low = max(self.last(name) for name in scope)
        found = []
        for name in names:
            places = self.places.get(name, [])
            i = bisect_right(places, low)
            if i < len(places):
                found.append(places[i])
        return min(found, default=0)


def _read(source: str) -> tuple[list[_Raw], list[_Node]]:
    """The text blocks in page order, but for elements that go in any case, and all elements."""
    stack = _Stack()
    nodes = [stack.root]
    found: list[_Raw] = []
    pieces: list[tuple[str, _Node, bool]] = []

    def flush() -> None:
        nonlocal pieces
        if pieces:
            found.append((stack.nodes[stack.blocks[-1]], pieces))
            pieces = []

    def add(text: str) -> None:
        if text and not stack.nodes[-1].dropped:
            pieces.append((text, stack.nodes[-1], bool(stack.places.get("a"))))

    def pop_to(index: int) -> None:
        if stack.blocks[-1] >= index:
            flush()
        stack.cut(index)

    at = 0
    while True:
        match = _TAG.search(source, at)
        if match is None:
            add(source[at:])
            break
        add(source[at : match.start()])
        at = match.end()
        name = (match["name"] or "").lower()
        if not name:
            continue
        if match["close"]:
            index = stack.last(name)
            # The end of an inline element does not reach over a block.
            if index and (name in BLOCKS or index > stack.blocks[-1]):
                pop_to(index)
            continue
        if name == "br":
            add("\n")
            continue
        if stack.last("head") and name not in IN_HEAD:
            pop_to(stack.last("head"))
        if name in BLOCKS:
            flush()
            if stack.nodes[stack.blocks[-1]].name == "p":
                pop_to(stack.blocks[-1])
        if name in SIBLING_CLOSES:
            index = stack.first_after(*SIBLING_CLOSES[name])
            if index:
                pop_to(index)
        if name in VOID:
            continue
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(source, at)
            at = end.end() if end else len(source)
            continue
        if match["attrs"].endswith("/") and name not in BLOCKS:
            continue
        parent = stack.nodes[-1]
        inside = bool(stack.last("article") or stack.last("main"))
        dropped, mark = _boilerplate(name, match["attrs"], inside)
        node = _Node(name, parent, parent.dropped or dropped, mark)
        nodes.append(node)
        stack.push(node)
    flush()
    return found, nodes


def main_text(source: str | None) -> str:
    """The article of one page, its blocks joined by line feeds."""
    blocks, nodes = _blocks(source or "")
    if not blocks:
        return ""
    candidates: dict[_Node, None] = {}
    for owner, text, links in blocks:
        points = _points(text, links)
        owner.chars += len(text)
        owner.links += links
        node = owner.parent if owner.name in PARAGRAPHS else owner
        for level in range(LEVELS + 1):
            if node is None:
                break
            node.score += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            candidates[node] = None
            node = node.parent
    # Children come after their parents in the list.
    for node in reversed(nodes):
        if node.chars and node.parent is not None:
            node.parent.chars += node.chars
            node.parent.links += node.links

    def value(node: _Node) -> float:
        return node.score * (1 - node.links / node.chars) if node.chars else 0.0

    best = max(candidates, key=value)
    # Sections of one article belong together, however the points fall.
    outer: _Node | None = best
    while outer is not None and outer.name not in ("article", "main"):
        outer = outer.parent
    best = outer or best
    threshold = max(10.0, 0.2 * value(best))

    # For each element: the child of the best one's parent that it lies in, if any.
    branch: dict[_Node, _Node | None] = {}
    for node in nodes:
        beside = node.parent is best.parent
        branch[node] = node if beside else branch[node.parent] if node.parent is not None else None
    kept = []
    for owner, text, links in blocks:
        sibling = branch[owner]
        if sibling is best:
            kept.append(text)
            continue
        if sibling is None:
            continue
        density = sibling.links / max(sibling.chars, 1)
        if (
            value(sibling) >= threshold
            or (sibling.name in ("h1", "h2") and density < 0.5)
            or (sibling.name == "p" and sibling.chars > 80 and density < 0.25)
        ):
            kept.append(text)
    return "\n".join(kept)


@F.pandas_udf(T.StringType())
def extracted(pages: pd.Series) -> pd.Series:
    return pages.map(main_text, na_action=None).astype(object)


def extract(df: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``df`` with the main text of ``html`` in place of it, and its code points as n_chars."""
    rest = [F.col(f"`{c}`") for c in df.columns if c not in (html, text, "n_chars")]
    out = df.select(*rest, extracted(F.col(f"`{html}`")).alias(text))
    return out.withColumn("n_chars", F.length(text).cast("bigint"))
