"""A small tolerant HTML reader: pages become trees of elements and texts."""

from __future__ import annotations

import re
from collections import defaultdict
from html import unescape

#: Elements without content, elements whose content is not markup, and elements that start a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead title tr ul".split()
)
#: An opening tag closes an open element of these kinds, as far as the given boundary.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}
_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
#: Attributes up to the tag's end, with quoted values; without backtracking.
_REST = re.compile(r"[^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+")
#: A whole tag whose quotes pair: a name, attributes and the end at once.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+)>")
_ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")


class Node:
    """An element with its class, id and role words and its children: nodes and strings."""

    __slots__ = ("children", "holds", "marks", "tag")

    def __init__(self, tag: str, marks: str = ""):
        self.tag, self.marks, self.children = tag, marks, []
        #: Whether an article stands below (see ``parse``).
        self.holds = False


def _marks(attrs: str) -> str:
    if "=" not in attrs and "hidden" not in attrs:
        return ""
    found = []
    for name, a, b, c in _ATTR.findall(attrs):
        name = name.lower()
        if name in ("class", "id", "role"):
            found += (a or b or c).lower().split()
        elif name == "hidden" or name == "aria-hidden" and (a or b or c).lower() == "true":
            found.append("hidden")
    return " ".join(found)


def _tokens(html: str):
    """(text, None), (attributes, opened tag) and ("", /closed tag) in page order, in time that grows with the page.

    A tag ends at the first ``>`` outside of quotes, or at the first one where quotes don't
    pair. A ``<`` that begins no tag is text, and so is all that follows the last ``>``.
    """
    at, size, spent, paired = 0, len(html), 0, True
    while at < size:
        lt = html.find("<", at)
        m = _TAG.match(html, lt) if paired and lt >= 0 else None
        if m is not None:
            end, (slash, tag, attrs) = m.end() - 1, m.groups()
        else:
            if lt < 0 or html.find(">", lt) < 0 and not html.startswith("<!--", lt):
                yield html[at:], None
                return
            if html.startswith("<!--", lt):
                end = html.find("-->", lt + 4)
                yield html[at:lt], None
                at = size if end < 0 else end + 3
                continue
            m = _NAME.match(html, lt + 1)
            if m is None and html[lt + 1 : lt + 2] not in ("!", "?", "/"):
                yield html[at : lt + 1], None
                at = lt + 1
                continue
            if m is None:
                yield html[at:lt], None
                at = html.find(">", lt) + 1
                continue
            paired = False  # quotes don't pair: the rest of the page is read within bounds
            rest = m.end()
            end = _REST.match(html, rest).end() if spent <= 8 * size else size
            if end >= size or html[end] != ">":
                spent += end - rest
                end = html.find(">", rest)
            slash, tag, attrs = m[1], m[2], html[rest:end]
        if lt > at:
            yield html[at:lt], None
        at, tag = end + 1, tag.lower()
        if slash:
            yield "", f"/{tag}"
            continue
        yield attrs, tag
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            to = close.start() if close else size
            yield html[at:to], None
            yield "", f"/{tag}"
            gt = html.find(">", to)
            at = size if gt < 0 else gt + 1


def parse(html: str, is_part=lambda n: False, closed=frozenset()) -> Node:
    """The tree of a page. ``holds`` is set on every element above one that ``is_part``, as far as one of the kinds ``closed``."""
    root = Node("#root")
    stack, opened = [root], defaultdict(int)

    def cut(to: int) -> None:
        for n in stack[to:]:
            opened[n.tag] -= 1
        del stack[to:]

    def close(tag: str) -> None:
        if not opened[tag]:
            return
        if stack[-1].tag == tag:
            stack.pop()
            opened[tag] -= 1
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag == tag:
                cut(i)
                return
            if (tag not in BLOCK or tag == "p") and stack[i].tag in BLOCK:  # an inline end tag doesn't close blocks
                return

    for text, tag in _tokens(html):
        if tag is None:
            if text:
                stack[-1].children.append(text)
            continue
        if tag[0] == "/":
            close(tag[1:])
            continue
        if tag in BLOCK:
            close("p")
        if tag in _CLOSES:
            own, edge = _CLOSES[tag]
            if any(opened[t] for t in own):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in edge:
                        break
                    if stack[i].tag in own:
                        cut(i)
                        break
        node = Node(tag, _marks(text))
        stack[-1].children.append(node)
        if is_part(node):
            for n in reversed(stack):
                if n.holds or n.tag in closed:
                    break
                n.holds = True
        if tag in VOID or text.endswith("/") and tag not in BLOCK and tag not in RAW:
            continue
        stack.append(node)
        opened[tag] += 1
    return root


def blocks(node: Node, skip, own=lambda n: False) -> tuple[list[tuple[int, str, int]], list[tuple[int, Node]]]:
    """Texts (holder, text, its characters in links) of each block in page order, and the elements (parent, element) that can hold some.

    Holders and parents are numbers of elements; ``node`` is number 0. ``skip(node)`` leaves
    out a subtree. Inline elements are looked through, but for those that are blocks by ``own``.
    """
    found: list[tuple[int, Node]] = [(-1, node)]
    out: list[tuple[int, list[str], list[str]]] = []
    open_ = None  # the block that is being said
    # entries: children left to see, number of the holder, whether in a link, whether a block ends with them
    stack = [(iter(node.children), 0, False, False)]
    while stack:
        children, holder, linked, ends = stack[-1]
        c = next(children, None)
        if c is None:
            stack.pop()
            if ends:
                open_ = None
        elif isinstance(c, str):
            if open_ is None:
                open_ = (holder, [], [])
                out.append(open_)
            open_[1].append(c)
            if linked:
                open_[2].append(c)
        elif skip(c):
            if c.tag in BLOCK:
                open_ = None
        elif c.tag in BLOCK or own(c):
            open_ = None
            found.append((holder, c))
            stack.append((iter(c.children), len(found) - 1, linked, True))
        elif c.tag in ("br", "wbr", "img"):
            if open_ is not None and c.tag == "br":
                open_[1].append(" ")
        else:
            stack.append((iter(c.children), holder, linked or c.tag == "a", False))
    tidy = lambda parts: " ".join(unescape("".join(parts)).split())
    said = ((h, tidy(parts), len(tidy(links)) if links else 0) for h, parts, links in out)
    return [x for x in said if x[1]], found
