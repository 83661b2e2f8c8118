"""A small reader of raw pages: elements in page order, their parents, and the text they hold.

It knows what page extraction needs: void and raw-text elements, end tags that may be left
out, comments and character references. It is no full HTML parser.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|data-part)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)

# Fixed by the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section select summary table tbody td tfoot th thead title tr ul".split()
)
UNSEEN = frozenset("script style head title template noscript iframe object svg math select option textarea noembed noframes xmp".split())
_CLOSES_P = BLOCKS - {"body", "head", "html", "option", "optgroup", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "title", "legend", "summary"}
# An element that ends when one of the listed ones begins, and what it does not reach beyond.
_ENDS = {
    "li": ("li", {"ul", "ol", "menu", "dir"}),
    "dt": ("dt dd", {"dl"}),
    "dd": ("dt dd", {"dl"}),
    "tr": ("tr td th", {"table"}),
    "td": ("td th", {"tr", "table"}),
    "th": ("td th", {"tr", "table"}),
    "tbody": ("tbody thead tfoot tr td th", {"table"}),
    "tfoot": ("tbody thead tfoot tr td th", {"table"}),
    "option": ("option", {"select"}),
}
_SCOPE = frozenset("table td th caption html template object button".split())


@dataclass
class Page:
    """Elements by number, element 0 being the page itself; ``text`` in page order."""

    tag: list[str] = field(default_factory=lambda: ["#page"])
    parent: list[int] = field(default_factory=lambda: [-1])
    attributes: list[dict[str, str]] = field(default_factory=lambda: [{}])
    #: Element, block number and text; the block number changes where a block begins or ends.
    text: list[tuple[int, int, str]] = field(default_factory=list)


def read(source: str) -> Page:
    """The page's elements and texts, scripts and other unseen content left out."""
    page = Page()
    stack = [0]
    block = at = 0
    unseen = 0
    position = 0
    size = len(source)

    def close_to(index: int) -> None:
        nonlocal unseen
        for element in stack[index:]:
            unseen -= page.tag[element] in UNSEEN
        del stack[index:]

    def find(names: frozenset[str] | set[str], stop: frozenset[str] | set[str]) -> int:
        for i in range(len(stack) - 1, 0, -1):
            tag = page.tag[stack[i]]
            if tag in names:
                return i
            if tag in stop:
                return 0
        return 0

    while position < size:
        match = _TOKEN.search(source, position)
        end = match.start() if match else size
        if end > at and not unseen:
            page.text.append((stack[-1], block, html.unescape(source[at:end])))
        if not match:
            break
        position = at = match.end()
        name = match[2]
        if name is None:
            continue
        name = name.lower()
        if match[1]:
            i = find({name}, _SCOPE - {name}) if name in BLOCKS else find({name}, BLOCKS)
            if i:
                close_to(i)
            block += name in BLOCKS
            continue
        if name in _CLOSES_P and (i := find({"p"}, _SCOPE)):
            close_to(i)
        if name in _ENDS:
            names, stop = _ENDS[name]
            if i := find(set(names.split()), stop):
                close_to(i)
        if name == "br":
            if not unseen:
                page.text.append((stack[-1], block, "\n"))
            continue
        block += name in BLOCKS
        found = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(match[3])} if match[3] else {}
        page.tag.append(name)
        page.parent.append(stack[-1])
        page.attributes.append(found)
        if name in VOID or match[3].endswith("/") and name not in BLOCKS and name not in RAW:
            continue
        stack.append(len(page.tag) - 1)
        unseen += name in UNSEEN
        if name in RAW:  # what stands inside is not markup
            close = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(source, position)
            inner = source[position : close.start() if close else size]
            if not unseen:
                page.text.append((stack[-1], block, inner))
            position = at = close.end() if close else size
            close_to(len(stack) - 1)
            block += name in BLOCKS
    return page
