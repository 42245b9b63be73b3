"""Text blocks of an HTML page, each with the path of elements it stands in.

A block is the text between two tags that break lines, with character references
decoded and white space runs as one space. Tags need not be closed or nested
well: a paragraph ends where a block starts, a list item where the next starts,
an end tag without its start is passed over. Scripts, styles, comments and other
content that is no text are left out; a tag or comment that never ends takes the
rest of the page, as in browsers.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
#: Elements that break lines: their text is apart from what stands around them.
_BREAKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt"
    " fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe"
    " legend li main menu nav noscript ol optgroup option p pre script search section select style"
    " summary table tbody td template textarea tfoot th thead title tr ul".split()
)
#: Elements whose content is no markup; that of the second line is text.
_RAW = frozenset(["script", "style", "iframe", "noembed", "noframes", "xmp"])
_RAW_TEXT = frozenset(["title", "textarea"])
#: An element that starts ends open ones of these names, up to the borders named.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}),
    "option": ({"option"}, {"select", "optgroup"}),
}
_MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^=>]++|=\s*(?:\"[^\"]*\"|'[^']*')|=)*+(?:>|\Z))"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(
    r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.DOTALL
)
_NAMES = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")
#: Elements of a path that are told: the outer and the inner ones.
_OUTER, _INNER = 4, 16


@dataclass
class Block:
    """Text with its path (names of elements, then ``.name`` for words of their attributes)."""

    text: str
    path: list[str]
    linked: int


def _names_of(attributes: str) -> list[str]:
    """Words in class, id and role, and whether the element is hidden."""
    found = []
    for name, *values in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        value = next(filter(None, values), "")
        if name in ("class", "id", "role", "itemprop"):
            found += [f".{word.lower()}" for word in _NAMES.findall(value)[:12]]
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            found.append(".hidden")
        elif name == "style" and re.search(r"display\s*:\s*none", value):
            found.append(".hidden")
    return found


class _Open:
    """The open elements, innermost last."""

    def __init__(self):
        self.names: list[str] = []
        self.words: list[list[str]] = []
        self.count: dict[str, int] = {}

    def start(self, name: str, words: list[str]) -> None:
        self.names.append(name)
        self.words.append([name, *words])
        self.count[name] = self.count.get(name, 0) + 1

    def cut(self, at: int) -> None:
        for name in self.names[at:]:
            self.count[name] -= 1
        del self.names[at:], self.words[at:]

    def end(self, name: str) -> None:
        if self.count.get(name):
            at = len(self.names) - 1
            while self.names[at] != name:
                at -= 1
            self.cut(at)

    def end_implied(self, name: str) -> None:
        if self.count.get("p") and name in _BREAKS:
            at = len(self.names) - 1
            while at >= 0 and self.names[at] not in _BREAKS:
                at -= 1
            if at >= 0 and self.names[at] == "p":
                self.cut(at)
        ended, borders = _ENDS.get(name, ((), ()))
        if any(self.count.get(other) for other in ended):
            for at in range(len(self.names) - 1, -1, -1):
                if self.names[at] in borders:
                    break
                if self.names[at] in ended:
                    self.cut(at)
                    break

    def path(self) -> list[str]:
        told = self.words
        if len(told) > _OUTER + _INNER:
            told = told[:_OUTER] + told[-_INNER:]
        return [word for words in told for word in words]


def blocks(page: str) -> Iterator[Block]:
    """The blocks of a page in their order."""
    open_, pieces, linked, path = _Open(), [], 0, []

    def ended() -> Iterator[Block]:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                yield Block(text, path, min(linked, len(text)))
        pieces.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked, path
        if "&" in text:
            text = unescape(text)
        if not pieces:
            if not text.strip():
                return
            path = open_.path()
        pieces.append(text)
        if open_.count.get("a"):
            linked += len(text.strip())

    at = 0
    while at < len(page):
        found = _MARKUP.search(page, at)
        if found is None:
            add(page[at:])
            break
        if found.start() > at:
            add(page[at : found.start()])
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        if found[0][-1] != ">":
            break
        if name == "br":
            add(" ")
            continue
        if name in _BREAKS:
            yield from ended()
        if found[1]:
            open_.end(name)
            continue
        open_.end_implied(name)
        if name in _VOID:
            continue
        open_.start(name, _names_of(found[3]))
        if name in _RAW or name in _RAW_TEXT:
            end = re.compile(f"</{name}(?=[\\s/>])", re.IGNORECASE).search(page, at)
            if name in _RAW_TEXT:
                add(page[at : end.start() if end else len(page)])
            at = end.start() if end else len(page)
    yield from ended()
