"""Leaf blocks of an HTML page: runs of text between block boundaries, with their place.

A small tolerant reader: tags are found by one pattern, elements that hold no text for the
reader (scripts, styles, comments, heads) are skipped, a stack of open elements gives each
block its place in the tree of elements. Places share their ancestors, and all a tag asks
about the open elements is kept up to date, so time and memory are in proportion to the
page however deep it nests. Unclosed and stray tags are tolerated as browsers do, as far as blocks
go: a closing tag closes the nearest open element of its name, if there is one.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable
from typing import NamedTuple

# Elements by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
HIDDEN = frozenset("script style noscript template head title svg math iframe object canvas audio video".split())
#: Elements that an opening tag of a block ends.
CLOSED_BY_BLOCK = frozenset(["p"])
#: Containers.
BOXES = frozenset("article main section div nav header footer aside form body".split())

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<name>[A-Za-z][A-Za-z0-9:-]*)(?P<rest>(?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
NAMES = re.compile(r"[a-z]+")


class Place:
    """An open element: its name, words of its class, id and role, and the element around it."""

    __slots__ = ("parent", "tag", "words", "depth", "box")

    def __init__(self, parent: Place | None, tag: str, words: tuple[str, ...]):
        self.parent, self.tag, self.words = parent, tag, words
        self.depth: int = parent.depth + 1 if parent else 1
        #: The nearest element, itself included, that is a container.
        self.box: Place | None = self if tag in BOXES else parent and parent.box

    @classmethod
    def of(cls, elements: Iterable[tuple[str, tuple[str, ...]]]) -> Place | None:
        """The place at the end of a path from the root."""
        place = None
        for tag, words in elements:
            place = cls(place, tag, words)
        return place


class Block(NamedTuple):
    text: str
    #: The innermost open element; none outside of all.
    place: Place | None
    #: Characters of the text inside links.
    linked: int


def _words(rest: str) -> tuple[str, ...]:
    if "=" not in rest:
        return ()
    return tuple(w for m in ATTRIBUTE.finditer(rest) for w in NAMES.findall((m[2] or m[3] or m[4] or "").lower()))


class _Open:
    """The open elements, and where on their stack names and kinds of names stand."""

    def __init__(self):
        self.stack: list[Place] = []
        self.links = 0
        self.at: dict[str, list[int]] = {}
        #: Positions of elements that are blocks, and of those that no block ends.
        self.blocks: list[int] = []
        self.firm: list[int] = []

    def top(self) -> Place | None:
        return self.stack[-1] if self.stack else None

    def push(self, name: str, words: tuple[str, ...]) -> None:
        number = len(self.stack)
        self.stack.append(Place(self.top(), name, words))
        self.at.setdefault(name, []).append(number)
        self.links += name == "a"
        if name not in INLINE:
            self.blocks.append(number)
            if name not in CLOSED_BY_BLOCK:
                self.firm.append(number)

    def cut(self, depth: int) -> None:
        """Close all from a position on."""
        while len(self.stack) > depth:
            name = self.stack.pop().tag
            self.at[name].pop()
            self.links -= name == "a"
            for kept in (self.blocks, self.firm):
                if kept and kept[-1] == len(self.stack):
                    kept.pop()

    def close(self, name: str) -> None:
        """Close the nearest element of a name; an inline one only if no block is open in it."""
        if found := self.at.get(name):
            if name not in INLINE or not self.blocks or self.blocks[-1] < found[-1]:
                self.cut(found[-1])

    def block_begins(self) -> None:
        """End the nearest paragraph if only inline elements are open in it."""
        found = [self.at[n][-1] for n in CLOSED_BY_BLOCK if self.at.get(n)]
        if found and (not self.firm or self.firm[-1] < max(found)):
            self.cut(max(found))


def blocks(page: str) -> list[Block]:
    """The blocks of a page in its order; those without characters but white space are left out."""
    out: list[Block] = []
    pieces: list[str] = []
    linked = at = 0
    place: Place | None = None
    opened = _Open()
    endless: set[str] = set()  # names that are not closed any more

    def said(piece: str) -> None:
        nonlocal linked, place
        if piece:
            if not pieces or not place:
                place = opened.top()
            pieces.append(piece)
            if opened.links:
                linked += len(piece)

    def flush() -> None:
        nonlocal linked, place
        text = " ".join("".join(pieces).split())
        if text:
            out.append(Block(text, place, min(linked, len(text))))
        pieces.clear()
        linked, place = 0, None

    while True:
        found = TAG.search(page, at)
        said(html.unescape(page[at : found.start() if found else len(page)]))
        if not found:
            break
        at = found.end()
        if found["data"] is not None:
            said(found["data"])
        if not found["name"]:
            continue
        name = found["name"].lower()
        if name in HIDDEN and not found["end"]:
            if name not in INLINE:
                flush()
            if not found["rest"].endswith("/"):
                end = None if name in endless else re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                if not end:
                    endless.add(name)
                at = end.end() if end else (len(page) if name in ("script", "style") else at)
            continue
        if name == "br":
            said(" ")
            continue
        if name not in INLINE:
            flush()
        if found["end"]:
            opened.close(name)
        elif name not in VOID and not found["rest"].endswith("/"):
            if name not in INLINE:
                opened.block_begins()
            opened.push(name, _words(found["rest"]))
    flush()
    return out
