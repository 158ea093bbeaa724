"""Text blocks of an HTML page with the tags around them.

A block is the text between two places where a block-level element begins or ends. Scanning is
linear in the page, whatever its markup: every search goes on from where the last one ended, a
delimiter that is nowhere ahead is not looked for again, open elements are counted by name, and a
block holds a link to its innermost element instead of a copy of the path.

Tags may be left out as HTML allows: a head ends where an element begins that may not stand in
one, and drawings and formulas end where an element of text begins.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

# Elements of running text, elements without end tags, elements whose content is
# not text, and the start tags that end an open element of the same kind.
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr nobr img br".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title iframe noembed noframes xmp".split())
HIDDEN = set("head script style title textarea iframe noembed noframes noscript template svg math object canvas select".split())
CLOSES = {
    "p": {"p"},
    "li": {"li", "p"},
    "dt": {"dt", "dd", "p"},
    "dd": {"dt", "dd", "p"},
    "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"},
    "th": {"td", "th", "p"},
    "option": {"option"},
}
# An open paragraph ends where one of these begins.
ENDS_P = set(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol pre section table ul".split()
)
# Elements that may stand in a head, and those that end an open drawing or formula.
IN_HEAD = set("base basefont bgsound link meta noframes noscript script style template title".split())
ENDS_FOREIGN = set(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p "
    "pre ruby s small span strong strike sub sup table tt u ul var".split()
)
# Where text of HTML may stand inside a drawing or formula.
ISLANDS = set("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
FOREIGN = {"svg", "math"}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}}

TAG_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"""\s*([^\s"'=<>/]+)(?:\s*=\s*(["']?))?|\s*/""")
UNQUOTED = re.compile(r"[^\s>]*")
NAMES = re.compile(r"[a-z]+|[0-9]+")
# Found in the page as it is: lower-casing some letters changes its length.
RAW_ENDS = {tag: re.compile(f"</{tag}", re.IGNORECASE | re.ASCII) for tag in RAW}


@dataclass(frozen=True, eq=False)
class Element:
    """An open element and what is around it; elements of running text take no part in paths."""

    parent: Element | None
    tag: str
    names: tuple[str, ...]  # words of class, id and role
    level: int  # elements on the path down to here
    depth: int  # parts of that path

    @property
    def last(self) -> str:
        return self.names[-1] if self.names else self.tag


@dataclass
class Block:
    text: str
    element: Element | None  # the innermost element that is not of running text
    link_chars: int

    @property
    def path(self) -> tuple[str, ...]:
        """Tags from the body down, each followed by the words of its class, id and role."""
        parts: list[tuple[str, ...]] = []
        at = self.element
        while at:
            parts.append((at.tag, *at.names))
            at = at.parent
        return tuple(w for part in reversed(parts) for w in part)


class Scanner:
    """Finds the next delimiter of a page; one that is missing is searched for once."""

    def __init__(self, page: str):
        self.page = page
        self.missing: set[str] = set()

    def find(self, what: str, start: int) -> int:
        if what in self.missing:
            return -1
        at = self.page.find(what, start)
        if at < 0:
            self.missing.add(what)
        return at


def _attributes(scan: Scanner, at: int) -> tuple[list[str], int]:
    """Words of class, id and role of the tag whose attributes begin here, and the place after it."""
    page, names = scan.page, []
    while True:
        m = ATTRIBUTE.match(page, at)
        if not m or m.end() == at:
            end = scan.find(">", at)
            return names, (end + 1 if end >= 0 else len(page))
        at = m.end()
        value = ""
        if m[2] is not None:
            if m[2]:
                end = scan.find(m[2], at)
                if end < 0:  # the quote never ends: the tag does at its next end mark
                    end = scan.find(">", at)
                    return names, (end + 1 if end >= 0 else len(page))
                value, at = page[at:end], end + 1
            else:
                u = UNQUOTED.match(page, at)
                value, at = u[0], u.end()
        if m[1] and m[1].lower() in ("class", "id", "role"):
            names += NAMES.findall(value.lower())


def blocks(page: str) -> list[Block]:
    """All blocks with text, in page order."""
    scan = Scanner(page)
    found: list[Block] = []
    stack: list[tuple[str, Element | None]] = []  # with the innermost element of the path there
    opened: Counter[str] = Counter()
    hidden = links = 0
    pieces: list[str] = []
    link_chars = 0

    def flush() -> None:
        nonlocal link_chars
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                found.append(Block(text, stack[-1][1] if stack else None, min(link_chars, len(text))))
            pieces.clear()
        link_chars = 0

    def close(place: int) -> None:
        """End all elements from this place of the stack on."""
        nonlocal hidden, links
        if any(tag not in INLINE for tag, _ in stack[place:]):
            flush()
        for tag, _ in stack[place:]:
            opened[tag] -= 1
            hidden -= tag in HIDDEN
            links -= tag == "a"
        del stack[place:]

    def last(tag: str) -> int:
        """Place of the innermost open element of a name; one that is not open is not looked for."""
        return next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag) if opened[tag] > 0 else -1

    def make_room(tag: str) -> None:
        """End what an element of this name may not stand in."""
        if opened["head"] > 0 and tag not in IN_HEAD and tag != "head" and not any(opened[t] > 0 for t in ("noscript", "template")):
            close(last("head"))
        if tag in ENDS_FOREIGN and any(opened[t] > 0 for t in FOREIGN):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ISLANDS:
                    return
                if stack[i][0] in FOREIGN:
                    close(i)
                    return

    def say(raw: str) -> None:
        nonlocal link_chars
        if raw and not hidden:
            text = html.unescape(raw) if "&" in raw else raw
            pieces.append(text)
            if links:
                link_chars += len(text)

    at, size = 0, len(page)
    while at < size:
        start = scan.find("<", at)
        if start < 0:
            say(page[at:])
            break
        say(page[at:start])
        if page.startswith("<!--", start):
            end = scan.find("-->", start + 4)
            at = size if end < 0 else end + 3
            continue
        if page[start + 1 : start + 2] in ("!", "?"):
            end = scan.find(">", start)
            at = size if end < 0 else end + 1
            continue
        m = TAG_NAME.match(page, start + 1)
        if not m:
            say("<")
            at = start + 1
            continue
        tag = m[1].lower()
        if page[start + 1] == "/":
            end = scan.find(">", m.end())
            at = size if end < 0 else end + 1
            place = last(tag)
            if place >= 0:
                close(place)
            elif tag not in INLINE:
                flush()
            continue
        names, at = _attributes(scan, m.end())
        make_room(tag)
        if tag == "br" or tag == "hr":
            pieces.append(" ")
        if tag not in INLINE:
            flush()
            ends = CLOSES.get(tag, set()) | ({"p"} if tag in ENDS_P else set())
            bounds = SCOPES.get(tag, set()) | {"body", "article", "div", "section", "table"} - ends
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ends:
                    close(i)
                    if tag not in SCOPES:
                        break
                elif stack[i][0] in bounds:
                    break
        if tag in VOID:
            continue
        if tag in RAW:
            # text up to the end tag, whatever it holds
            m = RAW_ENDS[tag].search(page, at)
            end = m.start() if m else -1
            if tag not in HIDDEN:
                say(page[at : size if end < 0 else end])
            if end < 0:
                at = size
            else:
                close_at = scan.find(">", end)
                at = size if close_at < 0 else close_at + 1
            continue
        if tag == "body":
            close(0)
        around = stack[-1][1] if stack else None
        if tag not in INLINE:
            level, depth = (around.level, around.depth) if around else (0, 0)
            around = Element(around, tag, tuple(names), level + 1, depth + 1 + len(names))
        stack.append((tag, around))
        opened[tag] += 1
        hidden += tag in HIDDEN
        links += tag == "a"
    flush()
    return found
