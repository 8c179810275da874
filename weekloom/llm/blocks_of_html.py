"""Leaf blocks of a web page: its text cut at block elements, each with the elements around it.

A small reader of tags that is as forgiving as a browser where it matters: void elements, end tags that are left out (p,
li, td and such), end tags without a start, tags and comments that the page's end cuts off, scripts that hold tags. It
passes once over the page, whatever is in it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

#: Elements within a block; all others end it.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rb rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
RAW = {t: re.compile(rf"</{t}(?=[\s/>])", re.IGNORECASE) for t in ("script", "style", "title", "textarea", "iframe", "noembed", "noframes", "xmp")}
#: Start tags that end an open paragraph, and what else a start tag ends: these elements, up to those.
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section summary table ul li dt dd".split())
ENDS = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "tr": ("tr", "table tbody thead tfoot"), "option": ("option", "select"), "body": ("head", "html")}
ENDS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in ENDS.items()}
SCOPE = frozenset("table td th caption button object template html body".split())

_TAG = re.compile(r"""</?([a-zA-Z][^\s/>]*+)((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?|["'])*+)>""")
_NAMED = re.compile(r"""\b(class|id|role|itemprop|style|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""", re.IGNORECASE)
_COMMENT_END = re.compile(r"--!?>")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass(slots=True)
class Block:
    text: str
    path: int
    linked: int
    heading: bool
    at: int  # where its text begins in the page


class Paths:
    """Ancestor chains by number, so that equal ones are looked at once. features[p]: names of tags and attribute parts."""

    def __init__(self):
        self.known: dict[tuple[int, str], int] = {}
        self.features: list[frozenset[str]] = [frozenset()]
        self.parts: dict[tuple[str, str], frozenset[str]] = {}

    def of(self, tag: str, attributes: str) -> frozenset[str]:
        key = tag, attributes
        got = self.parts.get(key)
        if got is None:
            names = {f"<{tag}>"}
            for name, value in _NAMED.findall(attributes):
                name, value = name.lower(), value.strip("\"'")
                if name in ("hidden", "aria-hidden"):
                    names |= {"hidden"} if value.lower() != "false" else set()
                elif name == "style":
                    names |= {"hidden"} if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE) else set()
                else:
                    names |= {x.lower() for x in _PART.findall(value)}
            got = self.parts[key] = frozenset(names)
        return got

    def below(self, path: int, tag: str, attributes: str) -> int:
        own = self.of(tag, attributes)
        key = path, f"{tag} {attributes}"
        got = self.known.get(key)
        if got is None:
            got = self.known[key] = len(self.features)
            self.features.append(self.features[path] if own <= self.features[path] else self.features[path] | own)
        return got


def plain(pieces: list[str]) -> str:
    return " ".join("".join(pieces).split())


def leaf_blocks(html: str, paths: Paths) -> list[Block]:
    """The blocks of a page in order, none of them empty, with white space as single blanks."""
    out: list[Block] = []
    stack: list[tuple[str, int]] = []
    open_tags: dict[str, int] = {}
    pieces: list[str] = []
    linked, block, began, at, size = 0, 0, 0, 0, len(html)

    def flush() -> None:
        nonlocal linked
        if pieces and (text := plain(pieces)):
            out.append(Block(text, block, linked, any(t[0] == "h" and t[1:].isdigit() for t, _ in stack[-3:]), began))
        pieces.clear()
        linked = 0

    def text(a: int, b: int) -> None:
        nonlocal linked, block, began
        if b > a:
            piece = html[a:b]
            piece = unescape(piece) if "&" in piece else piece
            if not pieces or not linked and not "".join(pieces).strip():  # white space belongs to no element
                block, began = stack[-1][1] if stack else 0, a
            pieces.append(piece)
            if open_tags.get("a"):
                linked += len(piece)

    def pop() -> str:
        tag = stack.pop()[0]
        open_tags[tag] -= 1
        return tag

    def close(tags: frozenset[str], barrier: frozenset[str]) -> None:
        """Ends the nearest of these elements, and all within, if no barrier comes first."""
        if any(open_tags.get(t) for t in tags):
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in tags:
                    while len(stack) > k:
                        pop()
                    return
                if stack[k][0] in barrier:
                    return

    while at < size:
        lt = html.find("<", at)
        if lt < 0:
            text(at, size)
            break
        nxt = html[lt + 1 : lt + 2]
        if not (nxt.isascii() and nxt.isalpha() or nxt and nxt in "/!?"):  # no tag
            text(at, lt + 1)
            at = lt + 1
            continue
        text(at, lt)
        if html.startswith("<!--", lt):
            end = _COMMENT_END.search(html, lt + 2)
            at = end.end() if end else size
            continue
        found = _TAG.match(html, lt)
        if not found:
            if nxt in "!?" or nxt == "/" and not (html[lt + 2 : lt + 3].isascii() and html[lt + 2 : lt + 3].isalpha()):
                end = html.find(">", lt)
                at = end + 1 if end >= 0 else size
                continue
            break  # the page ends within a tag
        at = found.end()
        tag = found[1].lower()
        inline = tag in INLINE
        if not inline and tag not in RAW:
            flush()
        if nxt == "/":
            if open_tags.get(tag):
                while pop() != tag:
                    pass
            continue
        if tag in RAW:
            end = RAW[tag].search(html, at)
            at = html.find(">", end.start()) + 1 or size if end else size
            continue
        if tag == "br":
            pieces.append(" ") if pieces else None
        if tag in ENDS:
            close(*ENDS[tag])
        if tag in ENDS_P:
            close(frozenset(("p",)), SCOPE)
        if tag not in VOID and not (found[2].endswith("/") and not inline and tag in ("path", "use", "circle", "rect")):
            stack.append((tag, paths.below(stack[-1][1] if stack else 0, tag, found[2])))
            open_tags[tag] = open_tags.get(tag, 0) + 1
    flush()
    return out
