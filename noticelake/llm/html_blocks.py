"""HTML as a sequence of leaf blocks: their text and the tags they stand in."""

from __future__ import annotations

import html
import re
from typing import NamedTuple

#: Elements that begin and end a block of text.
BLOCK = frozenset(
    "html head body title div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th section article aside nav header "
    "footer main form fieldset legend blockquote pre figure figcaption hr address details summary select option optgroup textarea button "
    "iframe noscript menu dialog template hgroup search center".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup; only the closing tag ends it.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: An open element of the value ends where the key begins.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_LISTS = frozenset("ul ol dl table menu select".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>?|[^<]+|<", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


class Block(NamedTuple):
    text: str
    path: tuple[str, ...]  # tags and .names from the root
    linked: int  # characters inside links


def _step(tag: str, attributes: str) -> tuple[str, ...]:
    names = [x.lower() for m in _NAMES.finditer(attributes) for x in re.split(r"[\s_-]+", next(g for g in m.groups() if g is not None)) if x]
    return (tag, *(f".{x}" for x in names))


def blocks(source: str) -> list[Block]:
    """Leaf blocks in page order, with references decoded, white space as single blanks and no empty ones."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked, links = 0, 0
    where: tuple[str, ...] = ()

    def flush() -> None:
        nonlocal linked
        if parts:
            if text := " ".join("".join(parts).split()):
                out.append(Block(text, where, min(linked, len(text))))
            parts.clear()
        linked = 0

    def pop(depth: int) -> None:
        nonlocal links
        for tag, _ in stack[depth:]:
            links -= tag == "a"
        del stack[depth:]

    at, n = 0, len(source)
    while at < n:
        m = _TOKEN.match(source, at)
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            if source[m.start()] != "<" or m.end() == m.start() + 1:
                if not parts:
                    where = tuple(x for _, step in stack for x in step)
                piece = html.unescape(m[0])
                parts.append(piece)
                if links:
                    linked += len(piece.strip())
            continue
        tag, closes, attributes = tag.lower(), m[1] or m[4], m[3] or m[6] or ""
        if closes:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if depth is not None:
                if tag in BLOCK:
                    flush()
                pop(depth)
            continue
        if tag in BLOCK:
            flush()
            # a paragraph ends at any block; list items and cells end at their likes of the same list
            for i in range(len(stack) - 1, -1, -1):
                open_tag = stack[i][0]
                if open_tag == "p" or open_tag in ENDS.get(tag, ()):
                    pop(i)
                    break
                if open_tag in _LISTS or (open_tag in BLOCK and tag not in ENDS):
                    break
        elif tag == "br":
            parts.append(" ") if parts else None
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(source, at)
            body = source[at : end.start() if end else n]
            at = end.end() if end else n
            if tag in ("title", "textarea"):
                parts.append(html.unescape(body))
                where = tuple(x for _, step in stack for x in step) + _step(tag, attributes)
                flush()
            continue
        if tag not in VOID and not attributes.rstrip().endswith("/"):
            stack.append((tag, _step(tag, attributes)))
            links += tag == "a"
    flush()
    return out
