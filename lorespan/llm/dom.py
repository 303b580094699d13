"""Leaf text blocks of HTML pages, with the elements around them."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

BLOCK_TAGS = frozenset(
    "address article aside blockquote body button center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header"
    " hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul video audio canvas iframe".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style noscript template textarea title svg math object iframe".split())
#: A start tag closes an open element of these kinds, unless one of the stops lies between.
CLOSES: dict[str, tuple[frozenset[str], frozenset[str]]] = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "option": (frozenset({"option"}), frozenset({"select"})),
}
_P = (frozenset({"p"}), frozenset({"button", "td", "th", "table", "object"}))

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|[^<]+|<", re.S
)
#: In these, markup is text up to their own end tag.
_ENDS = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*(?:>|$)", re.I) for t in ("script", "style", "textarea", "title", "iframe")}
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_NAME = re.compile(r"[A-Za-z]+")


@dataclass(slots=True)
class Block:
    """Text of a leaf block, the names of the elements around it (tags, and words of class, id and role), its own tag."""

    text: str
    names: tuple[str, ...]
    tag: str
    link_chars: int


def _words(attributes: str) -> tuple[str, ...]:
    if not attributes:
        return ()
    out = []
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name == "hidden" or (name == "style" and re.search(r"display\s*:\s*none", a or b or c, re.I)):
            out.append(".hidden")
        elif name != "style":
            out += ["." + w.lower() for w in _NAME.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", a or b or c))]
    return tuple(out)


def leaf_blocks(html: str) -> Iterator[Block]:
    """Blocks with text, in page order. Character references are decoded, white space is one space, ends are trimmed.

    Comments, scripts, styles and the head's title are no text. Broken markup is read as browsers do where it
    matters here: an open paragraph ends at the next block, list items and cells end at the next one, an end tag
    without a start is skipped, and what is open at the end of the page ends there.
    """
    stack: list[tuple[str, tuple[str, ...]]] = []
    names: tuple[str, ...] = ()
    parts: list[str] = []
    link_chars = in_links = 0
    skip = ""

    def block() -> Block | None:
        text = " ".join(unescape("".join(parts)).split())
        if not text:
            return None
        tag = next((t for t, _ in reversed(stack) if t in BLOCK_TAGS), "body")
        return Block(text, names, tag, link_chars)

    def pop_to(at: int) -> None:
        nonlocal names, in_links
        del stack[at:]
        names = tuple(n for tag, words in stack for n in (tag, *words))
        in_links = sum(t == "a" for t, _ in stack)

    at_char = 0
    while (m := _TOKEN.match(html, at_char)) is not None:
        at_char = m.end()
        closing, tag, attributes = m.group(1, 2, 3) if m.group(2) else m.group(4, 5, 6)  # the latter: quotes don't pair
        if tag is None:
            text = m.group()
            if text[0] == "<" and len(text) > 1:
                continue  # a comment or declaration
            if not skip:
                if text == "<" and html[m.start() + 1 : m.start() + 2].isalpha():
                    break  # a tag that the end of the page cuts off
                parts.append(text)
                if in_links:
                    link_chars += len(text)
            continue
        tag, closing = tag.lower(), closing == "/"
        if not closing and tag in _ENDS and (skip not in ("svg", "math") or tag in ("script", "style")) and not attributes.endswith("/"):
            # The content is no markup: go straight to the end tag; without one the rest of the page is content.
            end = _ENDS[tag].search(html, at_char)
            at_char = end.end() if end else len(html)
            continue
        if skip:
            if closing and tag == skip:
                skip = ""
            continue
        if not closing and tag in RAW_TAGS and not attributes.endswith("/"):
            skip = tag
            continue
        if tag == "br":
            parts.append(" ")
            continue
        is_block = tag in BLOCK_TAGS
        if is_block and parts:
            if (done := block()) is not None:
                yield done
            parts.clear()
            link_chars = 0
        if closing:
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] == tag:
                    pop_to(at)
                    break
                if not is_block and stack[at][0] in BLOCK_TAGS:
                    break
            continue
        if tag in VOID_TAGS:
            continue
        for kinds, stops in (*((CLOSES[tag],) if tag in CLOSES else ()), *((_P,) if is_block else ())):
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] in kinds:
                    pop_to(at)
                    break
                if stack[at][0] in stops:
                    break
        words = _words(attributes)
        stack.append((tag, words))
        names += (tag, *words)
        in_links += tag == "a"
    if parts and (done := block()) is not None:
        yield done
