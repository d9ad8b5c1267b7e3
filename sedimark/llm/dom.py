"""A tolerant HTML reader that yields the leaf blocks of a page with features of their ancestors."""

from __future__ import annotations

import re
from html import unescape

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[!?/][^>]*+>""", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_NAME = re.compile("[a-z]+")
RAW = ("script", "style", "title", "textarea", "template", "iframe", "svg", "xmp")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split())
#: A start tag on the left ends an open element on its right, within the nearest container.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "body": ("head",)}
SCOPE = frozenset("html body article section main div nav aside header footer table ul ol dl form td th blockquote".split())


class Block:
    """A run of text without block boundaries inside."""

    __slots__ = ("link", "own", "path", "text")

    def __init__(self, text: str, path: frozenset, own: str, link: float):
        self.text, self.path, self.own, self.link = text, path, own, link


def blocks(html: str) -> list[Block]:
    """The text blocks of a page in order; scripts, styles, title, comments and markup are left out."""
    out: list[Block] = []
    stack: list[tuple[str, frozenset]] = [("", frozenset())]
    parts: list[str] = []
    linked, links, first = 0, 0, stack[0]
    own = ""

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            out.append(Block(text, first[1], own, linked / len(text)))
        linked = 0

    def say(text: str) -> None:
        nonlocal linked, first, own
        if "&" in text:
            text = unescape(text)
        if not parts or not any(map(str.strip, parts)):
            first = stack[-1]
            own = next((t for t, _ in reversed(stack) if t not in INLINE), "")
        parts.append(text)
        if links:
            linked += len(text.strip())

    at, n = 0, len(html)
    while at < n:
        found = _TAG.search(html, at)
        if not found:
            say(html[at:])
            break
        if found.start() > at:
            say(html[at : found.start()])
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            if tag not in INLINE:
                flush()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
                if tag in INLINE and stack[k][0] not in INLINE:
                    break
            links = sum(t == "a" for t, _ in stack) if tag == "a" or links else 0
            continue
        if tag in RAW:
            if tag == "svg" and found[3].endswith("/"):
                continue
            end = re.compile(f"</{tag}\\b[^>]*>", re.I).search(html, at)
            if end or tag != "svg":  # in an svg that never ends, the page goes on
                at = end.end() if end else n
            continue
        if tag not in INLINE:
            flush()
            ends = ENDS.get(tag, ()) if tag in ENDS else ("p",)
            for k in range(len(stack) - 1, 0, -1) if tag != "noscript" else ():
                if stack[k][0] in ends or stack[k][0] == "p":
                    del stack[k:]
                    break
                if stack[k][0] in SCOPE:
                    break
        if tag in VOID or found[3].endswith("/") and tag not in INLINE:
            continue
        names = {f"in={tag}"}
        if "=" in found[3]:
            for name, *values in _ATTRIBUTE.findall(found[3]):
                names.update(f"as={w}" for w in _NAME.findall(" ".join(values).lower()) if name)
        stack.append((tag, stack[-1][1] | names))
        links += tag == "a"
    flush()
    return out
