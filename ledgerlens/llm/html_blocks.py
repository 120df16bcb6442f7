"""Text blocks of a page, in Python tasks: one pass over the markup."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BREAKS = HEADINGS | frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())  # their text is no markup, and no main text
ABOUT_PAGE = frozenset("head title meta link style script base noscript template".split())
# A start tag of the key ends an open element of the value.
ENDS = {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}

ASIDE = frozenset("aside audio button canvas dialog footer form nav noscript object search select svg template video".split())
ASIDE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
ASIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner nav navbar navigation menu breadcrumb breadcrumbs masthead topbar "
    "footer sidebar widget comment comments disqus respond reply replies cookie cookies consent gdpr notice notification alert popup modal overlay "
    "newsletter subscribe signup login search share sharing social related recommended pagination pager toolbar copyright disclaimer".split()
)
UNLESS = frozenset("has with without no not layout".split())  # has-sidebar names the page around a sidebar
NEVER_ASIDE = frozenset("html body main".split())

ATTRIBUTES = r"(?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+|[\"'])*+"
TAG = re.compile(rf"<(/?)([a-zA-Z][^\s/>]*+)({ATTRIBUTES})>")
ATTRIBUTE = re.compile(r"([^\s=\"'/>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?+")
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Block(NamedTuple):
    text: str
    linked: int  # characters inside links
    parent: int  # the element the block's own element lies in
    kind: str  # name of the block's element
    aside: bool  # in an element that never holds main text
    article: bool  # in an article or main element


class _Open(NamedTuple):
    name: str
    number: int
    parent: int
    aside: bool
    article: bool
    own_header: bool


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """("text", text, ""), ("start", name, attributes) and ("end", name, "")."""
    at, n = 0, len(html)
    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            yield "text", html[at:], ""
            return
        tag = TAG.match(html, lt)
        if tag is None and html[lt + 1 : lt + 2] not in ("!", "?", "/") and not html[lt + 1 : lt + 2].isalpha():
            yield "text", html[at : lt + 1], ""  # a bare sign
            at = lt + 1
            continue
        if lt > at:
            yield "text", html[at:lt], ""
        if tag is None:  # a comment, declaration or unfinished tag
            comment = html.startswith("<!--", lt)
            end = html.find("-->" if comment else ">", lt + 2)
            if end < 0 or html[lt + 1].isalpha():
                return
            at = end + (3 if comment else 1)
            continue
        at = tag.end()
        name = tag[2].lower()
        yield ("end" if tag[1] else "start"), name, tag[3]
        if not tag[1] and name in RAW:
            end = RAW_END[name].search(html, at)
            if end is None:
                return
            at = end.start()


def _attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(source):
        out.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    return out


def _is_aside(name: str, attributes: dict[str, str]) -> bool:
    if name in NEVER_ASIDE:
        return False
    if name in ASIDE or attributes.get("role", "").lower() in ASIDE_ROLES or "hidden" in attributes:
        return True
    if attributes.get("aria-hidden", "") == "true" or "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return True
    for value in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        parts = {p.lower() for p in NAME_PARTS.findall(value)}
        if parts & ASIDE_NAMES and not parts & UNLESS:
            return True
    return False


def blocks(html: str) -> list[Block]:
    """The blocks that hold text, in order: character references decoded, white
    space (Unicode's, so also no-break spaces) as one space."""
    out: list[Block] = []
    stack = [_Open("", 0, 0, False, False, False)]
    opened: Counter[str] = Counter()
    text: list[str] = []
    links = linked = number = 0

    def flush() -> None:
        nonlocal linked
        words = " ".join("".join(text).split())
        if words:
            top = stack[-1]
            heading = top.name in HEADINGS
            parent = top.parent if heading or top.name in ("p", "li", "td", "dd", "dt") else top.number
            # of a header inside an article only the headings belong to it
            out.append(Block(words, linked, parent, top.name, top.aside or (top.own_header and not heading), top.article))
        text.clear()
        linked = 0

    def pop() -> None:
        opened[stack.pop().name] -= 1

    for kind, name, rest in tokens(html):
        if kind == "text":
            value = unescape(name)
            text.append(value)
            if links:
                linked += sum(map(len, value.split()))
            continue
        if name in BREAKS:
            flush()
            links = 0
        elif name in ("br", "td", "img"):
            text.append(" ")
        if kind == "end":
            if name == "a":
                links = max(0, links - 1)
            if opened[name] > 0:
                flush_before = name not in BREAKS and stack[-1].aside
                if flush_before:
                    flush()
                while stack[-1].name != name:
                    pop()
                pop()
            continue
        if name == "a":
            links += 1
        ends = ENDS.get(name, {"p"} if name in BREAKS else ())
        while stack[-1].name in ends or (stack[-1].name == "head" and name not in ABOUT_PAGE):
            pop()
        if name in VOID:
            continue
        attributes = _attributes(rest) if rest.strip() else {}
        top = stack[-1]
        article = top.article or name in ("article", "main") or attributes.get("role", "").lower() in ("article", "main")
        header = name == "header" or "header" in (attributes.get("class", "") + " " + attributes.get("id", "")).lower().split()
        aside = _is_aside(name, attributes) or name in RAW or name == "head" or (header and not article)
        if name in BREAKS or aside:
            if name not in BREAKS:
                flush()
            number += 1
            stack.append(_Open(name, number, top.number, top.aside or aside, article, top.own_header or (header and article)))
            opened[name] += 1
    flush()
    return out
