"""HTML to text blocks: a tolerant reader of tags, character references and
block structure, for one page at a time."""

from __future__ import annotations

import re
from html import unescape
from typing import NamedTuple

# Names of HTML elements by their part in a page.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
_BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                   "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td "
                   "template tfoot th thead title tr ul".split())
_JUNK = frozenset("nav footer aside form script style noscript template iframe object applet canvas svg button select textarea input dialog menu search "
                  "head title noembed noframes".split())
_JUNK_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
# Words in class and id names that mark what is no main text.
_JUNK_NAMES = frozenset("ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
                        "notices popup modal overlay newsletter subscribe signup login sidebar menu nav navbar navigation breadcrumb breadcrumbs masthead "
                        "footer share sharing social related recommended recommendations comment comments disqus replies pagination pager widget toolbar".split())
_COMMENT_NAMES = frozenset("comment comments reply replies".split())
_NOT_ITS_OWN = frozenset("has with no without".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[a-zA-Z/!?][^>]*+>?""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_RAW_END = {tag: re.compile(f"</{tag}", re.I) for tag in _RAW}
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Block(NamedTuple):
    """A run of text between block borders, as it stands in the page between
    tags.  ``level``: 2 inside an article, 1 inside the main part only, 0
    elsewhere; ``junk``: inside markup that holds no main text."""

    parts: tuple[str, ...]
    level: int
    junk: bool
    tag: str

    @property
    def text(self) -> str:
        """Character references decoded, white space runs as one space."""
        return " ".join("".join([unescape(p) if "&" in p else p for p in self.parts]).split())


def _names(text: str) -> list[str]:
    """Words of class and id values; those after "has", "no" … say nothing of
    the element itself."""
    out = []
    for value in text.split():
        words = [w.lower() for w in _NAME.findall(value)]
        out += [w for w, before in zip(words, ["", *words]) if before not in _NOT_ITS_OWN]
    return out


def _kind(tag: str, attributes: str, level: int) -> tuple[int, bool]:
    """(level, junk) that an element gives to what it holds."""
    inside = 2 if tag == "article" else 1 if tag == "main" else 0
    junk = tag in _JUNK or tag == "header" and not level
    if "=" in attributes or "hidden" in attributes:
        got = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)}
        names = _names(f"{got.get('class', '')} {got.get('id', '')}")
        role = got.get("role", "").lower()
        if inside or role == "main" or got.get("itemprop", "").lower() == "articlebody":
            junk = junk or not _COMMENT_NAMES.isdisjoint(names)
            inside = max(inside, 2 if got.get("itemprop") else 1)
        elif tag not in ("body", "html"):
            junk = junk or not _JUNK_NAMES.isdisjoint(names) or role in _JUNK_ROLES or "header" in names and not level
        junk = junk or "hidden" in got or got.get("aria-hidden", "").lower() == "true"
    return max(inside, level), junk


def blocks(html: str) -> list[Block]:
    """The page's blocks in page order; those of white space alone are left
    out.  Comments, declarations, scripts, styles and tags give no text;
    a line break is white space; what a page cut short leaves open ends with it."""
    out: list[Block] = []
    names, states, parts = [""], [(0, False)], []
    at, end, search = 0, len(html), _TOKEN.search

    def close() -> None:
        if parts:
            if not all(map(str.isspace, parts)):
                tag = next((t for t in reversed(names) if t in _BLOCK), "")
                out.append(Block(tuple(parts), *states[-1], tag))
            parts.clear()

    def leave(tag: str) -> None:
        if tag in names:
            k = len(names) - 1 - names[::-1].index(tag)
            if tag in _BLOCK or states[k - 1] != states[-1] or not _BLOCK.isdisjoint(names[k:]):
                close()
            del names[k:], states[k:]

    while at < end:
        m = search(html, at)
        if m is None:
            parts.append(html[at:])
            break
        if m.start() > at:
            parts.append(html[at:m.start()])
        at = m.end()
        closing, tag, attributes = m.groups()
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            leave(tag)
            if tag == "p":
                close()
            continue
        if tag == "br":
            parts.append(" ")
        elif tag in _BLOCK:
            if tag != "button":
                leave("p")
            if tag == "li" and names[-1] == "li":
                leave("li")
            close()
        if tag in _RAW:
            stop = _RAW_END[tag].search(html, at)
            at = end if stop is None else html.find(">", stop.start()) + 1 or end
        elif tag not in _VOID:
            level, junk = states[-1]
            inside, own = _kind(tag, attributes, level)
            if (inside, junk or own) != (level, junk):
                close()
            names.append(tag)
            states.append((inside, junk or own))
    close()
    return out


def main_level(found: list[Block]) -> int:
    """The innermost kind of main part that has text on this page."""
    for level in (2, 1):
        if any(b.level == level and not b.junk and b.text for b in found):
            return level
    return 0
