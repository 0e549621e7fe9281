"""Text blocks of an HTML page, each with how surely its place in the page is the article.

A small tolerant scanner (unclosed and crossed tags, cut-off pages): block
elements end a block, inline ones and ``<br>`` don't.  Levels:

    3   in an ``article`` element (or ``itemprop=articleBody``)
    2   in ``main`` (or ``role=main``)
    1   in an element whose class or id calls it content
    0   elsewhere
    -1  in a menu, header, footer, sidebar, notice, advert, form or reader
        comment, told by element, role, class or id
"""

from __future__ import annotations

import re
from html import unescape

ARTICLE, MAIN, CONTENT, ELSEWHERE, ASIDE = 3, 2, 1, 0, -1

# Element names, roles and class words of the web.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter output "
                    "progress q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements whose text is none of the page's.
_RAW = frozenset("script style title textarea template noscript iframe object svg select xmp noembed noframes".split())
_ASIDE = frozenset("nav footer aside form dialog menu button fieldset".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
_MENU = "nav navbar navigation menu breadcrumb breadcrumbs pagination pager share sharing social"
_HEAD_FOOT = "masthead topbar footer colophon"
_SIDE = "sidebar aside widget widgets related recommended trending"
_NOTICE = "notice notices cookie cookies consent gdpr banner alert popup modal overlay paywall newsletter subscribe toast"
_ADVERT = "ad ads advert adverts advertisement adsense adsbygoogle sponsor sponsored promo promotion"
_COMMENT = "comment comments disqus respond replies discussion"
_FORM = "form login signup search searchbox"
_ASIDE_WORDS = frozenset(" ".join([_MENU, _HEAD_FOOT, _SIDE, _NOTICE, _ADVERT, _COMMENT, _FORM]).split())
_ARTICLE_ASIDE_WORDS = frozenset(" ".join([_ADVERT, _COMMENT]).split())
_CONTENT_WORDS = frozenset("content article post entry story main body text".split())
#: A class with one of these speaks of what is absent, or of the whole page's layout.
_LAYOUT_WORDS = frozenset("no has with without hide hidden".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""(class|id|role|itemprop|hidden|aria-hidden|style)(?![\w-])(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_CLOSES = {"li": ("li", ("ul", "ol")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr", ("table",)),
           "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ())}


def _place(name: str, raw: str, level: int) -> int | None:
    """The level that an element sets for what is in it; None if it leaves it as it is."""
    attrs = {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(raw)} if raw.strip() else {}
    if name in ("html", "body"):
        return None
    if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", attrs.get("style", ""), re.I):
        return ASIDE
    if name in _ASIDE or attrs.get("role", "").lower() in _ROLES or name == "header" and level < MAIN:
        return ASIDE
    names = [{w.lower() for w in _WORD.findall(n)} for n in f"{attrs.get('class', '')} {attrs.get('id', '')}".split()]
    names = [n for n in names if n and not n & _LAYOUT_WORDS]
    if name != "main" and any(n & (_ARTICLE_ASIDE_WORDS if name == "article" else _ASIDE_WORDS) for n in names):
        return ASIDE
    if level < MAIN and name not in ("main", "article") and any("header" in n for n in names):
        return ASIDE
    if name == "article" or attrs.get("itemprop", "").lower() == "articlebody":
        return ARTICLE
    if name == "main" or attrs.get("role", "").lower() == "main":
        return max(level, MAIN)
    if name not in _INLINE and any(n & _CONTENT_WORDS for n in names):
        return max(level, CONTENT)
    return None


def blocks(html: str) -> list[tuple[int, str]]:
    """(level, text) of every block with text, in page order."""
    out: list[tuple[int, str]] = []
    text: list[str] = []
    stack: list[tuple[str, int]] = []  # open elements and the level outside them
    counts: dict[str, int] = {}
    level, at, head = ELSEWHERE, 0, False

    def flush() -> None:
        if text:
            line = " ".join("".join(text).split())
            text.clear()
            if line:
                out.append((level, line))

    def close(depth: int) -> None:
        nonlocal level
        while len(stack) > depth:
            name, level = stack.pop()
            counts[name] -= 1

    for tag in _TAG.finditer(html):
        if tag.start() < at:
            continue
        if tag.start() > at and not head:
            text.append(unescape(html[at:tag.start()]))
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue
        if name in ("head", "body"):
            head = name == "head" and not tag[1]
        if name in _RAW:
            if not tag[1] and not tag[0].endswith("/>"):
                end = re.compile(f"</{re.escape(name)}(?![A-Za-z0-9-])[^>]*(?:>|\\Z)", re.I).search(html, at)
                at = end.end() if end else len(html)
            continue
        if name == "br":
            text.append(" ")
            continue
        inline = name in _INLINE
        if not inline:
            flush()
        if tag[1]:
            if counts.get(name):
                depth = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name)
                # An inline end tag does not close blocks around it.
                if not inline or all(n in _INLINE for n, _ in stack[depth:]):
                    if inline and stack[depth][1] != level:
                        flush()
                    close(depth)
            continue
        if not inline and counts.get("p"):
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == "p" or stack[i][0] not in _INLINE), -1)
            if depth >= 0 and stack[depth][0] == "p":
                close(depth)
        if name in _CLOSES:
            same, around = _CLOSES[name]
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in same.split() or stack[i][0] in around), -1)
            if depth >= 0 and stack[depth][0] in same.split():
                close(depth)
        if name in _VOID or tag[0].endswith("/>") and inline:
            continue
        place = ASIDE if level == ASIDE else _place(name, tag[3] or "", level)
        if place is not None and place != level and inline:
            flush()
        stack.append((name, level))
        counts[name] = counts.get(name, 0) + 1
        if place is not None:
            level = place
    if at < len(html) and not head:
        text.append(unescape(html[at:]))
    flush()
    return out
