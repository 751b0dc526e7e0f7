"""Markup to flat text blocks with the measures that a block classifier looks at.

A small forgiving reader, one page at a time: comments, raw elements and half-written tags are passed over, an
element that its tag leaves open ends where HTML lets it end. A block is the text between two block-level tags.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from typing import NamedTuple

BOILER, NEUTRAL, CONTENT = -1, 0, 1

# Element and attribute names of HTML.
BLOCK_TAGS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt
    fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav
    noscript ol option p pre search section select summary table tbody td tfoot th thead tr ul""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style textarea title xmp iframe noembed noframes template svg math object".split())
BOILER_TAGS = frozenset("nav footer aside form dialog menu noscript button select search head".split())
CONTENT_TAGS = frozenset("article main".split())
BOILER_ROLES = frozenset("""navigation banner contentinfo complementary search dialog alert alertdialog form menu
    menubar toolbar tablist""".split())
CONTENT_ROLES = frozenset("main article".split())

# Words in the class and id names of page furniture, and of articles.
BOILER_WORDS = frozenset("""ad ads advert advertisement adverts advertising adsense banner sponsor sponsored sponsors promo
    promotion cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription
    signup signin login register paywall nav navbar navigation menu menus submenu breadcrumb breadcrumbs pagination
    pager skip toolbar topbar header masthead footer colophon copyright legal sidebar sidebars aside widget widgets
    related recommended recommendations trending popular comment comments commentlist disqus respond reply replies
    discussion share sharing social search searchform form tags tagcloud""".split())
CONTENT_WORDS = frozenset("article articlebody body content entry main post story text".split())
NOT_THERE = frozenset("has no with without".split())

_ATTRIBUTES = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])))*+"""
TOKEN = re.compile(r"([^<]++)|<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([A-Za-z][^\s/>]*+)(" + _ATTRIBUTES + r")>|<[!?/][^>]*+(?:>|\Z)|(<)",
                   re.DOTALL)
#: Where a quote is never closed: the tag ends at the next ">".
LOOSE = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)([^>]*+)(?:>|\Z)")
ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|$)""",
                       re.IGNORECASE)
_WORDS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
#: Open elements that a start tag ends, and the elements beyond which it does not look.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}),
        "option": ({"option"}, {"select"}), "a": ({"a"}, BLOCK_TAGS)}
P_ENDS = ({"p"}, {"td", "th", "table", "caption", "button", "object"})


class Block(NamedTuple):
    """One text block: its text, words, words inside links, whether it is a heading, and where it stands."""
    text: str
    words: int
    linked: int
    heading: int
    place: int


def _named(names: str, whole: bool) -> int:
    """What class or id names say; of one name the last known word counts. ``whole``: only one-word names."""
    found = NEUTRAL
    for name in names.split():
        words = [w.lower() for w in _WORDS.findall(name)]
        if whole and len(words) > 1:
            continue
        for i in range(len(words) - 1, -1, -1):
            if i and words[i - 1] in NOT_THERE:
                break
            if words[i] in BOILER_WORDS:
                return BOILER
            if words[i] in CONTENT_WORDS:
                found = CONTENT
                break
    return found


def place_of(tag: str, attributes: str, around: int) -> int:
    """Where the text of an element stands. Inside page furniture everything is furniture."""
    if around == BOILER or tag in BOILER_TAGS or (tag == "header" and around != CONTENT):
        return BOILER
    found = CONTENT if tag in CONTENT_TAGS else NEUTRAL
    if attributes and tag not in ("html", "body"):
        for key, *values in ATTRIBUTE.findall(attributes):
            key, value = key.lower(), unescape("".join(values))
            if key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and _HIDDEN.search(value)):
                return BOILER
            if key == "role":
                said = BOILER if value.lower() in BOILER_ROLES else CONTENT if value.lower() in CONTENT_ROLES else NEUTRAL
            else:
                said = _named(value, tag in CONTENT_TAGS) if key in ("class", "id") else NEUTRAL
            if said == BOILER:
                return BOILER
            found = max(found, said)
    return max(found, around)


def blocks_of(html: str) -> list[Block]:
    """The text blocks of a page in their order."""
    out: list[Block] = []
    stack: list[tuple[str, int]] = []           # open elements and where their text stands
    opened: Counter[str] = Counter()
    parts: list[str] = []
    linked: list[str] = []
    at, end, loose = 0, len(html), False

    def flush() -> None:
        if parts:
            words = unescape("".join(parts)).split()
            if words:
                inside = len(unescape(" ".join(linked)).split())
                heading = next((1 for tag, _ in reversed(stack) if tag in HEADINGS), 0) if opened.keys() & HEADINGS else 0
                out.append(Block(" ".join(words), len(words), min(inside, len(words)), heading, stack[-1][1] if stack else NEUTRAL))
            parts.clear()
            linked.clear()

    def close(until: int) -> None:
        while len(stack) > until:
            tag = stack.pop()[0]
            opened[tag] -= 1
            if not opened[tag]:
                del opened[tag]

    def close_open(targets: set[str], beyond) -> None:
        if not any(t in opened for t in targets):
            return
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in targets:
                close(i)
                return
            if stack[i][0] in beyond:
                return

    while at < end:
        found = (LOOSE if loose and html[at] == "<" else TOKEN).match(html, at) or TOKEN.match(html, at)
        if found.re is LOOSE:
            text, (slash, tag, attributes), stray = None, found.groups(), None
        else:
            text, slash, tag, attributes, stray = found.groups()
        if stray and LOOSE.match(html, at):
            loose = True                        # a quote that nothing closes
            continue
        at = found.end()
        if text or stray:
            parts.append(text or stray)
            if "a" in opened:
                linked.append(text or stray)
            continue
        if tag is None:
            continue
        tag = tag.lower()
        block = tag in BLOCK_TAGS
        if tag == "br":
            parts.append(" ")
        if block:
            flush()
        if slash:
            if tag in opened:
                i = len(stack) - 1
                while stack[i][0] != tag:
                    i -= 1
                close(i)
            continue
        if tag in RAW_TAGS and not attributes.endswith("/"):
            ending = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.IGNORECASE).search(html, at)
            at = ending.start() if ending else end
            continue
        if block and "p" in opened:
            close_open(*P_ENDS)
        if tag in ENDS:
            close_open(*ENDS[tag])
        if tag not in VOID_TAGS:
            around = stack[-1][1] if stack else NEUTRAL
            stack.append((tag, place_of(tag, attributes, around)))
            opened[tag] += 1
    flush()
    return out
