"""Leaf blocks of a web page: texts between block-level tags, with what is above them in the element tree. Plain helpers for one page."""

from __future__ import annotations

import re
from html import unescape
from typing import NamedTuple

# Element names by what they mean for the text inside.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
RAW = frozenset("script style title textarea iframe xmp noembed noframes".split())
DROPPED = frozenset("noscript template svg math select datalist button object audio video canvas".split())
VOID = frozenset("hr br img input meta link base area col embed source track wbr".split())
#: An element that starts closes open ones of these names, down to the nearest of the others.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead"}, {"table"}), "tfoot": ({"tbody", "thead"}, {"table"}), "thead": ({"caption"}, {"table"}),
}
#: Names whose presence above a block is a feature.
ABOVE = "article main section div aside nav header footer form ul ol li dl dd table td th blockquote figure figcaption details dialog pre fieldset menu address search h1 h2 h3 h4 h5 h6 p".split()
LEAVES = "p li td h1 h2 h3 div blockquote pre a".split()
# Words of class, id and role, by what they hint at.
HINTS = {
    "content": "article articlebody body content entry main post prose story text",
    "menu": "breadcrumb breadcrumbs menu nav navbar navigation pager pagination tabs toc",
    "header": "branding header logo masthead topbar",
    "footer": "colophon copyright foot footer legal",
    "side": "archive aside more popular rail recommended related side sidebar tags teaser teasers trending widget widgets",
    "notice": "alert announcement banner consent cookie cookies gdpr modal newsletter notice notification overlay paywall popup subscribe toast warning",
    "advert": "ad ads adslot advert advertisement adverts commercial dfp promo promoted promotion sponsor sponsored",
    "form": "contact form login register search signin signup",
    "comment": "comment commentary commentlist comments discussion disqus feedback replies reply respond responses review reviews thread",
    "share": "facebook follow like share sharing social twitter",
    "meta": "author byline category credit date meta published time timestamp",
    "hidden": "hidden invisible offscreen",
}
GROUPS = list(HINTS)
_GROUP = {word: i for i, words in enumerate(HINTS.values()) for word in words.split()}
_ABOVE = {name: 1 << i for i, name in enumerate(ABOVE)}
_HINT_AT = len(ABOVE)
#: An article inside an article: often a comment.
NESTED = 1 << (_HINT_AT + len(GROUPS))

_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*)((?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|["'=])*+)>""")
_PLAIN_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|itemprop|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s"'/]|$)""", re.I)
_CAMEL = re.compile(r"([a-z])([A-Z])")
_WORDS = re.compile(r"[a-z]+")
_NO_DISPLAY = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}


class Block(NamedTuple):
    text: str
    #: Characters inside links.
    linked: int
    leaf: str
    #: Bits of ABOVE, then of GROUPS over all elements above, then NESTED.
    above: int
    #: The group bits of the nearest element that hints at any.
    nearest: int
    #: Numbers of the element that holds the block and of the one above it.
    parent: int
    grand: int


def _hints(name: str, attributes: str) -> int:
    """Group bits of an element's class, id and role. The page's own elements hint at nothing."""
    if not attributes or name in ("html", "body"):
        return 0
    found = 0
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "style":
            hidden = bool(_NO_DISPLAY.search(value))
        elif key in ("hidden", "aria-hidden"):
            hidden = value.lower() not in ("false", "until-found")
        else:
            hidden = False
            for word in _WORDS.findall(_CAMEL.sub(r"\1 \2", value).lower()):
                if word in _GROUP:
                    found |= 1 << _GROUP[word]
        if hidden:
            found |= 1 << GROUPS.index("hidden")
    return found


def blocks(html: str) -> list[Block]:
    """The blocks with text, in the order of the page. Time grows in proportion to the page's length."""
    out: list[Block] = []
    # name, bits above and of its own, nearest hints, number
    stack: list[tuple[str, int, int, int]] = [("body", 0, 0, 0)]
    made = 0
    texts: list[tuple[str, bool]] = []
    linked = False
    at, size = 0, len(html)
    quoted, last_end = True, html.rfind(">")
    dropped: list[str] = []
    count: dict[str, int] = {}

    def flush() -> None:
        nonlocal linked
        linked_now, linked = linked, False
        if not texts:
            return
        text = " ".join("".join(t for t, _ in texts).split())
        if text:
            name, above, nearest, number = stack[-1]
            inside = sum(len(t.strip()) for t, of_link in texts if of_link) if linked_now or any(x for _, x in texts) else 0
            # a paragraph, item, cell or heading is held by the element around it
            place = len(stack) - 1
            while place > 0 and stack[place][0] in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "td", "th", "tr", "pre", "dd", "dt"):
                place -= 1
            out.append(Block(text, min(inside, len(text)), name, above, nearest, stack[place][3], stack[max(place - 1, 0)][3]))
        texts.clear()

    def pop_to(place: int) -> None:
        for name, *_ in stack[place:]:
            count[name] -= 1
        del stack[place:]

    while at < size:
        lt = html.find("<", at)
        if lt < 0:
            lt = size
        if lt > at and not dropped:
            texts.append((unescape(html[at:lt]), linked))
        if lt == size:
            break
        if html.startswith("<!--", lt):
            end = html.find("-->", lt + 4 if not html.startswith("<!-->", lt) else lt + 2)
            at = size if end < 0 else end + 3
            continue
        if html.startswith(("<!", "<?", "</"), lt) and not html[lt + 2 : lt + 3].isalpha() or html.startswith(("<!", "<?"), lt):
            end = html.find(">", lt)
            at = size if end < 0 else end + 1
            continue
        m = None
        if lt < last_end:
            m = _TAG.match(html, lt) if quoted else _PLAIN_TAG.match(html, lt)
            if m is None and quoted and html[lt + 1 : lt + 2].isalpha():
                quoted = False  # a quote that never ends: from here on tags end at the next >
                m = _PLAIN_TAG.match(html, lt)
        if m is None:
            if lt > last_end and re.match(r"</?[A-Za-z]", html[lt : lt + 3]):
                break  # the page was cut inside a tag
            if not dropped:
                texts.append(("<", linked))
            at = lt + 1
            continue
        at = m.end()
        closing, name, attributes = m.group(1), m.group(2).lower(), m.group(3)
        if closing:
            if dropped:
                if name == dropped[-1]:
                    dropped.pop()
                elif name in dropped:
                    del dropped[dropped.index(name) :]
                continue
            if name == "a":
                linked = False
            elif name in BLOCK:
                flush()
                if count.get(name) and name not in ("body", "html"):
                    place = len(stack) - 1
                    while stack[place][0] != name:
                        place -= 1
                    pop_to(place)
            continue
        if name in RAW:
            end = _ENDS[name].search(html, at)
            at = end.start() if end else size
            continue
        if name in DROPPED:
            if not attributes.endswith("/"):
                dropped.append(name)
            continue
        if dropped:
            continue
        if name == "br":
            texts.append((" ", linked))
        elif name == "a":
            linked = True
        elif name in BLOCK:
            flush()
            if stack[-1][0] == "p":
                pop_to(len(stack) - 1)
            if name in CLOSES:
                open_, bound = CLOSES[name]
                if any(count.get(x) for x in open_):
                    place = len(stack) - 1
                    while place > 0 and stack[place][0] not in open_ and stack[place][0] not in bound:
                        place -= 1
                    if place > 0 and stack[place][0] in open_:
                        pop_to(place)
            if name in VOID or name in ("html", "body"):
                continue
            _, above, nearest, _ = stack[-1]
            hints = _hints(name, attributes)
            bit = _ABOVE.get(name, 0)
            if name == "article" and above & bit:
                bit |= NESTED
            made += 1
            count[name] = count.get(name, 0) + 1
            stack.append((name, above | bit | hints << _HINT_AT, hints or nearest, made))
    flush()
    return out
