"""Pages to text lines, in one pass over their markup.

Every search either moves on or remembers that there is nothing more to find, so a
page takes time in proportion to its length, however its tags are broken.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from functools import cache

_BLOCK_TAGS = (
    "address|article|aside|blockquote|body|dd|details|div|dl|dt|fieldset|figure|footer|form|h[1-6]|header|hr"
    "|html|li|main|nav|ol|p|pre|section|table|tbody|td|tr|ul"
)
#: Elements whose content is no text of the page. One that is closed in its own tag
#: has none; one that is left open ends at the next block, or, if its content is no
#: markup, at the end of the page.
CODE = frozenset("script style".split())
NOT_NESTED = frozenset("button iframe noscript select textarea title".split())
DRAWN = frozenset("audio canvas math object svg template video".split())
#: These are closed in their own tag by ``/>``.
SELF_CLOSED = (DRAWN | NOT_NESTED | {"script"}) - {"noscript"}
BEGIN = re.compile("<[/!?]?[a-zA-Z]")
SIMPLE = re.compile(r"""<[/!?]?[a-zA-Z][^<>"']*>""")
SPECIAL = re.compile("""[>"']""")
NEXT_BLOCK = re.compile(rf"</?(?:{_BLOCK_TAGS})\b", re.I)
NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
MARKS = re.compile(r"""\b(?:class|id|role|aria-label|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
SPLIT = re.compile(r"[^a-z]+|(?<=[a-z])(?=[A-Z])")

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol"
    " p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that end where the next block begins.
LOOSE = frozenset("p li dt dd td th tr caption h1 h2 h3 h4 h5 h6".split())
CONTENT = frozenset("article main".split())
#: Elements that no class sets apart.
WHOLE = frozenset("html body main article h1 h2 h3 h4 h5 h6".split())
#: Elements that only a form around a page or its article contains.
PAGE_PARTS = CONTENT | frozenset("nav header footer h1".split())
#: Words that in an article name a part of it.
SECTIONS = frozenset(["discussion"])
#: Elements without content or an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that a head holds; any other ends it.
HEAD = frozenset("base link meta noscript script style template title".split())
ASIDE = frozenset("aside dialog footer form head menu nav".split())
#: Words of a class, id or role that mark what is not the article.
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs cc comment"
    " comments complementary consent contentinfo cookie cookies copyright dialog disclaimer discussion"
    " disqus feedback footer form gdpr masthead menu menus modal nav navbar navigation newsletter"
    " notice notices notification pager pagination popup promo promoted promotion recommended"
    " related replies reply respond reviews search share sharing sidebar sidebars signup skip"
    " social sponsor sponsored subscribe subscription tagcloud teaser toolbar topbar widget widgets".split()
)
#: Of those, what an article may be about: there they need a second sign.
DOUBTFUL = frozenset(
    "banner cc dialog disclaimer feedback menu menus notice notices notification reviews skip"
    " widget widgets".split()
)
#: Lines of an article, other lines, lines set apart, and lines of an article that
#: stay unless a near page has them too.
MAIN, OTHER, APART, DOUBT = 0, 1, 2, 3
#: A doubtful block with more of its characters in links is no text.
LINKED = 0.5

#: Text and kind of a line.
Line = tuple[str, int]


class Source:
    """A page's markup, searched forward."""

    def __init__(self, page: str):
        self.page = page
        self._found: dict[re.Pattern, tuple[int, re.Match | None]] = {}
        self._ends: dict[int, int] = {}

    def next(self, pattern: re.Pattern, at: int) -> re.Match | None:
        """The first match from a place on; asked again, it is not searched again."""
        since, found = self._found.get(pattern, (len(self.page) + 1, None))
        if since <= at and (found is None or found.start() >= at):
            return found
        found = pattern.search(self.page, at)
        self._found[pattern] = at, found
        return found

    def tag_end(self, at: int) -> int:
        """The place of the ``>`` outside quotes that ends a tag; -1 without one.

        Tags that come to the same quote end alike, so each is followed once.
        """
        page, way, first, end = self.page, [], True, -1
        while True:
            found = self.next(SPECIAL, at) if first else SPECIAL.search(page, at)
            first = False
            if not found:
                break
            place = found.start()
            if page[place] == ">":
                end = place
                break
            if place in self._ends:
                end = self._ends[place]
                break
            way.append(place)
            close = page.find(page[place], place + 1)
            if close < 0:
                break
            at = close + 1
        self._ends.update(dict.fromkeys(way, end))
        return end

    def after(self, name: str, tag: str, at: int) -> int:
        """Where the page goes on after an element that holds no text."""
        close, begin = _of(name)
        found = self.next(close, at)
        if name in SELF_CLOSED and tag.endswith("/>"):
            again = self.next(begin, at) if name == "script" and found else None
            if name != "script" or not found or (again and again.start() < found.start()):
                return at
        if found and name in NOT_NESTED:
            nested = self.next(begin, at)
            if nested and nested.start() < found.start():
                found = None
        if found:
            return found.end()
        block = None if name in CODE else self.next(NEXT_BLOCK, at)
        return block.start() if block else len(self.page)

    def pieces(self) -> list[tuple[str | None, str]]:
        """Texts, without a name, and tags with theirs; elements without text and
        comments are left out."""
        page, found, at = self.page, [], 0
        while at < len(page):
            begin = page.find("<", at)
            if begin < 0:
                begin = len(page)
            if begin > at:
                found.append((None, page[at:begin].replace("]]>", "")))
            if begin == len(page):
                break
            if page.startswith("<!--", begin):
                close = page.find("-->", begin + 4)
                if close < 0:
                    break
                at = close + 3
                continue
            if page.startswith("<![CDATA[", begin):
                at = begin + 9
                continue
            if not BEGIN.match(page, begin):
                found.append((None, "<"))
                at = begin + 1
                continue
            simple = SIMPLE.match(page, begin)
            end = simple.end() - 1 if simple else self.tag_end(begin)
            if end < 0:
                # A quote is left open: the tag ends at its first >, if at all.
                close, other = self.next(_CLOSER, begin), page.find("<", begin + 1)
                if close and (other < 0 or close.start() < other):
                    end = close.start()
                elif other < 0:
                    break
                else:
                    found.append((None, "<"))
                    at = begin + 1
                    continue
            tag, at = page[begin : end + 1], end + 1
            named = NAME.match(tag)
            if not named:
                continue
            name = named[1].lower()
            if name in CODE or name in NOT_NESTED or name in DRAWN:
                if tag[1] != "/":
                    at = self.after(name, tag, at)
                continue
            found.append((name, tag))
        return found


_CLOSER = re.compile(">")


@cache
def _of(name: str) -> tuple[re.Pattern, re.Pattern]:
    return re.compile(rf"</{name}\s*>", re.I), re.compile(rf"<{name}\b", re.I)


def _words(tag: str) -> set[str]:
    found = set()
    for value in MARKS.findall(tag) if "=" in tag else ():
        found |= {w.lower() for w in SPLIT.split(value) if w} | set(re.findall("[a-z]+", value.lower()))
    return found


def _kind(name: str, tag: str, kind: int, holds_article: bool) -> int:
    """The kind of what an element holds, inside another kind."""
    in_article = kind in (MAIN, DOUBT)
    if name in ASIDE or (name == "header" and not in_article):
        return APART
    if name in WHOLE or holds_article or (in_article and name not in BLOCKS):
        return kind
    words = _words(tag) & ASIDE_WORDS
    if in_article:
        words -= SECTIONS
        if words and words <= DOUBTFUL:
            return DOUBT
    return APART if words else kind


def _around(parts: list[tuple[str | None, str]]) -> tuple[set[int], set[int]]:
    """Places of the start tags whose elements contain an article or main, and of
    forms around a page or a part of it."""
    open_: list[tuple[str, int]] = []
    names: Counter[str] = Counter()
    holding: set[int] = set()
    forms: set[int] = set()
    new_forms: list[int] = []
    for at, (name, part) in enumerate(parts):
        if name is None:
            continue
        if part[1] == "/":
            if names[name]:
                while True:
                    last, place = open_.pop()
                    names[last] -= 1
                    if new_forms and new_forms[-1] == place:
                        new_forms.pop()
                    if last == name:
                        break
            continue
        if name in CONTENT:
            for _, place in reversed(open_):
                if place in holding:
                    break  # and so are those around it
                holding.add(place)
        if name in PAGE_PARTS:
            forms.update(new_forms)
            new_forms.clear()
        if name not in VOID and name not in LOOSE and not part.endswith("/>"):
            open_.append((name, at))
            names[name] += 1
            if name == "form":
                new_forms.append(at)
    return holding, forms


def lines_of(page: str) -> list[Line]:
    """The blocks of a page in order, references decoded and white space single."""
    parts = Source(page).pieces()
    holding, forms = _around(parts)
    open_: list[tuple[str, int]] = []
    names: Counter[str] = Counter()
    kind, found, held, linked = OTHER, [], [], 0

    def flush() -> None:
        nonlocal linked
        if held:
            raw = "".join(held)
            text = " ".join(html.unescape(raw).split())
            if text:
                listed = kind == DOUBT and linked > LINKED * len(raw)
                found.append((text, APART if listed else kind))
            held.clear()
        linked = 0

    def push(name: str, kind: int) -> None:
        open_.append((name, kind))
        names[name] += 1

    def pop() -> str:
        name = open_.pop()[0]
        names[name] -= 1
        return name

    links = 0
    for at, (name, part) in enumerate(parts):
        if name is None:
            held.append(part)
            linked += len(part) if links else 0
            continue
        if name == "br":
            held.append(" ")
            continue
        if name == "a":
            links = 0 if part[1] == "/" else 1
        block = name in BLOCKS
        if block:
            flush()
        if part[1] == "/":
            if names[name]:
                if not block:
                    flush()
                while pop() != name:
                    pass
                kind = open_[-1][1] if open_ else OTHER
            continue
        if name in VOID or part.endswith("/>"):
            continue
        if open_ and open_[-1][0] == "head" and name not in HEAD:
            flush()
            pop()
            kind = open_[-1][1] if open_ else OTHER
        if block:
            while open_ and open_[-1][0] in LOOSE and (name in LOOSE or open_[-1][0] == "p"):
                if name in ("td", "th") and open_[-1][0] == "tr":
                    break
                if open_[-1][0] in ("li", "dd", "td", "th") and name == "p":
                    break
                pop()
            kind = open_[-1][1] if open_ else OTHER
        own = kind
        if kind != APART and at not in forms:
            own = _kind(name, part, kind, at in holding)
        if own != kind:
            if not block:
                flush()
            push(name, own)
        elif block:
            push(name, MAIN if name in CONTENT and kind != APART else kind)
        else:
            continue
        kind = open_[-1][1]
    flush()
    return found
