"""HTML main text by two-pass block rules.

A page becomes text blocks with features: length, stop-word density, link density, and what the markup says about them (an
element or class name that hints at boilerplate, an article element, the containers they stand in). Pass one decides the clear
blocks: mostly links is boilerplate, enough stop words is main text. A hint counts as boilerplate only if the page has other text:
names alone never empty a page. Pass two gives the ambiguous blocks, the short ones mostly, the label of their nearest
decided neighbours: main text if either is, in their own container or on the page. At the start or end of a page a neighbour
in another container counts only if one of the containers is around the other.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightloom.llm.common import small_batches

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    """a about after all an and any are as at be been but by can could did do for from had has have he her his how i if in into is it its
    more most my no not of on one only or other our out over she so some such than that the their them then there these they this to up
    was we were what when which who will with would you your
    aber als am an auch auf aus bei bin bis da das dass dem den der des die doch durch ein eine einem einen einer er es für hat ich ihr im
    in ist ja kann man mit nach nicht noch nur oder sich sie sind so über um und uns von vor war was wenn wie wir wird zu zum zur
    au aux avec ce ces comme dans de des du elle en est et il ils je la le les leur lui mais me même mon ne nous on ou où par pas plus pour
    qu que qui sa sans se ses son sont sur ta te tu un une vous
    al como con cuando de del desde donde el ella ellos en entre era es esta este está fue ha hasta hay la las le lo los me mi muy más no
    nos o para pero por porque que se ser si sin sobre su sus también te tiene todo un una uno y ya""".split()
)
# Elements that hold no text, elements with raw content, elements that end a block, elements without an end tag.
NO_TEXT = frozenset("head script style noscript template svg math iframe object select button textarea canvas audio video map".split())
RAW = frozenset("script style textarea title iframe noscript template".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main "
    "menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that group blocks, elements that hint at boilerplate, words of class and id attributes and roles that do,
# words that may stand beside them in a compound name, and words that mark a whole article element as not the page's own.
CONTAINERS = frozenset("article aside body center details dialog div fieldset figure footer form header main nav section td th".split())
HINT_ELEMENTS = frozenset("form nav footer header aside dialog menu".split())
HINTS = frozenset(
    "ad ads adbox advert adverts advertisement adsense sponsor sponsored sponsors promo promoted promotion banner cookie cookies consent gdpr notice notices alert alerts popup "
    "modal overlay newsletter subscribe subscription signup paywall nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars widget widgets related recommended "
    "recommendations footer header masthead topbar toolbar share sharing social comment comments disqus reply replies respond discussion pagination pager login search skip "
    "copyright disclaimer".split()
)
NEUTRAL = frozenset(
    "area bar bottom box block body button center col column container content fixed group head holder icon inner inline item left link links list main outer page panel right "
    "row section site slot small sticky text title top unit wrap wrapper zone reader user global primary secondary post news google".split()
)
OWN_ARTICLES = frozenset("comment comments disqus reply replies respond discussion related recommended recommendations sidebar sidebars widget widgets".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())

# Attribute values end with their quote; outside of them a tag ends at > and never runs over the next <.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^<>]*>|<(/?)([a-zA-Z][\w:-]*)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][\w:-]*)([^<>]*)>", re.S)
_ATTRIBUTE = re.compile(r"([\w:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_WORD = re.compile(r"\w+")
_DEEPEST = 64  # containers below count as their ancestor at this depth


@dataclass
class Tag:
    name: str
    end: bool
    attributes: str
    start: int
    stop: int
    partner: int = -1  # index of the end tag of a start tag


@dataclass
class Block:
    container: int = 0
    hinted: bool = False
    article: bool = False
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""
    size: int = 0  # characters other than white space


def read_tags(html: str) -> list[Tag]:
    """Tags in page order, each start tag paired with its end tag where there is one. One pass over the page."""
    tags: list[Tag] = []
    opened: list[int] = []
    count: dict[str, int] = {}
    unclosed: set[str] = set()  # raw elements without an end tag in the rest of the page
    pos = 0
    while m := _TOKEN.search(html, pos):
        pos = m.end()
        name = (m[2] or m[5] or "").lower()
        tag = Tag(name or "!", bool(m[1] or m[4]), m[3] or m[6] or "", m.start(), pos)
        tags.append(tag)
        if not name or name in VOID:
            continue
        if tag.end:
            if count.get(name):
                # what was opened inside and not closed has no end tag
                while tags[opened[-1]].name != name:
                    count[tags[opened.pop()].name] -= 1
                tags[opened.pop()].partner = len(tags) - 1
                count[name] -= 1
            continue
        opened.append(len(tags) - 1)
        count[name] = count.get(name, 0) + 1
        if name in RAW and name not in unclosed:
            close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, pos)
            if close is not None:
                pos = close.start()
            else:
                unclosed.add(name)
                if name in ("script", "style"):
                    pos = len(html)
    return tags


def _name_hints(value: str, wanted: frozenset[str]) -> bool:
    """Does a class or id value hold a name made of hint words and neutral ones only?"""
    for name in value.split():
        parts = [w.lower() for w in _NAME_PART.findall(name)]
        if any(w in wanted for w in parts) and all(w in HINTS or w in NEUTRAL for w in parts):
            return True
    return False


def _hint(tag: Tag) -> str:
    """"hidden" or "hint" if a start tag says that its content is no article text, "own" if even articles in it are not the page's, else empty."""
    wanted = HINTS if tag.name not in ("html", "body", "main", "article") else OWN_ARTICLES if tag.name == "article" else frozenset()
    found = "hint" if tag.name in HINT_ELEMENTS else ""
    if tag.attributes:
        for m in _ATTRIBUTE.finditer(tag.attributes):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key in ("class", "id") and wanted:
                if _name_hints(value, OWN_ARTICLES):
                    found = "own"
                elif _name_hints(value, wanted):
                    found = found or "hint"
            elif key == "role" and value.lower() in ROLES:
                found = found or "hint"
            elif key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
                return "hidden"
        if re.search(r"(?:^|\s)hidden(?:\s|$)", tag.attributes):
            return "hidden"
    return found


@dataclass
class Page:
    blocks: list[Block]
    parents: list[int]  # of each container; the root 0 is its own

    def above(self, c: int) -> list[int]:
        """The container and all around it, without the root and the body."""
        out = []
        while c and self.parents[c] != c:
            out.append(c)
            c = self.parents[c]
        return out

    def root(self, c: int) -> int:
        """The body or root around a container."""
        while c and self.parents[c] != c:
            c = self.parents[c]
        return c


def read_page(html: str) -> Page:
    """Text blocks in page order. Content of elements that hold no text is left out; unclosed ones end at the next block."""
    tags = read_tags(html)
    articles = [i for i, t in enumerate(tags) if not t.end and t.name in ("article", "main")]
    borders = [i for i, t in enumerate(tags) if t.name in BLOCKS]
    links = [i for i, t in enumerate(tags) if t.name in BLOCKS or t.name == "a"]
    blocks: list[Block] = []
    parents = [0]
    # open containers, hints and articles: index of the end, what is said of the text inside, container, its depth
    inside: list[tuple[int, str, int, int]] = [(len(tags), "", 0, 0)]
    current = Block()
    link_end = pos = i = 0

    def after(places: list[int]) -> int:
        at = bisect_left(places, i + 1)
        return places[at] if at < len(places) else len(tags)

    def finish() -> Block:
        current.text = " ".join("".join(current.parts).split())
        if current.text:
            current.size = len(current.text) - current.text.count(" ")
            blocks.append(current)
        _, kind, container, _ = inside[-1]
        return Block(container, kind in ("hint", "own"), kind == "article")

    def add(piece: str) -> None:
        if piece:
            piece = unescape(piece)
            current.parts.append(piece)
            if link_end >= max(i, 1):
                current.linked += len("".join(piece.split()))

    while i < len(tags):
        t = tags[i]
        add(html[pos : t.start])
        pos = t.stop
        link_end = link_end if link_end > i else 0
        ended = i >= inside[-1][0]
        while i >= inside[-1][0]:
            inside.pop()
        if t.name == "!" or t.end:
            if ended or t.name in BLOCKS:
                current = finish()
            i += 1
            continue
        hint = "" if t.name in VOID else _hint(t)
        if t.name in NO_TEXT or hint == "hidden":
            current = finish() if t.name in BLOCKS or hint else current
            if t.partner >= 0:
                i, pos = t.partner + 1, tags[t.partner].stop
            else:
                i = after(borders)
                pos = tags[i].start if i < len(tags) else len(html)
            continue
        end, around, container, depth = inside[-1]
        first = after(articles)
        if hint == "hint" and first < (t.partner if t.partner >= 0 else end) and (t.name not in ("aside", "nav", "footer") or tags[first].name == "main"):
            hint = ""  # a wrapper of the page's article says nothing about it
        kind = hint or ("article" if t.name in ("article", "main") and around != "own" else "")
        if kind or t.name in CONTAINERS:
            if t.partner >= 0:
                end = t.partner
            elif hint:
                end = min(end, after(borders))
            if t.name in CONTAINERS and depth < _DEEPEST:
                # the body is its own parent, as it is around everything
                parents.append(len(parents) if t.name == "body" else container)
                container, depth = len(parents) - 1, depth + 1
            inside.append((end, around if around == "own" else kind or around, container, depth))
            current = finish()
        elif t.name in BLOCKS:
            current = finish()
        if t.name == "a":
            # a link without an end reaches to the next block or link
            link_end = t.partner if t.partner >= 0 else after(links)
        elif t.name == "br":
            current.parts.append(" ")
        i += 1
    add(html[pos:])
    finish()
    return Page(blocks, parents)


def stop_share(block: Block) -> float:
    """Share of a block's words that are stop words."""
    words = _WORD.findall(block.text.lower())
    return sum(w in STOP_WORDS for w in words) / max(1, len(words))


def decide(block: Block, max_links: float, short: int, long: int, low: float, high: float) -> bool | None:
    """Pass one for one block: main text, boilerplate or neither (None), whatever the markup hints at."""
    if block.linked > (max_links if not block.article else (1 + max_links) / 2) * block.size:
        return False
    n = len(block.text)
    if n < short:
        return None
    density = stop_share(block)
    return True if density >= high or n >= long and density >= low else None


def label_blocks(page: Page, max_links: float = 0.5, short: int = 70, long: int = 200, bare: float = 0.08, low: float = 0.2, high: float = 0.3, crumb: int = 25) -> list[bool]:
    """Which blocks are main text.

    Pass one: more than ``max_links`` of a block's characters in links is boilerplate; at least ``short`` characters with a stop-word
    density of ``high``, or ``long`` ones with ``low``, are main text. Of the others, blocks of ``short`` characters with less than
    ``bare`` are boilerplate unless their own container holds main text next to them. What the markup says
    weighs less than this: text outside of article elements is boilerplate only if these hold most of the main text of the page (or it has none, and
    they hold undecided text); text under a hint only if there is main text, or ``crumb`` characters of undecided text, without
    one. Pass two: see the module. A page without any main text then keeps its undecided blocks.
    """
    blocks = page.blocks
    first = [decide(b, max_links, short, long, low, high) for b in blocks]

    def amount(label: bool | None, chosen: list[int]) -> int:
        return sum(blocks[i].size for i in chosen if first[i] is label)

    own = [i for i, b in enumerate(blocks) if b.article]
    free = [i for i, b in enumerate(blocks) if not b.hinted]
    rest = [i for i, b in enumerate(blocks) if b.hinted]
    main = amount(True, free)
    if amount(True, own) >= max(1, main / 2) or not main and amount(None, own):
        allowed = set(own)
    elif main or amount(None, free) >= crumb or not amount(True, rest) + amount(None, rest):
        allowed = set(free)
    else:
        allowed = set(range(len(blocks)))
    # what the markup alone rules out has no say about its neighbours
    decided = [first[i] if i in allowed else None for i in range(len(blocks))]
    both_ways = (range(len(blocks)), range(len(blocks) - 1, -1, -1))
    before, after = [_nearest(decided, order) for order in both_ways]
    kin_before, kin_after = [_nearest(decided, order, [b.container for b in blocks]) for order in both_ways]
    result = [d is True for d in decided]
    for i in allowed:
        if decided[i] is None:
            if any(decided[j] for j in (kin_before[i], kin_after[i]) if j is not None):
                result[i] = True
            elif len(blocks[i].text) < short or stop_share(blocks[i]) >= bare:
                result[i] = _between(page, i, before[i], after[i], decided)
    return result if any(result) else [i in allowed and first[i] is None for i in range(len(blocks))]


def _nearest(decided: list[bool | None], order: range, groups: list[int] | None = None) -> list[int | None]:
    """For every block the last decided one before it along ``order``, of its own group if there are groups."""
    last: dict[int, int] = {}
    out: list[int | None] = [None] * len(decided)
    for i in order:
        g = groups[i] if groups else 0
        if decided[i] is None:
            out[i] = last.get(g)
        else:
            last[g] = i
    return out


def _between(page: Page, i: int, before: int | None, after: int | None, decided: list[bool | None]) -> bool:
    """Label of an undecided block by its neighbours in other containers: main text if either is. One neighbour alone must be related."""
    near = [j for j in (before, after) if j is not None]
    good = [j for j in near if decided[j]]
    if len(near) != 1 or not good:
        return bool(good)
    own, other = page.blocks[i].container, page.blocks[good[0]].container
    return own in page.above(other) or own == page.root(other) or other in page.above(own)


def main_text(html: str | None) -> str:
    """Main text of a page: its blocks in page order, joined by one space; empty if there is none."""
    if not html:
        return ""
    page = read_page(html)
    return " ".join(b.text for b, keep in zip(page.blocks, label_blocks(page)) if keep)


def extract_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every row; ``n_chars`` counts code points.

    Null and empty pages have an empty text; pages are read whole, in time that grows with their length; a script or style
    without an end takes the rest of its page. Repeated rows give equal results; other columns of ``pages`` are not looked at. One projection over the pages: no shuffle.
    """

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda h: main_text(h if isinstance(h, str) else None))

    out = small_batches(pages).select("page_id", "url", extract.asNondeterministic()(F.col(html)).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
