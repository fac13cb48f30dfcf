"""The main text of web pages by two passes over their blocks.

A page is read once, from left to right, into blocks of text (what stands between tags that begin a new
line). Scripts, styles, comments, forms and the like are no text; places that say of themselves that they
are beside the article (by their element, role, class or id: menus, footers, sidebars, adverts, notices,
reader comments) are left out with everything in them.

First pass, each block by itself: a block of links is bad; a long block is good if stop words make up
enough of it, and undecided if hardly any do (a table, a list, a language without stop words here); a short
block is undecided. Second pass: undecided blocks take the label of the nearest decided block of the same
region, the good one of two equally near. A region is what an ``article`` or ``main`` element (or the like)
holds, or the rest of the page. Without any decided block an article's own blocks are good. The rest of the
page counts only where no article has any text.

Reading is linear in the length of the page: every search for the end of a tag, comment or script moves
forward, and one that finds no end finishes the page.

Defined results: null and empty pages, and pages without text, give the empty string; pages that break off in
a tag, comment or script lose only that; a character reference is decoded where it stands, an unknown one
stays; pages of any length are read whole; repeated rows give equal results; other columns pass through, but
for those that are called like a result; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .staging import slices

# Frequent function words of the languages of the pages.
STOP_WORDS = {
    "en": "the of and to in is that for it as was with be by on not he his but at are this have from or had an they which one you were all her she there would their we him been has when who will no more if out so up said what its about than into them can only other time",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec son aux d'un cette ou sa mais ont ses être comme était leur nous vous on elle tout",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si sin sobre este ya entre cuando todo esta ser son dos también fue había era muy hasta desde",
}
_STOP = frozenset(" ".join(STOP_WORDS.values()).split())

#: A block of fewer characters is short.
SHORT = 70
#: Least share of stop words among the words of a good block, and of words that stand in links in a bad one.
STOP_SHARE = 0.15
LINK_SHARE = 0.5

# Element names.
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript template svg math object canvas audio video".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BESIDE = frozenset("nav footer aside form button select menu dialog search fieldset datalist".split())
HELD = BLOCKS - VOID - frozenset(["p"]) | frozenset(["button", "select", "a", "span", "datalist"])
MAIN = frozenset(["article", "main"])
ROLES_BESIDE = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
# Words in a class or id that name a place beside the article, and those that speak for it.
WORDS_BESIDE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline comment comments commentlist "
    "consent cookie cookies copyright disclaimer disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter "
    "notice overlay pager pagination popup promo promoted promotion recommended related respond search share sharing sidebar signup "
    "skip social sponsor sponsored sponsors subscribe subscription teaser toolbar widget widgets".split()
)
WORDS_MAIN = frozenset("article articlebody content entry main maincontent post story".split())

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_TAG_PART = re.compile(r">|=\s*[\"']")
_ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role|itemprop|hidden|aria-hidden)(?![^\s=/>])(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")


class _Block:
    __slots__ = ("linked", "region", "text")

    def __init__(self, text: str, linked: int, region: int) -> None:
        self.text, self.linked, self.region = text, linked, region


def _attributes(tag: str) -> dict[str, str]:
    return {m[1].lower(): (m[2] or "").strip("\"'") for m in _ATTRIBUTE.finditer(tag)}


def place(name: str, tag: str, in_main: bool) -> str:
    """What an element is for the text in it: ``main``, ``beside``, or nothing of both."""
    if name in BESIDE or (name == "header" and not in_main):
        return "beside"
    if len(tag) == len(name) or name in ("html", "body"):
        return "main" if name in MAIN else ""
    said = _attributes(tag[len(name) :])
    role = said.get("role", "").lower()
    if role in ROLES_BESIDE and not (in_main and role == "banner"):
        return "beside"
    if ("hidden" in said and said["hidden"].lower() != "until-found") or said.get("aria-hidden", "").lower() == "true":
        return "beside"
    if name in MAIN or role == "main" or said.get("itemprop", "").lower() == "articlebody":
        return "main"
    words = {p.lower() for key in ("class", "id") for p in _PART.findall(said.get(key, ""))}
    if words & WORDS_BESIDE and not words & WORDS_MAIN:
        return "beside"
    return ""


class _Reader:
    """One pass over a page; ``blocks`` holds its text outside of places beside the article."""

    def __init__(self) -> None:
        self.blocks: list[_Block] = []
        self.parts: list[str] = []
        self.linked = 0  # words of the block that stand in links
        self.links = 0
        self.beside = 0
        self.skipped = False  # the paragraph that is open is itself beside the article
        self.open: list[tuple[str, str]] = []  # (element, what it is)
        self.count: dict[str, int] = {}
        self.regions = [0]
        self.made = 0

    def text(self, raw: str) -> None:
        if self.beside or self.skipped:
            return
        value = html.unescape(raw) if "&" in raw else raw
        self.parts.append(value)
        if self.links:
            self.linked += len(_WORD.findall(value))

    def flush(self) -> None:
        if self.parts:
            value = " ".join("".join(self.parts).split())
            if value:
                self.blocks.append(_Block(value, self.linked, self.regions[-1]))
            self.parts = []
        self.linked = 0

    def start(self, name: str, tag: str) -> None:
        if name == "br":
            self.parts.append("\n")
        if name in BLOCKS:
            self.flush()
            # a paragraph ends where the next block begins, with or without its end tag
            self.skipped = name == "p" and place(name, tag, len(self.regions) > 1) == "beside"
        if name not in HELD:
            return
        if name == "a":
            if self.count.get("a"):  # links do not nest
                self.end("a")
            self.links += 1
        kind = place(name, tag, len(self.regions) > 1)
        if kind == "beside":
            if name not in BLOCKS and name != "a" and name != "span":
                self.flush()
            self.beside += 1
        elif kind == "main":
            self.made += 1
            self.regions.append(self.made)
        self.open.append((name, kind))
        self.count[name] = self.count.get(name, 0) + 1

    def end(self, name: str) -> None:
        if name in BLOCKS:
            self.flush()
            self.skipped = False
        if not self.count.get(name):
            return
        while True:
            top, kind = self.open.pop()
            if kind == "beside" and top not in ("a", "span"):
                self.flush()
            self.count[top] -= 1
            self.links -= top == "a"
            self.beside -= kind == "beside"
            if kind == "main":
                self.flush()
                self.regions.pop()
            if top == name:
                return

    def read(self, page: str) -> list[_Block]:
        at, end = 0, len(page)
        while at < end:
            tag = page.find("<", at)
            if tag < 0:
                self.text(page[at:])
                break
            if tag > at:
                self.text(page[at:tag])
            at = self._markup(page, tag)
        self.flush()
        return self.blocks

    def _markup(self, page: str, at: int) -> int:
        """Handle what begins with ``<`` at a place; the place behind it."""
        end = len(page)
        if page.startswith("<!--", at):
            if page.startswith((">", "->"), at + 4):
                return page.index(">", at) + 1
            close = page.find("-->", at + 4)
            return end if close < 0 else close + 3
        following = page[at + 1 : at + 2]
        if following in ("!", "?"):
            close = page.find(">", at)
            return end if close < 0 else close + 1
        closing = following == "/"
        name = _NAME.match(page, at + 1 + closing)
        if name is None:
            if closing:  # "</" before anything else is a comment up to the next ">"
                close = page.find(">", at)
                return end if close < 0 else close + 1
            self.text("<")
            return at + 1
        stop = name.end()
        while True:
            part = _TAG_PART.search(page, stop)
            if part is None:
                return end
            if part[0] == ">":
                break
            stop = page.find(part[0][-1], part.end()) + 1
            if not stop:
                return end
        stop = part.end()
        element = name[0].lower()
        if closing:
            self.end(element)
            return stop
        if element in RAW:
            close = re.compile(rf"</{element}(?=[\s/>])", re.I).search(page, stop)
            if element in BLOCKS:
                self.flush()
            if close is None:
                return end
            close_end = page.find(">", close.end())
            return end if close_end < 0 else close_end + 1
        self.start(element, page[at + 1 : stop - 1])
        return stop


def first_pass(block: _Block) -> bool | None:
    """Whether a block is good, by itself; None where that cannot be said."""
    found = _WORD.findall(block.text.lower())
    if block.linked > LINK_SHARE * len(found):
        return False
    if len(block.text) < SHORT or not found:
        return None
    return True if sum(w in _STOP for w in found) >= STOP_SHARE * len(found) else None


def second_pass(labels: list[bool | None], otherwise: bool) -> list[bool]:
    """Undecided blocks take the label of the nearest decided one (the good one of two), else ``otherwise``."""
    far = len(labels) + 1
    ahead, distance, label = [], far, otherwise
    for own in reversed(labels):
        distance, label = (0, own) if own is not None else (distance + 1, label)
        ahead.append((distance, label))
    out, distance, label = [], far, otherwise
    for own, (later, late) in zip(labels, reversed(ahead), strict=True):
        distance, label = (0, own) if own is not None else (distance + 1, label)
        if distance == later:
            out.append(label or late)
        else:
            out.append(label if distance < later else late)
    return out


def main_text(page: str | None) -> str:
    """The main text of a page: its good blocks in order, with an empty line between two."""
    blocks = _Reader().read(page or "")
    regions: dict[int, list[int]] = {}
    for k, block in enumerate(blocks):
        regions.setdefault(block.region, []).append(k)
    kept: list[int] = []
    for region, inside in regions.items():
        if region:
            labels = second_pass([first_pass(blocks[k]) for k in inside], True)
            kept += [k for k, good in zip(inside, labels, strict=True) if good]
    if not kept and 0 in regions:
        inside = regions[0]
        labels = second_pass([first_pass(blocks[k]) for k in inside], True)
        kept = [k for k, good in zip(inside, labels, strict=True) if good]
    return "\n\n".join(blocks[k].text for k in sorted(kept))


def extracted(pages: DataFrame, page: str = "html") -> DataFrame:
    """``pages`` without the html, and its main ``text`` and ``n_chars`` (code points)."""
    made = ("text", "n_chars")
    kept = [c for c in pages.columns if c != page and c.lower() not in made]
    schema = StructType(
        [pages.schema[c] for c in kept] + [StructField("text", StringType()), StructField("n_chars", LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [main_text(value) for value in batch.column(page).to_pylist()]
            new = [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *new], names=[*kept, *made])

    return pages.select(*kept, page).mapInArrow(run, schema)
