"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. Subtrees that are never part of an article (scripts, styles, menus, page
headers, footers, sidebars, forms; elements whose class, id or role names an advert, a notice, comments and the like) are
left out, if they are closed where they should be; of one that isn't, only the text up to the next block is. If nothing
but links is left then, what only its name spoke against counts after all, so a page wrapped in such an element isn't lost.

First pass, block by block, by link density, and by stop-word density and length together. A block of which more than
LINKS are link text is bad. Of n words, PROSE * n stop words are expected at the border between running text and lists
of words; a block with significantly more (Z standard deviations) is good, one with significantly fewer is thin, and one
whose length doesn't allow either is undecided. Stop words are those of the page's language, of four that are listed; a
page that hardly has any of them has its own, the commonest words (characters, in scripts without spaces) that it has in
three blocks or more.

Second pass: an undecided block takes the label of its nearest decided (good or bad) neighbours, the page's ends being
bad; so does a thin one, which is bad by its own words where that doesn't overrule them. Where the two differ tags decide:
what is inside <article> or <main> is good, on a page without these an undecided block that shares its container with the
good neighbour, or is a heading before it. On a page without any good block, undecided and thin blocks inside <article>
or <main> are good, else undecided ones with more stop words than the border.

Character references are decoded, white space inside a block becomes one space, blocks are joined by an empty line.
A script, style or other raw element without an end tag ends before the next block-level tag, or with the page.
Null, empty and text-free pages give an empty string. Pages are taken whole; rows that repeat are done each. Columns may
have any names. An empty table gives an empty result.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrix.llm.common import text_batches

# The commonest function words of four languages.
STOP_WORDS = {
    "en": "a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their there they this to was we were which will with you",
    "fr": "à au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas plus pour qu que qui sa se ses son sont sur un une vous",
    "de": "aber als am an auch auf aus bei das dass dem den der des die ein eine einem einen einer er es für hat ich im in ist mit nach nicht noch oder sich sie sind so über um und von vor war was wie wird zu zum zur",
    "es": "a al como con de del el ella en entre era es esta este ha hay la las le lo los más me mi muy no nos o para pero por que se ser si sin sobre son su sus también un una y ya",
}
STOPS = [frozenset(words.split()) for words in STOP_WORDS.values()]

RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "object", "canvas", "audio", "video"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = set("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split()) - {"br"}
HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}
LEFT_OUT = {"head", "nav", "footer", "aside", "form", "menu", "select", "button", "dialog", "fieldset"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "menubar"}
NAMES = set("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices disclaimer alert sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs footer copyright share sharing social related recommended newsletter subscribe subscription signup login popup modal overlay widget toolbar pagination pager skip".split())
COMMENTS = {"comment", "comments", "disqus", "replies", "respond", "responses"}
HEADERS = {"header", "masthead", "topbar"}

CONTAINERS = {"article", "aside", "blockquote", "body", "center", "details", "div", "fieldset", "figure", "html", "main", "section", "table", "td"}

PROSE, Z = 0.15, 1.64
LINKS = 0.33
#: A page with a smaller share of listed stop words is in a language that isn't listed.
LISTED, OWN_WORDS, OWN_BLOCKS = 0.05, 30, 3

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|([^<]+|<)", re.S)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for name in RAW}
_NAME = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
_WORD = re.compile(r"[^\W\d_]+")
#: Scripts without spaces between words: each character counts as one.
_CHARACTERS = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff]")
_NEXT_BLOCK = re.compile(rf"<(?:{'|'.join(sorted(BLOCK))})(?=[\s/>])", re.I)


@dataclass(frozen=True)
class Block:
    text: str
    linked: int = 0
    heading: bool = False
    in_article: bool = False
    container: int = 0


class _Element:
    __slots__ = ("close", "drop", "inner", "name", "open")

    def __init__(self, name: str, at: int, drop: str):
        self.name, self.open, self.close, self.drop, self.inner = name, at, None, drop, False


def _why_left_out(name: str, attributes: str, in_article: bool) -> str:
    """"" or what speaks for leaving the element out; "name" gives way to an article inside it."""
    if name in LEFT_OUT or (name == "header" and not in_article):
        return "tag"
    if not attributes or name in ("html", "body"):
        return ""
    if "hidden" in attributes.lower() or "display" in attributes.lower():
        if _HIDDEN.search(attributes):
            return "tag"
    words: set[str] = set()
    for what, *values in _NAME.findall(attributes):
        found = set(_SPLIT.split("".join(values).lower()))
        if what.lower() == "role" and found & ROLES:
            return "name"
        words |= found
    if words & COMMENTS:
        return "tag"
    if name in ("article", "main"):
        return ""
    return "name" if words & NAMES or (words & HEADERS and not in_article) else ""


def tokens_of(page: str) -> list[tuple]:
    """("text", text, container) | ("void", name) | ("start", name, element) | ("end", name), with elements' ends known."""
    tokens: list[tuple] = []
    stack: list[_Element] = []
    at = 0

    def close(depth: int) -> None:
        stack[depth].close = len(tokens)
        del stack[depth:]

    while m := _TOKEN.match(page, at):
        at = m.end()
        slash, name, attributes, text = m.groups()
        if text is not None:
            tokens.append(("text", text, next((e.open for e in reversed(stack) if e.name in CONTAINERS), -1)))
            continue
        if name is None:
            continue
        name = name.lower()
        if slash:
            depth = next((d for d in range(len(stack) - 1, -1, -1) if stack[d].name == name), None)
            if depth is not None:
                close(depth)
            tokens.append(("end", name))
        elif name in RAW:
            if not attributes.endswith("/"):
                # what is inside isn't markup: on to the end tag, or else to the next block
                end = _RAW_END[name].search(page, at)
                following = None if end else _NEXT_BLOCK.search(page, at)
                at = end.end() if end else following.start() if following else len(page)
            tokens.append(("void", name))
        elif name in VOID:
            tokens.append(("void", name))
        else:
            if name in BLOCK:
                # a paragraph ends where a block begins
                depth = next((d for d in range(len(stack) - 1, -1, -1) if stack[d].name in BLOCK), None)
                if depth is not None and stack[depth].name == "p":
                    close(depth)
            if name in ("article", "main", "h1"):
                for e in stack:
                    e.inner = True
            element = _Element(name, len(tokens), _why_left_out(name, attributes, any(e.name in ("article", "main") for e in stack)))
            tokens.append(("start", name, element))
            if attributes.endswith("/"):
                element.close = len(tokens)
            else:
                stack.append(element)
    return tokens


def blocks_of(tokens: list[tuple], by_name: bool = True) -> list[Block]:
    """Blocks in page order. by_name: elements that only their names speak against are left out too."""
    out: list[Block] = []
    parts: list[str] = []
    linked, links, heading, container, skip_to, skip_block = 0, 0, False, None, 0, False
    articles: list[int] = []

    def close_block() -> None:
        nonlocal linked, heading, links, container
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append(Block(text, linked, heading, bool(articles), container))
        parts.clear()
        linked, heading, links, container = 0, False, 0, None

    for i, token in enumerate(tokens):
        while articles and articles[-1] <= i:
            close_block()
            articles.pop()
        if i < skip_to:
            continue
        kind, name = token[0], token[1]
        if kind == "text":
            if not skip_block:
                parts.append(name)
                linked += len(name.strip()) if links else 0
                if container is None and name.strip():
                    container = token[2]
            continue
        if kind == "void":
            if name in ("br", "hr", "img", "input", "wbr"):
                parts.append(" " if name != "wbr" else "")
            continue
        if name in BLOCK:
            close_block()
            skip_block = False
        if kind == "end":
            links = max(0, links - 1) if name == "a" else links
            continue
        element = token[2]
        drop = element.drop == "tag" or (by_name and element.drop == "name" and not element.inner)
        if drop and name == "head" and element.close is None:
            drop = False
        if drop:
            if element.close is not None:
                skip_to = element.close
            else:
                skip_block = True
        if name == "a":
            links += 1
        heading = heading or name in HEADING
        if name in ("article", "main") and not drop:
            articles.append(element.close if element.close is not None else len(tokens) + 1)
    close_block()
    return out


def is_linked(block: Block) -> bool:
    return block.linked > LINKS * len(block.text)


def blocks(page: str) -> list[Block]:
    tokens = tokens_of(page)
    found = blocks_of(tokens)
    if all(map(is_linked, found)):
        found = blocks_of(tokens, by_name=False)
    return found


def words_of_block(text: str) -> list[str]:
    out: list[str] = []
    for w in _WORD.findall(text.lower()):
        if w.isascii() or not _CHARACTERS.search(w):
            out.append(w)
        else:
            out += w
    return out


def page_stops(words: list[list[str]]) -> frozenset[str]:
    """The stop words that hold for a page, given the words of its blocks."""
    count = Counter(w for of in words for w in of)
    share = [sum(count[w] for w in stops) for stops in STOPS]
    if max(share) >= LISTED * count.total():
        return STOPS[share.index(max(share))]
    spread = Counter(w for of in words for w in set(of))
    own = [w for w in count if spread[w] >= OWN_BLOCKS]
    return frozenset(sorted(own, key=lambda w: (-count[w], w))[:OWN_WORDS])


def first_labels(found: list[Block]) -> list[str]:
    words = [words_of_block(b.text) if not is_linked(b) else [] for b in found]
    stops = page_stops(words)
    labels = []
    for b, of in zip(found, words):
        if is_linked(b):
            labels.append("bad")
            continue
        n = len(of)
        excess = sum(w in stops for w in of) - PROSE * n
        border = Z * math.sqrt(PROSE * (1 - PROSE) * n)
        labels.append("good" if n and excess >= border else "thin" if n and excess <= -border else "near" if excess > 0 else "short")
    return labels


def final_labels(found: list[Block], first: list[str], tags: bool = True) -> list[bool]:
    """tags: whether tags decide where neighbours don't; if not, those near to good and headings before good are good."""
    n = len(first)
    decided = [i for i in range(n) if first[i] in ("good", "bad")]
    before, after = [-1] * n, [n] * n
    for here, there in zip([-1, *decided], [*decided, n]):
        for i in range(here + 1, there):
            before[i], after[i] = here, there
    good = lambda i: 0 <= i < n and first[i] == "good"
    articles = tags and any(b.in_article for b in found)
    nothing = "good" not in first
    out = []
    for i, (b, label) in enumerate(zip(found, first)):
        if label in ("good", "bad"):
            out.append(label == "good")
        elif nothing:
            out.append(b.in_article if articles else label == "near")
        elif good(before[i]) == good(after[i]):
            out.append(good(before[i]))
        elif articles:
            out.append(b.in_article)
        elif label == "thin":
            out.append(False)
        else:
            beside = found[before[i] if good(before[i]) else after[i]]
            out.append((tags and b.container == beside.container) or (label == "near" and not tags) or (b.heading and good(after[i])))
    return out


def main_text(page: str | None, tags: bool = True) -> str:
    if not page:
        return ""
    found = blocks(page)
    keep = final_labels(found, first_labels(found), tags)
    return "\n\n".join(b.text for b, good in zip(found, keep) if good)


def extract(pages: DataFrame, key: str = "page_id", page: str = "html", also: tuple[str, ...] = ("url",)) -> DataFrame:
    """One row per page: key, the columns of ``also``, text, n_chars."""
    columns = [key, *also]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, column=len(columns)):
            texts = pa.array([main_text(value.as_py()) for value in batch.column(len(columns))], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], texts], [*(f"c{i}" for i in range(len(columns))), "text"])

    kinds = ", ".join(f"c{i} {pages.schema[c].dataType.simpleString()}" for i, c in enumerate(columns))
    out = pages.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)], F.col(page).alias("page")).mapInArrow(run, f"{kinds}, text string")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)], "text", F.length("text").cast("bigint").alias("n_chars"))
