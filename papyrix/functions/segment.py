"""Cutting texts into sentences, chunks and limited fragments.

A chunk is made of whole units, tried in this order: a block (paragraph or table row), a sentence, a piece between
secondary marks, a slice of words. Units are packed in order while their sizes fit the budget.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, replace

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

Count = Callable[[str], int]

# Characters that end sentences or close what was opened; abbreviations whose point ends nothing.
ENDS = ".!?…。！？؟।"
CLOSERS = "\")]»”’'›〉】"
ABBREVIATIONS = frozenset(
    """
    sr sra srta dr dra prof profa ing lic mr mrs ms jr dept univ inc ltd corp gen col lt cap cmdr adm sgt art arts caps vol vols
    fig figs tab tabs núm num nro ed eds pp pág págs pag pags ver vs etc aprox ej cf al ee uu ss aa av avda apdo tel
    """.split()
)

BUDGET, LIMIT, NER_BUDGET = 350, 250, 320

_GAP = re.compile(r"\s+")
_LAST_WORD = re.compile(r"[^\W\d_.]*(?:\.[^\W\d_]*)*\Z")
_SECONDARY = [re.compile(rf"(?<={mark})\s+(?=\S)") for mark in (r"\.", ";", ":")] + [re.compile("\n")]


def word_count(text: str) -> int:
    return len(text.split())


def ends_sentence(text: str) -> bool:
    """Whether a text ends where a sentence does; closers behind the mark belong to it."""
    bare = text.rstrip(CLOSERS)
    if not bare or bare[-1] not in ENDS:
        return False
    if bare[-1] != ".":
        return True
    word = _LAST_WORD.search(bare[:-1])[0].replace(".", "").lower()
    return len(word) != 1 and word not in ABBREVIATIONS


def sentences(text: str) -> list[str]:
    """Cuts at white space behind a sentence's end, unless what follows is lower case."""
    out, start = [], 0
    for gap in _GAP.finditer(text):
        a, b = gap.span()
        if b < len(text) and not text[b].islower() and ends_sentence(text[max(start, a - 200) : a]):
            out.append(text[start:a].strip())
            start = b
    out.append(text[start:].strip() if out else text)
    return [s for s in out if s] or [text]


def rejoined(blocks: Iterable[str]) -> list[str]:
    """A block that goes on in lower case what the one before it hasn't finished belongs to that one."""
    out: list[str] = []
    for block in blocks:
        if out and block[:1].islower() and not ends_sentence(out[-1]):
            out[-1] += " " + block
        else:
            out.append(block)
    return out


def secondary(text: str) -> list[str]:
    """Pieces between the first kind of secondary mark that cuts at all. A mark inside a word (3.5, a:b) doesn't cut."""
    for mark in _SECONDARY:
        pieces = [p for p in map(str.strip, mark.split(text)) if p]
        if len(pieces) > 1:
            return pieces
    return [text]


def packed(sizes: Iterable[int], budget: int) -> list[tuple[int, int]]:
    """Ranges of consecutive items whose sizes add up to ``budget`` at most; an item that is larger stands alone."""
    out, start, total, n = [], 0, 0, 0
    for n, size in enumerate(sizes):
        if n > start and total + size > budget:
            out.append((start, n))
            start, total = n, 0
        total += size
    return [*out, (start, n + 1)] if out or total or n else out


def word_slices(text: str, count: Count, budget: int) -> list[str]:
    w = text.split()
    return [" ".join(w[a:b]) for a, b in packed(map(count, w), budget)] or [text]


@dataclass(frozen=True)
class Unit:
    text: str
    before: str
    level: int
    size: int


def units(text: str, before: str, count: Count, budget: int, level: int = 1) -> Iterator[Unit]:
    """Units that fit, of the lowest level that works. Level 4, slices, isn't cut any further."""
    size = count(text)
    if size <= budget:
        yield Unit(text, before, level, size)
        return
    cutters = {1: sentences, 2: secondary, 3: lambda t: word_slices(t, count, budget)}
    pieces = cutters[level](text)
    if level == 3:
        made = [Unit(p, " ", 4, count(p)) for p in pieces]
        yield from [replace(made[0], before=before), *made[1:]] if len(made) > 1 else [Unit(text, before, 4, size)]
        return
    for i, piece in enumerate(pieces):
        yield from units(piece, " " if i else before, count, budget, level + 1)


@dataclass(frozen=True)
class ChunkText:
    position: int
    text: str
    num_tokens: int
    cut_level: int
    n_units: int


def chunks(text: str | None, tabular: bool = False, count: Count = word_count, budget: int = BUDGET, block: str = "\n\n") -> Iterator[ChunkText]:
    """Chunks in order, numbered from 0 without gaps. Blank texts have none."""
    blocks = [b for b in map(str.strip, (text or "").split(block)) if b]
    if not tabular:
        blocks = rejoined(blocks)
    all_units = [u for b in blocks for u in units(b, block, count, budget)]
    position = 0
    for a, b in packed([u.size for u in all_units], budget):
        group = all_units[a:b]
        body = (group[0].text + "".join(u.before + u.text for u in group[1:])).strip()
        if body:
            yield ChunkText(position, body, max(1, count(body)), max(u.level for u in group), len(group))
            position += 1


def limited(text: str, limit: int = LIMIT) -> list[str]:
    """Fragments of ``limit`` words at most: whole sentences, else pieces at secondary marks, else slices."""
    if word_count(text) <= limit:
        return [text]

    def joined(parts: list[str]) -> list[str]:
        return [" ".join(parts[a:b]) for a, b in packed(map(word_count, parts), limit)]

    out: list[str] = []
    small: list[str] = []
    for sentence in sentences(text):
        if word_count(sentence) <= limit:
            small.append(sentence)
            continue
        out += joined(small)
        small = []
        pieces, fitting = secondary(sentence), []
        for piece in pieces:
            if word_count(piece) <= limit:
                fitting.append(piece)
                continue
            out += joined(fitting)
            fitting = []
            w = piece.split()
            out += [" ".join(w[i : i + limit]) for i in range(0, len(w), limit)]
        out += joined(fitting)
    return (out + joined(small)) or [text]


@udtf(returnType="position int, text string, num_tokens int, cut_level int, n_units int")
class ChunkUdtf:
    def eval(self, text: str, tabular: bool, budget: int, block: str):
        for c in chunks(text, bool(tabular), word_count, budget, block):
            yield c.position, c.text, c.num_tokens, c.cut_level, c.n_units


@udtf(returnType="position int, text string")
class SentenceUdtf:
    def eval(self, text: str):
        yield from enumerate(sentences(text)) if text and text.strip() else ()


@udtf(returnType="position int, text string")
class LimitUdtf:
    def eval(self, text: str, limit: int):
        yield from enumerate(limited(text, limit)) if text and text.strip() else ()


def register(spark: SparkSession) -> None:
    """SQL names: chunk_text, split_sentences, split_limit, to be used with LATERAL."""
    spark.udtf.register("chunk_text", ChunkUdtf)
    spark.udtf.register("split_sentences", SentenceUdtf)
    spark.udtf.register("split_limit", LimitUdtf)
