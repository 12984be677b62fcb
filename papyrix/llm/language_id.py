"""Language identification by word-first backoff.

A model holds, for each language, log10 relative frequencies of words and of character n-grams (lengths 1 to 4, with
marks at word ends). A word that the model knows is scored by its word frequencies. A word it doesn't know is scored by
its 4-grams; where a 4-gram isn't known, by the 3-grams inside it, then 2-grams, then single characters; the word gets
the mean over its parts times the model's unseen-word weight. The language with the largest sum wins; ties go to the
smaller name.

Training counts words of whole labelled texts. Documents are a sample: of each language the ``max_docs`` with the smallest
hash of the key, so that every language stays a class at every size. Known words are those that the sample has twice or
more, as what is seen once tells no more than its parts; n-grams are counted on all of its words, weighted by count.

Words are runs of letters (Unicode L) and of marks (M) between or behind them, lower-cased; numerals such as one half or
a superscript two are no letters. Text without a letter, null text, or a model without languages give "und" and score 0.
Null languages don't train. Repeated keys are sampled together, a null key like any other. Rows that repeat are predicted
each; texts of any length are taken whole; ties go to the smaller name. Columns may have any names. An empty table gives
an empty result.
"""

from __future__ import annotations

import math
import re
import sys
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from papyrix.llm.common import cut, if_small, ship, text_batches


_CATEGORIES = np.array([unicodedata.category(chr(p)) for p in range(sys.maxunicode + 1)])


def _class(*categories: str) -> str:
    """The characters of some Unicode categories as ranges for a regular expression's class."""
    points = np.flatnonzero(np.isin(_CATEGORIES, categories))
    ends = np.flatnonzero(np.diff(points, append=-1) != 1)
    starts = np.concatenate([[0], ends[:-1] + 1])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(points[starts], points[ends]))


_LETTER = f"[{_class('Lu', 'Ll', 'Lt', 'Lm', 'Lo')}]"
LETTERS = re.compile(f"{_LETTER}+(?:[{_class('Mn', 'Mc', 'Me')}]+{_LETTER}*)*")
#: Says the same, faster, where neither marks nor numerals other than digits occur.
_PLAIN = re.compile(r"[^\W\d_]+")
_ODD = np.append(np.isin(_CATEGORIES[: 1 << 17], ("Nl", "No", "Mn", "Mc", "Me")), True)


def words_of_letters(text: str) -> list[str]:
    """The words of a text, lower-cased."""
    text = text.lower()
    if text.isascii() or not _ODD[np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), len(_ODD) - 1)].any():
        return _PLAIN.findall(text)
    return LETTERS.findall(text)


LONGEST = 4
MAX_DOCS = 5_000
LEAST_WORDS = 2
UNDETERMINED = "und"
#: A word's mean part score is worth this many words: unseen words are rarer evidence than a frequent known word.
UNSEEN = 1.0
#: Added to each count, so that a language that lacks a word isn't excluded by it.
PRIOR = 0.5

_FLUSH = 150_000
PIECE = 2 << 20


def word_counts(labelled: DataFrame) -> DataFrame:
    """labelled: (lang, text). (lang, word, n) over whole texts; counts leave a task whenever it holds many, so its memory is bounded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)

        def flushed() -> pa.RecordBatch:
            rows = [(name, word, n) for name, of in counts.items() for word, n in of.items()]
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.int64())], ["lang", "word", "n"])

        for batch in text_batches(batches):
            for name, value in zip(batch.column(0), batch.column(1)):
                counts[name.as_py()].update(words_of_letters(value.as_py()))
                if sum(map(len, counts.values())) > _FLUSH:
                    yield flushed()
        yield flushed()

    return labelled.select("lang", "text").mapInArrow(run, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def parts(word: str, size: int) -> list[str]:
    marked = f"<{word}>"
    return [marked[i : i + size] for i in range(max(1, len(marked) - size + 1))]


def gram_counts(words: DataFrame) -> DataFrame:
    """words: (lang, word, n). (lang, size, part, n) of the parts() of all words, weighted by their counts."""
    marked = F.concat(F.lit("<"), F.col("word"), F.lit(">"))
    of = lambda size: F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(marked) - size + 1)), lambda i: F.struct(F.lit(size).alias("size"), F.substring(marked, i, F.lit(size)).alias("part")))
    every = words.select("lang", "n", F.explode(F.concat(*[of(size) for size in range(1, LONGEST + 1)])).alias("g"))
    return every.groupBy("lang", "g.size", "g.part").agg(F.sum("n").alias("n"))


class LanguageModel:
    """Scores words; made from the counts of each language's words, and of its parts by size if these aren't those of the words."""

    def __init__(self, counts: dict[str, dict[str, int]], grams: list[dict[str, dict[str, int]]] | None = None):
        self.languages = sorted(counts)
        self.words = self._table(counts)
        if grams is None:
            grams = [{name: Counter() for name in counts} for _ in range(LONGEST)]
            for name, of in counts.items():
                for word, c in of.items():
                    for size, table in enumerate(grams, 1):
                        table[name].update({g: c * k for g, k in Counter(parts(word, size)).items()})
        self.grams = [self._table(of) for of in grams]
        self.unknown = np.zeros(len(self.languages))

    def _table(self, counts: dict) -> tuple[dict[str, int], np.ndarray]:
        """Row of each entry, and the rows."""
        seen = {w: i for i, w in enumerate(sorted({w for of in counts.values() for w in of}))}
        rows = np.full((len(seen), len(self.languages)), PRIOR)
        for column, name in enumerate(self.languages):
            for w, c in counts[name].items():
                rows[seen[w], column] += c
        return seen, np.log10(rows / rows.sum(axis=0)) if seen else rows

    def part(self, part: str) -> np.ndarray:
        """Scores of up to LONGEST characters: of the longest n-grams inside that are known."""
        for size in range(min(LONGEST, len(part)), 0, -1):
            known, rows = self.grams[size - 1]
            inner = [known[g] for i in range(len(part) - size + 1) if (g := part[i : i + size]) in known]
            if inner:
                return rows[inner].mean(axis=0)
        return self.unknown


class TextScores:
    """Sums of word scores over texts. Unseen words are scored a batch at a time; what is remembered is bounded."""

    LIMIT = 100_000

    def __init__(self, model: LanguageModel):
        self.model = model
        self.known = centred(model.words[1])
        self._forget()

    def _forget(self) -> None:
        self.index, self.rows = dict(self.model.words[0]), self.known
        self.parts: dict[str, int] = {}
        self.part_rows: list[np.ndarray] = []

    def _part(self, part: str) -> int:
        at = self.parts[part] = len(self.part_rows)
        self.part_rows.append(self.model.part(part))
        return at

    def _learn(self, unseen: list[str]) -> None:
        pieces = [parts(w, LONGEST) for w in unseen]
        known = self.parts
        at = [known[p] if p in known else self._part(p) for of in pieces for p in of]
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        sums = np.add.reduceat(np.array(self.part_rows)[at], np.concatenate([[0], np.cumsum(lengths)[:-1]]))
        self.index.update(zip(unseen, range(len(self.rows), len(self.rows) + len(unseen))))
        self.rows = np.concatenate([self.rows, centred(sums / lengths[:, None] * UNSEEN)])

    def of(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """For each text its sum, scaled by the root of its number of words; None if it has no letter."""
        words = [words_of_letters(t) if t else [] for t in texts]
        if len(self.rows) > len(self.known) + self.LIMIT:
            self._forget()
        unseen = list(dict.fromkeys(w for of in words for w in of if w not in self.index))
        if unseen:
            self._learn(unseen)
        look = self.index.__getitem__
        return [self.rows[np.fromiter(map(look, of), np.int64, len(of))].sum(axis=0) / math.sqrt(len(of)) if of else None for of in words]


def centred(rows: np.ndarray) -> np.ndarray:
    """Log frequencies less their mean: what a word says for and against each language."""
    return rows - rows.mean(axis=1, keepdims=True) if rows.size else rows


def sampled(labelled: DataFrame, key: str, lang: str, max_docs: int, salts: int = 64) -> DataFrame:
    """The rows of each language with the ``max_docs`` smallest hashes of the key. A language's hashes are ranked in salted
    groups first, so that none is ranked whole in one task; what meets there is ``salts`` times ``max_docs`` at most."""
    hashed = labelled.withColumn("_h", F.xxhash64(F.col(key), F.lit(17)))
    ranked = lambda rows, *by: rows.withColumn("_n", F.row_number().over(W.partitionBy(*by).orderBy("_h"))).filter(F.col("_n") <= max_docs).drop("_n")
    few = ranked(hashed.select(F.col(lang).alias("_lang"), "_h", F.pmod("_h", F.lit(salts)).alias("_salt")).distinct(), "_lang", "_salt")
    limits = cut(ranked(few, "_lang").groupBy("_lang").agg(F.max("_h").alias("_limit")))
    return hashed.join(if_small(limits), F.col(lang) == F.col("_lang")).filter("_h <= _limit").drop("_h", "_lang", "_limit")


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", max_docs: int = MAX_DOCS, least_words: int = LEAST_WORDS) -> LanguageModel:
    """Fits on at most ``max_docs`` labelled documents a language (more only if keys repeat)."""
    labelled = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")).filter("lang is not null and text is not null")
    words = cut(word_counts(sampled(labelled, "key", "lang", max_docs)))
    names = sorted(r["lang"] for r in words.select("lang").distinct().toArrow().to_pylist())
    counts: dict[str, dict[str, int]] = {name: {} for name in names}
    for row in words.filter(F.col("n") >= least_words).toArrow().to_pylist():
        counts[row["lang"]][row["word"]] = row["n"]
    grams = [{name: {} for name in names} for _ in range(LONGEST)]
    for row in gram_counts(words).toArrow().to_pylist():
        grams[row["size"] - 1][row["lang"]][row["part"]] = row["n"]
    return LanguageModel(counts, grams)


def predict(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, lang_pred, score (the posterior of a softmax, 0 to 1)."""
    shipped = ship(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped()
        scores = TextScores(model)
        for batch in text_batches(batches, PIECE):
            names, sure = [], []
            for sums in scores.of(batch.column(1).to_pylist()) if model.languages else [None] * batch.num_rows:
                if sums is None:
                    names.append(UNDETERMINED)
                    sure.append(0.0)
                    continue
                weight = 10.0 ** np.maximum(sums - sums.max(), -300)
                names.append(model.languages[int(sums.argmax())])
                sure.append(float(weight.max() / weight.sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(sure, pa.float64())], ["key", "lang_pred", "score"])

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, lang_pred string, score double")
    return out.withColumnRenamed("key", key)


def bucket(key: str, parts: int):
    """crc32 of the key as text, modulo ``parts``; a null key is in bucket 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(parts)), F.lit(0))


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 5) -> DataFrame:
    """Trains on the documents whose crc32(key) mod ``folds`` isn't 0, predicts all: key, held_out, lang_pred, score."""
    model = train(docs.filter(bucket(key, folds) != 0), key, text, lang)
    out = predict(docs, model, key, text)
    return out.select(key, (bucket(key, folds) == 0).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", min_score: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose language is found with a score of ``min_score`` or more; all columns."""
    model = train(docs, key, text, lang)
    shipped = ship(docs.sparkSession, model)
    names = docs.columns
    # the text goes second, where text_batches() looks; one more column first, as it may be the only one
    order = [F.lit(0).alias("_first"), F.col(text).alias("_second"), *[F.col(c) for c in names]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped()
        scores = TextScores(model)
        for batch in text_batches(batches, PIECE):
            found = scores.of(batch.column(1).to_pylist()) if model.languages else [None] * batch.num_rows
            keep = [sums is not None and 1 / (10.0 ** np.maximum(sums - sums.max(), -300)).sum() >= min_score for sums in found]
            yield pa.RecordBatch.from_arrays(batch.columns[2:], names).filter(pa.array(keep, pa.bool_()))

    return docs.select(order).mapInArrow(run, docs.schema)
