"""Language-model scoring by a probabilistic suffix tree over bytes.

A text is lower-cased (A-Z), cut into words at ASCII white space and written as the words with one space between them
and an end symbol behind. The tree's contexts are runs of up to DEPTH bytes. All training texts are counted: each task
adds up its (context, next byte) counts in sorted arrays, Spark adds those of the tasks. Counts of shorter contexts are
sums over longer ones.

A context is retained if its next-byte counts diverge enough from those of its suffix one byte shorter: the gain in log
likelihood, sum n(s, x) ln(P(x | s) / P(x | suffix)), must reach ``min_gain`` nats. All that reach it are retained, and
with each its suffixes. Next-byte distributions are smoothed down the tree,
P(x | s) = (n(s, x) + t(s) P(x | suffix)) / (n(s) + t(s)) with t(s) the number of different bytes seen behind s, from a
uniform distribution at the root. A byte is scored in the state of the longest retained suffix of what stands before it.

The divergence test alone decides the tree's size, which grows with the training texts, more slowly than they do. The tree
goes to the executors in slices of at most ``slice_entries`` entries, about 16 bytes each. A slice holds the contexts that
end in one range of byte pairs, with all their suffixes, so it scores the bytes behind these pairs exactly as the whole
tree does. A tree of one slice is asked in one pass over the texts; a larger one in a pass for each slice over a written
copy of the texts, and the scores of a text's slices are added. Only a single pair may exceed the bound.

Words are counted too, for the unigram base score: the most frequent ones, at most FREQUENT of them, are looked
up in a broadcast array of that bound, the few others of a document are joined with the table of counts.

A null text is empty: it has the end token only. Null keys are in bucket 0. Rows that repeat are counted and scored each.
Without training texts each byte has probability 1/256 and the counts are 0. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from papyrix.llm.common import WordHashes, cut, ship, text_batches, words_of

DEPTH = 5
MIN_GAIN = 12.0
FREQUENT = 1 << 19
SLICE_ENTRIES = 1 << 22
PAIRS = 1 << 16

_U = np.uint64
_END = b"\n"
_PIECE = 1 << 20
_HELD = 1_000_000
_KIND_GRAM, _KIND_WORD = 0, 1


def mask(n_bytes: int) -> int:
    return (1 << 8 * n_bytes) - 1


@dataclass
class Stream:
    """The texts of a piece, one after the other: grams of DEPTH + 1 bytes that end at each byte, and where texts start."""

    grams: np.ndarray
    starts: np.ndarray
    words: list[list[bytes]]


def stream(texts) -> Stream:
    words = [words_of(text) for text in texts]
    bodies = [b" ".join(w) + _END for w in words]
    before = _END * DEPTH
    data = np.frombuffer(before + before.join(bodies), np.uint8)
    grams = np.zeros(len(data) - DEPTH, _U)
    for k in range(DEPTH + 1):
        grams = (grams << _U(8)) | data[k : len(data) - DEPTH + k]
    lengths = np.array([len(b) for b in bodies])
    # grams that end inside the padding before a text are left out
    padded = np.concatenate([[0], np.cumsum(lengths[:-1] + DEPTH)])
    own = np.ones(len(grams), bool)
    for k in range(DEPTH):
        own[padded[1:] - 1 - k] = False
    return Stream(grams[own], np.concatenate([[0], np.cumsum(lengths)[:-1]]), words)


class Tally:
    """Counts of 64-bit values as sorted arrays."""

    def __init__(self):
        self.values, self.counts = np.zeros(0, _U), np.zeros(0, np.int64)

    def add(self, values: np.ndarray) -> None:
        new, n = np.unique(values, return_counts=True)
        both = np.concatenate([self.values, new])
        order = np.argsort(both, kind="stable")
        both, n = both[order], np.concatenate([self.counts, n])[order]
        first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.zeros(0, np.int64)
        self.values, self.counts = both[first], np.add.reduceat(n, first) if len(first) else n

    def rows(self, kind: int) -> pa.RecordBatch:
        n = len(self.values)
        out = pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), pa.array(self.values.view(np.int64)), pa.array(self.counts)], ["kind", "value", "n"])
        self.__init__()
        return out


def counts(docs: DataFrame, text: str) -> DataFrame:
    """(kind, value, n): grams of DEPTH + 1 bytes (kind 0) and hashes of words and of the end (kind 1), over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        tallies = [Tally(), Tally()]
        for piece in text_batches(batches, _PIECE):
            s = stream(v.as_py() for v in piece.column(1))
            tallies[_KIND_GRAM].add(s.grams)
            tallies[_KIND_WORD].add(np.concatenate([hashes.of([*w, _END]) for w in s.words]))
            for kind, tally in enumerate(tallies):
                if len(tally.values) > _HELD:
                    yield tally.rows(kind)
        for kind, tally in enumerate(tallies):
            yield tally.rows(kind)

    made = docs.select(F.lit(0).alias("one"), F.col(text).alias("text")).mapInArrow(run, "kind int, value bigint, n bigint")
    return made.groupBy("kind", "value").agg(F.sum("n").alias("n"))


class SuffixTree:
    """keys[d]: sorted context * 256 + byte of the retained contexts of d bytes, with smoothed probabilities;
    contexts[d]: the sorted contexts, with the weight of the shorter one for bytes not seen."""

    def __init__(self, entries: list[tuple[np.ndarray, np.ndarray]]):
        """entries[d]: sorted keys and counts."""
        self.keys, self.probs, self.contexts, self.back = [], [], [], []
        for d, (keys, n) in enumerate(entries):
            if len(keys) == 0:
                break
            of, first, types = np.unique(keys >> _U(8), return_index=True, return_counts=True)
            total = np.add.reduceat(n, first)
            shorter = self.probability(keys, d)
            row = np.repeat(np.arange(len(of)), types)
            self.keys.append(keys)
            self.probs.append((n + types[row] * shorter) / (total[row] + types[row]))
            self.contexts.append(of)
            self.back.append(types / (total + types))

    def probability(self, grams: np.ndarray, depths: int | None = None) -> np.ndarray:
        """Of the last byte of each gram behind the bytes before it, by contexts of fewer than ``depths`` bytes."""
        p = np.full(len(grams), 1 / 256)
        for d in range(len(self.keys) if depths is None else min(depths, len(self.keys))):
            key = grams & _U(mask(d + 1))
            at = np.minimum(np.searchsorted(self.contexts[d], key >> _U(8)), len(self.contexts[d]) - 1)
            known = self.contexts[d][at] == key >> _U(8)
            p = np.where(known, p * self.back[d][at], p)
            at = np.minimum(np.searchsorted(self.keys[d], key), len(self.keys[d]) - 1)
            p = np.where(self.keys[d][at] == key, self.probs[d][at], p)
        return p


class GramScores:
    """Log10 probabilities of grams met so far, sorted; what is remembered is bounded."""

    def __init__(self, tree: SuffixTree):
        self.tree = tree
        self.grams, self.logs = np.zeros(0, _U), np.zeros(0)

    def of(self, different: np.ndarray) -> np.ndarray:
        """different: sorted distinct grams."""
        if len(self.grams) > _HELD:
            self.grams, self.logs = self.grams[:0], self.logs[:0]
        at = np.searchsorted(self.grams, different)
        new = np.ones(len(different), bool)
        inside = at < len(self.grams)
        new[inside] = self.grams[at[inside]] != different[inside]
        if new.any():
            made = np.log10(self.tree.probability(different[new]))
            self.grams, self.logs = np.insert(self.grams, at[new], different[new]), np.insert(self.logs, at[new], made)
            at = np.searchsorted(self.grams, different)
        return self.logs[at]


def context_gains(grams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """grams: (value, n). All contexts' entries (d, key, context, n), and each context's gain over its suffix (d, context, gain)."""
    level = grams.select(F.col("value").alias("key"), "n")
    levels = [level]
    for d in range(DEPTH - 1, -1, -1):
        level = level.groupBy(F.col("key").bitwiseAND(F.lit(mask(d + 1))).alias("key")).agg(F.sum("n").alias("n"))
        levels.append(level)
    entries = None
    for d, level in zip(range(DEPTH, -1, -1), levels):
        rows = level.select(F.lit(d).alias("d"), "key", F.shiftrightunsigned("key", 8).alias("context"), "n")
        entries = rows if entries is None else entries.unionByName(rows)
    entries = cut(entries)
    totals = entries.groupBy("d", "context").agg(F.sum("n").alias("total"))

    def shorter(column: str, n_bytes: int):
        """Without its first byte: the bytes of a context of d bytes are d + n_bytes - 1 then."""
        masks = F.array(*[F.lit(mask(max(0, d - 1 + n_bytes))).cast("bigint") for d in range(DEPTH + 1)])
        return F.col(column).bitwiseAND(F.element_at(masks, F.col("d") + 1))

    parents = entries.select((F.col("d") + 1).alias("d"), F.col("key").alias("up"), F.col("n").alias("up_n"))
    tops = totals.select((F.col("d") + 1).alias("d"), F.col("context").alias("up_context"), F.col("total").alias("up_total"))
    each = entries.filter("d > 0").withColumn("up", shorter("key", 1)).join(parents, ["d", "up"])
    gains = each.groupBy("d", "context").agg(F.sum("n").alias("total"), F.sum(F.col("n") * F.ln(F.col("n") / F.col("up_n"))).alias("part"))
    gains = gains.withColumn("up_context", shorter("context", 0)).join(tops, ["d", "up_context"])
    return entries, gains.select("d", "context", (F.col("part") - F.col("total") * F.ln(F.col("total") / F.col("up_total"))).alias("gain"))


def retained(gains: DataFrame, min_gain: float = MIN_GAIN) -> DataFrame:
    """(d, context): every context whose gain reaches ``min_gain``, and its suffixes."""
    kept = gains.filter(F.col("gain") >= min_gain).select(F.explode(F.sequence(F.lit(1), "d")).alias("d"), "context")
    masks = F.array(*[F.lit(mask(d)).cast("bigint") for d in range(1, DEPTH + 1)])
    return kept.select("d", F.col("context").bitwiseAND(F.element_at(masks, F.col("d"))).alias("context")).distinct()


def tree_of(entries: DataFrame) -> SuffixTree:
    """entries: (d, key, n) of retained contexts, with their suffixes."""
    got = entries.select("d", "key", "n").toArrow()
    d, key, n = (got[c].to_numpy() for c in ("d", "key", "n"))
    tables = []
    for depth in range(DEPTH + 1):
        own = d == depth
        order = np.argsort(key[own])
        tables.append((key[own][order].astype(_U), n[own][order].astype(np.float64)))
    return SuffixTree(tables)


def pair(key):
    """The two bytes before the last one."""
    return F.shiftrightunsigned(key, 8).bitwiseAND(F.lit(PAIRS - 1))


def slices(sizes: list[tuple[int, int]], most: int) -> list[tuple[int, int]]:
    """Ranges [low, high) of pairs that cover all of them, given the number of entries of each pair that has any; a range
    has at most ``most`` entries, unless a single pair has more."""
    edges, inside = [0], 0
    for at, n in sorted(sizes):
        if inside and inside + n > most:
            edges.append(at)
            inside = 0
        inside += n
    return list(zip(edges, [*edges[1:], PAIRS]))


def grow(grams: DataFrame, min_gain: float = MIN_GAIN, slice_entries: int = SLICE_ENTRIES) -> list[tuple[int, int, Callable[[], SuffixTree]]]:
    """The tree's slices: (low, high, what makes the tree that scores bytes behind pairs from low to below high)."""
    entries, gains = context_gains(grams)
    of_retained = cut(entries.join(retained(gains, min_gain), ["d", "context"], "left_semi").select("d", "key", "n"))
    # contexts of up to one byte are suffixes of any: 257 contexts at most, which all slices have
    short = entries.filter("d = 0").select("d", "key", "n").unionByName(of_retained.filter("d = 1"))
    long = of_retained.filter("d > 1")
    sizes = [(r["pair"], r["n"]) for r in long.groupBy(pair("key").alias("pair")).agg(F.count("*").alias("n")).collect()]
    return [(low, high, lambda low=low, high=high: tree_of(short.unionByName(long.filter(pair("key").between(low, high - 1))))) for low, high in slices(sizes, slice_entries)]


def frequent_words(words: DataFrame, most: int = FREQUENT) -> DataFrame:
    """(value, n) of the words whose count is so high that at most ``most`` words have it."""
    by_count = words.groupBy("n").agg(F.count("*").alias("words"))
    reached = by_count.withColumn("reach", F.sum("words").over(W.orderBy(F.desc("n")))).filter(F.col("reach") <= most)
    return words.join(F.broadcast(reached.agg(F.min("n").alias("least"))), F.col("n") >= F.col("least")).select("value", "n")


def sliced_scores(rows: DataFrame, made: tuple[int, int, Callable[[], SuffixTree]]) -> DataFrame:
    """rows: (row, text). The part of each row's score that one slice of the tree gives: (row, score)."""
    low, high, tree = made
    shipped = ship(rows.sparkSession, tree())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = GramScores(shipped())
        for piece in text_batches(batches, _PIECE):
            s = stream(v.as_py() for v in piece.column(1))
            different, at = np.unique(s.grams, return_inverse=True)
            before = different >> _U(8) & _U(PAIRS - 1)
            own = (before >= _U(low)) & (before < _U(high))
            logs = np.zeros(len(different))
            logs[own] = scores.of(different[own])
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(np.add.reduceat(logs[at], s.starts), pa.float64())], ["row", "score"])

    return rows.mapInArrow(run, "row bigint, score double")


def score(
    docs: DataFrame, training: DataFrame, key: str = "doc_id", text: str = "text", min_gain: float = MIN_GAIN, frequent: int = FREQUENT, slice_entries: int = SLICE_ENTRIES
) -> DataFrame:
    """One row per document of ``docs``: key, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    counted = cut(counts(training, text))
    parts = grow(counted.filter(F.col("kind") == _KIND_GRAM).select("value", "n"), min_gain, slice_entries)
    words = counted.filter(F.col("kind") == _KIND_WORD).select("value", "n")
    size = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("types")).first()
    often = frequent_words(words, frequent).toArrow()
    order = np.argsort(often["value"].to_numpy().view(_U))
    whole = parts[0][2]() if len(parts) == 1 else None
    shipped = ship(spark, (whole, often["value"].to_numpy().view(_U)[order], np.log10(often["n"].to_numpy()[order] + 1.0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, values, logs = shipped()
        hashes, scores = WordHashes(), GramScores(tree) if tree else None
        for piece in text_batches(batches, _PIECE):
            s = stream(v.as_py() for v in piece.column(1))
            if scores:
                different, at = np.unique(s.grams, return_inverse=True)
                logp = np.add.reduceat(scores.of(different)[at], s.starts)
            else:
                logp = np.zeros(len(s.words))
            tokens, known, base, rare = [], [], [], []
            for w in s.words:
                h = hashes.of([*w, _END])
                where = np.minimum(np.searchsorted(values, h), max(0, len(values) - 1))
                found = values[where] == h if len(values) else np.zeros(len(h), bool)
                tokens.append(len(h))
                known.append(int(found.sum()))
                base.append(float(logs[where[found]].sum()))
                rare.append(h[~found].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(logp, pa.float64()), pa.array(rare, pa.list_(pa.int64())), *piece.columns[2:]],
                ["key", "n_tokens", "known", "logs", "score", "rare", *piece.schema.names[2:]],
            )

    kind = docs.schema[key].dataType.simpleString()
    asked = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    if whole is None:
        # rows keep their number over the passes
        asked = cut(asked.withColumn("row", F.monotonically_increasing_id()))
    numbered = "" if whole else ", row bigint"
    made = asked.mapInArrow(run, f"key {kind}, n_tokens bigint, known bigint, logs double, score double, rare array<bigint>{numbered}")
    made = cut(made if numbered else made.withColumn("row", F.monotonically_increasing_id()))
    others = made.select("row", F.explode("rare").alias("value")).join(words, "value").groupBy("row").agg(F.count("*").alias("more"), F.sum(F.log10(F.col("n") + 1)).alias("more_logs"))
    out = made.drop("rare").join(others, "row", "left")
    if whole is None:
        sums = None
        for part in parts:
            of_part = cut(sliced_scores(asked.select("row", "text"), part))
            sums = of_part if sums is None else sums.unionByName(of_part)
        out = out.drop("score").join(sums.groupBy("row").agg(F.sum("score").alias("score")), "row")
    tokens = int(size["tokens"])
    base = F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * F.log10(F.lit(float(tokens + size["types"] + 1)))
    return out.select(F.col("key").alias(key), "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(tokens).cast("bigint").alias("train_tokens"), base.alias("base_score"), "score")
