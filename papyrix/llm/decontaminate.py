"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

An item (a short test text) leaks into a document (long) if at least ``percent`` of its distinct word shingles occur in
it. Similarity of the two whole sets would be tiny, so the search is for containment and depends on the item's size:

1. Items are partitioned by the size of their shingle set, in powers of 2. In each partition the signature of an item is
   the smallest hashes of its set (bottom-k MinHash), k = floor((1 - t) * largest size in the partition) + 1, or all of
   them. A document that contains t of the item lacks fewer than k of its shingles, so it has one of the signature's:
   the search misses nothing.
2. Each document is read once; its windows of ``size`` words are probed in a bit table of the signatures' hashes. One
   without a hit is done with. The hits of the others are joined with the signatures to candidates, (document, item).
3. Candidates are verified: the item's whole set against the document's. For this a document that has a signature's hash
   gives, in the same pass, those of its windows that a second bit table, of all items' shingles, lets through; only those
   of candidates' own items are counted.

Items whose text is shorter than ``size`` words are one shingle, matched as a whole run of words of that length in a
document. The set of items may be of any size: signatures and sets are joined, not broadcast; only the bit tables (their
size follows from the number of hashes, at most 2**MOST_TABLE_BITS / 8 bytes = 16 MB for each length of items' shingles)
go to the executors.

Null or blank documents and items match nothing, nor do those with a null key. Rows that share a key are searched each
for itself; of several, or of several items with one key, the best one speaks for the pair. Rows that repeat give a pair
once.
Columns may have any names. Empty tables give an empty result. Texts are taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrix.llm.common import WordHashes, bits_for, cut, shingles, text_batches, without_keys, words_of

SIZE = 5
PERCENT = 80
#: A document has many windows, so few of them may be let through by chance.
LEAST_TABLE_BITS, MOST_TABLE_BITS = 24, 27


def item_shingles(items: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(unit, item, words, hash): the distinct shingles of each row of items, numbered; words: how many words one has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in text_batches(batches):
            found = [words_of(value.as_py()) for value in batch.column(1)]
            sets = [np.unique(shingles(words.of(w), size)).astype(np.int64) for w in found]
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(0), pa.array([min(size, len(w)) for w in found], pa.int32()), pa.array(sets, pa.list_(pa.int64()))], ["unit", "item", "words", "set"])

    kind = items.schema[key].dataType.simpleString()
    rows = items.select(F.col(key).alias("item"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("unit"))
    made = rows.mapInArrow(run, f"unit bigint, item {kind}, words int, set array<bigint>")
    return made.filter("words > 0 and item is not null").select("unit", "item", "words", F.explode("set").alias("hash"))


def signatures(sets: DataFrame, percent: int) -> DataFrame:
    """(unit, words, n, hash) of the smallest hashes of each item, as many as its size partition asks for."""
    sizes = sets.groupBy("unit", "words").agg(F.count("*").alias("n"), F.sort_array(F.collect_list("hash")).alias("all"))
    top = F.pow(2, F.ceil(F.log2("n")))
    k = F.least(F.col("n"), F.floor(top * (100 - percent) / 100) + 1).cast("int")
    return sizes.select("unit", "words", "n", F.explode(F.slice("all", 1, k)).alias("hash"))


def bit_tables(hashes: DataFrame, bits: int) -> dict[int, bytes]:
    """hashes: (words, hash). A table of 2**bits bits for each length; put together on the executors."""
    slots = hashes.select("words", F.shiftrightunsigned("hash", 64 - bits).alias("at"))
    parts = slots.select("words", F.bitmap_bucket_number(F.col("at") + 1).alias("part"), F.bitmap_bit_position(F.col("at") + 1).alias("bit")).groupBy("words", "part").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    tables: dict[int, np.ndarray] = {}
    for row in parts.toArrow().to_pylist():
        whole = tables.setdefault(row["words"], np.zeros(1 << (bits - 3), np.uint8))
        start = (row["part"] - 1) * 4096
        whole[start : start + 4096] = np.frombuffer(row["bitmap"], np.uint8)[: len(whole) - start]
    return {words: whole.tobytes() for words, whole in tables.items()}


def document_hits(docs: DataFrame, signature: DataFrame, sets: DataFrame, key: str, text: str, size: int, bits: int | None = None) -> DataFrame:
    """(row, doc, hash, signed): of documents that have a hash of some signature, the windows that may be an item's
    shingle, each once; signed: whether it may be of a signature."""
    bits = bits or min(MOST_TABLE_BITS, max(LEAST_TABLE_BITS, bits_for(sets.count(), 1024)))
    shared = docs.sparkSession.sparkContext.broadcast((bit_tables(signature, bits), bit_tables(sets, bits)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        signed, known = ({n: np.frombuffer(whole, np.uint8) for n, whole in tables.items()} for tables in shared.value)

        def let_through(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
            at = hashes >> np.uint64(64 - bits)
            return (table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1

        for batch in text_batches(batches, column=2):
            at, found, marks = [], [], []
            for i, value in enumerate(batch.column(2)):
                hashes = words.of(words_of(value.as_py()))
                windows = {n: shingles(hashes, n) for n in signed if len(hashes) >= n}
                if not any(let_through(signed[n], h).any() for n, h in windows.items()):
                    continue
                for n, h in windows.items():
                    h = np.unique(h[let_through(known[n], h)])
                    at.append(np.full(len(h), i))
                    found.append(h)
                    marks.append(let_through(signed[n], h))
            whole = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
            of = pa.array(whole(at, np.int64).astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(of), batch.column(1).take(of), pa.array(whole(found, np.uint64).astype(np.int64)), pa.array(whole(marks, bool))], ["row", "doc", "hash", "signed"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("doc"), F.col(text).alias("text"))
    return rows.filter("doc is not null").mapInArrow(run, f"row bigint, doc {kind}, hash bigint, signed boolean")


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", size: int = SIZE, percent: int = PERCENT, bits: int | None = None) -> DataFrame:
    """One row per leak: key, item, shared (shingles of the item in the document), n_item (its shingles)."""
    sets = cut(item_shingles(items, item, item_text, size))
    signature = cut(signatures(sets, percent))
    hits = cut(document_hits(docs, signature, sets, key, text, size, bits))
    candidates = hits.filter("signed").join(signature.select("unit", "n", "hash"), "hash").select("row", "unit", "n").distinct()
    # the sets meet the hits by hash; a pair that is no candidate isn't counted
    both = hits.join(sets.select("unit", "item", "hash"), "hash").join(candidates, ["row", "unit"])
    found = both.groupBy("row", "doc", "unit", "item", "n").agg(F.count("*").alias("shared")).filter(100 * F.col("shared") >= percent * F.col("n"))
    best = found.groupBy(F.col("doc").alias(key), F.col("item").alias(item)).agg(F.max(F.struct("shared", "n")).alias("best"))
    return best.select(key, item, "best.shared", F.col("best.n").alias("n_item"))


def drop_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` in which no item leaks, all columns; those with a null key stay."""
    return without_keys(docs, leaks(docs, items, key, text, item, item_text, size, percent).select(key), key)
