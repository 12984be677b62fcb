"""Substring deduplication by content-defined chunking.

A gear hash rolls over each text: h = (h << 1) + GEAR[symbol], in 32 bits, so a position's hash depends on the last 32
characters only. A chunk ends where the bits of CUT are zero, MIN characters at least and MAX at most from its start.
Cuts depend on content, not on position, so an insertion shifts no more than the chunks around it. Chunks are compared
by a 128-bit digest; of equal chunks the first (smallest key, then position, then row) stays and the others are repeats.

Neighbouring chunks that repeat are joined to regions; one shorter than ``least`` characters is too common to count. A
region is cut into spans where what stays and what is removed meet; spans may be of any length.
Offsets are code points, end exclusive.

Rows are numbered once, before they are chunked, and the chunks are written once: all that follows works on numbers and
digests, no text is read again. Digests are aggregated on the map side, so a line that a third of all documents share is
one row per task; chunks meet these counts only where a bit table (its size follows from the number of repeated digests,
128 MB at most) says that their digest may repeat. Digests of which one holds more than a 4,096th of all repeats are
met by broadcast, the others by a shuffle, so no task gets all of a frequent chunk.

A null or empty text has no chunks. A null key is smaller than any other; rows with null or equal keys are documents of
their own. Repeated rows are repeats of each other: the first stays. Columns may have any names. An empty table gives an
empty result. Texts of any length are taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from papyrix.llm.common import cut, join_counted, maybe_in, text_batches

MIN, MAX = 16, 256
CUT = 0x000F0000
LEAST = 64

GEAR = np.random.default_rng(20160622).integers(0, 1 << 32, 256, dtype=np.uint32)


def gear_hashes(symbols: np.ndarray) -> np.ndarray:
    """The rolling hash at each position; five doublings add up the last 32 shifted terms."""
    h = GEAR[(symbols ^ (symbols >> 8)) & 0xFF]
    for step in (1, 2, 4, 8, 16):
        shifted = h[:-step] << np.uint32(step)
        h = h.copy()
        h[step:] += shifted
    return h


def cuts(text: str) -> list[int]:
    """Ends of the chunks of a text."""
    symbols = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    marks = (np.flatnonzero((gear_hashes(symbols) & np.uint32(CUT)) == 0) + 1).tolist()
    out, start, end = [], 0, len(symbols)
    for mark in marks:
        while mark - start > MAX:
            start += MAX
            out.append(start)
        if mark - start >= MIN:
            out.append(mark)
            start = mark
    while end - start > MAX:
        start += MAX
        out.append(start)
    if end > start:
        out.append(end)
    return out


def chunks(rows: DataFrame) -> DataFrame:
    """rows: (row, doc, text). (row, doc, start, end, d1, d2) of each chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, 2 << 20, column=2):
            at, starts, ends, digests = [], [], [], bytearray()
            for i, value in enumerate(batch.column(2)):
                body = value.as_py()
                if not body:
                    continue
                stop = cuts(body)
                begin = [0, *stop[:-1]]
                at += [i] * len(stop)
                starts += begin
                ends += stop
                for a, b in zip(begin, stop):
                    digests += xxhash.xxh3_128_digest(body[a:b].encode("utf-8", "surrogatepass"))
            both = np.frombuffer(bytes(digests), np.int64).reshape(-1, 2)
            of = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(of), batch.column(1).take(of), pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], ["row", "doc", "start", "end", "d1", "d2"])

    return rows.mapInArrow(run, f"row bigint, doc {rows.schema['doc'].dataType.simpleString()}, start int, end int, d1 bigint, d2 bigint")


def spans_of_rows(rows: DataFrame, least: int = LEAST) -> DataFrame:
    """rows: (row, doc, text). (row, doc, start, end, copies, removed)."""
    made = cut(chunks(rows))
    first = F.min(F.struct("doc", "start", "row")).alias("first")
    groups = cut(made.groupBy("d1", "d2").agg(F.count("*").alias("copies"), first).filter("copies > 1").select("d1", "d2", "copies", F.col("first.row").alias("first_row"), F.col("first.start").alias("first_start")))
    hits = join_counted(maybe_in(made, groups, "d1"), groups, ["d1", "d2"], "copies")
    hits = hits.withColumn("removed", (F.col("row") != F.col("first_row")) | (F.col("start") != F.col("first_start")))
    order = W.partitionBy("row").orderBy("start")
    touches = F.coalesce(F.lag("end").over(order) == F.col("start"), F.lit(False))
    alike = touches & (F.lag("removed").over(order) == F.col("removed"))
    marked = hits.withColumn("_far", F.when(touches, 0).otherwise(1)).withColumn("_new", F.when(alike, 0).otherwise(1))
    runs = marked.withColumn("_region", F.sum("_far").over(order)).withColumn("_run", F.sum("_new").over(order))
    spans = runs.groupBy("row", "doc", "_region", "_run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max("copies").alias("copies"), F.first("removed").alias("removed"))
    region = W.partitionBy("row", "_region")
    spans = spans.withColumn("_length", F.max("end").over(region) - F.min("start").over(region))
    return spans.filter(F.col("_length") >= least).select("row", "doc", "start", "end", "copies", "removed")


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """One row per span that occurs more than once: key, start, end, copies (most of its chunks), removed (false for the
    occurrence that stays)."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("doc"), F.col(text).alias("text"))
    return spans_of_rows(rows, least).select(F.col("doc").alias(key), "start", "end", "copies", "removed")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """``docs`` with the repeats taken out of their texts; all columns. The numbered rows are written once, as the spans
    come back to them."""
    rows = cut(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("in")))
    spans = spans_of_rows(rows.select("row", F.col(f"in.`{key}`").alias("doc"), F.col(f"in.`{text}`").alias("text")), least).filter("removed")
    joined = rows.join(spans.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans")), "row", "left")
    # what stays lies between the ends of the spans and the starts of the next
    body = F.col(f"in.`{text}`")
    begins = F.concat(F.array(F.lit(0)), F.transform("spans", lambda s: s["end"]))
    stops = F.concat(F.transform("spans", lambda s: s["start"]), F.array(F.length(body)))
    kept = F.array_join(F.transform(F.arrays_zip(begins.alias("a"), stops.alias("b")), lambda x: F.substring(body, x["a"] + 1, x["b"] - x["a"])), "")
    new = F.when(F.col("spans").isNull(), body).otherwise(kept).alias(text)
    return joined.select(*[new if c == text else F.col(f"in.`{c}`").alias(c) for c in docs.columns])
