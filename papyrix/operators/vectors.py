"""Exact search over dense vectors, encoders, vector checks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

K, WIDEN = 200, 10
MAX_QUERY_BYTES = 64 << 20
#: Pairs that a task of the search holds, scores at a time, and rows that it gives at a time.
MAX_HELD, MAX_SCORES, OUT_ROWS = 1 << 18, 1 << 19, 1 << 16
#: Queries whose ids may be broadcast.
MAX_NAMES = 1_000_000


def dot(a: Column, b: Column) -> Column:
    """In double precision, in order of the components."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def normalised(a: Column) -> Column:
    size = norm(a)
    return F.when(size > 0, F.transform(a, lambda x: (x / size).cast("float"))).otherwise(a)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, key: str = "vec_id", vector: str = "embedding", query: str = "query_id") -> DataFrame:
    """(query, key, score, rank): the k largest inner products of each query, ties by key.

    The stated queries are a matrix that each task multiplies with its blocks of vectors; a task gives its own k best of
    each query, the final ranking is over those. Queries that don't fit into MAX_QUERY_BYTES, or whose k best don't fit into
    MAX_HELD, are asked in several such passes, each of which reads the vectors once; so what a task holds doesn't grow.
    All passes' rows, numbers only, meet in one shuffle.
    """
    asked = queries.select(query, vector).filter(F.col(vector).isNotNull())
    n, width = asked.agg(F.count("*"), F.max(F.size(vector))).first()
    parts = max(1, -(-n * (width or 1) * 8 // MAX_QUERY_BYTES), min(n, -(-n * k // MAX_HELD)))
    found, ids = None, []
    for part in range(parts):
        made = (asked.filter(F.pmod(F.xxhash64(query), F.lit(parts)) == part) if parts > 1 else asked).toArrow()
        some = _best_of_tasks(vectors, np.array(made[vector].to_pylist(), np.float64) if len(made) else np.zeros((0, 1)), sum(map(len, ids)), k, key, vector)
        found = some if found is None else found.unionByName(some)
        ids.append(made[query].combine_chunks())
    best = found.withColumn("rank", F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "key"))).filter(F.col("rank") <= k)
    names = vectors.sparkSession.createDataFrame(pa.table([pa.array(range(n), pa.int32()), pa.concat_arrays(ids)], ["q", query]))
    return best.join(F.broadcast(names) if n <= MAX_NAMES else names, "q").select(query, F.col("key").alias(key), "score", "rank")


def _ordered(rows: np.ndarray, keys: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each row's k best, ties by key."""
    order = np.lexsort((keys if keys.dtype.kind in "iu" else np.unique(keys, return_inverse=True)[1], -scores, rows))
    starts = np.searchsorted(rows[order], rows[order])
    order = order[np.arange(len(order)) - starts < k]
    return rows[order], keys[order], scores[order]


def _dots(q: np.ndarray, row: np.ndarray, block: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Inner products of pairs, in order of the components as dot() has them: equal vectors have equal scores, which
    products of matrices, whose sums are made in blocks, don't grant."""
    out = np.zeros(len(row))
    for i in range(q.shape[1]):
        out += q[row, i] * block[at, i]
    return out


def best_of(q: np.ndarray, blocks: Iterator[tuple[np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(row of q, key, score) of each row's k best among blocks of (keys, vectors). Products are made for MAX_SCORES pairs
    at a time; what reaches the row's k-th best so far, within their rounding, is scored exactly and held."""
    n, step = len(q), max(1, MAX_SCORES // max(1, len(q)))
    lengths = np.linalg.norm(q, axis=1)
    least = np.full(n, -np.inf)
    held, size, limit = [], 0, 2 * k * n

    def shrunk() -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        rows, keys, scores = _ordered(*(np.concatenate(c) for c in zip(*held)), k)
        ends = np.searchsorted(rows, np.arange(n), "right")
        full = ends - np.searchsorted(rows, np.arange(n)) == k
        least[full] = scores[ends[full] - 1]
        return [(rows, keys, scores)]

    for names, vectors in blocks:
        for low in range(0, len(vectors) if n else 0, step):
            block = vectors[low : low + step]
            new = q @ block.T
            slack = 1e-12 * lengths * np.linalg.norm(block, axis=1).max()
            floor = least - slack
            if k < len(block) and not np.isfinite(least).all():
                floor = np.maximum(floor, -np.partition(-new, k - 1, axis=1)[:, k - 1] - 2 * slack)
            row, at = np.nonzero(new >= floor[:, None])
            scores = _dots(q, row, block, at)
            good = scores >= least[row]
            held.append((row[good].astype(np.int32), names[low : low + step][at[good]], scores[good]))
            size += int(good.sum())
            if size > limit:
                held = shrunk()
                size = len(held[0][0])
    return shrunk()[0] if size else None


def _best_of_tasks(vectors: DataFrame, matrix: np.ndarray, first: int, k: int, key: str, vector: str) -> DataFrame:
    """(q, key, score): each task's k best of each query, a row of the matrix; these are numbered from ``first``."""
    shared = vectors.sparkSession.sparkContext.broadcast(matrix)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks():
            for batch in batches:
                if batch.num_rows:
                    column = batch.column(1)
                    yield batch.column(0).to_numpy(zero_copy_only=False), column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)

        found = best_of(shared.value, blocks(), k)
        if found is not None:
            rows, keys, scores = found
            for low in range(0, len(rows), OUT_ROWS):
                part = slice(low, low + OUT_ROWS)
                yield pa.RecordBatch.from_arrays([pa.array(rows[part] + np.int32(first)), pa.array(keys[part]), pa.array(scores[part])], ["q", "key", "score"])

    kind = vectors.schema[key].dataType.simpleString()
    return vectors.filter(F.col(vector).isNotNull()).select(key, vector).mapInArrow(run, f"q int, key {kind}, score double")


def hashed_vector(text: str, size: int) -> np.ndarray:
    """A stand-in for a model: words hashed to signed components, length 1."""
    out = np.zeros(size, np.float32)
    for w in (text or "").lower().split():
        h = xxhash.xxh64_intdigest(w)
        out[h % size] += 1.0 if h >> 63 else -1.0
    n = float(np.linalg.norm(out))
    return out / n if n else out


def encode(texts: DataFrame, encoder: Callable[[list[str]], np.ndarray] | None = None, text: str = "text", size: int = 64, batch: int = 64) -> DataFrame:
    """Adds ``embedding``, unit vectors. ``encoder`` gets lists of texts; a model belongs in a closure that loads it once."""
    from pyspark.sql import types as T

    made = encoder or (lambda many: np.array([hashed_vector(t, size) for t in many]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for all_rows in batches:
            for low in range(0, all_rows.num_rows, batch):
                part = all_rows.slice(low, batch)
                rows = np.asarray(made([t or "" for t in part.column(text).to_pylist()]), np.float32)
                lengths = np.linalg.norm(rows, axis=1, keepdims=True)
                rows = rows / np.where(lengths > 0, lengths, 1)
                vectors = pa.array(list(rows), pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([*part.columns, vectors], [*part.schema.names, "embedding"])

    return texts.mapInArrow(run, T.StructType([*texts.schema.fields, T.StructField("embedding", T.ArrayType(T.FloatType()))]))


def encode_missing(texts: DataFrame, done: DataFrame, signature: str, key: str = "chunk_id", **how) -> DataFrame:
    """Only what ``done`` (key, signature) lacks under the same model signature: the resumable form."""
    return encode(texts.join(done.filter(F.col("signature") == signature).select(key), key, "left_anti"), **how).withColumn("signature", F.lit(signature))


def bad_vectors(vectors: DataFrame, size: int, key: str = "vec_id", vector: str = "embedding", tolerance: float = 1e-3) -> DataFrame:
    """Vectors of another size, with nulls, or whose length isn't 1."""
    length = norm(F.col(vector))
    wrong = F.col(vector).isNull() | (F.size(vector) != size) | F.exists(vector, lambda x: x.isNull() | F.isnan(x)) | (F.abs(length - 1) > tolerance)
    return vectors.filter(F.coalesce(wrong, F.lit(True))).select(key, F.round(length, 6).alias("norm"))


def simulated_queries(vectors: DataFrame, n: int, total: int, key: str = "vec_id", step: int = 977) -> DataFrame:
    """Vectors of the corpus itself, as queries q001, q002, ..."""
    spark = vectors.sparkSession
    picks = spark.range(n).select(F.format_string("q%03d", F.col("id") + 1).alias("query_id"), F.pmod(F.col("id") * step, F.lit(total)).alias(key))
    return vectors.join(F.broadcast(picks), key).drop(key)
