"""What the training-data operators share: tables, words, stable hashes, bit tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrix.session import cut, for_long_texts, if_small, spread  # noqa: F401 - for the operators

#: Words are runs of anything but ASCII white space, which is what bytes.split() cuts at.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_M1 = np.uint64(0x9E3779B97F4A7C15)
_M2 = np.uint64(0xC2B2AE3D27D4EB4F)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    for_long_texts(spark)
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(rows) if name in ("documents", "pages") else rows


def ship(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """A broadcast of ``value``, whose classes the executors needn't have installed; each task loads it by a call."""
    data = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: cloudpickle.loads(data.value)


def ascii_lower(text: Column) -> Column:
    """A-Z only. lower() does the same, faster, where every character is ASCII."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words in UTF-8. bytes.lower() touches A-Z only."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class WordHashes(dict):
    """Stable 64-bit hash of each word, with a bound on what is remembered."""

    LIMIT = 100_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser: spreads the entropy of 64-bit values over all their bits."""
    h = (h ^ (h >> np.uint64(31))) * _M2
    return h ^ (h >> np.uint64(29))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words; a shorter text is one run, an empty one has none."""
    n = min(size, len(hashes))
    if n == 0:
        return hashes
    out = hashes[: len(hashes) - n + 1].copy()
    for k in range(1, n):
        out = mixed(out * _M1 + hashes[k : len(hashes) - n + 1 + k])
    return mixed(out + np.uint64(n))


def text_batches(batches: Iterator[pa.RecordBatch], size: int = 4 << 20, column: int = 1) -> Iterator[pa.RecordBatch]:
    """Splits Arrow batches, which Spark bounds at 64 MB, so that each holds about ``size`` bytes of text, one row at least."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(lengths, dtype=np.int64) // size
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            if b > a:
                yield batch.slice(a, b - a)


# Bit tables, made and probed by SQL functions: a false positive costs a row, nothing is ever missed.

#: 2**30 bits are 128 MB, which may be broadcast at any input size; beyond what that holds more rows are let through.
LEAST_BITS, MOST_BITS = 16, 30


def bits_for(entries: int, each: int = 64) -> int:
    """Size of a table for so many entries, ``each`` bits for one, within the bounds."""
    return min(MOST_BITS, max(LEAST_BITS, (entries * each - 1).bit_length()))


def slot(value: Column, bits: int) -> Column:
    """Number from 1 to 2**bits, as bitmap_bucket_number() counts."""
    return F.pmod(value, F.lit(1 << bits)) + 1


def bit_table(slots: DataFrame) -> DataFrame:
    """One row of 4 KB for each 32,768 slots of column ``slot``."""
    return slots.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bitmap"))


def bit_is_set(bitmap: Column, at: Column) -> Column:
    position = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring(bitmap, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.call_function("shiftright", byte, (position % 8).cast("int")) % 2 == 1, F.lit(False))


def marked_in(rows: DataFrame, keys: DataFrame, at: Column, of: Column, name: str) -> DataFrame:
    """``rows`` with a column ``name``: whether the hash ``at`` may be among the hashes ``of`` of ``keys``, a table that
    cut() gave, so its size is known."""
    bits = bits_for(keys.count())
    probe = F.broadcast(bit_table(keys.select(slot(of, bits).alias("slot"))).select(F.col("bucket").alias("_bucket"), F.col("bitmap").alias("_bitmap")))
    out = rows.withColumn("_at", slot(at, bits)).join(probe, F.bitmap_bucket_number("_at") == F.col("_bucket"), "left")
    return out.withColumn(name, bit_is_set(F.col("_bitmap"), F.col("_at"))).drop("_at", "_bucket", "_bitmap")


def maybe_in(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """The rows whose value of ``column``, a hash, may be among that column's of ``keys``."""
    return marked_in(rows, keys, F.col(column), F.col(column), "_maybe").filter("_maybe").drop("_maybe")


#: A group is frequent if it holds more than this part of all rows, so there are no more frequent groups than that.
FREQUENT = 4096


def join_counted(rows: DataFrame, groups: DataFrame, on: list[str], count: str) -> DataFrame:
    """Inner join of rows with one row per group, which counts the group's rows. Frequent groups, FREQUENT at most, are
    broadcast; only rows of the others, none of which is large, are shuffled by their key."""
    limit = (groups.agg(F.sum(count)).first()[0] or 0) / FREQUENT
    often = groups.filter(F.col(count) > limit)
    met = rows.join(F.broadcast(often), on)
    rest = rows.join(F.broadcast(often.select(*on)), on, "left_anti")
    return met.unionByName(rest.join(groups.filter(F.col(count) <= limit), on))


def anti_counted(rows: DataFrame, groups: DataFrame, on: list[str], count: str) -> DataFrame:
    """The rows whose group isn't among ``groups``, in the same way."""
    limit = (groups.agg(F.sum(count)).first()[0] or 0) / FREQUENT
    often, others = groups.filter(F.col(count) > limit).select(*on), groups.filter(F.col(count) <= limit).select(*on)
    return rows.join(F.broadcast(often), on, "left_anti").join(others, on, "left_anti")


def without_keys(docs: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``docs`` whose key isn't among ``keys`` (one column). Rows that a bit table clears pass straight through;
    the others, few more than go, are shuffled for the exact anti join. Null keys stay."""
    gone = cut(keys.select(F.col(key).alias("_gone")).filter("_gone is not null").distinct())
    rows = marked_in(docs.select(F.struct("*").alias("_in")), gone, F.xxhash64(F.col(f"_in.`{key}`")), F.xxhash64("_gone"), "_maybe")
    stays = rows.filter("_maybe").join(gone, F.col(f"_in.`{key}`") == F.col("_gone"), "left_anti")
    return rows.filter(~F.col("_maybe")).select("_in.*").unionByName(stays.select("_in.*"))
