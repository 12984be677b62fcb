"""Exact duplicates by two-pass Bloom filtering, in DataFrame functions only.

Texts are read once, into narrow rows of key and digest that are written; all passes go over these. Pass one hashes every
digest to two slots of a counting Bloom filter and keeps the slots that two or more rows hit, as a bit table. Pass two
probes each row: one whose slots aren't both taken twice has no copy and passes straight through; only the others are
shuffled and grouped by digest. Groups that hold more than a 4,096th of these rows are met by broadcast, so no task gets
all rows of a large group.

The bit table's size follows from the number of rows, 128 MB at most, so it can be broadcast at any input size. When the
corpus outgrows it, more unique rows pass the probe and are shuffled, narrow ones only; results stay the same.

Texts are equal when identical after lower-casing A-Z. A null text counts as empty. The row with the largest key
stays; a null key is smaller than any other. Of rows that tie on key and text, all count in the group and all stay,
since nothing tells them apart. Columns may have any names. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyrix.llm.common import anti_counted, ascii_lower, bit_is_set, bit_table, bits_for, cut, join_counted, marked_in, slot


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(ascii_lower(F.coalesce(text, F.lit(""))), 256))


def _slots(bits: int) -> tuple[Column, Column]:
    half = 1 << (bits - 1)
    return slot(F.xxhash64("_sha"), bits - 1), slot(F.xxhash64("_sha", F.lit(1)), bits - 1) + half


def repeated_slots(narrow: DataFrame, bits: int) -> DataFrame:
    """narrow: (_sha). Bit table of the slots that more than one row hits."""
    hits = narrow.select(F.explode(F.array(*_slots(bits))).alias("slot")).groupBy("slot").count()
    return bit_table(hits.filter("count > 1"))


def probed(narrow: DataFrame, bits: int | None = None) -> DataFrame:
    """narrow: (_key, _sha), which cut() gave. Adds ``maybe``: whether a copy may exist."""
    bits = bits or bits_for(narrow.count(), 16)
    bits_table = F.broadcast(repeated_slots(narrow, bits))
    one, two = _slots(bits)
    out = narrow.withColumn("_one", one).withColumn("_two", two)
    for name in ("_one", "_two"):
        side = bits_table.select(F.col("bucket").alias(f"{name}_k"), F.col("bitmap").alias(f"{name}_b"))
        out = out.join(side, F.bitmap_bucket_number(name) == F.col(f"{name}_k"), "left")
    return out.select("_key", "_sha", (bit_is_set(F.col("_one_b"), F.col("_one")) & bit_is_set(F.col("_two_b"), F.col("_two"))).alias("maybe"))


def _narrow(docs: DataFrame, key: str, text: str) -> DataFrame:
    return cut(docs.select(F.col(key).alias("_key"), digest_of(F.col(text)).alias("_sha")))


def _grouped(narrow: DataFrame, bits: int | None) -> tuple[DataFrame, DataFrame]:
    """(rows that may have copies with their group's _keep and _size, rows that have none)."""
    rows = cut(probed(narrow, bits))
    maybe = rows.filter("maybe").drop("maybe")
    groups = cut(maybe.groupBy("_sha").agg(F.max("_key").alias("_keep"), F.count("*").alias("_size")))
    return join_counted(maybe, groups, ["_sha"], "_size"), rows.filter("not maybe").drop("maybe")


def duplicate_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", bits: int | None = None) -> DataFrame:
    """One row per document: key, keep_<key>, group_size, kept, text_sha256."""
    maybe, alone = _grouped(_narrow(docs, key, text), bits)
    out = maybe.select("_key", "_sha", "_keep", "_size").unionByName(alone.select("_key", "_sha", F.col("_key").alias("_keep"), F.lit(1).cast("bigint").alias("_size")))
    return out.select(
        F.col("_key").alias(key),
        F.col("_keep").alias("keep_id"),
        F.col("_size").alias("group_size"),
        F.col("_key").eqNullSafe(F.col("_keep")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", bits: int | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, all columns. Of whole rows only those are shuffled whose key and digest may be
    those of a row that goes; all others pass straight through."""
    maybe, _ = _grouped(_narrow(docs, key, text), bits)
    pair = F.struct(F.col("_sha"), F.col("_key"))
    gone = cut(maybe.filter(~F.col("_key").eqNullSafe(F.col("_keep"))).groupBy(pair.alias("_pair")).agg(F.count("*").alias("_size")))
    rows = docs.select(F.struct("*").alias("_in")).withColumn("_pair", F.struct(digest_of(F.col(f"_in.`{text}`")).alias("_sha"), F.col(f"_in.`{key}`").alias("_key")))
    rows = marked_in(rows, gone, F.xxhash64("_pair"), F.xxhash64("_pair"), "_maybe")
    stays = anti_counted(rows.filter("_maybe"), gone, ["_pair"], "_size")
    return rows.filter(~F.col("_maybe")).select("_in.*").unionByName(stays.select("_in.*"))
