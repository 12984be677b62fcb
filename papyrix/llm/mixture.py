"""Mixing sources to target weights by capped water-filling, in DataFrame functions only.

Every source wants a share of all words in proportion to its weight, but may be repeated ``max_epochs`` times at most.
A source is clamped at that cap exactly if cap / weight is no more than the water level; with the sources sorted by
cap / weight the level follows from running sums, so no loop over rounds is needed and the excess ends up shared by
weight among the rest.

A document is repeated floor(target / size) times whole; for the fraction that is left, a seeded order of the source's
documents is cut where their words reach it. The order is by md5(seed, key). The cut is found level by level: 256 hash
buckets of a source, 256 of the one that the cut falls in, then the rows of that, so no source, however large, is sorted
or gathered in one task; then the one document of that last bucket that comes nearest to what is missing is added.

Words are counted once, into narrow rows that are written; a table of one row per source meets them by broadcast if it is
small (see if_small), else by a join on the source that the skew join splits.

A null text has size 0. Sources are ordered by code point, null last. Rows that tie on the key share one fate only if
they are in all respects equal in order; their sizes are counted row by row. Columns may have any names. An empty table
gives an empty result; a corpus of empty texts takes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from papyrix.llm.common import WORD, cut, if_small

SEED = "mixture-1"
MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)
#: Hexadecimal digits of the order's hash that name a bucket, level by level.
LEVELS = (2, 4)
MADE = ("size", "source_size", "target", "repetitions", "taken")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def water_fill(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """sources: (source, source_size, weight). Adds target: shares of the total by weight, none above its cap."""
    cap = F.col("source_size") * F.lit(float(max_epochs))
    ratio = cap / F.col("weight")
    order = W.orderBy("_ratio", F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    after = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    out = (
        sources.withColumn("_cap", cap)
        .withColumn("_ratio", ratio)
        .withColumn("_level", (F.sum("source_size").over(everything.orderBy("_ratio")) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("weight").over(after))
        # clamped sources come first; the level of the first that isn't clamped holds for all after it
        .withColumn("_free", F.col("_ratio") > F.col("_level"))
        .withColumn("_water", F.min(F.when(F.col("_free"), F.struct("_ratio", "_level"))).over(everything.orderBy("_ratio"))["_level"])
    )
    level = F.when(F.col("_water").isNotNull() & (F.col("_ratio") > F.col("_water")), F.col("_water") * F.col("weight"))
    return out.select("source", "source_size", F.coalesce(level, F.col("_cap")).alias("target"))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """sizes: (source, size). One row per source: source_size, weight by code-point rank, target."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(rank, F.lit(len(weights))) + 1)
    return water_fill(sources.withColumn("weight", weight), max_epochs)


def _numbered(docs: DataFrame, key: str, text: str, source: str, seed: str, *more: Column) -> DataFrame:
    order = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    return docs.select(F.col(key).alias("_key"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"), order.alias("_order"), *more)


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    return rows.join(if_small(plan), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def _plan(rows: DataFrame, weights: Sequence[int], max_epochs: int) -> DataFrame:
    """One row per source: size, target, whole repetitions, what is left (_rest), and the bucket that this ends in (_cut)
    with the words of those before it (_below)."""
    targets = source_targets(rows, weights, max_epochs).select(
        F.col("source").alias("_source"),
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.floor(F.round(F.col("target") / F.col("source_size"), 9))).otherwise(0).cast("bigint").alias("_whole"),
    )
    rest = F.greatest(F.round(F.col("target") - F.col("_whole") * F.col("source_size"), 6), F.lit(0.0))
    plan = cut(targets.withColumn("_rest", rest).withColumn("_cut", F.lit("")).withColumn("_below", F.lit(0).cast("bigint")))
    for digits in LEVELS:
        inside = _with_plan(rows, plan).filter(F.col("_order").startswith(F.col("_cut")))
        buckets = inside.groupBy("source", F.substring("_order", 1, digits).alias("_bucket")).agg(F.sum("size").alias("_words"), F.first("_rest").alias("_rest"), F.first("_below").alias("_base"))
        running = W.partitionBy("source").orderBy("_bucket")
        buckets = buckets.withColumn("_start", F.col("_base") + F.sum("_words").over(running) - F.col("_words"))
        found = buckets.filter((F.col("_start") <= F.col("_rest")) & (F.col("_rest") < F.col("_start") + F.col("_words")))
        found = found.select(F.col("source").alias("_s"), F.col("_bucket").alias("_c"), F.col("_start").alias("_b"))
        plan = plan.drop("_cut", "_below").join(found, F.col("_source").eqNullSafe(F.col("_s")), "left").drop("_s")
        plan = cut(plan.withColumnRenamed("_c", "_cut").withColumnRenamed("_b", "_below"))
    return plan


def _repeated(rows: DataFrame, plan: DataFrame, max_epochs: int) -> DataFrame:
    """rows: as _numbered() gives them. Adds source_size, target, repetitions, taken."""
    rows = _with_plan(rows, plan).withColumn("_bucket", F.substring("_order", 1, LEVELS[-1]))
    at_cut = F.coalesce(F.col("_bucket") == F.col("_cut"), F.lit(False))
    order = W.partitionBy("source").orderBy("_order", "_key", "size")
    missing = F.col("_rest") - F.col("_below")
    edge = rows.filter(at_cut).withColumn("_row", F.row_number().over(order))
    edge = edge.withColumn("_inside", missing - F.sum("size").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)) >= 0)
    whole = W.partitionBy("source")
    edge = (
        edge.withColumn("_missing", missing - F.coalesce(F.sum(F.when(F.col("_inside"), F.col("size"))).over(whole), F.lit(0)))
        .withColumn("_off", F.when(~F.col("_inside"), F.abs(F.col("size") - F.col("_missing"))))
        .withColumn("_best", F.min(F.when(F.col("_off") < F.col("_missing"), F.struct("_off", "_row"))).over(whole))
        .withColumn("_more", (F.col("_inside") | F.coalesce(F.col("_row") == F.col("_best._row"), F.lit(False))).cast("int"))
    )
    rest = rows.filter(~at_cut).withColumn("_more", F.coalesce(F.col("_bucket") < F.col("_cut"), F.lit(False)).cast("int"))
    repetitions = F.least(F.col("_whole") + F.col("_more"), F.lit(max_epochs).cast("bigint"))
    out = rest.unionByName(edge.select(*rest.columns)).withColumn("repetitions", repetitions)
    return out.withColumn("taken", F.col("size") * F.col("repetitions"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """One row per document: key, size, source_size, target, repetitions, taken."""
    rows = cut(_numbered(docs, key, text, source, seed))
    out = _repeated(rows, _plan(rows, weights, max_epochs), max_epochs)
    return out.select(F.col("_key").alias(key), *MADE)


def mixed_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The rows of ``docs`` that the mix takes, with all their columns and those of mix(), which replace any of the same
    name. A row says how often it goes in (repetitions); only rows of the bucket that a source ends in are shuffled."""
    plan = _plan(cut(_numbered(docs, key, text, source, seed)), weights, max_epochs)
    out = _repeated(_numbered(docs, key, text, source, seed, F.struct("*").alias("_whole_row")), plan, max_epochs).filter("repetitions > 0")
    return out.select(*[F.col(f"_whole_row.`{c}`").alias(c) for c in docs.columns if c not in MADE], *MADE)
