"""Documents to chunks, chunks to limited fragments and recogniser units."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papyrix.functions import segment
from papyrix.functions import text as X
from papyrix.operators.flat import flat_map
from papyrix.session import cut

_CHUNK = T.StructType().add("position", "integer").add("chunk_text", "string").add("num_tokens", "integer").add("cut_level", "integer").add("n_units", "integer")
_PART = T.StructType().add("part", "integer").add("part_text", "string")
# How dumps of bibliographies and trial registers begin.
BIBLIOGRAPHY = r"\b(PMID|NCT Number)\s*:"


def chunk_id(doc_id: Column, position: Column) -> Column:
    return F.format_string("%s#%04d", doc_id, position)


def chunk_documents(docs: DataFrame, count: Callable[[str], int] = segment.word_count, budget: int = segment.BUDGET, block: str = "\n\n") -> DataFrame:
    """docs: doc_id, text, format, any other columns. One row per chunk; positions are 0, 1, 2, ... in each document."""
    cut = lambda text, kind: ((c.position, c.text, c.num_tokens, c.cut_level, c.n_units) for c in segment.chunks(text, kind in X.TABULAR, count, budget, block))
    out = flat_map(docs, ["text", "format"], cut, _CHUNK).drop("text").withColumnRenamed("chunk_text", "text")
    return out.withColumn("chunk_id", chunk_id(F.col("doc_id").cast("string"), F.col("position"))).withColumn("strategy", F.when(F.col("format").isin(*X.TABULAR), "fila").otherwise("parrafo"))


def systematic(df: DataFrame, step: int, key: str = "doc_id") -> DataFrame:
    """Every ``step``-th row in order of the key. The ranks of all rows come from per-range counts, not from one task."""
    return with_row_number(df, key).filter(F.col("row_number") % step == 0).drop("row_number")


#: How monotonically_increasing_id counts: the partition, then 33 bits of the row's place in it.
_PLACES = 33


def with_row_number(df: DataFrame, *keys: str) -> DataFrame:
    """row_number from 0 in order of the keys. Rows are dealt into ranges and sorted there; only one count per range meets in
    one task. The ranges are drawn from a sample that differs from plan to plan, so they are written once, with each row's
    range and place in it, and used twice."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()))
    ranged = ranged.withColumn("_range", F.shiftright("_at", _PLACES).cast("int")).withColumn("_inside", F.col("_at").bitwiseAND((1 << _PLACES) - 1))
    sizes = ranged.groupBy("_range").count()
    starts = sizes.select(F.col("_range").alias("_r"), (F.sum("count").over(W.orderBy("_range")) - F.col("count")).alias("_start"))
    return ranged.join(F.broadcast(starts), F.col("_range") == F.col("_r")).withColumn("row_number", F.col("_start") + F.col("_inside")).drop("_at", "_range", "_r", "_start", "_inside")


def split_sentences(docs: DataFrame, text: str = "text") -> DataFrame:
    return flat_map(docs, [text], lambda t: enumerate(segment.sentences(t)) if t and t.strip() else (), _PART)


def split_to_limit(docs: DataFrame, text: str = "text", limit: int = segment.LIMIT) -> DataFrame:
    """Fragments of ``limit`` words at most, in order."""
    return flat_map(docs, [text], lambda t: enumerate(segment.limited(t, limit)) if t and t.strip() else (), _PART)


def recogniser_units(chunks: DataFrame, budget: int = segment.NER_BUDGET) -> DataFrame:
    """Chunks cut for an entity recogniser; ids stay those of the chunk."""
    cut = lambda text, kind: ((c.position, c.text) for c in segment.chunks(text, kind in X.TABULAR, segment.word_count, budget))
    return flat_map(chunks, ["text", "format"], cut, _PART).drop("text").withColumnRenamed("part_text", "text").withColumnRenamed("part", "unit")


def without_bibliographies(chunks: DataFrame, first: int = 1200) -> DataFrame:
    """Tabular documents go whose first chunk begins like a bibliographic dump. No text is shuffled."""
    dumps = (
        chunks.filter(F.col("format").isin(*X.TABULAR))
        .select("doc_id", "position", F.substring("text", 1, first).rlike(BIBLIOGRAPHY).alias("dump"))
        .groupBy("doc_id")
        .agg(F.min_by("dump", "position").alias("dump"))
        .filter("dump")
        .select("doc_id")
    )
    return chunks.join(dumps, "doc_id", "left_anti")


def metadata_records(chunks: DataFrame) -> DataFrame:
    """The store's records under their own names, with a dense number in order of chunk_id."""
    rows = with_row_number(chunks, "chunk_id")
    return rows.select(
        "doc_id", "chunk_id", F.col("source").alias("fuente"), F.col("format").alias("formato"), F.col("phenomenon").alias("fenomeno"),
        F.col("position").alias("posicion"), "num_tokens", F.col("text").alias("texto"), F.nullif(F.col("language"), F.lit("")).alias("idioma"),
        F.col("row_number").cast("bigint").alias("faiss_id"),
    )
