"""Files to chunks: read, clean, tag, cut, encode. Each step is DataFrame to DataFrame; write between them as needed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrix.functions import language, pytext
from papyrix.functions import text as X
from papyrix.operators import chunking, vectors


def clean_documents(docs: DataFrame) -> DataFrame:
    """Cleaned text, with chars_before, chars_removed and, if there were any, cid_markers in the metadata. Tables and
    prose are cleaned by different rules, so the two are split before Python sees them."""
    tabular = F.coalesce(F.col("format").isin(*X.TABULAR), F.lit(False))

    def cleaned(rows: DataFrame, table: bool) -> DataFrame:
        marks = F.regexp_count("_raw", F.lit(r"\(cid:\d+\)"))
        facts = F.map_from_arrays(
            F.array(F.lit("chars_before"), F.lit("chars_removed"), F.lit("cid_markers")),
            F.array(F.length("_raw").cast("string"), (F.length("_raw") - F.length("text")).cast("string"), marks.cast("string")),
        )
        facts = F.map_filter(facts, lambda k, v: (k != "cid_markers") | (v != "0"))
        out = rows.withColumn("_raw", F.coalesce("text", F.lit(""))).withColumn("text", pytext.clean(F.col("_raw"), table))
        if "metadata" in rows.columns:
            out = out.withColumn("metadata", F.map_concat(F.coalesce("metadata", F.create_map().cast("map<string,string>")), facts))
        return out.drop("_raw")

    return cleaned(docs.filter(~tabular), False).unionByName(cleaned(docs.filter(tabular), True))


def tag_documents(docs: DataFrame, detector: language.Detector) -> DataFrame:
    out = language.tag(docs, detector)
    if "metadata" in docs.columns:
        fact = F.create_map(F.lit("language_confidence"), F.col("confidence").cast("string"))
        out = out.withColumn("metadata", F.map_concat(F.coalesce("metadata", F.create_map().cast("map<string,string>")), fact))
    return out.drop("confidence")


def build_store(docs: DataFrame, detector: language.Detector | None = None, encoder=None, budget: int = 350, block: str = "\n\n") -> tuple[DataFrame, DataFrame]:
    """(chunks, vectors) of a document table."""
    cleaned = clean_documents(docs)
    tagged = tag_documents(cleaned, detector) if detector is not None else cleaned
    chunks = chunking.chunk_documents(tagged, budget=budget, block=block)
    return chunks, vectors.encode(chunks.select("chunk_id", "text"), encoder).select("chunk_id", "embedding")
