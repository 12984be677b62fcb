"""The stateless stages and windows over event time as streams. The windows go beyond documents: they serve event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from papyrix.operators.chunking import chunk_documents
from papyrix.plans.ingest import clean_documents

EVENTS = T.StructType().add("event_id", "long").add("ts", "timestamp").add("user_id", "long").add("event_type", "string").add("value", "double").add("props", "string")


def read_stream(spark: SparkSession, path: str, schema: T.StructType, per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(path)


def clean_stream(docs: DataFrame) -> DataFrame:
    return clean_documents(docs)


def chunk_stream(docs: DataFrame, budget: int = 350, block: str = "\n\n") -> DataFrame:
    return chunk_documents(docs, budget=budget, block=block)


def write_available(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Processes what there is and ends; begun again, it goes on behind what the checkpoint has."""
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _timed(events: DataFrame) -> DataFrame:
    """Watermarks need times with a zone; those without one are taken in the session's."""
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def windowed(events: DataFrame, width: str = "1 hour", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Tumbling or sliding windows by event type: n, total."""
    w = F.window("ts", width, slide) if slide else F.window("ts", width)
    return _timed(events).withWatermark("ts", late).groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Sessions of a user: no two neighbouring events are ``gap`` or more apart."""
    return _timed(events).withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
