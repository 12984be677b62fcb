from pyspark.sql import functions as F

from papyrix.operators import checks
from papyrix.streaming import text_stream as S


def test_stream_equals_batch(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet").withColumn("format", F.lit("txt")).select("doc_id", "text", "format")
    docs.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = S.read_stream(spark, str(tmp_path / "in"), docs.schema, 1)
    for _ in range(2):  # the second run finds nothing new
        S.write_available(S.chunk_stream(S.clean_stream(stream)), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    batch = S.chunk_stream(S.clean_stream(docs))
    assert checks.different(spark.read.parquet(str(tmp_path / "out")).select(batch.columns), batch).count() == 0


def test_windows_in_a_stream(spark, small, tmp_path):
    events = spark.read.parquet(f"{small}/events.parquet")
    events.write.parquet(str(tmp_path / "e"))
    stream = S.read_stream(spark, str(tmp_path / "e"), events.schema)
    q = S.windowed(stream).writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert checks.different(spark.table("w"), S.windowed(events)).count() == 0
