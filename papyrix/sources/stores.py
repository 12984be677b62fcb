"""What the stages write and read: documents, chunks, queries, judgements, results, graphs, manifests."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papyrix import schemas

MIN_QUERY = 15
_MARK = r"(?i)\bq0*(\d{1,3})\b"


def read_strict(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines under an explicit schema; a line that doesn't fit it fails the query. Empty lines are skipped."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_tolerant(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, bad lines)."""
    raw = spark.read.schema(T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])).option("mode", "PERMISSIVE").json(path).cache()
    return raw.filter("_corrupt_record is null").drop("_corrupt_record"), raw.filter("_corrupt_record is not null").select(F.col("_corrupt_record").alias("line"))


def write_json(df: DataFrame, path: str) -> int:
    """Writes JSON lines (the commit of a job is atomic), gives their number, counted while they are written."""
    from pyspark.sql import Observation

    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").json(path)
    return seen.get["n"]


def valid_chunks(chunks: DataFrame) -> DataFrame:
    """Chunks, or a failed query if one has a negative position, no tokens, no text or a topic that doesn't exist."""
    good = (F.col("position") >= 0) & (F.col("num_tokens") > 0) & (F.length(F.trim("text")) > 0) & F.col("phenomenon").isin(1, 2, 3)
    return chunks.filter(F.assert_true(F.coalesce(good, F.lit(False)), F.concat(F.lit("bad chunk "), F.coalesce("chunk_id", F.lit("?")))).isNull())


def parse_queries(texts: DataFrame, text: str = "text", least: int = MIN_QUERY) -> DataFrame:
    """Free text with marks q1, q02, q003: (query_id, text) of what follows each mark, if it isn't too short."""
    col = F.col(text)
    ids = F.regexp_extract_all(col, F.lit(_MARK), 1)
    bodies = F.slice(F.split(col, _MARK), 2, F.greatest(F.size(ids), F.lit(1)))
    pairs = texts.select(F.explode(F.arrays_zip(ids.alias("n"), bodies.alias("body"))).alias("p"))
    body = F.trim(F.regexp_replace("p.body", r"[\s\x1c-\x1f\x85\xa0]+", " "))
    return pairs.select(F.format_string("q%03d", F.col("p.n").cast("int")).alias("query_id"), body.alias("text")).filter(F.length("text") >= least)


def parse_queries_short(texts: DataFrame, text: str = "text", most: int = 300) -> DataFrame:
    """The bodies alone, cut to ``most`` characters."""
    return parse_queries(texts, text).select(F.substring("text", 1, most).alias("text"))


def parse_judgements(texts: DataFrame, text: str = "text") -> DataFrame:
    """JSON {query: {doc_id: grade}}: (query_id, doc_id, grade); keys that begin with _ are comments."""
    outer = texts.select(F.explode(F.from_json(text, T.MapType(T.StringType(), T.StringType()))).alias("query_id", "inner")).filter(~F.col("query_id").startswith("_"))
    each = outer.select("query_id", F.explode(F.from_json("inner", T.MapType(T.StringType(), T.StringType()))).alias("doc_id", "grade"))
    return each.filter(~F.col("doc_id").startswith("_")).select("query_id", "doc_id", F.col("grade").try_cast("int").alias("grade")).filter("grade is not null")


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """schemas.RESULT; of lines with one query_id the last of its file stays."""
    rows = spark.read.schema(schemas.RESULT).json(path).withColumn("_n", F.monotonically_increasing_id())
    last = rows.groupBy("query_id").agg(F.max("_n").alias("_n"))
    return rows.join(last, ["query_id", "_n"], "left_semi").drop("_n")


def result_lines(results: DataFrame) -> DataFrame:
    """One JSON line per query, in order of query_id."""
    return results.orderBy("query_id").select(F.to_json(F.struct("query_id", "documents", "fragments")).alias("value"))


# Graphs as GraphML

_NODE_KEYS = ("nombre", "tipo", "fenomenos", "chunk_ids", "n_chunks", "variantes", "n_variantes", "label")
_EDGE_KEYS = ("relacion", "peso", "doc_id", "chunk_id", "chunk_ids", "evidencia", "pasiva")


def _escaped(value: Column) -> Column:
    out = F.coalesce(value.cast("string"), F.lit(""))
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def graphml(nodes: DataFrame, edges: DataFrame, max_variants: int = 8) -> DataFrame:
    """Lines of a GraphML file as (ord, value); edge ids are e0, e1, ... in order of (src, relation, dst)."""
    from papyrix.operators.chunking import with_row_number

    data = lambda keys, values: F.concat(*[F.concat(F.lit(f'<data key="{k}">'), _escaped(v), F.lit("</data>")) for k, v in zip(keys, values)])
    node_values = [F.col("name"), F.col("type"), F.col("topics"), F.array_join("chunk_ids", " "), F.col("n_chunks"), F.array_join(F.slice("variants", 1, max_variants), " | "), F.col("n_variants"), F.col("name")]
    edge_values = [F.col("relation"), F.col("weight"), F.col("doc_id"), F.col("chunk_id"), F.array_join("chunk_ids", " "), F.col("evidence"), F.col("passive")]
    node_lines = nodes.select(F.struct(F.lit(1), F.col("node"), F.lit(""), F.lit("")).alias("ord"), F.concat(F.lit('<node id="'), _escaped(F.col("node")), F.lit('">'), data(_NODE_KEYS, node_values), F.lit("</node>")).alias("value"))
    numbered = with_row_number(edges, "src", "relation", "dst")
    edge_lines = numbered.select(
        F.struct(F.lit(2), F.col("src"), F.col("relation"), F.col("dst")).alias("ord"),
        F.concat(F.lit('<edge id="e'), F.col("row_number").cast("string"), F.lit('" source="'), _escaped(F.col("src")), F.lit('" target="'), _escaped(F.col("dst")), F.lit('">'), data(_EDGE_KEYS, edge_values), F.lit("</edge>")).alias("value"),
    )
    keys = "".join(f'<key id="{k}" for="{kind}" attr.name="{k}" attr.type="string"/>' for kind, names in (("node", _NODE_KEYS), ("edge", _EDGE_KEYS)) for k in names if not (kind == "edge" and k in _NODE_KEYS))
    head = f'<?xml version="1.0" encoding="utf-8"?>\n<graphml xmlns="http://graphml.graphdrawing.org/xmlns">{keys}<graph edgedefault="directed">'
    frame = nodes.sparkSession.range(1)
    end = lambda n, text: frame.select(F.struct(F.lit(n), F.lit(""), F.lit(""), F.lit("")).alias("ord"), F.lit(text).alias("value"))
    same = "ord struct<a:int,b:string,c:string,d:string>, value string"
    parts = [end(0, head), node_lines, edge_lines, end(3, "</graph></graphml>")]
    out = None
    for p in parts:
        p = p.select(F.col("ord").cast(same.split(" ", 1)[1].rsplit(",", 1)[0]).alias("ord"), "value")
        out = p if out is None else out.unionByName(p)
    return out.orderBy("ord")


_DATA = T.ArrayType(T.StructType().add("_VALUE", T.StringType()).add("_key", T.StringType()))


def read_graphml(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) as papyrix.operators.graph makes them. Keys are named by their attr.name."""
    names = spark.read.format("xml").option("rowTag", "key").schema(T.StructType().add("_id", "string").add("_attr.name", "string")).load(path)
    names = names.select(F.col("_id").alias("key"), F.col("`_attr.name`").alias("name"))
    raw = lambda tag, *ids: spark.read.format("xml").option("rowTag", tag).schema(T.StructType([*[T.StructField(f"_{i}", T.StringType()) for i in ids], T.StructField("data", _DATA)])).load(path)

    def wide(rows: DataFrame, ids: list[str], keys: tuple[str, ...]) -> DataFrame:
        each = rows.select(*ids, F.explode_outer("data").alias("d")).join(F.broadcast(names), F.col("d._key") == F.col("key"), "left")
        return each.groupBy(*ids).pivot("name", list(keys)).agg(F.first("d._VALUE"))

    n = wide(raw("node", "id"), ["_id"], _NODE_KEYS)
    split = lambda c, by: F.filter(F.split(F.coalesce(c, F.lit("")), by), lambda x: x != "")
    nodes = n.select(
        F.col("_id").alias("node"), F.coalesce("nombre", "_id").alias("name"), F.col("tipo").alias("type"), F.coalesce("fenomenos", F.lit("")).alias("topics"),
        split(F.col("chunk_ids"), " ").alias("chunk_ids"), F.col("n_chunks").cast("int").alias("n_chunks"),
        F.transform(split(F.col("variantes"), r"\|"), F.trim).alias("variants"), F.col("n_variantes").cast("int").alias("n_variants"),
    )
    e = wide(raw("edge", "id", "source", "target"), ["_id", "_source", "_target"], _EDGE_KEYS)
    chunks = split(F.col("chunk_ids"), " ")
    edges = e.select(
        F.col("_source").alias("src"), F.col("relacion").alias("relation"), F.col("_target").alias("dst"), F.col("peso").cast("bigint").alias("weight"), "doc_id", "chunk_id",
        F.when(F.size(chunks) > 0, chunks).otherwise(F.array_compact(F.array("chunk_id"))).alias("chunk_ids"), F.coalesce("evidencia", F.lit("")).alias("evidence"), (F.col("pasiva") == "true").alias("passive"),
    )
    return nodes, edges


def chunk_numbers(nodes: DataFrame, edges: DataFrame, records: DataFrame) -> DataFrame:
    """(chunk_id, faiss_id) of the chunks that the graph names."""
    named = nodes.select(F.explode("chunk_ids").alias("chunk_id")).unionByName(edges.select(F.explode("chunk_ids").alias("chunk_id")))
    return records.join(named, "chunk_id", "left_semi").select("chunk_id", "faiss_id")


# Reproducibility


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: n and a digest that doesn't depend on the order of rows but counts repeated ones."""
    h = F.xxhash64(*[F.to_json(F.struct(F.col(c))) for c in sorted(df.columns)]).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("n"), F.coalesce(F.sum(h), F.lit(0)).cast("string").alias("digest"))


def manifest(outputs: Mapping[str, DataFrame], configuration: Mapping) -> dict:
    """What a run made, under which configuration."""
    import pyspark

    made = {name: fingerprint(df).first().asDict() for name, df in outputs.items()}
    return {"outputs": made, "configuration": dict(configuration), "versions": {"pyspark": pyspark.__version__}}


def manifest_differences(before: Mapping, after: Mapping) -> list[str]:
    """Where two manifests differ; versions are warnings, not differences."""
    out = []
    for part in ("configuration", "outputs"):
        for key in sorted({*before[part], *after[part]}):
            a, b = before[part].get(key), after[part].get(key)
            if json.dumps(a, sort_keys=True, default=str) != json.dumps(b, sort_keys=True, default=str):
                out.append(f"{part}.{key}: {a} is now {b}")
    return out
