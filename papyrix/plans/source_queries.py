"""The registered queries of loaders and stores: rows of the benchmark tables are given the form of a file or of a line,
are read by the loader, and the SQL states what they held."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papyrix import schemas
from papyrix.operators import graph
from papyrix.operators.flat import flat_map
from papyrix.plans.queries import FACTS_SQL, WORDS_SQL, WS_SQL, facts, query, table
from papyrix.session import cut, scratch
from papyrix.sources import catalog, files, html_page, json_text, plain, stores

_MADE = T.StructType().add("text", "string").add("title", "string")


def trimmed(column: str) -> str:
    return f"regexp_replace({column}, '^{WS_SQL}+|{WS_SQL}+$', '', 'g')"


def loaded(rows: DataFrame, load: Callable[[bytes], list[dict]], content: Column, key: str) -> DataFrame:
    """What a loader makes of each row's content: key, digest of the text, title."""
    given = rows.select(key, content.alias("content"))
    made = flat_map(given, ["content"], lambda c: ((d["text"], d["title"]) for d in load((c or "").encode())), _MADE)
    return made.select(key, F.md5("text").alias("digest"), "title")


def folder(spark: SparkSession) -> str:
    return f"{scratch(spark)}/{uuid.uuid4().hex}"


@query(f"""WITH p AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: {trimmed("x")}), lambda x: x <> '') AS p FROM documents)
SELECT doc_id, md5(array_to_string(list_concat(['Document ' || doc_id], p), chr(10) || chr(10))) AS digest, 'Document ' || doc_id AS title FROM p""")
def json_articles(spark, d):
    body = F.to_json(F.struct(F.concat(F.lit(" Document "), "doc_id").alias("title"), F.split("text", "\n").alias("body_paragraphs"), F.lit("x").alias("status")))
    return loaded(table(spark, d, "documents"), json_text.load, body, "doc_id")


@query(f"""SELECT conv_id || '/' || turn AS id, md5('turn: ' || turn || chr(10) || 'role: ' || role || chr(10) || 'text: ' || {trimmed("text")} || chr(10) || chr(10) || 'parts: ' || role || '; ' || turn) AS digest, NULL::VARCHAR AS title FROM conversations WHERE {trimmed("text")} <> ''""")
def json_record_lists(spark, d):
    rows = table(spark, d, "conversations").filter(F.col("text").rlike(r"\S")).withColumn("id", F.concat_ws("/", "conv_id", "turn"))
    one = F.to_json(F.struct("turn", "role", "text", F.lit("x").alias("status")))
    two = F.to_json(F.struct(F.array(F.col("role"), F.col("turn").cast("string")).alias("parts"), F.lit(1).alias("size_mb")))
    return loaded(rows, json_text.load, F.concat(F.lit("["), one, F.lit(","), two, F.lit("]")), "id")


@query(f"""WITH p AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: {trimmed("x")}), lambda x: x <> '') AS p FROM documents)
SELECT doc_id, md5(array_to_string(p, chr(10) || chr(10))) AS digest, NULL::VARCHAR AS title FROM p""")
def text_files(spark, d):
    return loaded(table(spark, d, "documents"), plain.load, F.replace("text", F.lit("\n"), F.lit("\r\n \r\n")), "doc_id")


@query(f"""WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: array_to_string({WORDS_SQL.replace("(text", "(x").replace("lambda x: x", "lambda y: y")}, ' ')), lambda x: x <> '') AS l FROM documents)
SELECT doc_id, md5(array_to_string(l, chr(10) || chr(10))) AS digest, 'Doc & ' || doc_id AS title FROM l""")
def html_pages(spark, d):
    """Each line of a document as a paragraph of a page, behind a script and a style."""
    text = F.col("text")
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\n", "</p>\n<p class='b'>")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    page = F.concat(F.lit("<!doctype html><html><head><title> Doc &amp;\n"), "doc_id", F.lit("</title><style>p {}</style><script>if (1<2) x('</p>')</script></head><body><p>"), text, F.lit("</p></body></html>"))
    return loaded(table(spark, d, "documents"), html_page.load, page, "doc_id")


@query("""SELECT c_nationkey::VARCHAR AS nation, md5(string_agg('c_custkey: ' || c_custkey || chr(10) || 'c_name: ' || c_name || chr(10) || 'c_mktsegment: ' || c_mktsegment, chr(10) || chr(10) ORDER BY c_custkey)) AS digest, count(*)::VARCHAR AS n_rows FROM customer GROUP BY c_nationkey""")
def csv_files(spark, d):
    """Customers as one file for each nation, read with all files of a folder."""
    path = folder(spark)
    rows = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey").repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey")
    rows.write.partitionBy("c_nationkey").option("header", True).csv(path)
    found = files.read_files(spark, path, glob="*.csv")
    return found.select(F.regexp_extract("source", r"c_nationkey=(\d+)/", 1).alias("nation"), F.md5("text").alias("digest"), F.col("metadata")["n_filas_con_datos"].alias("n_rows"))


@query("""WITH n AS (SELECT n_nationkey AS k, ['txt', 'csv', 'htm', 'pdf'][n_nationkey % 4 + 1] AS format FROM nation)
SELECT CASE format WHEN 'csv' THEN md5('value: nation ' || k) WHEN 'pdf' THEN NULL ELSE md5('nation ' || k) END AS digest, 'k=' || k AS folder, format, format = 'pdf' AS failed FROM n""")
def mixed_files(spark, d):
    """Files of four formats under one folder; those without a reader are failures, not errors."""
    path = folder(spark)
    k, say = F.col("n_nationkey"), F.concat(F.lit("nation "), "n_nationkey")
    rows = table(spark, d, "nation").select(k.alias("k"), F.when(k % 4 == 2, F.concat(F.lit("<p>"), say, F.lit("</p>"))).when(k % 4 == 3, "%PDF-1.4").otherwise(say).alias("value"))
    for n, kind in enumerate(("txt", "csv", "htm", "pdf")):
        rows.filter(F.col("k") % 4 == n).repartition("k").write.partitionBy("k").option("extension", kind).option("header", kind == "csv").csv(f"{path}/{kind}")
    found = files.read_files(spark, path, glob="part-*")
    return found.select(F.md5("text").alias("digest"), F.regexp_extract("source", r"(k=\d+)/", 1).alias("folder"), "format", F.col("error").isNotNull().alias("failed"))


CATALOG_SQL = """c AS (SELECT c_custkey AS k, 'F' || (c_custkey % 4) || '-' || (c_custkey % 97) AS doc_id, 'dir/sub' || (c_nationkey % 5) || '/f' || (c_custkey % 101) || '.' || lower(substr(c_mktsegment, 1, 3)) AS source, (c_custkey % 4)::INT AS phenomenon, lower(substr(c_mktsegment, 1, 3)) AS format FROM customer WHERE c_custkey % 10 <> 7)"""


def entries(spark: SparkSession, d: str) -> DataFrame:
    c, k = table(spark, d, "customer"), F.col("c_custkey")
    name = F.when(k % 10 != 7, F.concat(F.lit(" f"), k % 101, F.lit("."), F.substring("c_mktsegment", 1, 3)))
    rows = c.select(F.concat(F.lit("F"), k % 4, F.lit("-"), k % 97).alias("doc_id"), name.alias("filename"), F.concat(F.lit("./dir\\sub"), F.col("c_nationkey") % 5, F.lit("\\")).alias("folder"), F.concat(F.lit("F"), k % 4, F.lit(" x")).alias("phenomenon"), F.lit("o").alias("observatory"), F.lit("t").alias("type_label"))
    return catalog.entries(rows)


@query(f"WITH {CATALOG_SQL} SELECT doc_id, regexp_replace(source, '[.][a-z]+$', '') AS stem, phenomenon, format FROM c")
def catalog_entries(spark, d):
    return entries(spark, d).select("doc_id", F.regexp_replace("source", "[.][A-Za-z]+$", "").alias("stem"), "phenomenon", "format")


@query(f"""WITH {CATALOG_SQL} SELECT 'repeated source' AS problem, lower(source) AS value FROM c GROUP BY source HAVING count(*) > 1 UNION ALL SELECT 'repeated doc_id', lower(doc_id) FROM c GROUP BY doc_id HAVING count(*) > 1 UNION ALL SELECT 'phenomenon', lower(doc_id) FROM c WHERE phenomenon = 0""")
def catalog_violations(spark, d):
    return catalog.violations(entries(spark, d)).withColumn("value", F.lower("value"))


@query(f"WITH {CATALOG_SQL} SELECT doc_id, phenomenon FROM c WHERE phenomenon = 2 AND format = 'mac'")
def catalog_selection(spark, d):
    return catalog.select(entries(spark, d), 2, ".MAC").select("doc_id", "phenomenon")


# Stores


@query("SELECT doc_id::VARCHAR AS doc_id, md5(text) AS digest, false AS bad FROM documents UNION ALL SELECT '{\"doc_id\": ' || n_nationkey, md5('{\"doc_id\": ' || n_nationkey), true FROM nation")
def json_lines(spark, d):
    """Documents as JSON lines among lines that are cut off: the good ones as rows, the others as they are."""
    path = folder(spark)
    good = table(spark, d, "documents").select(F.to_json(F.struct(F.col("doc_id").cast("string").alias("doc_id"), "text")).alias("value"))
    good.unionByName(table(spark, d, "nation").select(F.concat(F.lit('{"doc_id": '), "n_nationkey").alias("value"))).write.text(path)
    rows, bad = stores.read_tolerant(spark, path, T.StructType().add("doc_id", "string").add("text", "string"))
    return rows.select("doc_id", F.md5("text").alias("digest"), F.lit(False).alias("bad")).unionByName(bad.select(F.col("line").alias("doc_id"), F.md5("line").alias("digest"), F.lit(True).alias("bad")))


@query("SELECT printf('q%03d', n_nationkey + 1) AS query_id, 'What does ' || n_name || ' buy from others?' AS text FROM nation")
def parsed_queries(spark, d):
    """One text with a mark before each query, in varied form; every query is followed by one that is too short."""
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    k = F.col("n_nationkey") + 1
    mark = F.when(k % 2 == 0, F.format_string(" Q%03d \n", k)).otherwise(F.format_string(" q%d  ", k))
    return stores.parse_queries(n.select(F.concat(F.lit("intro"), mark, F.lit("What does  "), "n_name", F.lit("\n buy from others? q900 short")).alias("text")))


@query("""SELECT printf('q%03d', c_nationkey + 1) AS query_id, 'F1-' || c_custkey AS doc_id, (c_custkey % 3)::INT AS grade FROM customer WHERE c_nationkey <> 3 AND c_custkey % 11 <> 0""")
def parsed_judgements(spark, d):
    """Judgements as JSON, one object per customer; keys that begin with _ are comments, grades must be numbers."""
    c = table(spark, d, "customer")
    grade = F.when(F.col("c_custkey") % 11 == 0, "none").otherwise((F.col("c_custkey") % 3).cast("string"))
    query_id = F.when(F.col("c_nationkey") == 3, "_note").otherwise(F.format_string("q%03d", F.col("c_nationkey") + 1))
    inner = F.create_map(F.concat(F.lit("F1-"), "c_custkey"), grade, F.lit("_why"), F.lit("1"))
    return stores.parse_judgements(c.select(F.to_json(F.create_map(query_id, inner)).alias("text")))


@query("SELECT printf('q%03d', n_nationkey + 1) AS query_id, CASE WHEN n_nationkey % 2 = 0 THEN 'second' ELSE 'first' END AS doc_id FROM nation")
def read_results(spark, d):
    """Results as JSON lines; of a query that comes twice in a file the last stays."""
    path = folder(spark)
    n = table(spark, d, "nation")
    line = lambda name, order: n.select(F.format_string("q%03d", F.col("n_nationkey") + 1).alias("query_id"), F.lit(name).alias("which"), F.lit(order).alias("order"), "n_nationkey")
    rows = line("first", 1).unionByName(line("second", 2).filter("n_nationkey % 2 = 0"))
    made = rows.withColumn("documents", F.array(F.struct(F.lit(1).alias("rank"), F.col("which").alias("doc_id")))).withColumn("fragments", F.array().cast(schemas.RESULT["fragments"].dataType))
    made.repartition(1).sortWithinPartitions("order").select(F.to_json(F.struct("query_id", "documents", "fragments")).alias("value")).write.text(path)
    return stores.read_results(spark, path).select("query_id", F.col("documents")[0]["doc_id"].alias("doc_id"))


@query(f"""WITH {FACTS_SQL}, o AS (SELECT src, relation, dst, chunk_id, min((ord, nth)) AS pos FROM facts GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY src, relation, dst ORDER BY pos) AS n FROM o),
c AS (SELECT src, relation, dst, string_agg(chunk_id, ' ' ORDER BY n) AS chunk_ids FROM r WHERE n <= 10 GROUP BY ALL) SELECT src, relation, dst, weight, chunk_ids FROM edges JOIN c USING (src, relation, dst)""")
def graphml_edges(spark, d):
    """The graph of orders, written as GraphML and read again."""
    path = folder(spark)
    f = cut(facts(spark, d))
    n, e = cut(graph.nodes(f, ["ordinal"])), cut(graph.edges(f, ["ordinal"]))
    stores.graphml(n, e).select("value").coalesce(1).write.text(path)
    return stores.read_graphml(spark, path)[1].select("src", "relation", "dst", "weight", F.array_join("chunk_ids", " ").alias("chunk_ids"))


@query("SELECT doc_id, doc_id % 3 + 1 AS phenomenon FROM documents WHERE length(trim(text)) > 0 AND n_chars > 0")
def valid_chunks(spark, d):
    rows = table(spark, d, "documents").filter((F.length(F.trim("text")) > 0) & (F.col("n_chars") > 0)).select("doc_id", F.col("doc_id").cast("string").alias("chunk_id"), F.lit(0).alias("position"), F.col("n_chars").alias("num_tokens"), "text", (F.col("doc_id") % 3 + 1).alias("phenomenon"))
    return stores.valid_chunks(rows).select("doc_id", "phenomenon")
