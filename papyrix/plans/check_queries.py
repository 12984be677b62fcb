"""The registered queries of checks, metrics and graph merging. Each check runs over tables in which faults were planted
by a rule on the ids, and its SQL states the rule's outcome from the tables themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrix.functions import text as X
from papyrix.operators import checks, chunking, evaluation, graph, profile
from papyrix.plans.queries import FACTS_SQL, HITS_SQL, WORDS_SQL, WS_SQL, facts, hits, query, query_vectors, table
from papyrix.session import cut

# Cleaning: texts before and after, where every fourth lost its paragraphs, its text, got an invisible character or a
# letter in two code points

BOTH_SQL = """b AS (SELECT doc_id, source, replace(text, chr(10), chr(10) || chr(10)) AS before, CASE doc_id % 4 WHEN 0 THEN replace(text, chr(10), ' ') WHEN 1 THEN ' ' WHEN 2 THEN text || chr(8203) ELSE text || 'e' || chr(769) END AS after FROM documents)"""
PARAGRAPHS_SQL = r"len(list_filter(regexp_split_to_array({0}, '\n\s*\n'), lambda p: trim(p) <> ''))::INT"


def both(spark: SparkSession, d: str) -> DataFrame:
    k = F.pmod("doc_id", F.lit(4))
    after = F.when(k == 0, F.replace("text", F.lit("\n"), F.lit(" "))).when(k == 1, " ").when(k == 2, F.concat("text", F.lit("\u200b"))).otherwise(F.concat("text", F.lit("e\u0301")))
    return table(spark, d, "documents").select("doc_id", "source", F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("before"), after.alias("after"))


@query(f"""WITH {BOTH_SQL}, n AS (SELECT doc_id, {PARAGRAPHS_SQL.format("before")} AS paragraphs_before, {PARAGRAPHS_SQL.format("after")} AS paragraphs_after FROM b)
SELECT * FROM n WHERE paragraphs_before >= 3 AND paragraphs_after <= 1""")
def collapsed_paragraphs(spark, d):
    return checks.collapsed_paragraphs(both(spark, d), 3)


@query(f"WITH {BOTH_SQL} SELECT doc_id FROM b WHERE regexp_replace(before, '{WS_SQL}', '', 'g') <> '' AND regexp_replace(after, '{WS_SQL}', '', 'g') = ''")
def emptied_documents(spark, d):
    return checks.emptied(both(spark, d))


@query(f"WITH {BOTH_SQL} SELECT doc_id, round(1 - length(after) / length(before), 6) AS share FROM b WHERE length(before) > 2000 ORDER BY share DESC, doc_id LIMIT 15")
def worst_reductions(spark, d):
    return checks.worst_reductions(both(spark, d))


@query(rf"""WITH {BOTH_SQL} SELECT doc_id FROM b
WHERE regexp_matches(after, '[\x00-\x08\x0b\x0e-\x1f\x7f-\x{{9f}}\x{{fffd}}\x{{e000}}-\x{{f8ff}}\x{{ad}}\x{{200b}}-\x{{200f}}\x{{202a}}-\x{{202e}}\x{{2060}}-\x{{2064}}\x{{206a}}-\x{{206f}}\x{{feff}}]')""")
def control_left(spark, d):
    return checks.control_left(both(spark, d), "after")


@query(f"WITH {BOTH_SQL} SELECT doc_id FROM b WHERE nfc_normalize(after) <> after")
def not_nfc(spark, d):
    return checks.not_nfc(both(spark, d), "after")


@query(f"""WITH {BOTH_SQL} SELECT source, count(*) AS n_docs, sum(length(before))::BIGINT AS chars_before, sum(length(before) - length(after))::BIGINT AS chars_removed FROM b GROUP BY source""")
def cleaning_loss(spark, d):
    return profile.cleaning_loss(both(spark, d), by="source")[0]


@query(f"""WITH {BOTH_SQL} SELECT doc_id, source, length(before)::INT AS chars_before, (length(before) - length(after))::INT AS chars_removed, round((length(before) - length(after)) / nullif(length(before), 0), 6) AS share
FROM b ORDER BY share DESC NULLS LAST, doc_id LIMIT 20""")
def cleaning_worst(spark, d):
    return profile.cleaning_loss(both(spark, d), by="source")[1]


WATCHED = ("access", "data", "report", "system", "time", "und")


@query(rf"""WITH t AS (SELECT unnest(['{"', '".join(WATCHED)}']) AS term), g AS (SELECT doc_id, term FROM documents, t WHERE doc_id % 4 = 1 AND regexp_matches(lower(text), '(^|[^\p{{L}}\p{{N}}_])' || term || '($|[^\p{{L}}\p{{N}}_])'))
SELECT doc_id, string_agg(term, ' ' ORDER BY term) AS lost FROM g GROUP BY doc_id""")
def terms_lost(spark, d):
    rows = both(spark, d)
    lost = profile.terms_lost(rows.select("doc_id", F.col("before").alias("text")), rows.select("doc_id", F.col("after").alias("text")), list(WATCHED))
    return lost.select("doc_id", F.array_join("lost", " ").alias("lost"))


# Chunks of 50 words, in which every tenth document lost a chunk, a text, an id, got a longer count or a chunk twice

CHUNKS_SQL = f"""w AS (SELECT doc_id, lang, source, {WORDS_SQL} AS w FROM documents), i AS (SELECT *, unnest(range(0, len(w), 50)) AS i FROM w),
c0 AS (SELECT doc_id, printf('%d#%04d', doc_id, i // 50) AS chunk_id, lang, source, (i // 50)::INT AS position, array_to_string(w[i + 1:i + 50], ' ') AS text, len(w[i + 1:i + 50])::INT AS num_tokens FROM i),
c AS (SELECT doc_id, chunk_id, CASE WHEN doc_id % 10 = 1 AND position = 0 THEN NULL ELSE source END AS source, 'txt' AS format, doc_id % 3 + 1 AS phenomenon, lang AS language, position,
    CASE WHEN doc_id % 10 = 2 AND position = 0 THEN num_tokens + 50 ELSE num_tokens END AS num_tokens, CASE WHEN doc_id % 10 = 3 AND position = 1 THEN ' ' ELSE text END AS text FROM c0 WHERE NOT (doc_id % 10 = 0 AND position = 1))"""


def clean_chunks(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", F.posexplode(X.counted_slices(F.col("text"), 50)).alias("position", "slice"))
    return docs.select("doc_id", chunking.chunk_id(F.col("doc_id").cast("string"), F.col("position")).alias("chunk_id"), "source", F.lit("txt").alias("format"), (F.pmod("doc_id", F.lit(3)) + 1).alias("phenomenon"), F.col("lang").alias("language"), "position", F.col("slice.n_words").alias("num_tokens"), "slice.text")


def chunks(spark: SparkSession, d: str) -> DataFrame:
    k = F.pmod("doc_id", F.lit(10))
    at = lambda n, position: (k == n) & (F.col("position") == position)
    rows = clean_chunks(spark, d).filter(~at(0, 1))
    rows = rows.withColumn("source", F.when(~at(1, 0), F.col("source"))).withColumn("num_tokens", F.when(at(2, 0), F.col("num_tokens") + 50).otherwise(F.col("num_tokens")))
    return rows.withColumn("text", F.when(at(3, 1), " ").otherwise(F.col("text")))


@query(f"WITH {CHUNKS_SQL} SELECT chunk_id, array_to_string(list_filter([CASE WHEN coalesce(trim(source), '') = '' THEN 'source' END, CASE WHEN trim(text) = '' THEN 'text' END], lambda x: x IS NOT NULL), ' ') AS missing FROM c WHERE coalesce(trim(source), '') = '' OR trim(text) = ''")
def missing_fields(spark, d):
    return checks.missing_fields(chunks(spark, d)).withColumn("missing", F.array_join("missing", " "))


@query(f"WITH {CHUNKS_SQL}, n AS (SELECT doc_id, position, (row_number() OVER (PARTITION BY doc_id ORDER BY position) - 1)::INT AS want FROM c) SELECT * FROM n WHERE position <> want")
def bad_positions(spark, d):
    return checks.bad_positions(chunks(spark, d)).withColumn("want", F.col("want").cast("int"))


@query(f"WITH {CHUNKS_SQL} SELECT doc_id, position, num_tokens FROM c WHERE num_tokens > 50")
def over_budget(spark, d):
    return checks.over_budget(chunks(spark, d), 50)


@query(f"WITH {CHUNKS_SQL} SELECT chunk_id, len({WORDS_SQL})::INT AS n_words FROM c WHERE len({WORDS_SQL}) > 45")
def long_fragments(spark, d):
    return checks.long_fragments(chunks(spark, d), 45).select("chunk_id", "n_words")


@query(f"WITH {CHUNKS_SQL} SELECT c0.chunk_id FROM c0 LEFT JOIN c USING (chunk_id) WHERE c.text IS NULL OR c.text <> c0.text")
def misaligned_records(spark, d):
    """Records of the chunks as they were against the chunks as they are."""
    return checks.misaligned(clean_chunks(spark, d).select("chunk_id", F.col("text").alias("texto")), chunks(spark, d))


@query(f"WITH {CHUNKS_SQL} SELECT chunk_id FROM c WHERE source IS NULL")
def bad_records(spark, d):
    rows = chunks(spark, d)
    return checks.bad_records(rows.select("doc_id", "chunk_id", F.col("source").alias("fuente"), F.col("format").alias("formato"), F.col("phenomenon").alias("fenomeno"), F.col("position").alias("posicion"), "num_tokens", F.col("text").alias("texto")))


@query(f"""WITH {CHUNKS_SQL} SELECT chunk_id, text, 'first' AS only_in FROM (SELECT chunk_id, text FROM c0 EXCEPT ALL SELECT chunk_id, text FROM c) UNION ALL SELECT chunk_id, text, 'second' FROM (SELECT chunk_id, text FROM c EXCEPT ALL SELECT chunk_id, text FROM c0)""")
def different_runs(spark, d):
    return checks.different(clean_chunks(spark, d).select("chunk_id", "text"), chunks(spark, d).select("chunk_id", "text"))


@query(f"WITH {CHUNKS_SQL} SELECT 'chunks=' || (SELECT count(*) FROM c) || ' records=' || (SELECT count(*) FROM c0) AS counts WHERE (SELECT count(*) FROM c) <> (SELECT count(*) FROM c0)")
def count_mismatch(spark, d):
    found = checks.count_mismatch(records=clean_chunks(spark, d), chunks=chunks(spark, d))
    return found.select(F.array_join(F.transform(F.map_entries("counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), " ").alias("counts"))


@query(f"WITH {CHUNKS_SQL} SELECT chunk_id, row_number() OVER (ORDER BY chunk_id) - 1 AS faiss_id, doc_id, source AS fuente, position AS posicion, language AS idioma, md5(text) AS digest FROM c")
def metadata_records(spark, d):
    return chunking.metadata_records(chunks(spark, d)).select("chunk_id", "faiss_id", "doc_id", "fuente", "posicion", "idioma", F.md5("texto").alias("digest"))


@query(f"""WITH {CHUNKS_SQL}, t AS (SELECT doc_id, chunk_id, CASE WHEN doc_id % 5 < 2 THEN 'csv' ELSE 'txt' END AS format, CASE WHEN doc_id % 5 IN (1, 2) AND position = 0 THEN 'PMID: 1 ' || text ELSE text END AS text, position FROM c)
SELECT chunk_id FROM t WHERE doc_id NOT IN (SELECT doc_id FROM t WHERE format = 'csv' AND position = 0 AND regexp_matches(text[1:1200], '\\b(PMID|NCT Number)\\s*:'))""".replace("\\\\", "\\"))
def without_bibliographies(spark, d):
    k = F.pmod("doc_id", F.lit(5))
    rows = chunks(spark, d).withColumn("format", F.when(k < 2, "csv").otherwise("txt")).withColumn("text", F.when(k.isin(1, 2) & (F.col("position") == 0), F.concat(F.lit("PMID: 1 "), "text")).otherwise(F.col("text")))
    return chunking.without_bibliographies(rows).select("chunk_id")


@query(f"""WITH {CHUNKS_SQL}, s AS (SELECT doc_id, position, text, lead(text) OVER (PARTITION BY doc_id ORDER BY position) AS next FROM c)
SELECT doc_id, position FROM s WHERE NOT regexp_matches(text, '[.!?…。！？؟।][")\\]»”’''›〉】]*$') AND regexp_matches(next, '^\\p{{Ll}}')""".replace("\\\\", "\\"))
def split_sentence_chunks(spark, d):
    """Chunks cut by words alone, declared as cut at level 2: what is wrong is a sentence in two."""
    return checks.split_sentences(chunks(spark, d).withColumn("cut_level", F.lit(2)))


# Results: one of each nation, of six forms: good, a document missing, a fragment missing, ranks from 2, a blank id, a
# long fragment

@query("""SELECT printf('q%03d', n_nationkey + 1) AS query_id, unnest(CASE n_nationkey % 6 WHEN 1 THEN ['documents'] WHEN 2 THEN ['fragments'] WHEN 3 THEN ['document ranks'] WHEN 4 THEN ['fragment fields'] WHEN 5 THEN ['long fragment'] ELSE [] END) AS problem FROM nation
UNION ALL SELECT 'q001', 'repeated query'""")
def bad_results(spark, d):
    return checks.bad_results(results(spark, d).unionByName(results(spark, d).filter("query_id = 'q001'")))


def results(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").select(F.format_string("q%03d", F.col("n_nationkey") + 1).alias("query_id"), (F.col("n_nationkey") % 6).cast("int").alias("form"), F.col("n_name").alias("name"))
    form = F.col("form")
    upto = lambda k: F.sequence(F.lit(1), k)
    docs = F.transform(upto(F.when(form == 1, 2).otherwise(3)), lambda i: F.struct(F.when(form == 3, i + 1).otherwise(i).alias("rank"), F.concat(F.lit("F1-"), "name", i.cast("string")).alias("doc_id")))
    text = lambda i: F.when((form == 5) & (i == 10), F.repeat(F.lit("word "), 251)).otherwise("word")
    parts = F.transform(upto(F.when(form == 2, 9).otherwise(10)), lambda i: F.struct(i.alias("rank"), F.when((form == 4) & (i == 4), "").otherwise(F.concat("name", F.lit("#"), i.cast("string"))).alias("chunk_id"), F.concat(F.lit("F1-"), "name").alias("doc_id"), text(i).alias("text")))
    return n.select("query_id", docs.alias("documents"), parts.alias("fragments"))


@query("""WITH r AS (SELECT printf('q%03d', n_nationkey + 1) AS query_id, n_nationkey % 6 AS form, n_name AS name FROM nation), i AS (SELECT unnest(range(1, 11)) AS i),
x AS (SELECT query_id, 'F1-' || name || i AS id FROM r, i WHERE i BETWEEN 2 AND CASE WHEN form = 1 THEN 2 ELSE 3 END UNION ALL SELECT query_id, CASE WHEN form = 4 AND i = 4 THEN '' ELSE name || '#' || i END FROM r, i WHERE i BETWEEN 2 AND CASE WHEN form = 2 THEN 9 ELSE 10 END)
SELECT query_id, id FROM x""")
def unknown_ids(spark, d):
    """Only the first document and the first fragment of each result are recorded."""
    known = table(spark, d, "nation").select(F.concat(F.lit("F1-"), "n_name", F.lit("1")).alias("doc_id"), F.concat("n_name", F.lit("#1")).alias("chunk_id"))
    return checks.unknown_ids(results(spark, d), known)


@query("SELECT printf('q%03d', i) AS query_id FROM range(1, 51) t(i) WHERE (i - 1) % 7 = 3 OR i > (SELECT count(*) FROM nation) OR i = 1")
def bad_query_set(spark, d):
    """Of q001 to q050 every seventh is missing, those beyond the nations too, and q001 comes twice."""
    n = table(spark, d, "nation").filter("n_nationkey % 7 <> 3").select(F.format_string("q%03d", F.col("n_nationkey") + 1).alias("query_id"))
    return checks.bad_query_set(n.unionByName(n.filter("query_id = 'q001'")))


# Metrics

@query(f"""WITH {HITS_SQL}, f AS (SELECT query_id, query_label % 3 + 1 AS topic, printf('F%d-%s', h.label % 3 + 1, d.source) AS doc_id FROM hits h JOIN documents d ON d.doc_id = h.vec_id WHERE rank <= 10)
SELECT topic, count(*) AS slots, count(DISTINCT doc_id) AS docs, round(avg(starts_with(doc_id, 'F' || topic || '-')::INT), 6) AS topic_share FROM f GROUP BY topic
UNION ALL SELECT NULL, count(*), count(DISTINCT doc_id), round(avg(starts_with(doc_id, 'F' || topic || '-')::INT), 6) FROM f""")
def describe_run(spark, d):
    found = hits(spark, d).filter("rank <= 10").select("query_id", "doc_id")
    return evaluation.describe_run(found, query_vectors(spark, d).select("query_id", "topic"))


@query("""WITH f AS (SELECT doc_id % 50 AS q, doc_id, coalesce(lang, '-') AS lang FROM documents) SELECT q::VARCHAR AS query_id, doc_id AS step, coalesce(lang = lag(lang) OVER (PARTITION BY q ORDER BY doc_id), false) AS unchanged FROM f""")
def unchanged_from_previous(spark, d):
    rows = table(spark, d, "documents").select(F.pmod("doc_id", F.lit(50)).cast("string").alias("query_id"), F.col("doc_id").alias("step"), F.coalesce("lang", F.lit("-")).alias("fingerprint"))
    return evaluation.unchanged_from_previous(rows, "step").select("query_id", "step", "unchanged")


@query("SELECT o_orderstatus AS status, round(coalesce(avg(o_totalprice), 0), 6) AS o_totalprice, round(coalesce(avg(o_custkey), 0), 6) AS o_custkey FROM orders GROUP BY o_orderstatus")
def mean_metrics(spark, d):
    rows = table(spark, d, "orders").withColumnRenamed("o_orderstatus", "status")
    return evaluation.mean_metrics(rows, ["o_totalprice", "o_custkey"], ("status",))


@query("""SELECT printf('q%03d', n_nationkey + 1) AS query_id, count(s_suppkey) AS seeds, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS chunks FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_nationkey""")
def link_diagnostic(spark, d):
    name = lambda c: F.format_string("q%03d", F.col(c) + 1).alias("query_id")
    return evaluation.link_diagnostic(table(spark, d, "nation").select(name("n_nationkey")), table(spark, d, "supplier").select(name("s_nationkey")), table(spark, d, "customer").select(name("c_nationkey")))


# Graph

def _faulty_graph(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Nations and suppliers. Nations from 20 on have no node, those from 10 to 14 no name; every fifth edge has no chunk."""
    place = table(spark, d, "nation").filter("n_nationkey < 20").select(F.concat(F.lit("LOC:"), "n_nationkey").alias("node"), F.when(~F.col("n_nationkey").between(10, 14), F.col("n_name")).alias("name"), F.lit("LOC").alias("type"), F.lit("1").alias("topics"), F.array(F.concat(F.lit("n"), "n_nationkey")).alias("chunk_ids"))
    firm = table(spark, d, "supplier").select(F.concat(F.lit("ORG:"), "s_suppkey").alias("node"), F.col("s_name").alias("name"), F.lit("ORG").alias("type"), F.lit("23").alias("topics"), F.array(F.concat(F.lit("s"), "s_suppkey")).alias("chunk_ids"))
    chunk = F.when(F.col("s_suppkey") % 5 != 0, F.concat(F.lit("s"), "s_suppkey"))
    edges = table(spark, d, "supplier").select(F.concat(F.lit("ORG:"), "s_suppkey").alias("src"), F.lit("en").alias("relation"), F.concat(F.lit("LOC:"), "s_nationkey").alias("dst"), F.concat(F.lit("F1-"), "s_nationkey").alias("doc_id"), chunk.alias("chunk_id"), F.array_compact(F.array(chunk)).alias("chunk_ids"))
    return place.unionByName(firm), edges


@query("""SELECT 'LOC:' || n_nationkey AS id, 'node' AS what FROM nation WHERE n_nationkey BETWEEN 10 AND 14 UNION ALL SELECT 'ORG:' || s_suppkey || ' en LOC:' || s_nationkey, 'edge' FROM supplier WHERE s_suppkey % 5 = 0
UNION ALL SELECT DISTINCT 'LOC:' || s_nationkey, 'end' FROM supplier WHERE s_nationkey >= 20""")
def incomplete_graph(spark, d):
    return checks.incomplete_graph(*_faulty_graph(spark, d))


@query("SELECT 'n' || n_nationkey AS chunk_id FROM nation WHERE n_nationkey < 20 UNION ALL SELECT 's' || s_suppkey FROM supplier WHERE s_suppkey % 3 <> 0")
def unknown_evidence(spark, d):
    """Every third supplier's chunk is recorded."""
    known = table(spark, d, "supplier").filter("s_suppkey % 3 = 0").select(F.concat(F.lit("s"), "s_suppkey").alias("chunk_id"))
    return checks.unknown_evidence(*_faulty_graph(spark, d), known)


@query("""WITH t AS (SELECT DISTINCT 'LOC:' || s_nationkey AS node FROM supplier), d AS (SELECT n_nationkey IN (SELECT s_nationkey FROM supplier) AS has FROM nation)
SELECT (SELECT round(avg(has::INT), 6) FROM d) AS doc_share, '123' AS topics, (SELECT count(*) FROM nation WHERE n_nationkey < 20 AND 'LOC:' || n_nationkey NOT IN (SELECT node FROM t)) AS isolated""")
def graph_coverage(spark, d):
    docs = table(spark, d, "nation").select(F.concat(F.lit("F1-"), "n_nationkey").alias("doc_id"))
    return checks.graph_coverage(*_faulty_graph(spark, d), docs)


#: Spellings of one name: the key ignores case, a leading article, a company suffix.
def _spelled(name: Column, k: Column) -> Column:
    return F.when(k % 3 == 0, name).when(k % 3 == 1, F.concat(F.lit("The "), F.lower(name))).otherwise(F.concat(name, F.lit(" Inc")))


@query("SELECT 'ORG' AS type, lower(p_brand) AS key, count(*) AS n FROM part GROUP BY p_brand HAVING count(*) > 1")
def shared_keys(spark, d):
    rows = table(spark, d, "part").select(F.lit("ORG").alias("type"), _spelled(F.col("p_brand"), F.col("p_partkey")).alias("name"))
    return checks.shared_keys(rows)


@query("SELECT 'ORG' AS type, lower(p_brand) AS key, count(*) AS n, count(DISTINCT p_partkey % 3) AS forms FROM part GROUP BY p_brand")
def group_entities(spark, d):
    rows = table(spark, d, "part").select(_spelled(F.col("p_brand"), F.col("p_partkey")).alias("name"), F.lit("organization").alias("label"))
    return graph.group_entities(rows).select("type", "key", "n", F.size("variants").cast("bigint").alias("forms"))


@query("""WITH n AS (SELECT p_partkey, lower(p_brand) AS key, p_partkey % 4 AS t FROM part WHERE p_partkey <= 200), e AS (SELECT 'ORG:' || key AS src, 'ORG:' || (SELECT key FROM n m WHERE m.p_partkey = n.p_partkey % 200 + 1) AS dst, p_partkey FROM n),
c AS (SELECT key, 'c' || p_partkey AS chunk_id, row_number() OVER (PARTITION BY key ORDER BY printf('n%06d', p_partkey)) AS r FROM n)
SELECT 'ORG:' || key AS id, (SELECT count(*) FROM e WHERE src = 'ORG:' || n.key AND dst <> src) AS weight, string_agg(DISTINCT t::VARCHAR, '' ORDER BY t::VARCHAR) AS topics, (SELECT string_agg(chunk_id, ' ' ORDER BY r) FROM c WHERE c.key = n.key AND r <= 10) AS chunk_ids FROM n GROUP BY key""")
def merged_graph(spark, d):
    """Parts 1 to 200 as nodes, each with an edge to the next; those of one brand become one node."""
    p = table(spark, d, "part").filter("p_partkey <= 200").withColumn("node", F.format_string("n%06d", "p_partkey"))
    nodes = p.select("node", _spelled(F.col("p_brand"), F.col("p_partkey")).alias("name"), F.lit("ORG").alias("type"), (F.col("p_partkey") % 4).cast("string").alias("topics"), F.array(F.concat(F.lit("c"), "p_partkey")).alias("chunk_ids"))
    edges = p.select(F.col("node").alias("src"), F.lit("ante").alias("relation"), F.format_string("n%06d", F.col("p_partkey") % 200 + 1).alias("dst"), F.lit(1).cast("bigint").alias("weight"), F.lit("F1-a").alias("doc_id"), F.concat(F.lit("c"), "p_partkey").alias("chunk_id"), F.array(F.concat(F.lit("c"), "p_partkey")).alias("chunk_ids"), F.lit("").alias("evidence"), F.lit(False).alias("passive"))
    n, e = graph.merge_by_key(cut(nodes), cut(edges))
    weight = e.groupBy(F.col("src").alias("node")).agg(F.sum("weight").alias("weight"))
    return n.join(weight, "node", "left").select(F.col("node").alias("id"), F.coalesce("weight", F.lit(0).cast("bigint")).alias("weight"), "topics", F.array_join("chunk_ids", " ").alias("chunk_ids"))


@query("""WITH e AS (SELECT 'q' || n_nationkey AS query_id, CASE WHEN n_nationkey % 2 = 0 THEN 'LOC' ELSE 'ORG' END AS type, lower(n_name) AS key FROM nation), n AS (SELECT CASE WHEN n_nationkey % 3 = 0 THEN 'ORG' ELSE 'LOC' END AS type, lower(n_name) AS key FROM nation WHERE n_nationkey < 20)
SELECT query_id, n.type || ':' || n.key AS node FROM e JOIN n USING (key)""")
def linked_entities(spark, d):
    """Entities of queries by type and key, or by key alone where the type has no such node."""
    n = table(spark, d, "nation")
    asked = n.select(F.concat(F.lit("q"), "n_nationkey").alias("query_id"), F.when(F.col("n_nationkey") % 2 == 0, "LOC").otherwise("ORG").alias("type"), F.lower("n_name").alias("key"))
    kind = F.when(F.col("n_nationkey") % 3 == 0, "ORG").otherwise("LOC")
    nodes = n.filter("n_nationkey < 20").select(F.concat_ws(":", kind, F.lower("n_name")).alias("node"), F.initcap("n_name").alias("name"), F.array("n_name").alias("variants"))
    return graph.link(asked, nodes, graph.node_keys(nodes))


@query(f"""WITH {FACTS_SQL} SELECT src, relation, dst, weight, (SELECT count(DISTINCT f.chunk_id) FROM facts f WHERE f.src = e.src AND f.relation = e.relation AND f.dst = e.dst) AS chunks FROM edges e WHERE weight >= 3""")
def strong_edges(spark, d):
    f = cut(facts(spark, d))
    kept = graph.nucleus(f.select(F.explode(F.array("src", "dst")).alias("node")).distinct(), f.groupBy("src", "relation", "dst").agg(F.count("*").alias("weight"), F.countDistinct("chunk_id").alias("chunks")), 3)[1]
    return kept.select("src", "relation", "dst", "weight", "chunks")
