"""The registered queries of the engine's own operators over the benchmark tables, with SQL for DuckDB where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrix.functions import text as X
from papyrix.operators import checks, chunking, evaluation, graph, profile, ranking, vectors
from papyrix.plans import retrieve
from papyrix.session import cut, for_long_texts, if_small, spread
from papyrix.sources import html_page

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function (spark, sf_dir) -> DataFrame under its name, with its SQL."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(rows) if name in ("documents", "pages", "lineitem") else rows


#: Ids that may be broadcast: some 10 bytes each.
MAX_IDS = 2_000_000

# SQL pieces
WS_SQL = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WORDS_SQL = f"list_filter(regexp_split_to_array(text, '{WS_SQL}+'), lambda x: x <> '')"
DOT_SQL = "list_dot_product(v.embedding::DOUBLE[], q.embedding::DOUBLE[])"
HITS_SQL = f"""
q AS (SELECT vec_id AS qid, printf('q%03d', vec_id + 1) AS query_id, embedding, label FROM embeddings WHERE vec_id % 50 = 0),
scored AS (SELECT q.query_id, q.label AS query_label, v.vec_id, v.label, {DOT_SQL} AS score FROM embeddings v, q),
hits AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored),
cand AS (SELECT h.query_id, h.vec_id, h.rank, h.score, h.query_label % 3 + 1 AS topic, d.doc_id AS own_id, printf('F%d-%s', h.label % 3 + 1, d.source) AS doc_id,
    printf('c%06d', h.vec_id) AS chunk_id, d.lang AS language, d.text FROM hits h JOIN documents d ON d.doc_id = h.vec_id WHERE h.rank <= 200)"""


def store(spark: SparkSession, d: str) -> DataFrame:
    """The vector store of the benchmark tables: vec_id is doc_id."""
    e = table(spark, d, "embeddings")
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("vec_id"), "text", "lang", "source")
    return e.join(docs, "vec_id").select("vec_id", F.format_string("c%06d", F.col("vec_id")).alias("chunk_id"), F.format_string("F%d-%s", F.col("label") % 3 + 1, F.col("source")).alias("doc_id"), F.col("lang").alias("language"), "text", "embedding")


def query_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Every row whose id is divisible by 50 is a query, against all rows."""
    e = table(spark, d, "embeddings").filter("vec_id % 50 = 0")
    return e.select(F.format_string("q%03d", F.col("vec_id") + 1).alias("query_id"), "embedding", (F.col("label") % 3 + 1).alias("topic"), F.col("vec_id").alias("own"))


def hits(spark: SparkSession, d: str) -> DataFrame:
    found = cut(vectors.top_k(table(spark, d, "embeddings"), query_vectors(spark, d), 200))
    known = store(spark, d).drop("embedding")
    return found.join(known, "vec_id").join(F.broadcast(query_vectors(spark, d).select("query_id", "topic")), "query_id")


# Corpus profile


@query("""SELECT lang, source, count(*) AS n_docs, count(*) FILTER (length(trim(text)) = 0) AS n_empty, sum(length(text))::BIGINT AS n_chars
FROM documents GROUP BY GROUPING SETS ((lang), (source), ())""")
def counts_by(spark, d):
    return profile.counts_by(table(spark, d, "documents"), "lang", "source")


@query("SELECT source, count(*) FILTER (lang = 'de') AS de, count(*) FILTER (lang = 'en') AS en, count(*) FILTER (lang = 'es') AS es, count(*) FILTER (lang = 'fr') AS fr FROM documents GROUP BY source")
def language_crosstab(spark, d):
    return profile.crosstab(table(spark, d, "documents"), "source", "lang", ["de", "en", "es", "fr"])


@query(f"""WITH w AS (SELECT lang, len({WORDS_SQL}) AS n FROM documents), s AS (SELECT lang, list_sort(list(n)) AS l FROM w GROUP BY lang)
SELECT lang, len(l) AS n, l[1] AS min, l[(floor(len(l) * 0.1::DOUBLE) + 1)::BIGINT] AS p10, l[(floor(len(l) * 0.5::DOUBLE) + 1)::BIGINT] AS median, l[(floor(len(l) * 0.95::DOUBLE) + 1)::BIGINT] AS p95, l[-1] AS max FROM s""")
def length_profile(spark, d):
    docs = table(spark, d, "documents").select("lang", X.word_count(F.col("text")).alias("n_words"))
    return profile.upper_median(docs, "n_words", ("lang",))


@query("SELECT lang, source, count(*) AS n, round(100 * count(*) / (SELECT count(*) FROM documents), 6) AS percent FROM documents GROUP BY lang, source")
def histogram(spark, d):
    return profile.histogram(table(spark, d, "documents"), "lang", "source")


@query(f"""WITH k AS (SELECT array_to_string({WORDS_SQL}, ' ') AS k FROM documents), g AS (SELECT k, count(*) AS c FROM k GROUP BY k)
SELECT count(*) AS unique_texts, sum(c - 1)::BIGINT AS surplus, count(*) FILTER (c > 1) AS groups, max(c) AS largest FROM g""")
def duplicate_stats(spark, d):
    return profile.duplicate_stats(table(spark, d, "documents"), X.text_key(F.col("text")))


@query(f"WITH k AS (SELECT doc_id, array_to_string({WORDS_SQL}, ' ') AS k FROM documents) SELECT min(doc_id) AS doc_id FROM k GROUP BY k")
def dedup_keep_first(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.md5(X.text_key(F.col("text"))).alias("k"))
    return ranking.dedup_keep_first(docs, F.col("k"), ["doc_id"]).select("doc_id")


@query(r"""WITH w AS (SELECT unnest(regexp_extract_all(text, '([\p{L}\p{Nl}\p{No}]{3,})', 1)) AS w FROM documents)
SELECT CASE WHEN w = upper(w) THEN w ELSE lower(w) END AS term, count(*) AS n FROM w GROUP BY 1 ORDER BY n DESC, term LIMIT 50""")
def frequent_terms(spark, d):
    return profile.frequent_terms(table(spark, d, "documents"))


@query(r"""WITH t AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '([\p{L}\p{Nl}\p{No}]{3,})', 1)) AS term FROM benchmark),
w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '([\p{L}\p{Nl}\p{No}]+)', 1)) AS term FROM documents)
SELECT t.term, count(DISTINCT doc_id) AS docs, count(doc_id) AS occurrences FROM t LEFT JOIN w USING (term) GROUP BY t.term""")
def term_coverage(spark, d):
    words = F.regexp_extract_all(F.lower("text"), F.lit(rf"({X.LETTER}{{3,}})"), 1)
    terms = table(spark, d, "benchmark").select(F.explode(words).alias("term")).distinct()
    return profile.term_coverage(table(spark, d, "documents"), terms)


@query(f"""WITH w AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents), g AS (SELECT doc_id, len(w) AS n_words, unnest(range(1, len(w) - 4)) AS pos, w FROM w WHERE len(w) >= 12),
c AS (SELECT doc_id, n_words, array_to_string(w[pos:pos + 5], ' ') AS gram, count(*) AS n, min(pos)::INT AS first FROM g GROUP BY ALL)
SELECT doc_id, gram, n, first FROM c WHERE n >= greatest(5, ceil(greatest(1.0, n_words / 400) / 2))""")
def repeated_ngrams(spark, d):
    return profile.repeated_ngrams(table(spark, d, "documents"))


@query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS r FROM documents) WHERE r % 10 = 0")
def systematic_sample(spark, d):
    return chunking.systematic(table(spark, d, "documents").select("doc_id"), 10)


@query("SELECT doc_id, lang FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id::VARCHAR), doc_id) AS r FROM documents) WHERE r <= 20")
def stratified_sample(spark, d):
    return profile.stratified(table(spark, d, "documents").select("doc_id", "lang"), "lang", 20)


@query("""SELECT doc_id FROM (SELECT doc_id, source, sum(n_chars) OVER (PARTITION BY source ORDER BY md5(doc_id::VARCHAR), doc_id ROWS UNBOUNDED PRECEDING) AS s FROM documents) WHERE s <= 20000""")
def quota_sample(spark, d):
    return profile.until_quota(table(spark, d, "documents").select("doc_id", "source", "n_chars"), F.col("n_chars"), 20000, by="source").select("doc_id")


@query("SELECT doc_id FROM documents WHERE ('0x' || substr(md5(doc_id::VARCHAR), 29, 4))::BIGINT % 16 = 0")
def md5_sample(spark, d):
    return table(spark, d, "documents").filter(X.stable_draw(F.col("doc_id").cast("string"), 16)).select("doc_id")


# Text rules


@query(f"SELECT doc_id, len({WORDS_SQL})::INT AS n_words, md5(array_to_string({WORDS_SQL}, ' ')) AS key FROM documents")
def text_keys(spark, d):
    return table(spark, d, "documents").select("doc_id", X.word_count(F.col("text")).alias("n_words"), F.md5(X.text_key(F.col("text"))).alias("key"))


@query("""WITH r AS (SELECT doc_id, replace(replace(text, ' ', '  '), chr(10), ' ' || chr(10) || chr(10) || chr(10) || ' ') AS t FROM documents)
SELECT doc_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(t, '[ \\t]+', ' ', 'g'), ' ?\\n ?', chr(10), 'g'), '\\n{3,}', chr(10) || chr(10), 'g'))) AS digest FROM r""".replace("\\\\", "\\"))
def collapse_whitespace(spark, d):
    raw = F.replace(F.replace("text", F.lit(" "), F.lit("  ")), F.lit("\n"), F.lit(" \n\n\n "))
    return table(spark, d, "documents").select("doc_id", F.md5(X.collapse_whitespace(raw)).alias("digest"))


@query("""WITH r AS (SELECT doc_id, text || chr(10) || 'columna_1: ' || doc_id || chr(10) || 'x: 1' AS t FROM documents) SELECT doc_id, md5(text || chr(10) || 'x: 1') AS digest FROM documents""")
def anonymous_columns(spark, d):
    raw = F.concat("text", F.lit("\ncolumna_1: "), F.col("doc_id").cast("string"), F.lit("\nx: 1"))
    return table(spark, d, "documents").select("doc_id", F.md5(X.strip_anonymous_columns(raw)).alias("digest"))


@query("SELECT doc_id, md5(text || ' alpha beta gamma') AS digest FROM documents")
def control_characters(spark, d):
    """Spaces that became bells come back, as that makes more words; zero-width spaces go."""
    bell, more = F.col("doc_id") % 2 == 0, F.concat("text", F.lit(" alpha beta gamma"))
    raw = F.when(bell, F.replace(more, F.lit(" "), F.lit("\x07"))).otherwise(F.replace(more, F.lit(" "), F.lit("\u200b ")))
    return table(spark, d, "documents").select("doc_id", F.md5(X.strip_control(raw)).alias("digest"))


@query(r"SELECT doc_id, len(list_filter(regexp_split_to_array(replace(text, chr(10), chr(10) || chr(10)), '\n\s*\n'), lambda p: trim(p) <> ''))::INT AS n FROM documents")
def paragraph_counts(spark, d):
    return table(spark, d, "documents").select("doc_id", X.paragraph_count(F.replace("text", F.lit("\n"), F.lit("\n\n"))).alias("n"))


@query(f"""WITH w AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents), i AS (SELECT doc_id, w, unnest(range(0, len(w), 250)) AS i FROM w)
SELECT doc_id, (i // 250)::INT AS part, md5(array_to_string(w[i + 1:i + 250], ' ')) AS digest FROM i""")
def hard_slices(spark, d):
    return table(spark, d, "documents").select("doc_id", F.posexplode(X.hard_slices(F.col("text"))).alias("part", "t")).select("doc_id", "part", F.md5("t").alias("digest"))


@query(f"SELECT doc_id, len({WORDS_SQL})::BIGINT AS n_words FROM documents WHERE len({WORDS_SQL}) > 0")
def chunk_words(spark, d):
    """Cutting into chunks keeps every word."""
    docs = table(spark, d, "documents").withColumn("format", F.lit("txt"))
    return chunking.chunk_documents(docs, block="\n").groupBy("doc_id").agg(F.sum("num_tokens").alias("n_words"))


@query(f"SELECT doc_id, len({WORDS_SQL})::BIGINT AS n_words, true AS all_short FROM documents WHERE len({WORDS_SQL}) > 0")
def limited_fragments(spark, d):
    parts = chunking.split_to_limit(table(spark, d, "documents")).withColumn("n", X.word_count(F.col("part_text")))
    return parts.groupBy("doc_id").agg(F.sum("n").alias("n_words"), (F.max("n") <= 250).alias("all_short"))


@query(f"SELECT doc_id, len({WORDS_SQL})::BIGINT AS n_words FROM documents WHERE len({WORDS_SQL}) > 0")
def sentence_words(spark, d):
    parts = chunking.split_sentences(table(spark, d, "documents"))
    return parts.groupBy("doc_id").agg(F.sum(X.word_count(F.col("part_text"))).alias("n_words"))


@query()
def chunk_documents(spark, d):
    docs = table(spark, d, "documents").withColumn("format", F.lit("txt")).select("doc_id", "text", "format")
    return chunking.chunk_documents(docs, block="\n").select("doc_id", "chunk_id", "position", "num_tokens", "cut_level", "n_units", "text")


@query("SELECT doc_id, doc_id % 10 = 3 AS without_chunks FROM documents WHERE doc_id % 10 IN (3, 4) AND length(regexp_replace(text, '\\s', '', 'g')) > 0".replace("\\\\", "\\"))
def chunk_coverage(spark, d):
    """Documents that their chunks don't cover: none but those that lose all chunks, or a character, here."""
    docs = table(spark, d, "documents").withColumn("format", F.lit("txt"))
    chunks = chunking.chunk_documents(docs, block="\n").filter("doc_id % 10 <> 3")
    spoiled = F.when((F.col("doc_id") % 10 == 4) & (F.col("position") == 0), F.concat("text", F.lit("x"))).otherwise(F.col("text"))
    return checks.uncovered(docs, chunks.withColumn("text", spoiled))


@query()
def clean_documents(spark, d):
    from papyrix.plans.ingest import clean_documents as clean

    for_long_texts(spark)
    docs = table(spark, d, "documents").select("doc_id", "text", F.lit("txt").alias("format"))
    return clean(docs).select("doc_id", "text", F.length("text").alias("n_chars"))


@query()
def language_tags(spark, d):
    from papyrix.functions import language

    docs = table(spark, d, "documents")
    detector = language.Detector(language.gram_counts(docs.filter(F.pmod("doc_id", F.lit(5)) != 0)))
    return language.tag(docs.select("doc_id", "text"), detector).select("doc_id", "language", "confidence")


# Sources


@query(r"""SELECT page_id, trim(regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '\s+', ' ', 'g')) AS raw_title FROM pages""")
def html_titles(spark, d):
    pages = table(spark, d, "pages")
    return pages.select("page_id", F.trim(F.regexp_replace(F.regexp_extract("html", "<title>([^<]*)</title>", 1), r"\s+", " ")).alias("raw_title"))


@query()
def html_texts(spark, d):
    from pyspark.sql import types as T

    from papyrix.operators.flat import flat_map

    made = T.StructType().add("text", "string").add("title", "string")
    return flat_map(table(spark, d, "pages").select("page_id", "html"), ["html"], lambda h: [html_page.page_text(h or "")], made).drop("html")


@query("""SELECT event_id, k AS key, json_extract_string(props, '$."' || k || '"') AS value FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)""")
def json_records(spark, d):
    from pyspark.sql import types as T

    flat = F.from_json("props", T.MapType(T.StringType(), T.StringType()))
    return table(spark, d, "events").select("event_id", F.explode(flat).alias("key", "value"))


@query("""SELECT c_custkey, 'c_custkey: ' || c_custkey || chr(10) || 'c_name: ' || c_name || chr(10) || 'c_nationkey: ' || c_nationkey || chr(10) || 'c_mktsegment: ' || c_mktsegment AS block FROM customer""")
def record_blocks(spark, d):
    c = table(spark, d, "customer")
    kinds = {n: t for n, t in c.dtypes}
    return c.select("c_custkey", X.record_block(kinds, skip=("c_acctbal",)).alias("block"))


@query("""SELECT coalesce(d.doc_id, l.doc_id) AS source, CASE WHEN d.doc_id IS NOT NULL AND l.doc_id IS NOT NULL THEN 'matched' WHEN d.doc_id IS NOT NULL THEN 'missing' ELSE 'unexpected' END AS status
FROM (SELECT DISTINCT doc_id::VARCHAR AS doc_id FROM documents) d FULL JOIN (SELECT DISTINCT doc_id::VARCHAR AS doc_id FROM labels) l ON d.doc_id = l.doc_id""")
def catalog_audit(spark, d):
    from papyrix.sources.catalog import audit

    ids = lambda name: table(spark, d, name).select(F.col("doc_id").cast("string").alias("source"))
    return audit(ids("documents"), ids("labels"))


@query("""SELECT check_name AS "check", violations, violations = 0 AS passed FROM (
SELECT 'doc_id unique' AS check_name, (SELECT count(*) FROM (SELECT doc_id FROM documents GROUP BY doc_id HAVING count(*) > 1)) AS violations
UNION ALL SELECT 'labels known', (SELECT count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents))
UNION ALL SELECT 'vectors known', (SELECT count(*) FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM documents))
UNION ALL SELECT 'turns dense', (SELECT count(*) FROM (SELECT turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS r FROM conversations) WHERE turn <> r)
UNION ALL SELECT 'vectors good', (SELECT count(*) FROM embeddings WHERE len(embedding) <> 64 OR abs(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) - 1) > 1e-3))""")
def integrity_report(spark, d):
    docs, e = table(spark, d, "documents"), table(spark, d, "embeddings")
    turns = table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("position"))
    return checks.report(
        {
            "doc_id unique": checks.repeated(docs, "doc_id"),
            "labels known": checks.orphans(table(spark, d, "labels"), docs, "doc_id"),
            "vectors known": checks.orphans(e.withColumnRenamed("vec_id", "doc_id"), docs, "doc_id"),
            "turns dense": checks.bad_positions(turns),
            "vectors good": vectors_bad(e),
        }
    )


def vectors_bad(e: DataFrame) -> DataFrame:
    return vectors.bad_vectors(e, 64)


# Retrieval


@query(f"""WITH {HITS_SQL} SELECT query_id, vec_id, round(score, 6) AS score, rank::INT AS rank FROM hits WHERE rank <= 10""")
def vector_top10(spark, d):
    found = vectors.top_k(table(spark, d, "embeddings"), query_vectors(spark, d), 10)
    return found.select("query_id", "vec_id", F.round("score", 6).alias("score"), "rank")


@query(f"""WITH v AS (SELECT * FROM embeddings WHERE vec_id % 100 <> 0), q AS (SELECT vec_id::VARCHAR AS query_id, embedding FROM embeddings WHERE vec_id % 50 = 0),
s AS (SELECT query_id, vec_id, {DOT_SQL} AS score FROM v, q QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) = 1)
SELECT query_id, vec_id, round(score, 6) AS score FROM s WHERE query_id <> vec_id::VARCHAR AND score < 0.9999""")
def vector_self_search(spark, d):
    """Vectors that aren't found first by themselves: every second query's own vector is taken out."""
    e = table(spark, d, "embeddings")
    asked = e.filter("vec_id % 50 = 0").select(F.col("vec_id").cast("string").alias("query_id"), "embedding")
    return checks.not_first_of_itself(vectors.top_k(e.filter("vec_id % 100 <> 0"), asked, 1)).withColumn("score", F.round("score", 6))


@query(f"""WITH {HITS_SQL}, f AS (SELECT query_id, printf('F%d-%s', h.label % 3 + 1, d.source) AS doc_id, min(rank) AS first FROM hits h JOIN documents d ON d.doc_id = h.vec_id GROUP BY ALL),
n AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY first) AS r FROM f), t AS (SELECT query_id, max(first) AS need FROM n WHERE r <= 3 GROUP BY query_id)
SELECT query_id, CASE WHEN need <= 2 THEN 2 WHEN need <= 20 THEN 20 WHEN need <= 200 THEN 200 ELSE (SELECT count(*) FROM embeddings) END::INT AS k FROM t""")
def adaptive_k(spark, d):
    """The width at which each query's hits name three documents: only those queries go on that need a wider search."""
    return retrieve.widths(store(spark, d), query_vectors(spark, d), k=2).select("query_id", F.col("k").cast("int").alias("k"))


BOOSTED_SQL = """boosted AS (SELECT *, CASE WHEN starts_with(doc_id, 'F' || topic || '-') THEN score * 1.03::DOUBLE ELSE score END AS s1 FROM cand),
final AS (SELECT *, CASE WHEN language NOT IN ('es', 'en') THEN s1 * 0.97::DOUBLE ELSE s1 END AS s2 FROM boosted)"""


def boosted(spark: SparkSession, d: str, found: DataFrame | None = None) -> DataFrame:
    return ranking.language_factor(ranking.topic_boost(hits(spark, d) if found is None else found))


@query(f"""WITH {HITS_SQL}, {BOOSTED_SQL} SELECT query_id, chunk_id, round(s2, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY s2 DESC, chunk_id)::INT AS rank FROM final QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY s2 DESC, chunk_id) <= 20""")
def boosted_rank(spark, d):
    found = ranking.ranked(boosted(spark, d).drop("rank"))
    return found.filter("rank <= 20").select("query_id", "chunk_id", F.round("score", 6).alias("score"), "rank")


def _pool_sql(how: str) -> str:
    return f"""WITH {HITS_SQL}, {BOOSTED_SQL}, p AS (SELECT query_id, doc_id, {how}(s2) AS s FROM final GROUP BY query_id, doc_id)
SELECT query_id, doc_id, round(s, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, doc_id)::INT AS rank FROM p QUALIFY rank <= 3"""


@query(_pool_sql("max"))
def documents_max(spark, d):
    return ranking.top_documents(boosted(spark, d)).withColumn("score", F.round("score", 6))


@query(_pool_sql("sum"))
def documents_sum(spark, d):
    return ranking.top_documents(boosted(spark, d), strategy="sum").withColumn("score", F.round("score", 6))


@query(_pool_sql("avg"))
def documents_mean(spark, d):
    return ranking.top_documents(boosted(spark, d), strategy="mean").withColumn("score", F.round("score", 6))


@query()
def fragments(spark, d):
    return ranking.select_fragments(boosted(spark, d)).withColumn("score", F.round("score", 6))


#: A graph of the store: sources and languages, with the chunks that speak for each; a query asks for its own source.
STORE_GRAPH_SQL = """f AS (SELECT 'SRC:' || d.source AS src, 'LNG:' || d.lang AS dst, d.doc_id AS ord, printf('c%06d', d.doc_id) AS chunk_id FROM documents d JOIN embeddings ON vec_id = d.doc_id WHERE d.source IS NOT NULL AND d.lang IS NOT NULL),
s AS (SELECT src AS node, chunk_id, ord FROM f UNION ALL SELECT dst, chunk_id, ord FROM f), nc AS (SELECT node, chunk_id FROM s QUALIFY row_number() OVER (PARTITION BY node ORDER BY ord) <= 10),
ec AS (SELECT src, dst, chunk_id FROM f QUALIFY row_number() OVER (PARTITION BY src, dst ORDER BY ord) <= 10), e AS (SELECT DISTINCT src, dst FROM f),
g AS (SELECT node, 1 / log2(2 + count(*)) AS w FROM (SELECT src AS node FROM e UNION ALL SELECT dst FROM e) GROUP BY node),
seeds AS (SELECT printf('q%03d', doc_id + 1) AS query_id, 'SRC:' || source AS node FROM documents JOIN embeddings ON vec_id = doc_id WHERE doc_id % 50 = 0),
p AS (SELECT query_id, chunk_id, w AS part FROM seeds JOIN g USING (node) JOIN nc USING (node)
    UNION ALL SELECT query_id, chunk_id, w FROM seeds JOIN g USING (node) JOIN ec ON ec.src = seeds.node
    UNION ALL SELECT query_id, nc.chunk_id, g.w * 0.4::DOUBLE * o.w FROM seeds JOIN g USING (node) JOIN e ON e.src = seeds.node JOIN g o ON o.node = e.dst JOIN nc ON nc.node = e.dst),
ev AS (SELECT query_id, chunk_id, least(1, weight) AS weight FROM (SELECT query_id, chunk_id, round(sum(part), 12) AS weight FROM p GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY weight DESC, chunk_id) <= 60)"""


def store_evidence(spark: SparkSession, known: DataFrame) -> DataFrame:
    """known: (vec_id, chunk_id, doc_id, source, language). Evidence of each query for chunks, from the graph of the store."""
    f = cut(
        known.filter("source is not null and language is not null").select(
            F.col("source").alias("subject"), F.lit("SRC").alias("subject_type"), F.lit("en").alias("relation"), F.col("language").alias("object"), F.lit("LNG").alias("object_type"),
            F.lit("").alias("evidence"), F.lit(False).alias("passive"), "doc_id", "chunk_id", F.col("vec_id").alias("ordinal"), F.concat(F.lit("SRC:"), "source").alias("src"), F.concat(F.lit("LNG:"), "language").alias("dst"),
        )
    )
    seeds = known.filter("vec_id % 50 = 0").select(F.format_string("q%03d", F.col("vec_id") + 1).alias("query_id"), F.concat(F.lit("SRC:"), "source").alias("node"))
    return graph.evidence(seeds, cut(graph.nodes(f, ["ordinal"])), cut(graph.edges(f, ["ordinal"])))


def with_sources(spark: SparkSession, d: str) -> DataFrame:
    return store(spark, d).withColumn("source", F.regexp_extract("doc_id", "^F[0-9]-(.*)$", 1))


@query(f"""WITH {HITS_SQL}, {STORE_GRAPH_SQL}, r AS (SELECT query_id, vec_id FROM hits WHERE rank <= 200 UNION SELECT query_id, substr(chunk_id, 2)::BIGINT FROM ev),
x AS (SELECT r.query_id, q.label % 3 + 1 AS topic, printf('F%d-%s', v.label % 3 + 1, d.source) AS doc_id, d.lang AS language, {DOT_SQL} * (1 + 0.03::DOUBLE * coalesce(weight, 0)) AS score
    FROM r JOIN q USING (query_id) JOIN embeddings v USING (vec_id) JOIN documents d ON d.doc_id = vec_id LEFT JOIN ev ON ev.query_id = r.query_id AND ev.chunk_id = printf('c%06d', vec_id)),
y AS (SELECT query_id, doc_id, score * CASE WHEN starts_with(doc_id, 'F' || topic || '-') THEN 1.03::DOUBLE ELSE 1 END * CASE WHEN language NOT IN ('es', 'en') THEN 0.97::DOUBLE ELSE 1 END AS s FROM x)
SELECT query_id, doc_id, round(max(s), 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY max(s) DESC, doc_id)::INT AS rank FROM y GROUP BY query_id, doc_id QUALIFY rank <= 3""")
def fused_documents(spark, d):
    """Vector search, evidence of a graph, topic and language factors, then documents: the whole ranking."""
    known = cut(with_sources(spark, d).drop("text"))
    asked = query_vectors(spark, d)
    found = ranking.fuse_graph(
        retrieve.candidates(known, asked).select("query_id", "chunk_id", "doc_id", "score", "language"), store_evidence(spark, known), known.select("chunk_id", "doc_id", "language", "embedding"),
        asked.select("query_id", F.col("embedding").alias("query_vector")), vectors.dot(F.col("embedding"), F.col("query_vector")),
    )
    found = ranking.topic_boost(found.join(F.broadcast(asked.select("query_id", "topic")), "query_id"))
    return ranking.top_documents(ranking.language_factor(found)).withColumn("score", F.round("score", 6))


@query()
def retrieve_full(spark, d):
    """From query vectors and texts to results, with the evidence of the store's graph."""
    known = cut(with_sources(spark, d).drop("text"))
    texts = table(spark, d, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    own = texts.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("own"), "text")
    asked = cut(query_vectors(spark, d).join(own, "own"))
    stored = texts.join(if_small(known.select("vec_id"), MAX_IDS), "vec_id", "left_semi")
    out = retrieve.retrieve(known, asked, store_evidence(spark, known), texts=stored)
    return out.select("query_id", F.to_json("documents").alias("documents"), F.to_json("fragments").alias("fragments"))


@query(f"""WITH {HITS_SQL}, p AS (SELECT unnest([1.0, 0.99, 0.97, 0.95]::DOUBLE[]) AS factor),
s AS (SELECT query_id, factor, chunk_id, doc_id, language, CASE WHEN language NOT IN ('es', 'en') THEN score * factor ELSE score END AS score FROM cand, p),
r AS (SELECT *, row_number() OVER (PARTITION BY factor, query_id ORDER BY score DESC, chunk_id) AS rank FROM s)
SELECT factor, count(*) FILTER (language NOT IN ('es', 'en')) AS others, count(DISTINCT doc_id) AS docs FROM r WHERE rank <= 10 GROUP BY factor""")
def factor_sweep(spark, d):
    each = evaluation.sweep(hits(spark, d).drop("rank"), (1.0, 0.99, 0.97, 0.95), "factor")
    found = ranking.ranked(ranking.language_factor(each, F.col("factor")), ("factor", "query_id")).filter("rank <= 10")
    return found.groupBy("factor").agg(F.count_if(~F.col("language").isin("es", "en")).alias("others"), F.countDistinct("doc_id").alias("docs"))


@query(f"""WITH {HITS_SQL}, {BOOSTED_SQL}, a AS (SELECT query_id, doc_id, max(score) AS s FROM cand GROUP BY ALL), b AS (SELECT query_id, doc_id, max(s2) AS s FROM final GROUP BY ALL),
ra AS (SELECT query_id, doc_id FROM a QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY s DESC, doc_id) <= 3), rb AS (SELECT query_id, doc_id FROM b QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY s DESC, doc_id) <= 3)
SELECT query_id, count(*) FILTER (ra.doc_id IS NULL)::INT AS doc_changes, count(*) FILTER (rb.doc_id IS NULL)::INT AS docs_lost FROM ra FULL JOIN rb USING (query_id, doc_id) GROUP BY query_id""")
def run_difference(spark, d):
    as_result = lambda c: ranking.results(ranking.top_documents(c), ranking.ranked(c.drop("rank")).filter("rank <= 10"))
    found = hits(spark, d)
    return evaluation.run_difference(as_result(found), as_result(boosted(spark, d, found))).select("query_id", "doc_changes", "docs_lost")


QRELS_SQL = """qrels AS (SELECT printf('q%03d', q.vec_id + 1) AS query_id, v.vec_id::VARCHAR AS doc_id, CASE WHEN v.label = q.label THEN 2 ELSE 1 END AS grade
    FROM embeddings q, embeddings v WHERE q.vec_id % 50 = 0 AND abs(v.label - q.label) <= 1)"""


def qrels(spark: SparkSession, d: str) -> evaluation.ByClass:
    """Vectors of a query's label have grade 2, those of a neighbouring label 1."""
    e = table(spark, d, "embeddings").select("vec_id", "label")
    asked = e.filter("vec_id % 50 = 0").select(F.format_string("q%03d", F.col("vec_id") + 1).alias("query_id"), F.explode(F.sequence(F.col("label") - 1, F.col("label") + 1)).alias("label"), F.col("label").alias("own"))
    grade = F.when(F.col("label") == F.col("own"), 2).otherwise(1).alias("grade")
    return evaluation.ByClass(e.select(F.col("vec_id").cast("string").alias("doc_id"), F.col("label").alias("class")), asked.select("query_id", F.col("label").alias("class"), grade))


def vector_run(spark: SparkSession, d: str) -> DataFrame:
    found = vectors.top_k(table(spark, d, "embeddings"), query_vectors(spark, d), 10)
    return cut(found.select("query_id", F.col("vec_id").cast("string").alias("doc_id"), "rank"))


@query(f"""WITH {HITS_SQL}, {QRELS_SQL}, g AS (SELECT h.query_id, sum(coalesce(r.grade, 0) / log2(h.rank + 1)) AS dcg FROM hits h LEFT JOIN qrels r ON r.query_id = h.query_id AND r.doc_id = h.vec_id::VARCHAR WHERE h.rank <= 10 GROUP BY h.query_id),
i AS (SELECT query_id, grade, row_number() OVER (PARTITION BY query_id ORDER BY grade DESC, doc_id) AS r FROM qrels), b AS (SELECT query_id, sum(grade / log2(r + 1)) AS ideal FROM i WHERE r <= 10 GROUP BY query_id)
SELECT g.query_id, round(CASE WHEN ideal > 0 THEN dcg / ideal ELSE 0 END, 6) AS ndcg FROM g LEFT JOIN b USING (query_id)""")
def ndcg_at_10(spark, d):
    return evaluation.ndcg(vector_run(spark, d), qrels(spark, d)).withColumn("ndcg", F.round("ndcg", 6))


@query(f"""WITH {HITS_SQL}, {QRELS_SQL}, h AS (SELECT query_id, count(r.grade) AS hits FROM (SELECT h.query_id, r.grade FROM hits h LEFT JOIN qrels r ON r.query_id = h.query_id AND r.doc_id = h.vec_id::VARCHAR AND r.grade >= 2 WHERE h.rank <= 3) r GROUP BY query_id),
w AS (SELECT query_id, count(*) AS wanted FROM qrels WHERE grade >= 2 GROUP BY query_id), m AS (SELECT query_id, hits / 3 AS p, coalesce(hits / least(wanted, 3), 0) AS r FROM h LEFT JOIN w USING (query_id))
SELECT query_id, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1 FROM m""")
def f1_at_3(spark, d):
    out = evaluation.precision_recall_f1(vector_run(spark, d), qrels(spark, d), 3, 2)
    return out.select("query_id", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query(f"""WITH {HITS_SQL}, c AS (SELECT lang AS language, count(*) / sum(count(*)) OVER () AS corpus_share FROM documents GROUP BY lang),
r AS (SELECT language, count(*) / sum(count(*)) OVER () AS retrieved_share FROM cand WHERE rank <= 10 GROUP BY language)
SELECT language, round(coalesce(corpus_share, 0), 6) AS corpus_share, round(coalesce(retrieved_share, 0), 6) AS retrieved_share, coalesce(retrieved_share, 0) > 0.85 AS dominant FROM c FULL JOIN r USING (language)""")
def language_share(spark, d):
    corpus = table(spark, d, "documents").select(F.col("lang").alias("language"))
    return evaluation.language_share(hits(spark, d).filter("rank <= 10"), corpus)


# Graph: orders as facts "customer places order with part"; chunks are orders

FACTS_SQL = """facts AS (SELECT 'LOC:' || n_name AS src, CASE WHEN l_returnflag = 'R' THEN 'devuelve' ELSE 'compra' END AS relation, 'TEC:' || p_brand AS dst, 'F' || (l_orderkey % 3 + 1) || '-' || (l_orderkey % 100) AS doc_id,
    'o' || l_orderkey AS chunk_id, l_orderkey AS ord, l_linenumber AS nth FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN part ON p_partkey = l_partkey),
edges AS (SELECT src, relation, dst, count(*) AS weight FROM facts GROUP BY ALL)"""


def facts(spark: SparkSession, d: str) -> DataFrame:
    t = lambda name: table(spark, d, name)
    rows = t("lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag").join(t("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    rows = rows.join(t("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey")), "o_custkey").join(t("nation").select("n_nationkey", "n_name"), "n_nationkey").join(t("part").select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
    return rows.select(
        F.col("n_name").alias("subject"), F.lit("LOC").alias("subject_type"), F.when(F.col("l_returnflag") == "R", "devuelve").otherwise("compra").alias("relation"), F.col("p_brand").alias("object"), F.lit("TEC").alias("object_type"),
        F.lit("").alias("evidence"), F.lit(False).alias("passive"), F.concat(F.lit("F"), F.col("l_orderkey") % 3 + 1, F.lit("-"), F.col("l_orderkey") % 100).alias("doc_id"), F.concat(F.lit("o"), "l_orderkey").alias("chunk_id"),
        F.struct("l_orderkey", "l_linenumber").alias("ordinal"), F.concat(F.lit("LOC:"), "n_name").alias("src"), F.concat(F.lit("TEC:"), "p_brand").alias("dst"),
    )


@query(f"""WITH {FACTS_SQL}, o AS (SELECT src, relation, dst, chunk_id, min((ord, nth)) AS pos FROM facts GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY src, relation, dst ORDER BY pos) AS n FROM o),
c AS (SELECT src, relation, dst, string_agg(chunk_id, ' ' ORDER BY n) AS chunk_ids FROM r WHERE n <= 10 GROUP BY ALL), f AS (SELECT src, relation, dst, count(*) AS weight, arg_min(doc_id, (ord, nth)) AS doc_id, arg_min(chunk_id, (ord, nth)) AS chunk_id FROM facts GROUP BY ALL)
SELECT * FROM f JOIN c USING (src, relation, dst)""")
def graph_edges(spark, d):
    return graph.edges(cut(facts(spark, d)), ["ordinal"]).select("src", "relation", "dst", "weight", "doc_id", "chunk_id", F.array_join("chunk_ids", " ").alias("chunk_ids"))


@query(f"""WITH {FACTS_SQL}, s AS (SELECT src AS node, doc_id, chunk_id, ord, nth FROM facts UNION ALL SELECT dst, doc_id, chunk_id, ord, nth FROM facts),
o AS (SELECT node, chunk_id, min((ord, nth)) AS pos FROM s GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY node ORDER BY pos) AS n FROM o), c AS (SELECT node, string_agg(chunk_id, ' ' ORDER BY n) AS chunk_ids FROM r WHERE n <= 10 GROUP BY node),
t AS (SELECT node, string_agg(DISTINCT substr(doc_id, 2, 1), '' ORDER BY substr(doc_id, 2, 1)) AS topics FROM s GROUP BY node)
SELECT node, substr(node, 5) AS name, substr(node, 1, 3) AS type, topics, chunk_ids FROM t JOIN c USING (node)""")
def graph_nodes(spark, d):
    return graph.nodes(cut(facts(spark, d)), ["ordinal"]).select("node", "name", "type", "topics", F.array_join("chunk_ids", " ").alias("chunk_ids"))


@query(f"WITH {FACTS_SQL}, e AS (SELECT src AS node FROM edges UNION ALL SELECT dst FROM edges) SELECT node, count(*) AS degree, round(1 / log2(2 + count(*)), 6) AS weight FROM e GROUP BY node")
def graph_degrees(spark, d):
    e = facts(spark, d).groupBy("src", "relation", "dst").agg(F.count("*").alias("weight"))
    return graph.degrees(e).withColumn("weight", F.round(graph.entity_weight(F.col("degree")), 6))


@query(f"WITH {FACTS_SQL}, k AS (SELECT * FROM edges WHERE weight >= 8) SELECT DISTINCT node FROM (SELECT src AS node FROM k UNION ALL SELECT dst FROM k)")
def graph_nucleus(spark, d):
    f = facts(spark, d)
    e = f.groupBy("src", "relation", "dst").agg(F.count("*").alias("weight"))
    n = f.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    return graph.nucleus(n, e, 8)[0]


@query("""WITH RECURSIVE e AS (SELECT 'r' || n_regionkey AS a, 'n' || n_nationkey AS b FROM nation UNION ALL SELECT 'n' || s_nationkey, 's' || s_suppkey FROM supplier), l AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT a AS v, a AS u FROM l UNION SELECT r.v, l.b FROM r JOIN l ON r.u = l.a) SELECT v AS node, min(u) AS component FROM r GROUP BY v""")
def graph_components(spark, d):
    n = table(spark, d, "nation").select(F.concat(F.lit("r"), "n_regionkey").alias("src"), F.concat(F.lit("n"), "n_nationkey").alias("dst"))
    s = table(spark, d, "supplier").select(F.concat(F.lit("n"), "s_nationkey").alias("src"), F.concat(F.lit("s"), "s_suppkey").alias("dst"))
    return graph.components(n.unionByName(s))


@query(f"""WITH {FACTS_SQL}, c0 AS (SELECT src, relation, dst, chunk_id, min((ord, nth)) AS pos FROM facts GROUP BY ALL), c AS (SELECT *, row_number() OVER (PARTITION BY src, relation, dst ORDER BY pos) AS n FROM c0), ec AS (SELECT src, relation, dst, chunk_id FROM c WHERE n <= 10),
s AS (SELECT src AS node, chunk_id, (ord, nth) AS pos FROM facts UNION ALL SELECT dst, chunk_id, (ord, nth) FROM facts), m0 AS (SELECT node, chunk_id, min(pos) AS pos FROM s GROUP BY node, chunk_id), m AS (SELECT *, row_number() OVER (PARTITION BY node ORDER BY pos) AS n FROM m0), nc AS (SELECT node, chunk_id FROM m WHERE n <= 10),
g AS (SELECT node, 1 / log2(2 + count(*)) AS w FROM (SELECT src AS node FROM edges UNION ALL SELECT dst FROM edges) GROUP BY node), seeds AS (SELECT node AS query_id, node FROM g WHERE node LIKE 'LOC:%'),
p AS (SELECT query_id, chunk_id, w AS part FROM seeds JOIN g USING (node) JOIN nc USING (node)
    UNION ALL SELECT query_id, chunk_id, w FROM seeds JOIN g USING (node) JOIN ec ON ec.src = seeds.node
    UNION ALL SELECT query_id, nc.chunk_id, g.w * 0.4::DOUBLE * o.w FROM seeds JOIN g USING (node) JOIN (SELECT DISTINCT src, dst FROM edges) e ON e.src = seeds.node JOIN g o ON o.node = e.dst JOIN nc ON nc.node = e.dst),
t AS (SELECT query_id, chunk_id, round(sum(part), 6) AS weight FROM p GROUP BY ALL)
SELECT query_id, count(*) AS chunks, round(max(least(1, weight)), 5) AS top FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY weight DESC, chunk_id) AS n FROM t) WHERE n <= 60 GROUP BY query_id""")
def graph_evidence(spark, d):
    f = cut(facts(spark, d))
    n, e = cut(graph.nodes(f, ["ordinal"])), cut(graph.edges(f, ["ordinal"]))
    seeds = n.filter("type = 'LOC'").select(F.col("node").alias("query_id"), "node")
    found = graph.evidence(seeds, n, e)
    return found.groupBy("query_id").agg(F.count("*").alias("chunks"), F.round(F.max("weight"), 5).alias("top"))


@query("""WITH w AS (SELECT DISTINCT lower(w) AS key FROM (SELECT unnest(regexp_extract_all(text, '[A-Za-z]{4,}')) AS w FROM benchmark)), k AS (SELECT key, 'T:' || key AS node FROM w),
d AS (SELECT DISTINCT doc_id::VARCHAR AS query_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS key FROM documents WHERE regexp_matches(text, '^[A-Za-z ,.\\x0a]*$')) SELECT query_id, node FROM d JOIN k USING (key)""".replace("\\\\", "\\"))
def benchmark_links(spark, d):
    """Words of the benchmark found literally in whole documents (those of letters, stops and commas only)."""
    words = F.regexp_extract_all("text", F.lit("([A-Za-z]{4,})"), 1)
    keys = table(spark, d, "benchmark").select(F.explode(words).alias("w")).select(F.lower("w").alias("key")).distinct().withColumn("node", F.concat(F.lit("T:"), "key"))
    plain = table(spark, d, "documents").filter(F.col("text").rlike(r"^[A-Za-z ,.\n]*$"))
    asked = plain.select(F.col("doc_id").cast("string").alias("query_id"), F.regexp_replace("text", "[,.]", " ").alias("text"))
    return graph.literal_links(asked, keys, longest=1)


@query("SELECT 'o' || n_nationkey AS query_id, 'LOC:' || lower(n_name) AS node FROM nation WHERE length(n_name) >= 4")
def literal_links(spark, d):
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    asked = n.select(F.concat(F.lit("o"), "n_nationkey").alias("query_id"), F.concat(F.lit("what does "), F.lower("n_name"), F.lit(" buy")).alias("text"))
    keys = n.select(F.lower("n_name").alias("key"), F.concat(F.lit("LOC:"), F.lower("n_name")).alias("node"))
    return graph.literal_links(asked, keys)


@query(f"""WITH {FACTS_SQL} SELECT 'relation' AS what, relation AS name, count(*) AS n FROM edges GROUP BY relation
UNION ALL SELECT 'type', substr(node, 1, 3), count(*) FROM (SELECT DISTINCT src AS node FROM edges UNION SELECT dst FROM edges) GROUP BY 2
UNION ALL (SELECT 'hub', node, count(*) AS n FROM (SELECT src AS node FROM edges UNION ALL SELECT dst FROM edges) GROUP BY node ORDER BY n DESC, node LIMIT 10)""")
def graph_summary(spark, d):
    f = cut(facts(spark, d))
    e = f.groupBy("src", "relation", "dst").agg(F.count("*").alias("weight"))
    n = f.select(F.explode(F.array("src", "dst")).alias("node")).distinct().withColumn("type", F.substring("node", 1, 3))
    return graph.summary(n, e)


#: Sentence forms by number: what is said of a nation, and what follows from it.
SAID = (
    "{n} develops anti-satellite weapons.",
    "Drones were developed by {n}.",
    "{n} no desarrolla ASAT.",
    "{n} y Rusia controlan drones.",
    "{n} signed. The NPT is old.",
    "{n} has the control of drones.",
    "The NPT was signed by {n} and China.",
)


@query("""WITH n AS (SELECT n_nationkey, n_nationkey % 7 AS form, 'ORG:' || lower(n_name) AS node FROM nation), r AS (
SELECT n_nationkey, node AS src, 'desarrolla' AS relation, 'ORG:arma antisatelite' AS dst, false AS passive FROM n WHERE form = 0
UNION ALL SELECT n_nationkey, node, 'desarrolla', 'ORG:vehiculo aereo no tripulado', true FROM n WHERE form = 1
UNION ALL SELECT n_nationkey, x, 'controla', 'ORG:vehiculo aereo no tripulado', false FROM n, unnest([node, 'ORG:rusia']) u(x) WHERE form = 3
UNION ALL SELECT n_nationkey, x, 'firma', 'ORG:tnp', true FROM n, unnest([node, 'ORG:china']) u(x) WHERE form = 6)
SELECT DISTINCT n_nationkey::VARCHAR AS doc_id,
    CASE src WHEN 'ORG:united states' THEN 'ORG:estados unidos' WHEN 'ORG:united kingdom' THEN 'ORG:reino unido' WHEN 'ORG:brazil' THEN 'ORG:brasil' WHEN 'ORG:germany' THEN 'ORG:alemania' WHEN 'ORG:france' THEN 'ORG:francia'
        WHEN 'ORG:japan' THEN 'ORG:japon' WHEN 'ORG:russia' THEN 'ORG:rusia' ELSE src END AS src, relation, dst, passive FROM r""")
def relations_extract(spark, d):
    """Entities and relations in a sentence about each nation: active, passive, denied, coordinated, over a sentence's end,
    behind a determiner."""
    from papyrix.functions.names import ALIASES

    n = table(spark, d, "nation").select("n_nationkey", F.initcap("n_name").alias("name"))
    forms = F.array(*[F.lit(form) for form in SAID])
    text = F.replace(F.element_at(forms, (F.col("n_nationkey") % len(SAID) + 1).cast("int")), F.lit("{n}"), F.col("name"))
    units = n.select(F.col("n_nationkey").cast("string").alias("doc_id"), F.concat(F.lit("n#"), "n_nationkey").alias("chunk_id"), F.lit(1).alias("position"), text.alias("text"))
    known = {form for name, forms in ALIASES.items() for form in (name, *forms)}
    names = [r["name"] for r in n.select("name").collect()]
    aliases = {**ALIASES, **{name: [] for name in names if name not in known}}
    return graph.with_keys(graph.extract_triples(units, aliases)).select("doc_id", "src", "relation", "dst", "passive").distinct()


def _zoneless(df: DataFrame) -> DataFrame:
    """As the events' own times are."""
    return df.withColumn("start", F.col("start").cast("timestamp_ntz")).withColumn("end", F.col("end").cast("timestamp_ntz"))


# Streams, run to their end as batches of the same plans


@query("""SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS "end", event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY ALL""")
def event_windows(spark, d):
    from papyrix.streaming.text_stream import windowed

    return _zoneless(windowed(table(spark, d, "events")))


@query("""WITH s AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
n AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM s) SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS n FROM n GROUP BY user_id, k""")
def event_sessions(spark, d):
    from papyrix.streaming.text_stream import sessions

    return _zoneless(sessions(table(spark, d, "events")))
