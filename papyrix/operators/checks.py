"""Integrity checks. Each gives the rows that violate it; an empty result passes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from papyrix.functions import text as X
from papyrix.functions.names import name_key_column
from papyrix.functions.pytext import is_nfc

MANDATORY = ("doc_id", "chunk_id", "source", "format", "phenomenon", "position", "num_tokens", "text")
BARE = rf"{X.WS}+"


def squeezed(text: Column) -> Column:
    """Without any white space."""
    return F.regexp_replace(text, BARE, "")


def report(checks: Mapping[str, DataFrame]) -> DataFrame:
    """(check, violations, passed) of all checks, in one plan."""
    out = None
    for name, rows in checks.items():
        row = rows.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations", (F.col("violations") == 0).alias("passed"))
        out = row if out is None else out.unionByName(row)
    if out is None:
        raise ValueError("no checks")
    return out


# Cleaning. both: (doc_id, before, after)


def collapsed_paragraphs(both: DataFrame, many: int = 10) -> DataFrame:
    n = both.select("doc_id", X.paragraph_count(F.col("before")).alias("paragraphs_before"), X.paragraph_count(F.col("after")).alias("paragraphs_after"))
    return n.filter((F.col("paragraphs_before") >= many) & (F.col("paragraphs_after") <= 1))


def emptied(both: DataFrame) -> DataFrame:
    has = lambda c: F.length(squeezed(F.coalesce(c, F.lit("")))) > 0
    return both.filter(has("before") & ~has("after")).select("doc_id")


def worst_reductions(both: DataFrame, least: int = 2000, n: int = 15) -> DataFrame:
    rows = both.filter(F.length("before") > least).withColumn("share", F.round(1 - F.length("after") / F.length("before"), 6))
    return rows.orderBy(F.desc("share"), "doc_id").limit(n).select("doc_id", "share")


def control_left(docs: DataFrame, text: str = "text") -> DataFrame:
    return docs.filter(F.col(text).rlike(f"{X.CONTROL}|{X.INVISIBLE}")).select("doc_id")


def not_nfc(docs: DataFrame, text: str = "text") -> DataFrame:
    return docs.filter(~is_nfc(text)).select("doc_id")


# Chunks


def split_sentences(chunks: DataFrame) -> DataFrame:
    """A cut of level 1 or 2 in prose behind which the text goes on in lower case, with no sentence end before it."""
    order = W.partitionBy("doc_id").orderBy("position")
    rows = chunks.filter(~F.col("format").isin(*X.TABULAR)).withColumn("next", F.lead("text").over(order)).withColumn("next_level", F.lead("cut_level").over(order))
    open_end = ~F.col("text").rlike(r"""[.!?…。！？؟।][")\]»”’'›〉】]*$""")
    return rows.filter((F.col("cut_level") <= 2) & (F.col("next_level") <= 2) & open_end & F.col("next").rlike(r"^\p{Ll}")).select("doc_id", "position")


def uncovered(docs: DataFrame, chunks: DataFrame) -> DataFrame:
    """Documents whose chunks, put together without white space, aren't the document without white space."""
    parts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "text"))), lambda c: c["text"]), "")
    made = chunks.groupBy("doc_id").agg(F.md5(squeezed(parts)).alias("made"))
    want = docs.select("doc_id", squeezed(F.coalesce("text", F.lit(""))).alias("s")).filter("s <> ''").select("doc_id", F.md5("s").alias("want"))
    return want.join(made, "doc_id", "left").filter(~F.col("want").eqNullSafe(F.col("made"))).select("doc_id", F.col("made").isNull().alias("without_chunks"))


def missing_fields(rows: DataFrame, fields: tuple[str, ...] = MANDATORY) -> DataFrame:
    empty = lambda c: F.when(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == ""), F.lit(c))
    return rows.withColumn("missing", F.array_compact(F.array(*[empty(c) for c in fields]))).filter(F.size("missing") > 0).select("chunk_id", "missing")


def bad_positions(chunks: DataFrame) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("doc_id").orderBy("position")) - 1
    return chunks.withColumn("want", rank).filter("position <> want").select("doc_id", "position", "want")


def repeated(rows: DataFrame, *key: str) -> DataFrame:
    return rows.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def over_budget(chunks: DataFrame, budget: int) -> DataFrame:
    return chunks.filter(F.col("num_tokens") > budget).select("doc_id", "position", "num_tokens")


def long_fragments(rows: DataFrame, limit: int = 250, text: str = "text") -> DataFrame:
    return rows.withColumn("n_words", X.word_count(F.col(text))).filter(F.col("n_words") > limit)


def different(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that only one has, with their multiplicity: empty for two runs of a deterministic stage."""
    both = a.withColumn("_n", F.lit(1)).union(b.withColumn("_n", F.lit(-1)))
    left = both.groupBy(*a.columns).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
    each = left.withColumn("only_in", F.when(F.col("_n") > 0, "first").otherwise("second"))
    return each.withColumn("_n", F.explode(F.array_repeat(F.lit(0), F.abs("_n").cast("int")))).drop("_n")


def orphans(rows: DataFrame, known: DataFrame, *key: str) -> DataFrame:
    """Rows whose key isn't known."""
    return rows.join(known.select(*key), list(key), "left_anti")


def misaligned(records: DataFrame, chunks: DataFrame) -> DataFrame:
    """Records and chunks that don't have the same id and text, joined by id. Texts are compared by digest and aren't shuffled."""
    digest = lambda text: F.unhex(F.sha2(text, 256))
    a = records.select("chunk_id", digest("texto").alias("recorded"))
    b = chunks.select("chunk_id", digest("text").alias("chunk"))
    return a.join(b, "chunk_id", "full").filter(~F.col("recorded").eqNullSafe(F.col("chunk"))).select("chunk_id")


def bad_records(records: DataFrame) -> DataFrame:
    wrong = (F.col("posicion") < 0) | (F.col("num_tokens") <= 0)
    fields = ("doc_id", "chunk_id", "fuente", "formato", "fenomeno", "posicion", "num_tokens", "texto")
    empty = [F.col(c).isNull() for c in fields]
    for e in empty:
        wrong = F.coalesce(wrong, F.lit(False)) | e
    return records.filter(wrong).select("chunk_id")


def count_mismatch(**tables: DataFrame) -> DataFrame:
    """A row with all counts if they aren't all equal."""
    out = None
    for name, df in tables.items():
        row = df.agg(F.count("*").alias("n")).withColumn("table", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("table", "n")))).alias("counts"), F.min("n").alias("lo"), F.max("n").alias("hi")).filter("lo <> hi").select("counts")


def not_first_of_itself(found: DataFrame, key: str = "vec_id", tolerance: float = 1e-4) -> DataFrame:
    """found: (query_id = own key, key, score, rank) of vectors searched by themselves. A tie within tolerance passes."""
    own = F.col("query_id").cast("string") == F.col(key).cast("string")
    return found.filter(F.col("rank") == 1).filter(~own & (F.col("score") < 1 - tolerance)).select("query_id", key, "score")


# Results (schemas.RESULT)


def bad_results(results: DataFrame, n_documents: int = 3, n_fragments: int = 10, limit: int = 250) -> DataFrame:
    """(query_id, problem): sizes, empty fields, ranks that aren't 1..n, fragments that are too long, repeated queries."""
    has = lambda condition, name: F.when(F.coalesce(condition, F.lit(True)), F.lit(name))
    ranks = lambda c: F.transform(c, lambda x: x["rank"]) != F.sequence(F.lit(1), F.size(c))
    blank = lambda x, *fields: F.exists(F.array(*[x[f] for f in fields]), lambda v: v.isNull() | (v == ""))
    problems = F.array_compact(
        F.array(
            has(F.col("query_id").isNull(), "no query_id"),
            has(F.size("documents") != n_documents, "documents"),
            has(F.size("fragments") != n_fragments, "fragments"),
            has(ranks("documents"), "document ranks"),
            has(ranks("fragments"), "fragment ranks"),
            has(F.exists("documents", lambda d: blank(d, "doc_id")), "document fields"),
            has(F.exists("fragments", lambda f: blank(f, "chunk_id", "doc_id", "text")), "fragment fields"),
            has(F.exists("fragments", lambda f: X.word_count(f["text"]) > limit), "long fragment"),
        )
    )
    found = results.select("query_id", F.explode(problems).alias("problem"))
    return found.unionByName(repeated(results, "query_id").select("query_id", F.lit("repeated query").alias("problem")))


def unknown_ids(results: DataFrame, records: DataFrame) -> DataFrame:
    """Documents and chunks of results that the records don't have."""
    docs = results.select("query_id", F.explode("documents.doc_id").alias("id"))
    chunks = results.select("query_id", F.explode("fragments.chunk_id").alias("id"))
    return docs.join(records.select(F.col("doc_id").alias("id")).distinct(), "id", "left_anti").unionByName(chunks.join(records.select(F.col("chunk_id").alias("id")), "id", "left_anti"))


def bad_query_set(queries: DataFrame, n: int = 50) -> DataFrame:
    """Queries that aren't q001, q002, ... qN, each once."""
    want = queries.sparkSession.range(1, n + 1).select(F.format_string("q%03d", "id").alias("query_id"), F.lit(1).alias("want"))
    got = queries.groupBy("query_id").agg(F.count("*").alias("got"))
    return want.join(got, "query_id", "full").filter(~F.col("want").eqNullSafe(F.col("got"))).select("query_id")


# Graph


def incomplete_graph(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes without name or type; edges without relation, document or chunk, or whose ends aren't nodes."""
    n = nodes.filter(F.col("type").isNull() | (F.coalesce("name", F.lit("")) == "")).select(F.col("node").alias("id"), F.lit("node").alias("what"))
    gap = edges.filter(F.col("relation").isNull() | F.col("doc_id").isNull() | F.col("chunk_id").isNull()).select(F.concat_ws(" ", "src", "relation", "dst").alias("id"), F.lit("edge").alias("what"))
    ends = edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct().join(nodes.select("node"), "node", "left_anti").select(F.col("node").alias("id"), F.lit("end").alias("what"))
    return n.unionByName(gap).unionByName(ends)


def unknown_evidence(nodes: DataFrame, edges: DataFrame, records: DataFrame) -> DataFrame:
    named = nodes.select(F.explode("chunk_ids").alias("chunk_id")).unionByName(edges.select(F.explode("chunk_ids").alias("chunk_id"))).distinct()
    return named.join(records.select("chunk_id"), "chunk_id", "left_anti")


def shared_keys(nodes: DataFrame) -> DataFrame:
    """Nodes of one type whose names have the same key."""
    return nodes.groupBy("type", name_key_column("name").alias("key")).agg(F.count("*").alias("n")).filter("n > 1")


def graph_coverage(nodes: DataFrame, edges: DataFrame, docs: DataFrame) -> DataFrame:
    """One row: share of documents with an edge, topics of the nodes, isolated nodes."""
    touched = edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    lone = nodes.join(touched, "node", "left_anti").agg(F.count("*").alias("isolated"))
    topics = nodes.select(F.explode(F.split("topics", "")).alias("t")).filter("t <> ''").agg(F.array_join(F.sort_array(F.collect_set("t")), "").alias("topics"))
    share = docs.select("doc_id").distinct().join(edges.select("doc_id").distinct().withColumn("has", F.lit(1)), "doc_id", "left").agg(F.round(F.count("has") / F.count("*"), 6).alias("doc_share"))
    one = F.lit(1).alias("one")
    return share.select("*", one).join(topics.select("*", one), "one").join(lone.select("*", one), "one").drop("one")
