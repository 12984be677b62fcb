"""From candidates to results: boosts, documents, fragments. All queries go through one plan.

Candidates: query_id, chunk_id, doc_id, score, text, language (see schemas.CANDIDATE).
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papyrix.functions.pytext import unaccented
from papyrix.functions.segment import LIMIT, limited

N_DOCUMENTS, N_FRAGMENTS, PER_DOCUMENT = 3, 10, 2
TOPIC_BOOST, LANGUAGE_FACTOR, GRAPH_BONUS = 1.03, 0.97, 0.03
PREFERRED = ("es", "en")

# Spanish and English words that tell nothing about a text.
STOP_WORDS = frozenset(
    """
    el la los las un una unos unas de del al a en con por para sin sobre entre que qué cual cuál cuales como cómo cuando cuándo
    donde dónde quien quién es son ser sea fue han ha hay su sus lo se no ni o u y e
    the an of in on at to for with by from and or as is are was were be been this that these those it its
    """.split()
)
_TERM = re.compile(r"[^\W\d_]{3,}")


def terms(text: str | None) -> set[str]:
    return set(_TERM.findall(unaccented(text or ""))) - STOP_WORDS


def best_part(parts: list[str], query: str | None) -> str:
    """The part with most terms of the query, the first of those; the first if the query has none."""
    return _best_for(parts, terms(query))


def _best_for(parts: list[str], asked: set[str]) -> str:
    return max(parts, key=lambda p: len(asked & terms(p))) if asked and len(parts) > 1 else parts[0] if parts else ""


def best_part_column(parts: Column, asked: Column) -> Column:
    """The same for arrays of structs (part, text, terms), inside the JVM."""
    overlap = lambda p: F.size(F.array_intersect(p["terms"], asked))
    ranked = F.array_sort(F.transform(parts, lambda p: F.struct((-overlap(p)).alias("miss"), p["part"].alias("part"), p["text"].alias("text"))))
    return F.element_at(ranked, 1)["text"]


def language_factor(candidates: DataFrame, factor: float | Column = LANGUAGE_FACTOR, preferred: tuple[str, ...] = PREFERRED) -> DataFrame:
    """Scores of other languages shrink; one that isn't known doesn't."""
    if factor == 1.0 if isinstance(factor, float) else False:
        return candidates
    other = F.col("language").isNotNull() & ~F.col("language").isin(*preferred)
    return candidates.withColumn("score", F.when(other, F.col("score") * factor).otherwise(F.col("score")))


def topic_boost(candidates: DataFrame, topic: str = "topic", factor: float | Column = TOPIC_BOOST) -> DataFrame:
    """Documents whose id begins with the query's topic gain; null or 0 is no topic."""
    own = (F.col(topic) > 0) & F.col("doc_id").startswith(F.concat(F.lit("F"), F.col(topic).cast("string"), F.lit("-")))
    return candidates.withColumn("score", F.when(F.coalesce(own, F.lit(False)), F.col("score") * factor).otherwise(F.col("score")))


def fuse_graph(candidates: DataFrame, evidence: DataFrame, store: DataFrame, queries: DataFrame, score: Column, bonus: float | Column = GRAPH_BONUS) -> DataFrame:
    """Chunks that the graph names join the candidates with their true similarity; all it names gain up to ``bonus``.

    evidence: (query_id, chunk_id, weight). store: the candidates' columns but query_id and score, and ``embedding``.
    queries: (query_id, query_vector). score: similarity of the two vectors.
    """
    known = evidence.select("query_id", "chunk_id")
    new = known.join(candidates, ["query_id", "chunk_id"], "left_anti").join(store, "chunk_id").join(F.broadcast(queries), "query_id")
    new = new.withColumn("score", score).select(*candidates.columns)
    fused = candidates.unionByName(new).join(evidence, ["query_id", "chunk_id"], "left")
    return fused.withColumn("score", F.col("score") * (1 + F.lit(bonus) * F.coalesce("weight", F.lit(0.0)))).drop("weight")


def ranked(candidates: DataFrame, by: tuple[str, ...] = ("query_id",)) -> DataFrame:
    return candidates.withColumn("rank", F.row_number().over(W.partitionBy(*by).orderBy(F.desc("score"), "chunk_id")))


def top_documents(candidates: DataFrame, n: int = N_DOCUMENTS, strategy: str = "max", by: tuple[str, ...] = ("query_id",)) -> DataFrame:
    """The n best documents of each query; a document's score is the max, sum or mean of its chunks'."""
    how = {"max": F.max, "sum": F.sum, "mean": F.avg}
    if strategy not in how:
        raise ValueError(f"strategy must be one of {sorted(how)}")
    scored = candidates.groupBy(*by, "doc_id").agg(how[strategy]("score").alias("score"))
    order = W.partitionBy(*by).orderBy(F.desc("score"), "doc_id")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


_FRAGMENT = T.StructType().add("rank", "integer").add("chunk_id", "string").add("doc_id", "string").add("text", "string").add("score", "double")


def select_fragments(candidates: DataFrame, queries: DataFrame | None = None, n: int = N_FRAGMENTS, per_document: int | None = PER_DOCUMENT, limit: int = LIMIT) -> DataFrame:
    """The n fragments of each query that are reported, greedily in order of rank.

    A candidate's best part of ``limit`` words goes in unless its document has ``per_document`` already, or the same text
    went in before; such a repeat is out for good, while a full document's candidates get another chance, without that
    cap, if there are fewer than n. Queries' candidates are few (top-k), so one task holds those of a query.
    """
    asked = queries.select("query_id", F.col("text").alias("query")) if queries is not None else candidates.select("query_id").distinct().withColumn("query", F.lit(None).cast("string"))
    rows = candidates.select("query_id", "chunk_id", "doc_id", F.col("score").cast("double").alias("score"), "text").join(asked, "query_id", "left")

    def pick(got: pa.Table) -> pa.Table:
        chosen = _chosen(got.to_pylist(), n, per_document, limit)
        final = [{"query_id": r["query_id"], "rank": i, "chunk_id": r["chunk_id"], "doc_id": r["doc_id"], "text": r["text"], "score": r["score"]} for i, r in enumerate(chosen, 1)]
        return pa.Table.from_pylist(final, schema=pa.schema([got.schema.field("query_id"), ("rank", pa.int32()), ("chunk_id", pa.string()), ("doc_id", pa.string()), ("text", pa.string()), ("score", pa.float64())]))

    schema = T.StructType([candidates.schema["query_id"], *_FRAGMENT.fields])
    return rows.groupBy("query_id").applyInArrow(pick, schema)


def _chosen(rows: list[dict], n: int, per_document: int | None, limit: int) -> list[dict]:
    """The rows of one query that are reported, in order of rank, with their best parts. The query's terms and each
    different text are looked at once: copies have the same part."""
    rows = sorted(rows, key=lambda r: (-r["score"], r["chunk_id"]))
    asked = {q: terms(q) for q in {r["query"] for r in rows}}
    chosen, taken, seen, out, parts = [], {}, set(), set(), {}
    for cap in (per_document, None):
        for r in rows:
            if len(chosen) == n:
                break
            if r["chunk_id"] in out or (cap and taken.get(r["doc_id"], 0) >= cap):
                continue
            of = (r["text"] or "", r["query"])
            if of not in parts:
                parts[of] = _best_for(limited(of[0], limit), asked[of[1]]).strip()
            part = parts[of]
            if not part:
                continue
            out.add(r["chunk_id"])
            key = " ".join(part.split())
            if key not in seen:
                seen.add(key)
                taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + 1
                chosen.append({**r, "text": part})
    return sorted(chosen, key=lambda r: (-r["score"], r["chunk_id"]))


def dedup_keep_first(rows: DataFrame, key: Column, order: list[str | Column], by: tuple[str, ...] = (), limit: int | None = None) -> DataFrame:
    """Of rows with one key the first stays; of what stays, the first ``limit`` of each group."""
    out = rows.withColumn("_key", key).withColumn("_n", F.row_number().over(W.partitionBy(*by, "_key").orderBy(*order))).filter("_n = 1")
    if limit is not None:
        out = out.withColumn("_n", F.row_number().over(W.partitionBy(*by).orderBy(*order))).filter(F.col("_n") <= limit)
    return out.drop("_key", "_n")


def results(documents: DataFrame, fragments: DataFrame) -> DataFrame:
    """schemas.RESULT: a row per query with both lists in order of rank."""
    docs = documents.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("rank", "doc_id"))).alias("documents"))
    frags = fragments.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("rank", "chunk_id", "doc_id", "text"))).alias("fragments"))
    return docs.join(frags, "query_id", "full")


