"""Retrieval metrics, comparisons of runs and sweeps over parameters.

A run: (query_id, rank, doc_id) and any grouping columns. Judgements: (query_id, doc_id, grade), or ByClass; what isn't
judged is 0.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from papyrix.session import cut, if_small

#: Rows of a run, ids only, that may be broadcast.
RUN_ROWS = 1_000_000


@dataclass(frozen=True)
class ByClass:
    """Judgements of classes: a document has the grade that the query gives its class. The pairs of queries and documents,
    whose number grows with the square of the input, are never made."""

    #: (doc_id, class)
    documents: DataFrame
    #: (query_id, class, grade)
    asked: DataFrame


def _of_run(qrels: DataFrame | ByClass, run: DataFrame) -> DataFrame:
    """The judgements of what the run has: there may be far more of others, which then aren't shuffled."""
    pairs = if_small(cut(run.select("query_id", "doc_id").distinct()), RUN_ROWS)
    if isinstance(qrels, ByClass):
        return qrels.documents.join(pairs, "doc_id").join(qrels.asked, ["query_id", "class"]).select("query_id", "doc_id", "grade")
    return qrels.join(pairs, ["query_id", "doc_id"], "left_semi")


def _grades(qrels: DataFrame | ByClass) -> DataFrame:
    """(query_id, grade, n): how many judgements have each grade."""
    if isinstance(qrels, ByClass):
        sizes = qrels.documents.groupBy("class").agg(F.count("*").alias("n"))
        return qrels.asked.join(sizes, "class").groupBy("query_id", "grade").agg(F.sum("n").alias("n"))
    return qrels.groupBy("query_id", "grade").agg(F.count("*").alias("n"))


def _first(rows: DataFrame, by: str, n: int) -> DataFrame:
    """Rows of the first n different documents of each group, numbered; those of a task go no further."""
    return rows.withColumn("nth", F.dense_rank().over(W.partitionBy(by).orderBy("doc_id"))).filter(F.col("nth") <= n)


def _relevant(qrels: DataFrame | ByClass, least_grade: int, n: int) -> DataFrame:
    """(query_id, doc_id) of relevant documents, of which n at least are there if there are so many."""
    if isinstance(qrels, ByClass):
        return qrels.asked.filter(F.col("grade") >= least_grade).join(_first(qrels.documents, "class", n), "class").select("query_id", "doc_id")
    return qrels.filter(F.col("grade") >= least_grade).select("query_id", "doc_id")


def ndcg(run: DataFrame, qrels: DataFrame | ByClass, k: int = 10, by: tuple[str, ...] = ("query_id",)) -> DataFrame:
    """Linear gain; the ideal order is that of all judged documents; 0 where nothing judged is relevant."""
    gain = lambda grade, rank: F.sum(F.when(rank <= k, grade / F.log2(rank + 1)))
    got = run.join(_of_run(qrels, run), ["query_id", "doc_id"], "left").groupBy(*by).agg(F.coalesce(gain(F.coalesce("grade", F.lit(0)), F.col("rank")), F.lit(0.0)).alias("dcg"))
    # the ideal order's grades follow from how many judgements have each
    grades = _grades(qrels)
    last = F.sum("n").over(W.partitionBy("query_id").orderBy(F.desc("grade")))
    first = grades.select("query_id", "grade", (last - F.col("n") + 1).alias("first"), last.alias("last")).filter(F.col("first") <= k)
    ranks = first.select("query_id", "grade", F.explode(F.sequence("first", F.least("last", F.lit(k).cast("bigint")))).alias("ideal_rank"))
    best = ranks.groupBy("query_id").agg(gain(F.col("grade"), F.col("ideal_rank")).alias("ideal"))
    value = F.when(F.col("ideal") > 0, F.col("dcg") / F.col("ideal")).otherwise(0.0)
    return got.join(best, "query_id", "left").select(*by, F.coalesce(value, F.lit(0.0)).alias("ndcg"))


def precision_recall_f1(run: DataFrame, qrels: DataFrame | ByClass, n: int = 3, least_grade: int = 1, by: tuple[str, ...] = ("query_id",)) -> DataFrame:
    """Over sets: precision is out of n, recall out of the relevant ones or n if there are more."""
    # more than n make no difference: each query's first n documents are counted
    wanted = _first(_relevant(qrels, least_grade, n), "query_id", n).groupBy("query_id").agg(F.max("nth").alias("wanted"))
    returned = run.filter(F.col("rank") <= n).select(*by, "doc_id").distinct()
    relevant = _of_run(qrels, returned).filter(F.col("grade") >= least_grade).select("query_id", "doc_id").distinct()
    hits = returned.join(relevant.withColumn("hit", F.lit(1)), ["query_id", "doc_id"], "left").groupBy(*by).agg(F.coalesce(F.sum("hit"), F.lit(0)).alias("hits"))
    out = hits.join(wanted, "query_id", "left").withColumn("precision", F.col("hits") / n)
    out = out.withColumn("recall", F.coalesce(F.col("hits") / F.least(F.col("wanted"), F.lit(n)), F.lit(0.0)))
    total = F.col("precision") + F.col("recall")
    return out.withColumn("f1", F.when(total > 0, 2 * F.col("precision") * F.col("recall") / total).otherwise(0.0)).select(*by, "precision", "recall", "f1")


def mean_metrics(metrics: DataFrame, columns: Sequence[str], by: tuple[str, ...] = ()) -> DataFrame:
    return metrics.groupBy(*by).agg(*[F.round(F.coalesce(F.avg(c), F.lit(0.0)), 6).alias(c) for c in columns])


def f1_sets(returned: Column, relevant: Column, n: int = 3) -> Column:
    """The same for two arrays."""
    hits = F.size(F.array_intersect(returned, relevant))
    p = hits / n
    r = hits / F.least(F.size(F.array_distinct(relevant)), F.lit(n))
    return F.when(hits > 0, 2 * p * r / (p + r)).otherwise(0.0)


def run_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """schemas.RESULT twice. Per query: documents that only one has (as sets), fragments that differ by rank, identical."""
    left = a.select("query_id", F.transform("documents", lambda d: d["doc_id"]).alias("d1"), F.transform("fragments", lambda f: f["chunk_id"]).alias("f1"))
    right = b.select("query_id", F.transform("documents", lambda d: d["doc_id"]).alias("d2"), F.transform("fragments", lambda f: f["chunk_id"]).alias("f2"))
    out = left.join(right, "query_id", "full")
    none = F.array().cast("array<string>")
    for c in ("d1", "d2", "f1", "f2"):
        out = out.withColumn(c, F.coalesce(c, none))
    moved = F.size(F.filter(F.zip_with("f1", "f2", lambda x, y: ~x.eqNullSafe(y)), lambda x: x))
    out = out.withColumn("doc_changes", F.size(F.array_except("d2", "d1"))).withColumn("docs_lost", F.size(F.array_except("d1", "d2"))).withColumn("fragment_changes", moved)
    return out.select("query_id", "doc_changes", "docs_lost", "fragment_changes", ((F.col("doc_changes") + F.col("docs_lost") + F.col("fragment_changes")) == 0).alias("identical"))


def describe_run(documents: DataFrame, topics: DataFrame) -> DataFrame:
    """documents: (query_id, doc_id); topics: (query_id, topic). Per topic and overall (topic null): slots, different
    documents, share whose id begins with the query's topic."""
    match = F.col("doc_id").startswith(F.concat(F.lit("F"), F.col("topic").cast("string"), F.lit("-"))).cast("int")
    rows = documents.join(topics, "query_id").withColumn("match", match)
    return rows.rollup("topic").agg(F.count("*").alias("slots"), F.countDistinct("doc_id").alias("docs"), F.round(F.avg("match"), 6).alias("topic_share"))


def language_share(retrieved: DataFrame, corpus: DataFrame, alarm: float = 0.85) -> DataFrame:
    """Share of each language among what was retrieved and in the corpus; whether one has more than ``alarm``."""
    share = lambda df, name: df.groupBy("language").count().withColumn(name, F.col("count") / F.sum("count").over(W.partitionBy())).drop("count")
    out = share(corpus, "corpus_share").join(share(retrieved, "retrieved_share"), "language", "full")
    kept = F.coalesce("retrieved_share", F.lit(0.0))
    return out.select("language", F.round(F.coalesce("corpus_share", F.lit(0.0)), 6).alias("corpus_share"), F.round(kept, 6).alias("retrieved_share"), (kept > alarm).alias("dominant"))


def sweep(candidates: DataFrame, values: Sequence[float], name: str) -> DataFrame:
    """Each candidate once for each value of a parameter, as a column: the plan behind it then runs for all values."""
    return candidates.withColumn(name, F.explode(F.array(*[F.lit(float(v)) for v in values])))


def unchanged_from_previous(fingerprints: DataFrame, parameter: str) -> DataFrame:
    """(query_id, parameter, fingerprint): adds whether it equals that of the parameter's previous value."""
    before = F.lag("fingerprint").over(W.partitionBy("query_id").orderBy(parameter))
    return fingerprints.withColumn("unchanged", F.col("fingerprint").eqNullSafe(before) & before.isNotNull())


def sweep_report(spark: SparkSession, run: Callable[[float], DataFrame], values: Sequence[float], base: float) -> DataFrame:
    """run(value) gives schemas.RESULT. Per value: identical queries, document and fragment changes against ``base``."""
    reference = run(base)
    out = None
    for value in values:
        diff = run_difference(reference, run(value))
        row = diff.agg(F.count("*").alias("queries"), F.count_if("identical").alias("identical"), F.sum("doc_changes").alias("doc_changes"), F.sum("fragment_changes").alias("fragment_changes")).withColumn("value", F.lit(float(value)))
        out = row if out is None else out.unionByName(row)
    return out if out is not None else spark.createDataFrame([], "queries bigint, identical bigint, doc_changes bigint, fragment_changes bigint, value double")


def link_diagnostic(queries: DataFrame, seeds: DataFrame, evidence: DataFrame) -> DataFrame:
    """Per query: how many nodes it links to and how many chunks those speak for."""
    s = seeds.groupBy("query_id").agg(F.count("*").alias("seeds"))
    e = evidence.groupBy("query_id").agg(F.count("*").alias("chunks"))
    zero = F.lit(0).cast("bigint")
    return queries.select("query_id").join(s, "query_id", "left").join(e, "query_id", "left").select("query_id", F.coalesce("seeds", zero).alias("seeds"), F.coalesce("chunks", zero).alias("chunks"))
