"""Counts, distributions and samples of a corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from papyrix.functions import text as X
from papyrix.session import cut, if_small


def counts_by(docs: DataFrame, *columns: str) -> DataFrame:
    """Documents, empty ones and characters by each of the columns and overall, in one pass (grouping sets)."""
    sets = [[c] for c in columns] + [[]]
    out = docs.groupingSets([[F.col(c) for c in s] for s in sets], *columns)
    return out.agg(F.count("*").alias("n_docs"), F.count_if(F.length(F.trim(F.coalesce("text", F.lit("")))) == 0).alias("n_empty"), F.sum(F.length("text")).alias("n_chars"))


def crosstab(docs: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    return docs.groupBy(row).pivot(column, values).count().na.fill(0)


def upper_median(values: DataFrame, column: str, by: tuple[str, ...] = ()) -> DataFrame:
    """min, median (the upper of two), max, 10th and 95th percent, exactly: by ranks over the counts of different values,
    so that no task sorts all rows of a group."""
    c = values.groupBy(*by, F.col(column).alias("v")).count()
    run = F.sum("count").over(W.partitionBy(*by).orderBy("v"))
    n = F.sum("count").over(W.partitionBy(*by))
    c = c.withColumn("_run", run).withColumn("_n", n)
    at = lambda share: F.min(F.when(F.col("_run") > F.floor(F.col("_n") * share), F.col("v")))
    return c.groupBy(*by).agg(F.max("_n").alias("n"), F.min("v").alias("min"), at(0.1).alias("p10"), at(0.5).alias("median"), at(0.95).alias("p95"), F.max("v").alias("max"))


def histogram(rows: DataFrame, *columns: str) -> DataFrame:
    out = rows.groupBy(*columns).agg(F.count("*").alias("n"))
    return out.withColumn("percent", F.round(100 * F.col("n") / F.sum("n").over(W.partitionBy()), 6))


def duplicate_stats(docs: DataFrame, key: Column) -> DataFrame:
    """Different texts, surplus copies, groups with copies, the largest group."""
    groups = docs.groupBy(F.xxhash64(key), F.md5(key)).count()
    return groups.agg(F.count("*").alias("unique_texts"), F.sum(F.col("count") - 1).alias("surplus"), F.count_if(F.col("count") > 1).alias("groups"), F.max("count").alias("largest"))


def cleaning_loss(both: DataFrame, top: int = 20, by: str = "format") -> tuple[DataFrame, DataFrame]:
    """both: (doc_id, by, before, after). Removed characters by format; the documents that lost the largest share."""
    rows = both.select("doc_id", by, F.length("before").alias("chars_before"), (F.length("before") - F.length("after")).alias("chars_removed"))
    per = rows.groupBy(by).agg(F.count("*").alias("n_docs"), F.sum("chars_before").alias("chars_before"), F.sum("chars_removed").alias("chars_removed"))
    worst = rows.withColumn("share", F.round(F.col("chars_removed") / F.nullif(F.col("chars_before"), F.lit(0)), 6)).orderBy(F.desc("share"), "doc_id").limit(top)
    return per, worst


def frequent_terms(docs: DataFrame, text: str = "text", n: int = 50) -> DataFrame:
    """The n commonest words of three letters or more, and acronyms as they are written."""
    found = F.regexp_extract_all(F.col(text), F.lit(rf"({X.LETTER}{{3,}})"), 1)
    word = F.when(X.is_acronym(F.col("w")), F.col("w")).otherwise(F.lower("w"))
    return docs.select(F.explode(found).alias("w")).groupBy(word.alias("term")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "term").limit(n)


def term_coverage(docs: DataFrame, terms: DataFrame, text: str = "text") -> DataFrame:
    """terms: (term), single words. Documents with each term and how often it occurs. Words meet terms by equality."""
    w = docs.select("doc_id", F.explode(F.regexp_extract_all(F.lower(text), F.lit(rf"({X.LETTER}+)"), 1)).alias("term")).groupBy("doc_id", "term").count()
    return terms.join(w, "term", "left").groupBy("term").agg(F.count("doc_id").alias("docs"), F.coalesce(F.sum("count"), F.lit(0)).alias("occurrences"))


def terms_lost(before: DataFrame, after: DataFrame, terms: list[str], text: str = "text") -> DataFrame:
    """(doc_id, lost): watched terms (of one or more words) that a document has before but not after."""
    words = "|".join(f"\\Q{t.lower()}\\E" for t in sorted(terms, key=len, reverse=True))
    has = lambda df, name: df.select("doc_id", F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(rf"(?<![\p{{L}}\p{{N}}_])({words})(?![\p{{L}}\p{{N}}_])"), 1)).alias(name))
    gone = has(before, "had").join(has(after, "has"), "doc_id").withColumn("lost", F.array_except("had", "has"))
    return gone.filter(F.size("lost") > 0).select("doc_id", F.sort_array("lost").alias("lost"))


def repeated_ngrams(docs: DataFrame, size: int = 6, text: str = "text") -> DataFrame:
    """(doc_id, gram, n, first): runs of ``size`` words that recur within a document as often as page furniture does.
    The relational form of the cleaning step: hashes of runs are counted by document, whole documents are never gathered;
    the few runs that recur are looked up in their documents, and counted there again by their words."""
    w = docs.select("doc_id", X.words(F.col(text)).alias("w")).withColumn("n_words", F.size("w")).filter(F.col("n_words") >= 2 * size)
    run = lambda words, i: F.array_join(F.slice(words, i, size), " ")
    starts = F.sequence(F.lit(1), F.col("n_words") - size + 1)
    hashes = w.select("doc_id", "n_words", F.explode(F.transform(starts, lambda i: F.xxhash64(F.slice("w", i, size)))).alias("h"))
    often = hashes.groupBy("doc_id", "n_words", "h").agg(F.count("*").alias("n")).filter(F.col("n") >= X.repeat_threshold(F.col("n_words")))
    known = cut(often.groupBy("doc_id").agg(F.collect_set("h").alias("hs")))
    again = w.join(if_small(known), "doc_id")
    at = F.filter(F.transform(starts, lambda i: F.struct(i.alias("pos"), F.xxhash64(F.slice("w", i, size)).alias("h"))), lambda x: F.array_contains("hs", x["h"]))
    each = again.select("doc_id", "n_words", F.explode(F.transform(at, lambda x: F.struct(x["pos"].alias("pos"), run(F.col("w"), x["pos"]).alias("gram")))).alias("g"))
    grams = each.groupBy("doc_id", "n_words", F.col("g.gram").alias("gram")).agg(F.count("*").alias("n"), F.min("g.pos").alias("first"))
    return grams.filter(F.col("n") >= X.repeat_threshold(F.col("n_words"))).select("doc_id", "gram", "n", "first")


def stratified(docs: DataFrame, by: str, per_group: int, key: str = "doc_id") -> DataFrame:
    """The first ``per_group`` rows of each group in a stable random order."""
    order = W.partitionBy(by).orderBy(F.md5(F.col(key).cast("string")), key)
    return docs.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= per_group).drop("_n")


def until_quota(docs: DataFrame, size: Column, quota: int, key: str = "doc_id", by: str | None = None) -> DataFrame:
    """Rows of each group in a stable random order while their sizes add up to ``quota`` at most."""
    order = W.partitionBy(*([by] if by else [])).orderBy(F.md5(F.col(key).cast("string")), key).rowsBetween(W.unboundedPreceding, 0)
    return docs.withColumn("_sum", F.sum(size).over(order)).filter(F.col("_sum") <= quota).drop("_sum")
