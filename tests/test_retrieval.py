import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from papyrix.operators import checks, ranking, vectors
from papyrix.operators import evaluation as E
from papyrix.plans import retrieve

CAND = "query_id string, chunk_id string, doc_id string, score double, text string, language string"


def candidates(spark, rows):
    return spark.createDataFrame([("q1", c, d, s, t, lang) for c, d, s, t, lang in rows], CAND)


def test_factors(spark):
    df = candidates(spark, [("a", "F1-x", 1.0, "", None), ("b", "F2-x", 1.0, "", "es"), ("c", "F1-y", 1.0, "", "zh")])
    out = {r["chunk_id"]: r["score"] for r in ranking.language_factor(df).collect()}
    assert out == {"a": 1.0, "b": 1.0, "c": 0.97}
    assert ranking.language_factor(df, 1.0) is df
    for topic, want in ((1, {"a": 1.03, "b": 1.0, "c": 1.03}), (0, dict.fromkeys("abc", 1.0)), (None, dict.fromkeys("abc", 1.0))):
        assert {r["chunk_id"]: r["score"] for r in ranking.topic_boost(df.withColumn("topic", F.lit(topic).cast("int"))).collect()} == want


def test_documents(spark):
    df = candidates(spark, [("a", "B", 0.5, "", None), ("b", "A", 0.5, "", None), ("c", "C", 0.3, "", None), ("d", "C", 0.3, "", None), ("e", "D", 0.1, "", None)])
    order = lambda how: [r["doc_id"] for r in ranking.top_documents(df, strategy=how).orderBy("rank").collect()]
    assert order("max") == ["A", "B", "C"] and order("sum") == ["C", "A", "B"] and order("mean") == ["A", "B", "C"]
    with pytest.raises(ValueError):
        ranking.top_documents(df, strategy="median")


def fragments(spark, rows, **how):
    df = candidates(spark, [(f"c{i}", d, 1 - i / 100, t, None) for i, (d, t) in enumerate(rows)])
    return [(r["doc_id"], r["text"]) for r in ranking.select_fragments(df, **how).orderBy("rank").collect()]


def test_greedy_selection(spark):
    rows = [("A", "x"), ("A", "y"), ("A", "z"), ("B", "z")]
    assert fragments(spark, rows, n=3) == [("A", "x"), ("A", "y"), ("B", "z")]
    # a capped text isn't taken, so another document may bring it; with room left the cap is lifted, repeats stay out
    assert fragments(spark, rows, n=4) == [("A", "x"), ("A", "y"), ("B", "z")]
    assert fragments(spark, [("A", "x"), ("A", "x "), ("A", "y"), ("A", "w"), ("A", " ")], n=4) == [("A", "x"), ("A", "y"), ("A", "w")]
    assert fragments(spark, [], n=3) == []


def test_best_part(spark):
    parts = ["uno dos tres.", "la órbita baja terrestre.", "la orbita alta."]
    assert ranking.best_part(parts, "satélites en ÓRBITA baja") == parts[1]
    assert ranking.best_part(parts, "de la") == parts[0] == ranking.best_part(parts, None)
    df = spark.createDataFrame([([(0, "p", ["a"]), (1, "q", ["a", "b"]), (2, "r", ["a", "b"])], ["a", "b"])], "parts array<struct<part:int,text:string,terms:array<string>>>, asked array<string>")
    assert df.select(ranking.best_part_column(F.col("parts"), F.col("asked"))).first()[0] == "q"


def test_one_document_owns_the_first_hits(spark):
    # chunk i is at angle i / 1000 from the first query; of 300 chunks A has the first 200 and more
    at = [(i, f"c{i:03d}", "A" if i < 210 else "BC"[i % 2], f"text {i}", "en", [math.cos(i / 1000), math.sin(i / 1000)]) for i in range(300)]
    store = spark.createDataFrame(at, "vec_id long, chunk_id string, doc_id string, text string, language string, embedding array<float>")
    asked = spark.createDataFrame([("q1", [1.0, 0.0], None, None), ("q2", at[212][5], None, None)], "query_id string, embedding array<float>, text string, topic int")
    out = {r["query_id"]: r for r in retrieve.retrieve(store, asked).collect()}
    assert all({d["doc_id"] for d in r["documents"]} == {"A", "B", "C"} for r in out.values())
    assert len({f["doc_id"] for f in out["q1"]["fragments"]}) == 3
    # only the query that lacks documents is widened, ten times at once, and to all rows at most
    n = lambda k: {r["query_id"]: r["count"] for r in retrieve.candidates(store, asked, k).groupBy("query_id").count().collect()}
    assert n(10) == {"q1": 300, "q2": 10} and n(22) == {"q1": 220, "q2": 22}
    one = store.filter("doc_id = 'A'")
    assert retrieve.candidates(one, asked, 10).count() == 420 and retrieve.candidates(store.limit(0), asked).count() == 0


def test_search_is_exact(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(300, 8)).astype(np.float32)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    v[7] = v[3]
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "vec_id long, embedding array<float>").repartition(5)
    asked = df.filter("vec_id % 50 = 3").selectExpr("cast(vec_id as string) query_id", "embedding")
    got = vectors.top_k(df, asked, 5).collect()
    for q in {r["query_id"] for r in got}:
        scores = v.astype(np.float64) @ v[int(q)].astype(np.float64)
        want = sorted(range(300), key=lambda i: (-scores[i], i))[:5]
        assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] == want
    assert checks.not_first_of_itself(vectors.top_k(df, asked, 1)).count() == 0
    assert vectors.top_k(df, asked.limit(0), 5).count() == 0
    assert vectors.bad_vectors(df, 8).count() == 0 and vectors.bad_vectors(df, 9).count() == 300


def test_widths(spark):
    def width(n, only=None):
        rows = [(r, f"c{r}", "A" if r < 201 else "B" if r < 210 else "C", "", None, [1.0 - r / 10000]) for r in range(1, n + 1)]
        store = spark.createDataFrame(rows, "vec_id long, chunk_id string, doc_id string, text string, language string, embedding array<float>")
        asked = spark.createDataFrame([("q", [1.0])], "query_id string, embedding array<float>")
        return [r["k"] for r in retrieve.widths(store.filter(F.col("doc_id") == only) if only else store, asked).collect()]

    assert width(2500) == [2000] and width(300) == [300] and width(300, "A") == [200]


def test_many_queries_are_asked_in_passes(spark, monkeypatch):
    df = spark.createDataFrame([(i, [float(i % 7), float(i % 11)]) for i in range(90)], "vec_id long, embedding array<float>").repartition(3)
    asked = df.selectExpr("cast(vec_id as string) query_id", "embedding")
    rows = lambda: sorted(map(tuple, vectors.top_k(df, asked, 4).collect()))
    whole = rows()
    monkeypatch.setattr(vectors, "MAX_QUERY_BYTES", 400)
    assert rows() == whole and len(whole) == 360
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert rows() == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_detector(spark, small):
    from papyrix.functions import language

    docs = spark.read.parquet(f"{small}/documents.parquet")
    detector = language.Detector(language.gram_counts(docs.filter("doc_id % 5 <> 0")))
    got = language.tag(docs.filter("doc_id % 5 = 0 and length(text) > 200"), detector).collect()
    assert sum(r["lang"] == r["language"] for r in got) >= 0.95 * len(got) > 20
    assert detector("too short") == (None, 0.0) and detector(None) == (None, 0.0) and language.Detector({})("a" * 60) == (None, 0.0)
    grams, letters = language.codes("Añ, b")
    assert [language.shown(int(g)) for g in grams] == [" añ", "añ ", "ñ b", " b "] and letters == 3


def test_encode(spark):
    df = spark.createDataFrame([("a", "x y"), ("b", None)], "chunk_id string, text string")
    out = {r["chunk_id"]: r["embedding"] for r in vectors.encode(df).collect()}
    assert sum(x * x for x in out["a"]) == pytest.approx(1) and not any(out["b"])
    done = spark.createDataFrame([("a", "m1")], "chunk_id string, signature string")
    assert [r["chunk_id"] for r in vectors.encode_missing(df, done, "m1").collect()] == ["b"]
    assert vectors.encode_missing(df, done, "m2").count() == 2


def run_of(spark, docs):
    return spark.createDataFrame([("q", d, i) for i, d in enumerate(docs, 1)], "query_id string, doc_id string, rank int")


def qrels_of(spark, grades):
    return spark.createDataFrame([("q", d, g) for d, g in grades.items()], "query_id string, doc_id string, grade int")


def test_ndcg(spark):
    grades = dict(zip("abcdef", (3, 2, 3, 0, 1, 2)))
    assert E.ndcg(run_of(spark, "abcdef"), qrels_of(spark, grades), 6).first()["ndcg"] == pytest.approx(0.9608, abs=5e-5)
    two = E.ndcg(run_of(spark, "bc"), qrels_of(spark, {"a": 3, "b": 1, "c": 1}), 2).first()["ndcg"]
    assert two == pytest.approx((1 + 1 / math.log2(3)) / (3 + 1 / math.log2(3)))
    assert E.ndcg(run_of(spark, "xy"), qrels_of(spark, {"a": 0}), 2).first()["ndcg"] == 0


@pytest.mark.parametrize("returned,relevant,f1", [("abc", "abxyz", 2 / 3), ("abc", "a", 0.5), ("abc", "xyz", 0), ("abc", "abc", 1)])
def test_f1(spark, returned, relevant, f1):
    got = E.precision_recall_f1(run_of(spark, returned), qrels_of(spark, dict.fromkeys(relevant, 1))).first()
    assert got["f1"] == pytest.approx(f1)
    arrays = spark.createDataFrame([(list(returned), list(relevant))], "a array<string>, b array<string>").select(E.f1_sets(F.col("a"), F.col("b")))
    assert arrays.first()[0] == pytest.approx(f1)


def test_graph_fusion(spark):
    cands = candidates(spark, [("a", "A", 0.5, "t", None)])
    store = spark.createDataFrame([("b", "B", "u", None, [1.0, 0.0])], "chunk_id string, doc_id string, text string, language string, embedding array<float>")
    asked = spark.createDataFrame([("q1", [0.6, 0.8])], "query_id string, query_vector array<float>")
    evidence = spark.createDataFrame([("q1", "a", 1.0), ("q1", "b", 0.5), ("q1", "zz", 1.0)], "query_id string, chunk_id string, weight double")
    out = {r["chunk_id"]: r["score"] for r in ranking.fuse_graph(cands, evidence, store, asked, vectors.dot(F.col("embedding"), F.col("query_vector"))).collect()}
    assert out == {"a": pytest.approx(0.5 * 1.03), "b": pytest.approx(0.6 * 1.015)}


def test_results_are_well_formed(spark, small):
    from papyrix.plans import queries, retrieve

    store = queries.store(spark, small).cache()
    asked = queries.query_vectors(spark, small).withColumn("text", F.lit("the of and"))
    out = retrieve.retrieve(store, asked).cache()
    assert checks.bad_results(out).count() == 0
    records = store.select("doc_id", "chunk_id")
    assert checks.unknown_ids(out, records).count() == 0
    again = retrieve.retrieve(store.repartition(5), asked)
    assert E.run_difference(out, again).filter("not identical").count() == 0
    broken = out.withColumn("fragments", F.slice("fragments", 1, 9)).unionByName(out.limit(1))
    assert {r["problem"] for r in checks.bad_results(broken).collect()} == {"fragments", "repeated query"}
    report = E.sweep_report(spark, lambda f: retrieve.retrieve(store, asked, language_factor=f), [1.0, 0.97], 1.0)
    assert report.filter("value = 1.0").first()["identical"] == report.first()["queries"]
