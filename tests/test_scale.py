"""Work and memory that must grow with the input only: what plans compute once, what tasks hold."""

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from papyrix.functions import segment as S
from papyrix.functions import text as X
from papyrix.operators import checks, graph, vectors
from papyrix.plans import queries as registered


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_slices_split_a_text_once(spark):
    df = spark.createDataFrame([(1, " ".join(map(str, range(7)))), (2, None), (3, " ")], "i int, t string")
    sliced = df.select("i", X.hard_slices(F.col("t"), 3).alias("s"))
    assert plan(sliced).count("split(") == 1
    assert [r["s"] for r in sliced.orderBy("i").collect()] == [["0 1 2", "3 4 5", "6"], [], []]


def test_different_reads_each_side_once(spark, small):
    rows = lambda *n: spark.createDataFrame([(k, "x") for k, times in n for _ in range(times)], "k int, v string")
    found = checks.different(rows((1, 3), (2, 1), (3, 1)), rows((1, 1), (3, 1), (4, 2)))
    assert sorted(map(tuple, found.collect())) == [(1, "x", "first"), (1, "x", "first"), (2, "x", "first"), (4, "x", "second"), (4, "x", "second")]
    assert plan(entry.queries()["different_runs"](spark, small)).count("Relation [") == 2


#: 400 words without a sentence's end, in which marks stand inside words and behind them.
LONG = " ".join(f"w{i} 3.{i} a:{i};b" if i % 50 else f"end{i}; x" for i in range(1, 140))


def test_chunks_keep_words_with_marks_inside():
    assert " ".join(c.text for c in S.chunks(LONG)).split() == LONG.split()
    assert sum(c.num_tokens for c in S.chunks(LONG, budget=50)) == len(LONG.split())


def test_fragments_keep_words_with_marks_inside():
    parts = S.limited(LONG, 50)
    assert " ".join(parts).split() == LONG.split() and max(len(p.split()) for p in parts) <= 50
    assert any(p.endswith("end50;") for p in parts)


def test_links_split_a_text_once(spark):
    asked = spark.createDataFrame([("q1", "what does alpha beta buy"), ("q2", "alpha"), ("q3", None), ("q4", "a alpha b c d beta")], "query_id string, text string")
    keys = spark.createDataFrame([("alpha", "A"), ("alpha beta", "AB"), ("alpha b c d beta", "L"), ("buy", "B")], "key string, node string")
    want = [("q1", "A"), ("q1", "AB"), ("q2", "A"), ("q4", "A"), ("q4", "L")]
    for longest in (2, 12):
        assert sorted(map(tuple, graph.literal_links(asked, keys, longest=longest).collect())) == want
    few = graph.literal_links(asked, keys.filter("key <> 'alpha b c d beta'"), longest=2)
    assert plan(few).count("split(") == 1 and sorted(map(tuple, few.collect())) == want[:-1]


def test_search_holds_a_bounded_number_of_pairs():
    rng = np.random.default_rng(1)
    q, v = rng.standard_normal((3000, 16)), rng.standard_normal((10000, 16))
    tracemalloc.start()
    rows, keys, scores = vectors.best_of(q, iter([(np.arange(10000), v)]), 20)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 160 << 20  # all products are 240 MB
    order = np.argsort(-(q[:50] @ v.T), axis=1, kind="stable")[:, :20]
    assert (keys[rows < 50].reshape(50, 20) == order).all() and len(rows) == 20 * 3000


def test_equal_vectors_tie_and_hold_k(spark):
    rng = np.random.default_rng(2)
    q, one = rng.standard_normal((7, 64)), rng.standard_normal((1, 64))
    names = np.arange(5000)[::-1]
    rows, keys, scores = vectors.best_of(q, ((names[i : i + 700], np.repeat(one, len(names[i : i + 700]), 0)) for i in range(0, 5000, 700)), 5)
    assert keys.tolist() == [0, 1, 2, 3, 4] * 7 and len(set(scores.tolist())) == 7
    assert vectors.best_of(q, iter([]), 5) is None
    assert vectors.best_of(q, iter([(np.array(["b", "a"], object), one.repeat(2, 0))]), 1)[1].tolist() == ["a"] * 7


@pytest.mark.parametrize("held", (1, 30, 1000))
def test_passes_give_the_same_hits(spark, monkeypatch, held):
    rows = [(i, [float((i * 7) % 11), float(i % 5), 1.0]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    asked = df.filter("vec_id < 6").select(F.col("vec_id").cast("string").alias("query_id"), "embedding")
    monkeypatch.setattr(vectors, "MAX_HELD", held)
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in vectors.top_k(df, asked, 10).collect()}
    for i in range(6):
        want = sorted(range(60), key=lambda j: (-sum(a * b for a, b in zip(rows[i][1], rows[j][1])), j))[:10]
        assert [got[str(i), n] for n in range(1, 11)] == want


def test_a_task_of_the_search_holds_little():
    rng = np.random.default_rng(3)
    most, k = vectors.MAX_HELD, 200
    q, v = rng.standard_normal((most // k, 16)), rng.standard_normal((6000, 16))
    tracemalloc.start()
    rows, keys, scores = vectors.best_of(q, iter([(np.arange(6000), v)]), k)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(rows) == len(q) * k and peak < 100 << 20
    order = np.argsort(-(q[:20] @ v.T), axis=1, kind="stable")[:, :k]
    assert (keys[rows < 20].reshape(20, k) == order).all()


def test_passes_share_one_ranking(spark, monkeypatch):
    df = spark.range(60).selectExpr("id as vec_id", "array(float(id % 7), 1f) as embedding")
    monkeypatch.setattr(vectors, "MAX_HELD", 30)
    found = vectors.top_k(df, df.filter("vec_id < 6").selectExpr("string(vec_id) as query_id", "embedding"), 10)
    assert plan(found).count("MapInArrow") == 2 and plan(found).count("Window [") == 1


def test_judgements_of_others_are_not_shuffled(spark):
    from papyrix.operators import evaluation as E

    run = spark.createDataFrame([("q1", "a", 1), ("q1", "z", 2), ("q2", "b", 1)], "query_id string, doc_id string, rank int")
    qrels = spark.createDataFrame([("q1", "a", 1), ("q1", "b", 2), ("q1", "b2", 2), ("q1", "c", 1), ("q2", "c", 0)], "query_id string, doc_id string, grade int")
    found = E.ndcg(run, qrels, 3)
    want = 1 / (2 + 2 / np.log2(3) + 1 / 2)
    assert {r["query_id"]: round(r["ndcg"], 9) for r in found.collect()} == {"q1": round(want, 9), "q2": 0.0}
    assert "row_number" not in plan(found) and "LeftSemi" in plan(found)


def test_no_more_relevant_documents_are_counted_than_matter(spark):
    from papyrix.operators import evaluation as E

    run = spark.createDataFrame([("q1", "a", 1), ("q1", "z", 2), ("q2", "b", 1), ("q3", "b", 1)], "query_id string, doc_id string, rank int")
    qrels = spark.createDataFrame([("q1", d, 2) for d in "aabcdef"] + [("q2", "b", 2), ("q2", "b", 3), ("q2", "c", 2), ("q2", "d", 1)], "query_id string, doc_id string, grade int")
    found = E.precision_recall_f1(run, qrels, 3, 2)
    got = {r["query_id"]: (round(r["precision"], 6), round(r["recall"], 6)) for r in found.collect()}
    assert got == {"q1": (0.333333, 0.333333), "q2": (0.333333, 0.5), "q3": (0.333333 * 0, 0.0)}
    assert "dense_rank" in plan(found)


def test_judgements_of_classes_equal_those_of_pairs(spark, small):
    from papyrix.operators import evaluation as E

    run = spark.createDataFrame([("q1", "a", 1), ("q1", "z", 2), ("q1", "f", 3), ("q2", "b", 1), ("q3", "b", 1)], "query_id string, doc_id string, rank int")
    documents = spark.createDataFrame([("a", 1), ("b", 1), ("b", 3), ("c", 2), ("d", 2), ("e", 2), ("f", 2), ("g", None)], "doc_id string, class int")
    asked = spark.createDataFrame([("q1", 1, 2), ("q1", 2, 1), ("q2", 1, 2), ("q2", 3, 2), ("q2", 2, 1), ("q3", 9, 2)], "query_id string, class int, grade int")
    classes, pairs = E.ByClass(documents, asked), documents.join(asked, "class").select("query_id", "doc_id", "grade")
    for least in (1, 2):
        for n in (1, 2, 3, 10):
            assert sorted(E.precision_recall_f1(run, classes, n, least).collect()) == sorted(E.precision_recall_f1(run, pairs, n, least).collect())
            assert sorted(E.ndcg(run, classes, n).collect()) == sorted(E.ndcg(run, pairs, n).collect())
    assert "windowspecdefinition(class#" in plan(E.precision_recall_f1(run, classes, 3, 2))
    assert isinstance(registered.qrels(spark, small), E.ByClass)


def test_both_runs_come_from_one_search(spark, small, monkeypatch):
    asked = []
    search = vectors.top_k
    monkeypatch.setattr(vectors, "top_k", lambda *a, **k: asked.append(1) or search(*a, **k))
    assert entry.queries()["run_difference"](spark, small).columns == ["query_id", "doc_changes", "docs_lost"]
    assert len(asked) == 1


@pytest.mark.parametrize("name", ("fused_documents", "retrieve_full"))
def test_texts_of_the_store_are_not_written_again(spark, small, monkeypatch, name):
    written = []
    real = registered.cut
    monkeypatch.setattr(registered, "cut", lambda df: written.append(df.columns) or real(df))
    found = entry.queries()[name](spark, small)
    assert found.count() and [c for c in written if "embedding" in c and "source" in c]
    assert not [c for c in written if "text" in c and "own" not in c]


def test_copies_and_the_query_are_looked_at_once(monkeypatch):
    from papyrix.operators import ranking

    cuts, looks = [], []
    cut, terms = ranking.limited, ranking.terms
    monkeypatch.setattr(ranking, "limited", lambda *a: cuts.append(a) or cut(*a))
    monkeypatch.setattr(ranking, "terms", lambda t: looks.append(t) or terms(t))
    rows = [{"chunk_id": f"c{i:02d}", "doc_id": f"d{i % 2}", "score": 1.0, "text": f"text {i // 20}", "query": "asked"} for i in range(60)]
    found = ranking._chosen(rows, 10, 2, 250)
    assert [(r["chunk_id"], r["text"]) for r in found] == [("c00", "text 0"), ("c20", "text 1"), ("c41", "text 2")]
    assert len(cuts) == 3 and looks.count("asked") == 1


def test_cleaning_sends_few_texts_to_python_at_once(spark, small):
    from papyrix.session import ARROW_ROWS

    spark.conf.set(ARROW_ROWS, "10000")
    entry.queries()["clean_documents"](spark, small)
    assert int(spark.conf.get(ARROW_ROWS)) <= 500


#: Queries over chunks of 50 words: names, and how often their plan may split texts into slices.
CHUNKED = {"count_mismatch": 2, "without_bibliographies": 2, "bad_records": 1, "misaligned_records": 2, "bad_positions": 1, "long_fragments": 1}


def test_no_text_is_shuffled_to_compare_records(spark):
    records = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", None), ("d", None), ("e", ""), ("only", "x"), ("g", None)], "chunk_id string, texto string")
    chunks = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", None), ("d", ""), ("e", ""), ("more", "x"), ("more2", None)], "chunk_id string, text string")
    found = checks.misaligned(records, chunks)
    assert sorted(r["chunk_id"] for r in found.collect()) == ["b", "d", "more", "only"]
    assert plan(found).count("sha2(") == 2 and "chunk#" in plan(found)


def test_words_of_slices_are_not_counted_again(spark, small):
    df = spark.createDataFrame([(1, "\u3000a b\nc  d e f g "), (2, "a b c"), (3, None), (4, " ")], "i int, t string")
    got = df.select("i", X.counted_slices(F.col("t"), 3).alias("s")).orderBy("i").collect()
    assert [[tuple(s) for s in r["s"]] for r in got] == [[("a b c", 3), ("d e f", 3), ("g", 1)], [("a b c", 3)], [], []]
    assert plan(entry.queries()["bad_records"](spark, small)).count("split(") == 1


@pytest.mark.parametrize("name", CHUNKED)
def test_chunk_queries_split_each_text_once(spark, small, name):
    made = [line for line in plan(entry.queries()[name](spark, small)).split("\n") if "posexplode(" in line]
    assert len(made) == CHUNKED[name] and all(line.count("split(") == 1 for line in made)


def test_words_are_split_without_a_class_of_ranges(spark):
    space = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
    texts = [*(f"{s}a{s}{s}\U0001f600 b\u200b{s}" for s in space), space, "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", X.words(F.col("t")).alias("w"))
    assert [r["w"] for r in df.orderBy("i").collect()] == [["a", "\U0001f600", "b\u200b"]] * len(space) + [[], [], None]
    assert "x09" not in plan(df) and "lambda" not in plan(df)


def test_no_text_is_shuffled_to_find_bibliographies(spark):
    from papyrix.operators import chunking

    rows = [(1, "csv", 0, "PMID: 1"), (1, "csv", 1, "a"), (2, "csv", 0, "a"), (2, "csv", 1, "PMID: 1"), (3, "txt", 0, "PMID: 1"), (4, "csv", 0, None)]
    df = spark.createDataFrame(rows, "doc_id long, format string, position int, text string")
    found = chunking.without_bibliographies(df)
    assert sorted((r["doc_id"], r["position"]) for r in found.collect()) == [(2, 0), (2, 1), (3, 0), (4, 0)]
    made = [line for line in plan(found).split("\n") if "Aggregate" in line]
    assert made and "min_by(dump" in made[0]


def test_row_numbers_come_without_a_window_over_rows(spark):
    from papyrix.operators import chunking

    df = spark.range(5000).selectExpr("pmod(id * 7919, 5000) * 2 as k", "id % 3 as other", "repeat('x', 20) as text")
    found = chunking.with_row_number(df, "k")
    assert found.columns == ["k", "other", "text", "row_number"] and found.filter("row_number * 2 <> k").count() == 0 and found.count() == 5000
    assert "row_number(" not in plan(found)
    twice = chunking.with_row_number(spark.range(10).selectExpr("id % 2 as k"), "k").collect()
    assert sorted(r["row_number"] for r in twice) == list(range(10)) and all(r["k"] == r["row_number"] // 5 for r in twice)
