import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from papyrix.functions import pytext as P
from papyrix.functions import segment as S
from papyrix.functions import text as X


def column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("t"))).collect()]


@pytest.mark.parametrize(
    "rule,given_text,expected",
    [
        (X.strip_control, "Barany,\x07Armies\x07of\x07Arabia", "Barany, Armies of Arabia"),
        (X.strip_control, "a\u200bb", "ab"),
        (X.dehyphenate, "infor-\nmación", "información"),
        (X.dehyphenate, "Latino-\nAmericano", "Latino-\nAmericano"),
        (X.strip_anonymous_columns, "columna_1: 0\nx: 1", "x: 1"),
        (X.strip_anonymous_columns, "columna_1: 2020-01-01", "columna_1: 2020-01-01"),
        (X.collapse_whitespace, "a  b\n c\n\n\nd", "a b c\n\nd"),
        (lambda t: X.collapse_whitespace(t, True), "a  b\n c\n\n\nd", "a b\nc\n\nd"),
        (X.line_breaks, "a\r\nb\rc\x0cd\x0be\u2028f\u2029g", "a\nb\nc\n\nd\ne\nf\n\ng"),
        (X.strip_spaced_letters, "x a b c d e f g h i j k y12", " y12"),
        (X.snake_case, "CreationDate", "creation_date"),
        (X.normal_path, r" .\a\b.pdf", "a/b.pdf"),
    ],
)
def test_rules(spark, rule, given_text, expected):
    assert column(spark, [given_text, None], rule) == [expected, None]


def test_counts(spark):
    assert column(spark, ["a b\n\nc \n \n d", "", "  "], X.paragraph_count) == [3, 0, 0]
    assert column(spark, ["a b\x1cc", "", " "], X.word_count) == [3, 0, 0]
    assert column(spark, [" ".join(["w"] * 501)], lambda t: F.transform(X.hard_slices(t), X.word_count)) == [[250, 250, 1]]
    assert column(spark, ["q016", "q017", "q050", "q051", "x"], X.topic_of_query) == [1, 2, 3, None, None]
    assert column(spark, ["F2-ESA-001", "X"], X.topic_of_document) == [2, None]


def test_repeat_threshold(spark):
    df = spark.createDataFrame([(14883,), (9931,), (508576,), (88099,), (10,)], "n int")
    assert [r[0] for r in df.select(X.repeat_threshold(F.col("n"))).collect()] == [19, 13, 636, 111, 5]


def test_stable_draw(spark):
    import hashlib

    keys = [f"d{i}" for i in range(300)]
    want = [int(hashlib.md5(k.encode()).hexdigest(), 16) % 7 == 0 for k in keys]
    assert column(spark, keys, lambda k: X.stable_draw(k, 7)) == want


def test_furniture():
    page = "foot note of the page here"
    texts = [f"w{i} " + " ".join(f"v{i}x{j}" for j in range(33)) for i in range(5)]
    four, five = [" ".join(f"{page} {t}" for t in texts[:n]) for n in (4, 5)]
    assert P.strip_furniture(four) == four
    assert P.strip_furniture(five).count(page) == 1
    assert P.strip_furniture("short text") == "short text"


def test_glyphs():
    secret = "The cat and the dog are for you that with from this not has been, and the and of was "
    marks = "".join(f"(cid:{ord(c) - 3})" for c in secret)
    assert P.decode_glyphs(marks) == secret
    assert P.decode_glyphs("x(cid:7)(cid:9)y") == "x  y"
    assert P.decode_glyphs("plain") == "plain"


def test_clean_documents(spark):
    from papyrix.plans.ingest import clean_documents

    rows = [("a", "txt", "Café  y\ntarea", {"k": "v"}), ("b", "csv", "columna_1: 3\nx: 1\n\ny:  2", None), ("c", None, None, None)]
    out = {r["doc_id"]: r for r in clean_documents(spark.createDataFrame(rows, "doc_id string, format string, text string, metadata map<string,string>")).collect()}
    assert out["a"]["text"] == "Café y tarea" and out["a"]["metadata"]["k"] == "v"
    assert out["b"]["text"] == "x: 1\n\ny: 2" and out["c"]["text"] == ""
    assert unicodedata.is_normalized("NFC", out["a"]["text"])


def test_sentences():
    assert S.sentences("Ver Art. 31 hoy. Luego sigue.") == ["Ver Art. 31 hoy.", "Luego sigue."]
    assert S.sentences("Dijo «sí.» Luego J. Smith vino. fin") == ["Dijo «sí.»", "Luego J. Smith vino. fin"]
    assert S.sentences("一。 二。 三") == ["一。", "二。", "三"]
    assert S.sentences("") == [""]


def test_rejoined():
    assert S.rejoined(["the AI mod", "els were"]) == ["the AI mod els were"]
    assert S.rejoined(["Figure 1.2.1", "Number of AI patents"]) == ["Figure 1.2.1", "Number of AI patents"]
    assert S.rejoined([]) == []


def test_chunks_by_levels():
    assert list(S.chunks("  \n\n ")) == [] and list(S.chunks(None)) == []
    long = " ".join(["word"] * 400)
    assert [(c.position, c.num_tokens, c.cut_level) for c in S.chunks(long)] == [(0, 350, 4), (1, 50, 4)]
    assert [c.num_tokens for c in S.chunks("a b\n\nc d", budget=2)] == [2, 2]
    row = next(S.chunks("alpha\n\nBeta"))
    assert row.text == "alpha\n\nBeta" and row.n_units == 2 and row.cut_level == 1


texts = st.text(alphabet=st.sampled_from("ab .;:\n!?éÑ9\"»"), max_size=400)
bare = lambda s: re.sub(r"\s", "", s)


@settings(max_examples=150, deadline=None)
@given(texts, st.integers(1, 8))
def test_nothing_is_lost(text, budget):
    chunks = list(S.chunks(text, budget=budget))
    assert bare("".join(c.text for c in chunks)) == bare(text)
    assert [c.position for c in chunks] == list(range(len(chunks)))
    assert all(c.num_tokens <= budget for c in chunks)
    parts = S.limited(text, budget)
    assert bare("".join(parts)) == bare(text) and all(len(p.split()) <= budget for p in parts)
    assert bare("".join(S.sentences(text))) == bare(text)


def test_chunking_is_repeatable(spark, small):
    from papyrix.operators import checks, chunking

    docs = spark.read.parquet(f"{small}/documents.parquet").withColumn("format", F.lit("txt"))
    make = lambda d: chunking.chunk_documents(d, block="\n").select("doc_id", "chunk_id", "text", "position", "num_tokens", "cut_level", "format")
    a, b = make(docs).cache(), make(docs.repartition(7))
    assert checks.different(a, b).count() == 0
    assert checks.uncovered(docs, a).count() == 0
    assert checks.bad_positions(a).count() == 0 and checks.over_budget(a, 350).count() == 0
    assert checks.repeated(a, "chunk_id").count() == 0


def test_udtfs(spark):
    S.register(spark)
    rows = spark.sql("SELECT c.* FROM (VALUES ('Uno. Dos.'), (NULL)) t(x), LATERAL split_sentences(x) c").collect()
    assert [(r[0], r[1]) for r in rows] == [(0, "Uno."), (1, "Dos.")]
    assert spark.sql("SELECT c.num_tokens FROM (VALUES ('a b c')) t(x), LATERAL chunk_text(x, false, 2, '\n\n') c").count() == 2


def test_row_numbers(spark):
    from papyrix.operators.chunking import with_row_number

    df = spark.range(1000).selectExpr("(id * 7919) % 1000 as k")
    assert with_row_number(df, "k").filter("k <> row_number").count() == 0
    assert with_row_number(spark.range(0).withColumnRenamed("id", "k"), "k").count() == 0
