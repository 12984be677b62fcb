import hashlib

import pytest

from papyrix.llm import exact_dedup as X

SCHEMA = "doc_id long, text string, maybe int"
ROWS = [(1, "Ab"), (2, "aB"), (3, "É"), (4, "é"), (5, None), (6, ""), (7, "x" * 200_000), (8, "X" * 200_000), (9, "alone"), (None, "ab"), (10, "dup"), (10, "dup")]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("bits", [None, 17])
def test_equals_brute_force(spark, bits):
    docs = spark.createDataFrame([(k, t, 1) for k, t in ROWS], SCHEMA).repartition(3)
    groups = {}
    for k, t in ROWS:
        groups.setdefault(lower(t), []).append(k)
    want = []
    for k, t in ROWS:
        of = groups[lower(t)]
        keep = max((x for x in of if x is not None), default=None)
        want.append((k, keep, len(of), k == keep, hashlib.sha256(lower(t).encode()).hexdigest()))
    got = [tuple(r) for r in X.duplicate_groups(docs, bits=bits).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    kept = X.drop_exact_duplicates(docs, bits=bits)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(w[0] for w in want if w[3])


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert X.duplicate_groups(docs).count() == 0 and X.drop_exact_duplicates(docs).count() == 0


def test_unique_rows_pass_straight_through(spark):
    docs = spark.range(2000).selectExpr("id doc_id", "concat('text ', id) text").unionByName(spark.createDataFrame([(5000, "text 3")], "doc_id long, text string"))
    maybe = X.probed(X._narrow(docs, "doc_id", "text"), 28).filter("maybe")
    assert maybe.count() == 2


def test_no_python(spark):
    docs = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    plan = X.duplicate_groups(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
