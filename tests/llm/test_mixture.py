import pytest

from papyrix.llm import mixture as M

SCHEMA = "doc_id long, text string, source string, size string"


def targets(sizes, weights=(1, 2, 3), epochs=3):
    """Water-filling in rounds."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left, weight = total - sum(fixed.values()), sum(w[s] for s in free)
        want = {s: left * w[s] / weight for s in free} if free else {}
        over = [s for s in free if want[s] > epochs * sizes[s] * (1 + 1e-12)]
        if not over:
            return {**fixed, **want}
        fixed |= {s: epochs * sizes[s] for s in over}


def docs_of(spark, sizes):
    rows, i = [], 0
    for source, lengths in sizes.items():
        for n in lengths:
            rows.append((i, " ".join(["w"] * n) if n else None, source, "x"))
            i += 1
    return spark.createDataFrame(rows, SCHEMA)


CASES = [
    {"a": [10] * 30, "b": [100] * 10, "c": [7] * 90, None: [50] * 5},
    {"a": [1], "b": [1000, 1000], "é": [3, 3]},
    {"a": [0, 0], "b": [5] * 10},
    {"only": [4, 5, 6]},
    {"big": [20] * 2000, "s1": [5] * 3, "s2": [6] * 3, "s3": [900]},
]


@pytest.mark.parametrize("sizes", CASES)
def test_targets_and_takings(spark, sizes):
    got = M.mix(docs_of(spark, sizes)).collect()
    total = {s: sum(v) for s, v in sizes.items()}
    want = targets(total)
    source = {}
    i = 0
    for s, lengths in sizes.items():
        for _ in lengths:
            source[i] = s
            i += 1
    taken = dict.fromkeys(sizes, 0)
    assert len(got) == len(source)
    for r in got:
        s = source[r["doc_id"]]
        assert r["target"] == pytest.approx(want[s]) and r["source_size"] == total[s]
        assert r["taken"] == r["size"] * r["repetitions"] <= 3 * r["size"]
        taken[s] += r["taken"]
    for s, v in sizes.items():
        assert abs(taken[s] - want[s]) <= max(v) / 2 + 1e-6
    assert sum(want.values()) == pytest.approx(sum(total.values()))


def test_reruns_agree(spark):
    docs = docs_of(spark, CASES[0])
    rows = lambda d: sorted(map(tuple, M.mix(d).collect()))
    assert rows(docs) == rows(docs.repartition(7)) != rows(docs.withColumn("doc_id", docs["doc_id"] + 1000))
    twice = M.mix(docs.unionByName(docs)).collect()
    assert len(twice) == 2 * docs.count()


def test_edges(spark):
    assert M.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    got = M.mix(spark.createDataFrame([(None, "a b", None, ""), (None, None, None, ""), (3, " ", "x", "")], SCHEMA)).collect()
    assert sorted((r["size"], r["taken"]) for r in got) == [(0, 0), (0, 0), (2, 2)]
    plan = M.mix(spark.createDataFrame([], SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
