from collections import defaultdict

import corpus_pipeline as P
from papyrix.llm import language_id as L


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_stages_equal_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    items = [set(shingles(r["text"])) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]

    one = P.language(spark, docs, small)
    model = L.train(docs)
    pred = {r["doc_id"]: r for r in L.predict(docs, model).collect()}
    want = {k for k in rows if pred[k]["lang_pred"] != "und" and pred[k]["score"] >= 0.5}
    assert {r["doc_id"] for r in one.collect()} == want and len(want) > 0.97 * len(rows)

    best = defaultdict(list)
    for k in want:
        best[lower(rows[k]["text"])].append(k)
    want = {max(v) for v in best.values()}
    two = P.exact(spark, one, small)
    assert {r["doc_id"] for r in two.collect()} == want

    sets = {k: set(shingles(rows[k]["text"])) for k in want}
    parent = {k: k for k in want}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(want)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    want = {k for k in want if find(k) == k}
    three = P.near(spark, two, small)
    assert {r["doc_id"] for r in three.collect()} == want

    want = {k for k in want if not any(i and 100 * len(i & sets[k]) >= 80 * len(i) for i in items)}
    four = P.benchmark(spark, three, small)
    assert {r["doc_id"] for r in four.collect()} == want
    assert one.columns == two.columns == three.columns == four.columns == docs.columns

    last = P.run(spark, small)
    assert last.columns == [*docs.columns, "size", "source_size", "target", "repetitions", "taken"]
    final = {r["doc_id"]: r for r in last.collect()}
    assert all((r["text"], r["lang"], r["source"]) == (rows[k]["text"], rows[k]["lang"], rows[k]["source"]) for k, r in final.items())
    assert set(final) <= want and all(1 <= r["repetitions"] <= 3 for r in final.values())
    taken, target = defaultdict(int), {}
    for k, r in final.items():
        taken[rows[k]["source"]] += r["taken"]
        target[rows[k]["source"]] = r["target"]
    assert sum(taken.values()) > 0.9 * sum(len(rows[k]["text"].encode().split()) for k in want)


def shingles(text, n=5):
    w = lower(text).encode().split()
    n = min(n, len(w))
    return (tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if n else ()


def test_names():
    assert [name for name, _ in P.STAGES] == ["language", "exact", "near", "benchmark", "mixture"] and P.ORACLE_SQL is None
