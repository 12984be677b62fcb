import random

import numpy as np
import pytest

from papyrix.llm import near_dedup as N
from papyrix.llm.common import WordHashes, shingles

SCHEMA = "doc_id long, text string"


def brute(rows, size, percent):
    """Components by comparing all pairs of shingle sets."""
    sets, out = {}, {}
    for key, text in rows:
        w = (text or "").encode().lower().split()
        n = min(size, len(w))
        sets[key] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both, one = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if both and 100 * both >= percent * one:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    for k in keys:
        out[k] = (len(sets[k]), find(k), find(k) == k)
    return out


def corpus(seed, groups=12, alone=40):
    """Chains of edits, copies, and texts that share half."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    text = lambda n: rng.choices(words, k=n)
    rows = [text(rng.randint(1, 60)) for _ in range(alone)]
    for _ in range(groups):
        base = text(rng.choice([4, 5, 8, 30, 120]))
        for _ in range(rng.randint(2, 25)):
            if rng.random() < 0.5:
                base = list(base)
            copy = base if rng.random() < 0.7 else list(base)
            for _ in range(max(1, len(base) // 25)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append(list(copy))
            if rng.random() < 0.3:
                rows.append(list(copy))
    half = text(60)
    rows += [half + text(40) for _ in range(15)]
    texts = [" ".join(r) for r in rows] + ["", None, " \t", "one", "ONE", "one two", "One  two", "a b a b a b"]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed,size,percent", [(1, 2, 80), (2, 2, 80), (3, 5, 80), (4, 3, 90)])
def test_equals_all_pairs(spark, seed, size, percent):
    rows = corpus(seed)
    got = N.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3), size=size, percent=percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == brute(rows, size, percent)


def test_without_stars_all_is_left_to_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "MAX_ROUNDS", 1)
    monkeypatch.setattr(N, "BLOCK", 3)
    rows = corpus(5, groups=5, alone=5)
    got = N.near_duplicates(spark.createDataFrame(rows, SCHEMA), size=2).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == brute(rows, 2, 80)


def test_edges_of_the_input(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert N.near_duplicates(empty).count() == 0 and N.drop_near_duplicates(empty).count() == 0
    text = "a b c d e f g h"
    rows = [(None, text), (5, text), (7, text), (7, text), (9, None)]
    docs = spark.createDataFrame([(k, t, 1) for k, t in rows], SCHEMA + ", n_shingles int")
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in N.near_duplicates(docs).collect()), key=repr)
    assert got == sorted([(None, None, True), (5, 5, True), (7, 5, False), (7, 5, False), (9, 9, True)], key=repr)
    kept = N.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted([r["doc_id"] for r in kept.collect()], key=str) == [5, 9, None]


def test_long_text(spark):
    rng = random.Random(0)
    long = [f"w{rng.randrange(10**6)}" for _ in range(60_000)]
    rows = [(1, " ".join(long)), (2, " ".join(long[:50_000])), (3, " ".join(long[:40_500]))]
    got = {r["doc_id"]: r["component_id"] for r in N.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: 1, 2: 1, 3: 1}


def test_signatures_estimate_similarity():
    words, orders = WordHashes(), N.bin_orders(N.ROWS * N.BANDS)
    rng = random.Random(3)
    for n in (3, 20, 400):
        agree = []
        for _ in range(60):
            base = [str(rng.random()).encode() for _ in range(n)]
            other = base[: n * 2 // 3] + [str(rng.random()).encode() for _ in range(n - n * 2 // 3)]
            a, b = (np.unique(words.of(x)) for x in (base, other))
            agree.append((N.signature(a, orders) == N.signature(b, orders)).mean())
        shared = n * 2 // 3
        assert abs(np.mean(agree) - shared / (2 * n - shared)) < 0.08


def test_shingles():
    h = np.array([1, 2, 3], np.uint64)
    assert len(shingles(h, 2)) == 2 and len(shingles(h, 9)) == 1 and len(shingles(h[:0], 2)) == 0
    assert shingles(h, 2)[0] != shingles(h[::-1], 2)[1]


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 101), (103, 101)]
    got = {r["v"]: r["label"] for r in N._labels(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(31), 0), 100: 100, 101: 100, 103: 100}
    assert N._labels(spark.createDataFrame([], "a long, b long")).count() == 0
