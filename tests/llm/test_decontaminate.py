import random

from hypothesis import given
from hypothesis import strategies as st

from papyrix.llm import decontaminate as D

DOCS, ITEMS = "doc_id long, text string, item_id string", "item_id long, text string"


def brute(docs, items, size=5, percent=80):
    sets = lambda text, n: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w := (text or "").encode().lower().split()) >= n else set()
    out = set()
    for item, body in items:
        n = min(size, len((body or "").split()))
        want = sets(body, n) if n else set()
        for doc, text in docs:
            both = len(want & sets(text, n)) if want else 0
            if item is not None and doc is not None and both and 100 * both >= percent * len(want):
                out.add((doc, item, both, len(want)))
    return out


def fixture(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    items = [(i, text(rng.choice([1, 3, 5, 12, 40, 70]))) for i in range(40)] + [(97, None), (98, " "), (None, "x y z")]
    docs = []
    for i in range(120):
        body = text(rng.randint(0, 400)).split()
        if rng.random() < 0.6:
            inner = rng.choice(items[:40])[1].upper().split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                inner[rng.randrange(len(inner))] = "changed"
            at = rng.randint(0, len(body))
            body[at:at] = inner
        docs.append((i, " ".join(body)))
    return docs + [(500, None), (501, ""), (None, items[4][1]), (7, docs[7][1])], items


def test_equals_brute_force(spark):
    for seed in (1, 2):
        docs, items = fixture(seed)
        d = spark.createDataFrame([(k, t, "x") for k, t in docs], DOCS).repartition(4)
        got = [tuple(r) for r in D.leaks(d, spark.createDataFrame(items, ITEMS)).select("doc_id", "item_id", "shared", "n_item").collect()]
        want = brute(docs, items)
        assert len(got) == len(set(got)) and set(got) == want and want
        gone = {x[0] for x in want}
        kept = D.drop_leaks(d, spark.createDataFrame(items, ITEMS))
        assert kept.columns == d.columns
        assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(k) for k, _ in docs if k not in gone)


def test_a_small_bit_table_only_costs(spark):
    docs, items = fixture(3)
    got = D.leaks(spark.createDataFrame([(k, t, "x") for k, t in docs], DOCS), spark.createDataFrame(items, ITEMS), bits=15)
    assert {tuple(r) for r in got.select("doc_id", "item_id", "shared", "n_item").collect()} == brute(docs, items)


def test_empty(spark):
    none, no_items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "a b c d e f", "x")], DOCS)
    assert D.leaks(none, no_items).count() == 0 and D.leaks(some, no_items).count() == 0
    assert D.drop_leaks(some, no_items).count() == 1


@given(st.integers(1, 500), st.integers(50, 99))
def test_a_signature_can_not_be_missed(n, percent):
    """Whatever part of a set a document lacks, it has one of the signature's hashes."""
    top = 1 << (n - 1).bit_length()
    k = min(n, int(top * (100 - percent) / 100) + 1)
    most_missing = n - -(-percent * n // 100)
    assert k > most_missing


def test_signatures_are_what_is_searched(spark):
    docs, items = fixture(4)
    d, i = spark.createDataFrame([(k, t, "x") for k, t in docs], DOCS).coalesce(1), spark.createDataFrame(items, ITEMS).coalesce(1)
    sets = D.item_shingles(i, "item_id", "text", 5).cache()
    signature = D.signatures(sets, 80).cache()
    assert signature.count() < sets.count() / 2
    hits = D.document_hits(d, signature, sets, "doc_id", "text", 5).collect()
    signed = {r["hash"] for r in signature.collect()}
    by_row = {}
    for r in hits:
        by_row.setdefault(r["row"], []).append(r)
    # only documents with a signature's hash give anything, and of what they give only that hash is joined to find items
    assert by_row and all(any(r["hash"] in signed for r in rows) for rows in by_row.values())
    assert all(r["signed"] == (r["hash"] in signed) for r in hits) and any(not r["signed"] for r in hits)
    leaking = {x[0] for x in brute(docs, items)}
    assert leaking <= {r["doc"] for r in hits}


def test_rows_that_share_keys(spark):
    inside = "a b c d e f g h i j"
    docs = spark.createDataFrame([(1, inside[:9], "x"), (1, inside[8:], "x"), (2, inside, "x"), (2, inside, "x")], DOCS)
    items = spark.createDataFrame([(5, inside), (5, "z y x w v u")], ITEMS)
    assert [tuple(r) for r in D.leaks(docs, items).select("doc_id", "item_id", "shared", "n_item").collect()] == [(2, 5, 6, 6)]
    assert sorted(r["doc_id"] for r in D.drop_leaks(docs, items).collect()) == [1, 1]
