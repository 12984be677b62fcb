"""Near-duplicates by MinHash: one-permutation hashing, optimal densification, banded buckets, star-shaped edges.

1. One pass makes each document's set of distinct word shingles and, by one permutation, its signature: the hash range
   is cut into BANDS * ROWS bins, a bin's value is its smallest hash, and an empty bin borrows that of the first
   non-empty bin in an order of its own (optimal densification). Documents with equal sets (128-bit digest) become one
   vertex, named by their smallest key.
2. Each band's ROWS values are a bucket. In a bucket every member gets one edge, to the smallest vertex, the star's
   centre. Edges are confirmed on full sets.
3. A star alone can miss a link between two of its leaves. With d = 1 - similarity, a metric, leaves that are linked lie
   within 1 - t of each other, so either both are within FAR + (1 - t) of the centre, and then belong to the centre's
   neighbourhood, or both are beyond FAR, and then they go on to the bucket's next round with another centre. What has
   gone through MAX_ROUNDS rounds is a neighbourhood as it is.
4. Components of the confirmed edges are labelled. A neighbourhood with more than one label is compared in blocks of
   about BLOCK members and ELEMENTS shingles, those of its largest label only with the others: a task gets two blocks,
   multiplies their incidence matrices, and gives only links that join different labels. So all pairs of a bucket are
   decided, but never emitted as rows.

With 40 bands of 5 rows a pair at similarity 0.8 shares no bucket with probability (1 - 0.8**5)**40 = 1.2e-7.

Sets of fewer than t / (1 - t) shingles can only be linked with equal sets and get no buckets. Null and blank texts have
an empty set and are linked with nothing. A null key is never linked: its component is null and it is kept. Rows that
share a key are one vertex, whose set is the one of theirs with the smallest digest; what is linked with any text that
has this as its smallest key has its component. Columns may have any names. An empty table gives an empty result. Texts of
any length are taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrix.llm.common import WordHashes, bit_is_set, bit_table, bits_for, cut, if_small, join_counted, marked_in, mixed, shingles, slot, text_batches, without_keys, words_of
from papyrix.operators import graph

ROWS = 5
BANDS = 40
FAR = 0.4
MAX_ROUNDS = 5
BLOCK, ELEMENTS = 256, 1 << 20

_U = np.uint64
_SEED = 20240229


def bin_orders(bins: int) -> np.ndarray:
    """For each bin (column) the order in which it looks for a non-empty one."""
    rng = np.random.default_rng(_SEED)
    return np.array([rng.permutation(bins) for _ in range(bins)], np.int64).T.copy()


def signature(hashes: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """hashes: sorted distinct values, not empty. One value for each bin."""
    bins = len(orders)
    at = ((hashes >> _U(32)) * _U(bins) >> _U(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    values, full = np.zeros(bins, _U), np.zeros(bins, bool)
    values[at[first]] = hashes[first]
    full[at[first]] = True
    empty = np.flatnonzero(~full)
    for depth in (24, bins):
        if len(empty) == 0:
            break
        ways = orders[:depth, empty]
        hit = full[ways]
        step = hit.argmax(axis=0)
        found = hit[step, np.arange(len(empty))]
        values[empty[found]] = values[ways[step, np.arange(len(empty))][found]]
        empty = empty[~found]
    return values


def band_hashes(values: np.ndarray, rows: int) -> np.ndarray:
    parts = values.reshape(-1, rows)
    out = np.arange(1, len(parts) + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)
    for k in range(rows):
        out = mixed(out ^ parts[:, k])
    return out


def shingle_set(text: str | None, size: int, words: WordHashes) -> np.ndarray:
    return np.unique(shingles(words.of(words_of(text)), size))


def signed(docs: DataFrame, key: str, text: str, size: int, rows: int, bands: int, least: int) -> DataFrame:
    """(key, n, d1, d2, bands): set size, digest of the set, bucket hashes (null for sets below ``least``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, orders = WordHashes(), bin_orders(rows * bands)
        for batch in text_batches(batches):
            n, d1, d2, buckets = [], [], [], []
            for value in batch.column(1):
                hashes = shingle_set(value.as_py(), size, words)
                one, two = digest_of(hashes)
                n.append(len(hashes))
                d1.append(one)
                d2.append(two)
                buckets.append(band_hashes(signature(hashes, orders), rows).astype(np.int64) if len(hashes) >= max(1, least) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(buckets, pa.list_(pa.int64()))], ["key", "n", "d1", "d2", "bands"])

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {docs.schema[key].dataType.simpleString()}, n bigint, d1 bigint, d2 bigint, bands array<bigint>")


def digest_of(hashes: np.ndarray) -> tuple[int, int]:
    whole = xxhash.xxh3_128_intdigest(hashes)
    return (whole >> 64) - (1 << 63), (whole & ((1 << 64) - 1)) - (1 << 63)


def sets_of(docs: DataFrame, vertices: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """vertices: (v, d1, d2), which cut() gave. (v, set) for each. A bit table keeps most other texts from Python."""
    rows = marked_in(docs.select(F.col(key).alias("v"), F.col(text).alias("text")), vertices, F.xxhash64("v"), F.xxhash64("v"), "_maybe").filter("_maybe").select("v", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in text_batches(batches):
            found = [shingle_set(value.as_py(), size, words) for value in batch.column(1)]
            digests = [digest_of(s) for s in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([d[k] for d in digests], pa.int64()) for k in (0, 1)], pa.array([s.astype(np.int64) for s in found], pa.list_(pa.int64()))], ["v", "d1", "d2", "set"])

    made = rows.mapInArrow(run, f"v {docs.schema[key].dataType.simpleString()}, d1 bigint, d2 bigint, set array<bigint>")
    return made.join(vertices, ["v", "d1", "d2"], "left_semi").dropDuplicates(["v"]).select("v", "set")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (c, v): adds n_c, n_v and their intersection's size."""
    left = sets.select(F.col("v").alias("c"), F.col("set").alias("set_c"))
    out = pairs.join(left, "c").join(sets, "v")
    return out.select("c", "v", F.size("set_c").alias("n_c"), F.size("set").alias("n_v"), F.size(F.array_intersect("set_c", "set")).alias("shared"))


def _stars(members: DataFrame) -> DataFrame:
    """members (bucket, v): (bucket, c, v) for each member but the centre, of buckets with two members or more."""
    centres = members.groupBy("bucket").agg(F.min("v").alias("c"), F.count("*").alias("size")).filter("size > 1").drop("size")
    return members.join(centres, "bucket").filter("v <> c").select("bucket", "c", "v")


def block_links(sets: list[np.ndarray], labels: list, percent: int, width: int = 1 << 14) -> list[tuple[int, int]]:
    """Positions of linked sets under different labels, a link for each two labels that become one."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    values, where = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), sizes)
    shared = np.zeros((n, n), np.float32)
    order = np.argsort(where, kind="stable")
    where, owner = where[order], owner[order]
    for low in range(0, len(values), width):
        a, b = np.searchsorted(where, (low, low + width))
        part = np.zeros((n, min(width, len(values) - low)), np.float32)
        part[owner[a:b], where[a:b] - low] = 1
        shared += part @ part.T
    union = sizes[:, None] + sizes[None, :] - shared
    root = {label: label for label in labels}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links = []
    for i, j in np.argwhere(np.triu(100 * shared >= percent * union, 1)).tolist():
        a, b = find(labels[i]), find(labels[j])
        if a != b:
            root[max(a, b)] = min(a, b)
            links.append((i, j))
    return links


def _inner_links(groups: DataFrame, labels: DataFrame, sets: DataFrame, percent: int, kind: str) -> DataFrame:
    """groups (g, v, n): links (a, b) between members of a group that have different labels. n: the set's size."""
    named = cut(groups.join(labels, "v", "left").select("g", "v", "n", F.coalesce("label", "v").alias("label")))
    # members of a group's largest label needn't meet each other: they are dealt into blocks of their own
    of_label = named.groupBy("g", "label").agg(F.count("*").alias("members"), F.sum("n").alias("elements"))
    sizes = of_label.groupBy("g").agg(F.max_by(F.struct("label", "members", "elements"), F.struct("members", "label")).alias("main"), F.sum("members").alias("members"), F.sum("elements").alias("elements"))
    sizes = sizes.filter(F.col("members") > F.col("main.members"))
    dealt = lambda members, elements: F.ceil(F.greatest(members / BLOCK, elements / ELEMENTS)).cast("int")
    sizes = cut(
        sizes.select(
            "g",
            "members",
            F.col("main.label").alias("main"),
            dealt(F.col("main.members"), F.col("main.elements")).alias("main_blocks"),
            dealt(F.col("members") - F.col("main.members"), F.col("elements") - F.col("main.elements")).alias("other_blocks"),
        )
    )
    inside = F.col("label") == F.col("main")
    main_blocks, other_blocks = F.col("main_blocks"), F.col("other_blocks")
    rows = (
        join_counted(named, sizes, ["g"], "members")
        .withColumn("own", F.when(inside, F.pmod(F.xxhash64("v"), main_blocks)).otherwise(main_blocks + F.pmod(F.xxhash64("v"), other_blocks)).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.when(inside, main_blocks).otherwise(0), main_blocks + other_blocks - 1)))
        .select("g", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "v", "label")
        .join(sets, "v")
    )

    def run(got: pa.Table) -> pa.Table:
        v, label = got["v"].to_pylist(), got["label"].to_pylist()
        found = block_links([np.asarray(s, np.int64) for s in got["set"].to_numpy()], label, percent)
        like = got.schema.field("v").type
        return pa.table([pa.array([v[i] for i, _ in found], like), pa.array([v[j] for _, j in found], like)], ["a", "b"])

    return rows.groupBy("g", "i", "j").applyInArrow(run, f"a {kind}, b {kind}")


def _labels(edges: DataFrame) -> DataFrame:
    """edges (a, b): (v, label), the smallest vertex that each reaches."""
    made = graph.components(edges.select(F.col("a").alias("src"), F.col("b").alias("dst")))
    return made.select(F.col("node").alias("v"), F.col("component").alias("label"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """One row per document: key, n_shingles, component_id, kept, component's set_id (its smallest key with an equal set).

    size: words in a shingle. percent: links have 100 * intersection >= percent * union.
    """
    least = -(-percent // (100 - percent)) if percent < 100 else 1 << 62
    kind = docs.schema[key].dataType.simpleString()
    sketch = cut(signed(docs, key, text, size, rows, bands, least))
    digest = ["n", "d1", "d2"]
    classes = sketch.filter("n > 0 and key is not null").groupBy(*digest).agg(F.min("key").alias("rep"), F.first("bands").alias("bands"))
    classes = cut(classes)
    # keys that several texts have: the smallest digest is the vertex
    twice = cut(classes.groupBy("rep").agg(F.min(F.struct(*digest)).alias("own"), F.count("*").alias("_n")).filter("_n > 1").select("rep", "own"))
    vertices = classes.filter("bands is not null").join(if_small(twice), "rep", "left").filter(F.col("own").isNull() | (F.col("own") == F.struct(*digest)))
    members = vertices.select(F.explode("bands").alias("bucket"), F.col("rep").alias("v"))
    bits = bits_for(classes.count() * bands, 8)
    shared = members.select(slot(F.col("bucket"), bits).alias("slot")).groupBy("slot").count().filter("count > 1")
    probe = F.broadcast(bit_table(shared).withColumnRenamed("bucket", "_bucket"))
    members = members.withColumn("_at", slot(F.col("bucket"), bits)).join(probe, F.bitmap_bucket_number("_at") == F.col("_bucket")).filter(bit_is_set(F.col("bitmap"), F.col("_at")))
    stars = cut(_stars(cut(members.select("bucket", "v"))))
    found = stars.select(F.col("c").alias("rep")).unionByName(stars.select(F.col("v").alias("rep"))).distinct()
    sets = cut(sets_of(docs, cut(vertices.select("rep", "d1", "d2").join(found, "rep", "left_semi").withColumnRenamed("rep", "v")), key, text, size))

    similarity = F.col("shared") / (F.col("n_c") + F.col("n_v") - F.col("shared"))
    slack = 1 - percent / 100
    pairs, groups = [], []
    for turn in range(MAX_ROUNDS):
        found = cut(_confirmed(stars.select("c", "v").distinct(), sets))
        pairs.append(found.filter(100 * F.col("shared") >= percent * (F.col("n_c") + F.col("n_v") - F.col("shared"))).select(F.col("c").alias("a"), F.col("v").alias("b")))
        near = found.filter(similarity >= 1 - FAR - slack - 1e-9)
        group = F.col("c").cast("string").alias("g")
        groups.append(near.select(group, "v", F.col("n_v").alias("n")).unionByName(near.select(group, F.col("c").alias("v"), F.col("n_c").alias("n"))).distinct())
        far = found.filter(similarity <= 1 - FAR + 1e-9).select("c", "v")
        rest = stars.join(far, ["c", "v"], "left_semi").select("bucket", "v")
        if turn < MAX_ROUNDS - 1:
            stars = cut(_stars(rest))
            if not stars.limit(1).count():
                break
        else:
            sizes = sets.select("v", F.size("set").alias("n"))
            groups.append(rest.join(sizes, "v").select(F.concat(F.lit("bucket "), F.col("bucket")).alias("g"), "v", "n"))
    edges = pairs[0]
    for more in pairs[1:]:
        edges = edges.unionByName(more)
    edges = cut(edges.distinct())
    labels = _labels(edges)
    near = groups[0]
    for more in groups[1:]:
        near = near.unionByName(more)
    inner = cut(_inner_links(near.distinct(), labels, sets, percent, kind))
    if inner.limit(1).count():
        labels = _labels(edges.unionByName(inner).distinct())

    named = classes.join(labels.select(F.col("v").alias("rep"), "label"), "rep", "left").select(*digest, "rep", F.coalesce("label", "rep").alias("label"))
    out = sketch.select("key", *digest).join(named, digest, "left")
    component = F.when(F.col("key").isNotNull(), F.coalesce("label", "key"))
    return out.select(
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("key") == component, F.lit(True)).alias("kept"),
        F.when(F.col("key").isNotNull(), F.coalesce("rep", "key")).alias("set_id"),
    )


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose key is the smallest of its component, and those with a null key; all columns."""
    return without_keys(docs, near_duplicates(docs, key, text, size, percent).filter(~F.col("kept")).select(key), key)
