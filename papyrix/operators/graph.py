"""The knowledge graph: mentions to triples to nodes and edges, and what the graph says about chunks.

Order matters where "first" is said, so triples carry an ordinal; results don't depend on how rows are dealt.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papyrix.functions import relations as R
from papyrix.functions.names import ALIASES, INITIALS_SKIP, alias_keys, name_key_column
from papyrix.functions.text import heads, is_plural_of, may_be_acronym, once
from papyrix.operators.flat import flat_map
from papyrix.session import cut, if_small

MAX_EVIDENCE, MAX_VARIANTS, NEIGHBOUR, MAX_CHUNKS = 10, 8, 0.4, 60
MIN_KEY = 4

_TRIPLE = (
    T.StructType().add("subject", "string").add("subject_type", "string").add("relation", "string").add("object", "string")
    .add("object_type", "string").add("evidence", "string").add("passive", "boolean").add("nth", "integer")
)
_MENTION = T.StructType().add("start", "integer").add("end", "integer").add("form", "string").add("label", "string")


def find_mentions(units: DataFrame, aliases: Mapping[str, Sequence[str]] = ALIASES, label: str = "organization", text: str = "text") -> DataFrame:
    pattern = R.gazetteer(aliases)
    return flat_map(units, [text], lambda t: ((m.start, m.end, m.text, m.label) for m in R.mentions(t or "", pattern, label)), _MENTION)


def extract_triples(units: DataFrame, aliases: Mapping[str, Sequence[str]] = ALIASES, label: str = "organization", max_gap: int = R.MAX_GAP, co_occurrence: bool = False, skip_cover: bool = True) -> DataFrame:
    """units: doc_id, chunk_id, position, text. Triples between entities of the gazetteer; covers (position 0) are left out."""
    pattern, known = R.gazetteer(aliases), alias_keys(aliases)

    def of(text: str | None):
        found = R.mentions(text or "", pattern, label)
        if len(found) > 1:
            yield from ((*t, i) for i, t in enumerate(R.triples(text, found, known, max_gap, co_occurrence)))

    rows = units.filter("position <> 0") if skip_cover else units
    return flat_map(rows, ["text"], of, _TRIPLE).drop("text")


def with_keys(triples: DataFrame) -> DataFrame:
    """Adds src and dst, "type:key" of subject and object."""
    node = lambda kind, name: F.concat_ws(":", kind, name_key_column(name))
    return triples.withColumn("src", node("subject_type", "subject")).withColumn("dst", node("object_type", "object"))


def first_distinct(order: list[str], value: str, limit: int) -> Column:
    """The first ``limit`` different values in order; nulls and empty ones don't count."""
    pairs = F.array_sort(F.collect_list(F.when(F.coalesce(F.col(value), F.lit("")) != "", F.struct(*order, F.col(value).alias("_v")))))
    return F.slice(F.array_distinct(F.transform(pairs, lambda p: p["_v"])), 1, limit)


def _firsts(rows: DataFrame, keys: list[str], value: str, order: list[str], limit: int, name: str) -> DataFrame:
    """As first_distinct(), but no group is gathered: each value's first place, then the first ``limit`` places."""
    each = rows.filter(F.coalesce(F.col(value), F.lit("")) != "").groupBy(*keys, value).agg(F.min(F.struct(*order)).alias("_at"))
    best = each.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy("_at", value))).filter(F.col("_n") <= limit)
    return best.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", value))), lambda p: p[value]).alias(name))


def edges(triples: DataFrame, order: list[str], limit: int = MAX_EVIDENCE) -> DataFrame:
    """triples with src, dst. One row per (src, relation, dst): weight, first evidence, first ``limit`` different chunks."""
    keys = ["src", "relation", "dst"]
    first = F.min(F.struct(*order, "doc_id", "chunk_id", F.substring("evidence", 1, 200).alias("evidence"), "passive"))
    base = triples.groupBy(*keys).agg(F.count("*").alias("weight"), first.alias("_f"))
    out = base.join(_firsts(triples, keys, "chunk_id", order, limit, "chunk_ids"), keys, "left")
    return out.select(*keys, "weight", F.col("_f.doc_id").alias("doc_id"), F.col("_f.chunk_id").alias("chunk_id"), "chunk_ids", F.col("_f.evidence").alias("evidence"), F.col("_f.passive").alias("passive"))


def nodes(triples: DataFrame, order: list[str], limit: int = MAX_EVIDENCE) -> DataFrame:
    """One row per node: name (its commonest form), type, topics, first chunks, all variants."""
    side = lambda node, name, kind: triples.select(F.col(node).alias("node"), F.col(name).alias("form"), F.col(kind).alias("type"), "doc_id", "chunk_id", *order)
    seen = side("src", "subject", "subject_type").unionByName(side("dst", "object", "object_type"))
    forms = seen.groupBy("node", "type", "form").count()
    named = forms.groupBy("node", "type").agg(F.min_by("form", F.struct((-F.col("count")).alias("n"), "form")).alias("name"), F.sort_array(F.collect_set("form")).alias("variants"))
    topic = F.when(F.col("doc_id").startswith("F"), F.substring("doc_id", 2, 1)).otherwise("?")
    topics = seen.groupBy("node").agg(F.sort_array(F.collect_set(topic)).alias("topics"))
    out = named.join(topics, "node").join(_firsts(seen, ["node"], "chunk_id", order, limit, "chunk_ids"), "node", "left")
    return out.select("node", "name", "type", F.array_join("topics", "").alias("topics"), "chunk_ids", F.size("chunk_ids").alias("n_chunks"), "variants", F.size("variants").alias("n_variants"))


def degrees(edge_rows: DataFrame) -> DataFrame:
    """Edges in and out; parallel ones count, a loop counts twice."""
    return edge_rows.select(F.explode(F.array("src", "dst")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))


def entity_weight(degree: Column) -> Column:
    return 1 / F.log2(2 + F.coalesce(degree, F.lit(0)))


def merge_by_key(node_rows: DataFrame, edge_rows: DataFrame, limit: int = MAX_EVIDENCE) -> tuple[DataFrame, DataFrame]:
    """Nodes whose names share type and key become one, named as the one of the highest degree; loops that arise go."""
    new = node_rows.withColumn("new", F.concat_ws(":", "type", name_key_column("name"))).join(degrees(edge_rows), "node", "left")
    order = F.struct((-F.coalesce("degree", F.lit(0))).alias("d"), "name", "node")
    merged = new.groupBy("new").agg(
        F.min_by("name", order).alias("name"),
        F.min_by("type", order).alias("type"),
        F.array_join(F.array_sort(F.array_distinct(F.filter(F.split(F.array_join(F.sort_array(F.collect_set("topics")), ""), ""), lambda c: c != ""))), "").alias("topics"),
        F.sort_array(F.collect_set("name")).alias("variants"),
    )
    listed = _firsts(new.select("new", "node", F.posexplode("chunk_ids").alias("at", "chunk_id")), ["new"], "chunk_id", ["node", "at"], limit, "chunk_ids")
    none = F.array().cast("array<string>")
    merged = merged.join(listed, "new", "left").withColumn("chunk_ids", F.coalesce("chunk_ids", none))
    merged = merged.select(F.col("new").alias("node"), "name", "type", "topics", "chunk_ids", F.size("chunk_ids").alias("n_chunks"), "variants", F.size("variants").alias("n_variants"))
    to = new.select("node", "new")
    moved = edge_rows.join(to.withColumnRenamed("node", "src"), "src").drop("src").withColumnRenamed("new", "src").join(to.withColumnRenamed("node", "dst"), "dst").drop("dst").withColumnRenamed("new", "dst")
    moved = moved.filter("src <> dst")
    first = F.min(F.struct("doc_id", "chunk_id", "evidence", "passive"))
    keys = ["src", "relation", "dst"]
    listed = _firsts(moved.select(*keys, "doc_id", F.col("chunk_id").alias("first_chunk"), F.posexplode("chunk_ids").alias("at", "chunk_id")), keys, "chunk_id", ["doc_id", "first_chunk", "at"], limit, "chunk_ids")
    joined = moved.groupBy(*keys).agg(F.sum("weight").alias("weight"), first.alias("_f")).join(listed, keys, "left").withColumn("chunk_ids", F.coalesce("chunk_ids", none))
    return merged, joined.select("src", "relation", "dst", "weight", "_f.doc_id", "_f.chunk_id", "chunk_ids", "_f.evidence", "_f.passive")


def nucleus(node_rows: DataFrame, edge_rows: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Edges of weight ``least`` or more, and the nodes that they touch."""
    strong = edge_rows.filter(F.col("weight") >= least)
    touched = strong.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    return node_rows.join(touched, "node", "left_semi"), strong


def components(edge_rows: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each reaches, edges taken both ways."""
    both = edge_rows.select(F.col("src").alias("v"), F.col("dst").alias("u")).unionByName(edge_rows.select(F.col("dst").alias("v"), F.col("src").alias("u"))).distinct()
    both = cut(both)
    labels = cut(both.groupBy("v").agg(F.least(F.col("v"), F.min("u")).alias("label")))
    while True:
        nearest = both.join(labels.withColumnRenamed("v", "u"), "u").select("v", "label").unionByName(labels).groupBy("v").agg(F.min("label").alias("label"))
        jump = labels.select(F.col("v").alias("label"), F.col("label").alias("further"))
        new = cut(nearest.join(jump, "label", "left").select("v", F.least("label", F.coalesce("further", "label")).alias("label")))
        if not new.join(labels.withColumnRenamed("label", "old"), "v").filter("label <> old").limit(1).count():
            return new.select(F.col("v").alias("node"), F.col("label").alias("component"))
        labels = new


def node_keys(node_rows: DataFrame, limit: int | None = MAX_VARIANTS) -> DataFrame:
    """(key, node) of each node's name and stored variants."""
    variants = F.slice("variants", 1, limit) if limit else F.col("variants")
    forms = node_rows.select("node", "name", F.explode(F.array_union(F.array("name"), variants)).alias("form"))
    return forms.select(name_key_column("form").alias("key"), "node").filter("key <> ''").distinct()


def link(entities: DataFrame, node_rows: DataFrame, keys: DataFrame, known: Mapping[str, str] | None = None) -> DataFrame:
    """entities: (query_id, type, key). (query_id, node): the node "type:key" where there is one, else all with that key."""
    exact = entities.withColumn("node", F.concat_ws(":", "type", "key")).join(node_rows.select("node"), "node", "left_semi")
    rest = entities.join(exact.select("query_id", "type", "key"), ["query_id", "type", "key"], "left_anti")
    return exact.select("query_id", "node").unionByName(rest.join(keys, "key").select("query_id", "node")).distinct()


def literal_links(queries: DataFrame, keys: DataFrame, longest: int = 12, least: int = MIN_KEY) -> DataFrame:
    """(query_id, node): nodes one of whose keys is a run of whole words of the query's key. The query's runs of up to
    ``longest`` words are joined by equality; longer keys, if there are any, are looked up by containment."""
    asked = queries.select("query_id", name_key_column("text").alias("asked"))
    usable = cut(keys.filter(F.length("key") >= least).select("key", "node"))

    def runs(w: Column) -> Column:
        of = lambda n: F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, n), " "))
        return F.flatten(F.transform(F.sequence(F.lit(1), F.least(F.size(w), F.lit(longest))), of))

    found = F.array_distinct(F.filter(once(F.split("asked", " "), runs), lambda run: F.length(run) >= least))
    each = asked.select("query_id", F.explode(found).alias("key"))
    out = each.join(if_small(usable), "key").select("query_id", "node")
    long = usable.filter(F.size(F.split("key", " ")) > longest)
    if not long.isEmpty():
        within = F.concat(F.lit(" "), F.col("asked"), F.lit(" ")).contains(F.concat(F.lit(" "), F.col("key"), F.lit(" ")))
        out = out.unionByName(asked.join(if_small(long), within).select("query_id", "node"))
    return out.distinct()


def evidence(seeds: DataFrame, node_rows: DataFrame, edge_rows: DataFrame, chunk_ids: DataFrame | None = None, most: int = MAX_CHUNKS, neighbour: float = NEIGHBOUR) -> DataFrame:
    """seeds: (query_id, node). (query_id, chunk_id, weight): the ``most`` chunks that the seeds speak for, weight up to 1.

    A seed gives its weight to its own chunks and, for each different neighbour, to the chunks of their edges (those from
    the seed, or if there are none those to it), and a share, by the neighbour's weight, to the neighbour's chunks.
    """
    weight = node_rows.select("node").join(degrees(edge_rows), "node", "left").select("node", entity_weight(F.col("degree")).alias("w"))
    from_seed = seeds.distinct().join(weight, "node")
    of_node = node_rows.select("node", F.explode("chunk_ids").alias("chunk_id"))
    own = from_seed.join(of_node, "node").select("query_id", "chunk_id", F.col("w").alias("part"))

    out_edges = edge_rows.select(F.col("src").alias("node"), F.col("dst").alias("other"), "chunk_ids", F.lit(0).alias("way"))
    in_edges = edge_rows.select(F.col("dst").alias("node"), F.col("src").alias("other"), "chunk_ids", F.lit(1).alias("way"))
    around = from_seed.join(out_edges.unionByName(in_edges), "node")
    way = F.min("way").over(W.partitionBy("query_id", "node", "other"))
    by_edge = around.withColumn("best", way).filter("way = best").select("query_id", F.explode("chunk_ids").alias("chunk_id"), F.col("w").alias("part"))
    near = around.select("query_id", "node", "other", "w").distinct().join(weight.select(F.col("node").alias("other"), F.col("w").alias("w_other")), "other")
    by_neighbour = near.join(of_node.withColumnRenamed("node", "other"), "other").select("query_id", "chunk_id", (F.col("w") * neighbour * F.col("w_other")).alias("part"))

    parts = own.unionByName(by_edge).unionByName(by_neighbour)
    if chunk_ids is not None:
        parts = parts.join(chunk_ids.select("chunk_id"), "chunk_id", "left_semi")
    total = parts.groupBy("query_id", "chunk_id").agg(F.round(F.sum("part"), 12).alias("weight"))
    order = W.partitionBy("query_id").orderBy(F.desc("weight"), "chunk_id")
    return total.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= most).select("query_id", "chunk_id", F.least(F.lit(1.0), F.col("weight")).alias("weight"))


def group_entities(entities: DataFrame, aliases: Mapping[str, Sequence[str]] = ALIASES) -> DataFrame:
    """entities: (name, label). One row per (type, key): shown name, n, variants with their counts. Blank ones are left out."""
    from papyrix.functions.names import OTHER, TYPES

    spark = entities.sparkSession
    known = alias_keys(aliases)
    table = spark.createDataFrame([(k, v) for k, v in known.items()], "key string, shown string")
    kinds = F.create_map(*[F.lit(x) for pair in TYPES.items() for x in pair])
    rows = entities.withColumn("key", name_key_column("name")).join(F.broadcast(table), "key", "left")
    rows = rows.withColumn("type", F.coalesce(kinds[F.lower(F.trim("label"))], F.lit(OTHER))).withColumn("key", F.when(F.col("shown").isNotNull(), name_key_column("shown")).otherwise(F.col("key")))
    rows = rows.filter("key <> ''").withColumn("shown", F.coalesce("shown", F.trim("name")))
    forms = rows.groupBy("type", "key", "shown", "name").count()
    return forms.groupBy("type", "key").agg(F.min("shown").alias("name"), F.sum("count").alias("n"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("name", F.col("count").cast("bigint"))))).alias("variants"))


def suggest_aliases(groups: DataFrame, least: int = 2) -> DataFrame:
    """groups: (type, key, name, n). Pairs of a type that may be one: an acronym and its long form, singular and plural."""
    often = groups.filter(F.col("n") >= least)
    long = often.filter(F.col("key").contains(" ")).select("type", heads(F.col("key"), tuple(sorted(INITIALS_SKIP))).alias("key"), F.col("name").alias("other"), F.col("n").alias("n_other"))
    short = often.filter(may_be_acronym(F.replace("key", F.lit(" "), F.lit("")))).withColumn("key", F.replace("key", F.lit(" "), F.lit("")))
    acronyms = short.join(long, ["type", "key"]).select("type", F.col("name").alias("short"), F.col("other").alias("long"), F.lit("initials").alias("why"), (F.col("n") + F.col("n_other")).alias("n"))
    # each key's possible singulars, joined by equality
    s = F.col("key")
    stem = lambda cut, add: F.concat(F.substring(s, F.lit(1), F.length(s) - cut), F.lit(add))
    singulars = F.array(stem(1, ""), stem(2, ""), stem(3, "z"), stem(3, "y"))
    many = often.select("type", F.col("key").alias("plural"), F.col("name").alias("plural_name"), F.col("n").alias("n_plural"), F.explode(F.array_distinct(singulars)).alias("key"))
    plurals = many.join(often, ["type", "key"]).filter(is_plural_of(F.col("plural"), F.col("key")))
    plurals = plurals.select("type", F.col("plural_name").alias("short"), F.col("name").alias("long"), F.lit("plural").alias("why"), (F.col("n") + F.col("n_plural")).alias("n"))
    return acronyms.unionByName(plurals)


def summary(node_rows: DataFrame, edge_rows: DataFrame, top: int = 10) -> DataFrame:
    """(what, name, n): nodes by type, edges by relation, the nodes of the highest degree."""
    hubs = degrees(edge_rows).orderBy(F.desc("degree"), "node").limit(top).select(F.lit("hub").alias("what"), F.col("node").alias("name"), F.col("degree").alias("n"))
    kinds = node_rows.groupBy(F.col("type").alias("name")).agg(F.count("*").alias("n")).select(F.lit("type").alias("what"), "name", "n")
    relations = edge_rows.groupBy(F.col("relation").alias("name")).agg(F.count("*").alias("n")).select(F.lit("relation").alias("what"), "name", "n")
    return kinds.unionByName(relations).unionByName(hubs)
