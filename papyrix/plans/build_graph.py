"""Chunks to the knowledge graph, and queries to evidence in it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrix.operators import chunking, graph

ORDER = ["doc_id", "position", "unit", "nth"]


def build(chunks: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(triples, nodes, edges) of chunks: doc_id, chunk_id, position, format, text."""
    units = chunking.recogniser_units(chunking.without_bibliographies(chunks).select("doc_id", "chunk_id", "position", "format", "text"))
    triples = graph.with_keys(graph.extract_triples(units))
    triples = triples.withColumn("ordinal", F.struct(*ORDER))
    return triples, graph.nodes(triples, ["ordinal"]), graph.edges(triples, ["ordinal"])


def query_evidence(queries: DataFrame, nodes: DataFrame, edges: DataFrame, entities: DataFrame | None = None, chunk_ids: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(seeds, evidence). entities: (query_id, type, key) recognised beforehand; other queries are matched literally."""
    keys = graph.node_keys(nodes)
    seeds = graph.literal_links(queries if entities is None else queries.join(entities.select("query_id"), "query_id", "left_anti"), keys)
    if entities is not None:
        seeds = seeds.unionByName(graph.link(entities, nodes, keys)).distinct()
    return seeds, graph.evidence(seeds, nodes, edges, chunk_ids)

