import pytest
from pyspark.sql import functions as F

from papyrix.functions import names as N
from papyrix.functions import relations as R
from papyrix.functions import text as X
from papyrix.operators import graph as G
from papyrix.sources import stores


@pytest.mark.parametrize("a,b", [("EE.UU.", "EEUU"), ("U.S.", "US"), ("México", "Mexico"), ("the United States", "United States"), ("La OTAN", "OTAN"), ("NATO's", "NATO"), ("Airbus S.A.", "Airbus")])
def test_same_key(a, b):
    assert N.name_key(a) == N.name_key(b) != ""


@pytest.mark.parametrize("a,b", [("U.S. Army", "US"), ("El Salvador", "Salvador"), ("J. Smith", "JS"), ("OTAN", "ONU")])
def test_different_key(a, b):
    assert N.name_key(a) != N.name_key(b)


def test_names():
    assert N.name_key(None) == "" and N.name_key("La Haya") == "la haya"
    assert N.identity("NATO", "Organization", N.alias_keys()) == ("OTAN", "ORG", "otan")
    assert N.identity(" Foo ", "thing", {}) == ("Foo", "OTRO", "foo")


def test_acronyms(spark):
    rows = [("OTAN", "Organización del Tratado del Atlántico Norte"), ("XY", "Xenon Yard"), ("X", "Xenon"), ("X", "Xenon Yard"), ("OT", "Organización del Tratado del Norte")]
    df = spark.createDataFrame([(i, N.name_key(a), N.name_key(b)) for i, (a, b) in enumerate(rows)], "i int, short string, long string")
    found = df.filter(X.may_be_acronym(F.col("short")) & (X.heads(F.col("long"), tuple(N.INITIALS_SKIP)) == F.col("short")))
    assert {r["i"] for r in found.collect()} == {0, 1}


def relations(text, **how):
    return [(s, r, o, p) for s, _, r, o, _, _, p in R.triples(text, R.mentions(text, R.gazetteer()), **how)]


def test_relations():
    assert relations("Estados Unidos desarrolla armas antisatélite") == [("Estados Unidos", "desarrolla", "arma antisatélite", False)]
    assert relations("ASAT developed by China") == [("China", "desarrolla", "arma antisatélite", True)]
    assert relations("EE.UU. no desarrolla ASAT") == []
    assert relations("EE.UU. y China desarrollan ASAT") == [(s, "desarrolla", "arma antisatélite", False) for s in ("Estados Unidos", "China")]
    assert relations("La OTAN prohíbe LAWS") == [("OTAN", "prohibe", "sistema de armas autónomo", False)]
    assert relations("OTAN " + "x" * 70 + " desarrolla ASAT") == []
    assert relations("OTAN desarrolla. China") == []
    assert relations("OTAN con ASAT") == [] and relations("OTAN con ASAT", co_occurrence=True)[0][1] == "aparece_con"
    assert relations("el control de la OTAN y la ONU") == []
    assert [m.text for m in R.mentions("un dron en us y US", R.gazetteer())] == ["dron", "US"]


SENTENCES = [
    ("F1-A-1", "F1-A-1#0001", "La OTAN desarrolla ASAT."),
    ("F1-A-1", "F1-A-1#0002", "NATO develops anti-satellite weapons."),
    ("F2-B-1", "F2-B-1#0001", "La OTAN controla drones y la OTAN desarrolla drones."),
    ("F2-B-1", "F2-B-1#0000", "China desarrolla ASAT."),
    ("F3-C-1", "F3-C-1#0001", "China, Rusia."),
]


@pytest.fixture(scope="module")
def made(spark):
    from papyrix.plans.build_graph import build

    rows = [(d, c, int(c[-4:]), "txt", t) for d, c, t in SENTENCES]
    chunks = spark.createDataFrame(rows, "doc_id string, chunk_id string, position int, format string, text string")
    return tuple(df.cache() for df in build(chunks))


def test_build(made):
    _, nodes, edges = made
    found = {(r["src"], r["relation"], r["dst"]): r for r in edges.collect()}
    assert found["ORG:otan", "desarrolla", "ORG:arma antisatelite"]["weight"] == 2
    assert found["ORG:otan", "desarrolla", "ORG:arma antisatelite"]["chunk_ids"] == ["F1-A-1#0001", "F1-A-1#0002"]
    assert ("ORG:otan", "controla", "ORG:vehiculo aereo no tripulado") in found and ("ORG:otan", "desarrolla", "ORG:vehiculo aereo no tripulado") in found
    assert not any(r["src"] == "ORG:china" for r in found.values()), "covers are left out"
    n = {r["node"]: r for r in nodes.collect()}
    assert n["ORG:otan"]["topics"] == "12" and n["ORG:otan"]["name"] == "OTAN"


def test_graphml_round_trip(spark, made, tmp_path):
    from papyrix.operators import checks

    _, nodes, edges = made
    path = str(tmp_path / "g.graphml")
    lines = [r["value"] for r in stores.graphml(nodes, edges).collect()]
    open(path, "w", encoding="utf-8").write("\n".join(lines))
    n, e = stores.read_graphml(spark, path)
    columns = ["node", "name", "type", "topics", "chunk_ids", "n_chunks", "variants", "n_variants"]
    assert checks.different(n.select(columns), nodes.select(columns)).count() == 0
    assert checks.different(e.select(edges.columns), edges).count() == 0
    assert checks.incomplete_graph(n, e).count() == 0 and checks.shared_keys(n).count() == 0


def test_evidence(spark, made):
    _, nodes, edges = made
    queries = spark.createDataFrame([("q1", "What does la OTAN want?"), ("q2", "nothing")], "query_id string, text string")
    seeds = G.literal_links(queries, G.node_keys(nodes))
    assert [tuple(r) for r in seeds.collect()] == [("q1", "ORG:otan")]
    found = {r["chunk_id"]: r["weight"] for r in G.evidence(seeds, nodes, edges).collect()}
    w = 1 / __import__("math").log2(2 + 3)
    other = 1 / __import__("math").log2(2 + 1)
    assert found["F1-A-1#0001"] == pytest.approx(min(1, w + w + w * 0.4 * other))


def test_weight(spark):
    rows = spark.createDataFrame([(0,), (1,), (99,), (None,)], "d int").select(F.round(G.entity_weight(F.col("d")), 4)).collect()
    assert [r[0] for r in rows] == [1.0, 0.6309, 0.1502, 1.0]


def test_components_and_nucleus(spark):
    e = spark.createDataFrame([("a", "r", "b", 1), ("c", "r", "b", 3), ("x", "r", "y", 2)], "src string, relation string, dst string, weight int")
    assert {r["node"]: r["component"] for r in G.components(e).collect()} == {"a": "a", "b": "a", "c": "a", "x": "x", "y": "x"}
    n = spark.createDataFrame([(x,) for x in "abcxyz"], "node string")
    nodes, edges = G.nucleus(n, e, 2)
    assert {r[0] for r in nodes.collect()} == set("bcxy") and edges.count() == 2


def test_merge(spark):
    n = spark.createDataFrame([("t:eeuu", "EE.UU.", "LOC", "1", ["c1"]), ("t:us", "EEUU", "LOC", "2", ["c2"]), ("t:x", "Xenon", "LOC", "3", None)], "node string, name string, type string, topics string, chunk_ids array<string>")
    e = spark.createDataFrame([("t:eeuu", "r", "t:us", 1, "d", "c", ["c"], "", False), ("t:eeuu", "r", "t:x", 2, "d", "c1", ["c1"], "", False), ("t:us", "r", "t:x", 3, "d", "c2", ["c2"], "", False)], "src string, relation string, dst string, weight int, doc_id string, chunk_id string, chunk_ids array<string>, evidence string, passive boolean")
    nodes, edges = G.merge_by_key(n, e)
    assert {r["node"]: (r["topics"], r["chunk_ids"]) for r in nodes.collect()} == {"LOC:eeuu": ("12", ["c1", "c2"]), "LOC:xenon": ("3", [])}
    assert [(r["src"], r["weight"], r["chunk_ids"]) for r in edges.collect()] == [("LOC:eeuu", 5, ["c1", "c2"])]


def test_groups_and_suggestions(spark):
    rows = [(x, "country") for x in ("EE.UU.", "EEUU", "U.S.", "US", "USA", "United States")] + [("OTAN", "organization"), ("NATO", "organization"), ("Colombia", "country"), (" ", "country")]
    groups = G.group_entities(spark.createDataFrame(rows, "name string, label string"))
    assert {(r["type"], r["key"], r["n"]) for r in groups.collect()} == {("LOC", "estados unidos", 6), ("ORG", "otan", 2), ("LOC", "colombia", 1)}
    more = [("ABC", "organization"), ("Alpha Beta Club", "organization"), ("misil", "technology"), ("misiles", "technology"), ("luz", "event"), ("voces", "event"), ("voz x", "event")]
    found = G.suggest_aliases(G.group_entities(spark.createDataFrame(more, "name string, label string")), 1)
    assert {(r["short"], r["long"], r["why"]) for r in found.collect()} == {("ABC", "Alpha Beta Club", "initials"), ("misiles", "misil", "plural")}
