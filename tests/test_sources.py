import gzip
import io
import json
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from papyrix import schemas
from papyrix.operators import checks
from papyrix.sources import catalog, files, html_page, json_text, plain, stores, tables, tiles


def test_json_articles():
    a = json_text.article({"title": "T", "body_paragraphs": [], "sections": [{"heading": "H", "paragraphs": ["p", "q"]}], "content": "no", "lists": ["l"], "excerpt": "E", "x": 1})
    assert a["text"] == "T\n\nH\n\np\n\nq\n\nl\n\nE" and a["metadata"] == {"title": "T", "body_paragraphs": [], "content": "no", "x": 1} | {}
    assert json_text.article({"content": {"k": "v", "n": ["a"]}})["text"] == "k\n\nv\n\na"
    r = json_text.records([{"a": 1, "status": "x", "b": [1, None, "c"], "d": {"e": 2}}, "s", {}])
    assert r["text"] == "a: 1\nb: 1; c\nd: e: 2\n\ns"


def test_html():
    text, title = html_page.page_text("<title>A &amp; B</title><script>x</script><p>one <b>two</b><br>three</p><div>four</div>&copy;")
    assert title == "A & B" and text == "one two\nthree\n\nfour\n\n©"
    assert html_page.decoded('<meta charset="latin-1">é'.encode("latin-1")).endswith("é")


def test_csv():
    doc = tables.load_csv("﻿a;;c\n1;2;\n;;\n3;x;y\n".encode())[0]
    assert doc["text"] == "a: 1\ncolumna_2: 2\n\na: 3\ncolumna_2: x\nc: y"
    assert doc["metadata"]["n_filas"] == 3 and doc["metadata"]["n_filas_con_datos"] == 2
    assert tables.cell_text(2.0) == "2" and tables.cell_text(None) == ""


def workbook(rows):
    letter = "ABCDEFGH"
    cell = lambda r, c, v: f'<c r="{letter[c]}{r}" t="inlineStr"><is><t>{v}</t></is></c>' if isinstance(v, str) else f'<c r="{letter[c]}{r}"><v>{v}</v></c>'
    body = "".join(f'<row r="{r}">{"".join(cell(r, c, v) for c, v in enumerate(row) if v is not None)}</row>' for r, row in enumerate(rows, 1))
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="{catalog.SHEET}" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")
    return out.getvalue()


def test_xlsx():
    assert tables.load_xlsx(workbook([["a", "b"], [1, "x"], [2.5, None]]))[0]["text"] == "a: 1\nb: x\n\na: 2.5"


def test_catalog(spark, tmp_path):
    head = list(catalog.COLUMNS.values())
    rows = [head, ["F1-A-1", "x.PDF", "dir", "F1", "obs", "t"], [None] * 6, ["F2-A-1", "y.json", "dir\\", "F2", "obs", "t"], ["F9", None, "dir", "F9", "", ""]]
    path = tmp_path / "c.xlsx"
    path.write_bytes(workbook(rows))
    c = catalog.read_catalog(spark, str(path)).cache()
    assert {(r["source"], r["format"], r["phenomenon"]) for r in c.collect()} == {("dir/x.PDF", "pdf", 1), ("dir/y.json", "json", 2)}
    assert catalog.violations(c).count() == 0 and catalog.violations(c.unionByName(c)).count() == 4
    assert [r["doc_id"] for r in catalog.select(c, kind=".JSON").collect()] == ["F2-A-1"]
    assert catalog.with_unique_ids(c).count() == 2
    with pytest.raises(Exception, match="repeated ids"):
        catalog.with_unique_ids(c.unionByName(c)).collect()
    seen = spark.createDataFrame([("dir/x.PDF",), ("dir/.DS_Store",), ("new",), ("extra",)], "source string")
    extra = spark.createDataFrame([("extra",)], "source string")
    assert {tuple(r) for r in catalog.audit(c, seen, extra).collect()} == {("dir/x.PDF", "matched"), ("dir/y.json", "missing"), ("new", "unexpected"), ("extra", "known")}


def _field(number, wire, data):
    def varint(n):
        out = b""
        while n > 127:
            out += bytes([n & 127 | 128])
            n >>= 7
        return out + bytes([n])

    return varint(number << 3 | wire) + (varint(len(data)) + data if wire == 2 else varint(data) if wire == 0 else data)


def test_tiles():
    value = _field(1, 2, b"road")
    number = _field(3, 1, struct.pack("<d", 2.0))
    feature = _field(2, 2, bytes([0, 0, 1, 1]))
    layer = _field(1, 2, b"L") + _field(2, 2, feature) * 2 + _field(3, 2, b"k") + _field(3, 2, b"n") + _field(4, 2, value) + _field(4, 2, number)
    for content in (_field(3, 2, layer), gzip.compress(_field(3, 2, layer))):
        doc = tiles.load(content)[0]
        assert doc["text"] == "capa: L\nk: road\nn: 2" and doc["metadata"] == {"n_elementos": 2, "n_unicos": 1}


def test_plain():
    assert plain.load("a\r\n\r\n \r\nb".encode("utf-8-sig"))[0]["text"] == "a\n\nb"
    assert plain.load("é".encode("cp1252"))[0]["text"] == "é"
    assert plain.page_paragraphs("a\nb\n \nc") == ["a b", "c"]
    assert plain.pages_document(["x"], lambda: ["longer text"])["text"] == "longer text"
    assert plain.pages_document(["longer text"], lambda: ["x"])["text"] == "longer text"
    assert plain.nearest_caption(100, [(130, "near"), (190, "far")]) == "near" and plain.nearest_caption(0, [(41, "x")]) is None


def test_files(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d/a b.txt").write_text("hola")
    (tmp_path / "d/p.pdf").write_text("  <html><p>page</p>")
    (tmp_path / "d/q.pdf").write_bytes(b"%PDF-1.4")
    (tmp_path / "d/j.json").write_text("{bad")
    (tmp_path / "d/.DS_Store").write_text("x")
    read = files.read_files(spark, str(tmp_path)).cache()
    got = {r["source"]: r for r in read.collect()}
    assert got["d/a b.txt"]["text"] == "hola" and got["d/p.pdf"]["text"] == "page" and got["d/p.pdf"]["format"] == "html"
    assert "installed" in got["d/q.pdf"]["error"] and "JSONDecodeError" in got["d/j.json"]["error"]
    cat = spark.createDataFrame([("F1-1", "d/a b.txt", 1, "txt", "", ""), ("F1-2", "d/q.pdf", 1, "pdf", "", "")], schemas.CATALOG)
    docs, failures = files.documents(read, cat)
    assert [r["doc_id"] for r in docs.collect()] == ["F1-1"] and failures.count() == 1
    own = {r["source"]: r for r in files.read_files(spark, str(tmp_path), {"pdf": lambda content: [{"text": f"{len(content)} bytes"}]}).collect()}
    assert own["d/q.pdf"]["text"] == "8 bytes"


def test_queries(spark):
    text = spark.createDataFrame([("intro q1 What is the orbit of it? Q02 short q003  Another  question\nof two lines",)], "text string")
    assert [tuple(r) for r in stores.parse_queries(text).collect()] == [("q001", "What is the orbit of it?"), ("q003", "Another question of two lines")]
    assert checks.bad_query_set(stores.parse_queries(text), 3).collect()[0]["query_id"] == "q002"
    assert stores.parse_queries(spark.createDataFrame([("nothing",), (None,)], "text string")).count() == 0


def test_judgements(spark):
    body = json.dumps({"_note": {"x": 1}, "q1": {"_consulta": "text", "F1-1": 2, "F1-2": 0}})
    out = stores.parse_judgements(spark.createDataFrame([(body,)], "text string"))
    assert {tuple(r) for r in out.collect()} == {("q1", "F1-1", 2), ("q1", "F1-2", 0)}


def test_stores(spark, tmp_path):
    rows = [("d", "c1", "s", "txt", 1, 0, 2, "a b", None, None, None, "parrafo", 1, 1)]
    chunks = spark.createDataFrame(rows, schemas.CHUNK)
    assert stores.write_json(chunks, str(tmp_path / "c")) == 1
    back = stores.read_strict(spark, str(tmp_path / "c"), schemas.CHUNK)
    assert checks.different(back, chunks).count() == 0 if "metadata" not in back.columns else back.drop("metadata").exceptAll(chunks.drop("metadata")).count() == 0
    assert stores.valid_chunks(chunks).count() == 1
    with pytest.raises(Exception, match="bad chunk"):
        stores.valid_chunks(chunks.withColumn("position", F.lit(-1))).collect()
    (tmp_path / "bad.json").write_text('{"query_id": "q1"}\n\n{oops\n')
    good, bad = stores.read_tolerant(spark, str(tmp_path / "bad.json"), schemas.RESULT)
    assert good.count() == 1 and bad.count() == 1
    with pytest.raises(Exception):
        stores.read_strict(spark, str(tmp_path / "bad.json"), schemas.RESULT).collect()
    (tmp_path / "r.json").write_text('{"query_id": "q1", "documents": [{"rank": 1, "doc_id": "a"}]}\n{"query_id": "q1", "documents": [{"rank": 1, "doc_id": "b"}]}\n')
    assert stores.read_results(spark, str(tmp_path / "r.json")).first()["documents"][0]["doc_id"] == "b"


def test_metadata_records(spark):
    from papyrix.operators.chunking import metadata_records

    rows = [("d", f"d#{i:04d}", "s", "txt", 1, i, 2, f"t{i}", "", None, None, "parrafo", 1, 1) for i in range(20)]
    chunks = spark.createDataFrame(rows, schemas.CHUNK)
    records = metadata_records(chunks)
    assert records.filter("idioma is not null").count() == 0
    assert [r["faiss_id"] for r in records.orderBy("chunk_id").collect()] == list(range(20))
    assert checks.misaligned(records, chunks).count() == 0 and checks.bad_records(records).count() == 0
    assert checks.missing_fields(chunks.withColumn("source", F.lit(" "))).count() == 20


def test_manifest(spark):
    df = spark.range(10)
    a = stores.manifest({"out": df}, {"k": 200})
    b = stores.manifest({"out": df.repartition(3)}, {"k": 100})
    assert stores.manifest_differences(a, a) == [] and stores.manifest_differences(a, b) == ["configuration.k: 200 is now 100"]
