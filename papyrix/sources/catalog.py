"""The catalog of files: its workbook, its rules, and the audit against the files that are there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrix.functions.text import normal_path
from papyrix.schemas import CATALOG
from papyrix.sources.tables import cell_text, read_xlsx

# The workbook's sheet and columns; files that are known not to be documents.
SHEET = "Inventario de Archivos"
COLUMNS = {"doc_id": "DOC_ID", "filename": "Nombre estandarizado", "folder": "Carpeta", "phenomenon": "Fenómeno", "observatory": "Observatorio", "type_label": "Tipo"}
IGNORED = (".DS_Store",)


def entries(rows: DataFrame) -> DataFrame:
    """rows: the columns of COLUMNS, as text. Catalog entries; rows without folder or file name are left out."""
    clean = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    named = rows.select(*[clean(c).alias(c) for c in COLUMNS]).filter("folder <> '' and filename <> ''")
    return named.select(
        "doc_id",
        F.concat_ws("/", F.rtrim(normal_path(F.col("folder")), F.lit("/")), "filename").alias("source"),
        F.regexp_extract("phenomenon", r"^[Ff]?(\d)", 1).try_cast("int").alias("phenomenon"),
        F.lower(F.regexp_extract("filename", r"\.([^.]+)$", 1)).alias("format"),
        "observatory",
        "type_label",
    )


def read_catalog(spark: SparkSession, path: str, sheet: str = SHEET) -> DataFrame:
    """The workbook, read as bytes by Spark."""
    content = spark.read.format("binaryFile").load(path).select("content").first()["content"]
    rows = read_xlsx(bytes(content), sheet)
    head = [cell_text(v) for v in rows[0]] if rows else []
    lost = [name for name in COLUMNS.values() if name not in head]
    if lost:
        raise ValueError(f"the catalog lacks the columns {lost}")
    at = {c: head.index(name) for c, name in COLUMNS.items()}
    values = [tuple(cell_text(r[i]) for i in at.values()) for r in rows[1:] if any(v is not None for v in r)]
    return entries(spark.createDataFrame(values, ", ".join(f"{c} string" for c in at)))


def select(catalog: DataFrame, phenomenon: int | None = None, kind: str | None = None) -> DataFrame:
    """In order of doc_id; the format may be given as an extension."""
    out = catalog
    if phenomenon is not None:
        out = out.filter(F.col("phenomenon") == phenomenon)
    if kind is not None:
        out = out.filter(F.col("format") == kind.lower().lstrip("."))
    return out.orderBy("doc_id")


def violations(catalog: DataFrame) -> DataFrame:
    """(problem, value): repeated sources and ids, topics other than 1, 2, 3."""
    twice = lambda c: catalog.groupBy(c).count().filter("count > 1").select(F.lit(f"repeated {c}").alias("problem"), F.col(c).alias("value"))
    topics = catalog.filter(~F.coalesce(F.col("phenomenon").isin(1, 2, 3), F.lit(False))).select(F.lit("phenomenon").alias("problem"), F.col("doc_id").alias("value"))
    return twice("source").unionByName(twice("doc_id")).unionByName(topics)


def audit(catalog: DataFrame, files: DataFrame, expected_extra: DataFrame | None = None) -> DataFrame:
    """files: (source). (source, status): matched, missing, unexpected or known (an expected extra)."""
    seen = files.filter(~F.element_at(F.split("source", "/"), -1).isin(*IGNORED)).select("source").distinct()
    both = catalog.select("source").distinct().withColumn("c", F.lit(True)).join(seen.withColumn("f", F.lit(True)), "source", "full")
    known = (expected_extra if expected_extra is not None else catalog.select("source").limit(0)).select("source").distinct().withColumn("k", F.lit(True))
    both = both.join(known, "source", "left")
    status = F.when(F.col("c").isNotNull() & F.col("f").isNotNull(), "matched").when(F.col("c").isNotNull(), "missing").when(F.col("k").isNotNull(), "known").otherwise("unexpected")
    return both.select("source", status.alias("status"))


def with_unique_ids(catalog: DataFrame) -> DataFrame:
    """Fails the query if ids or sources repeat."""
    n = violations(catalog).agg(F.count("*").alias("_n"), F.lit(1).alias("_one"))
    return catalog.withColumn("_one", F.lit(1)).join(F.broadcast(n), "_one").filter(F.assert_true(F.col("_n") == 0, F.lit("the catalog has repeated ids or sources")).isNull()).drop("_one", "_n").select(*[f.name for f in CATALOG.fields])
