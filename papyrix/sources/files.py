"""Files of many formats to the document table.

Files are read by Spark's binaryFile source and routed by format; each format has a loader (path, content, entry) that
gives documents. What fails becomes a row of the failures table, not an error of the job.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from papyrix.sources import html_page, json_text, plain, tables, tiles

#: doc: text, title, metadata. A loader gives any number of them.
Loader = Callable[[bytes], list[dict]]


class LoadError(Exception):
    """A file that its loader can't read."""


def missing(library: str) -> Loader:
    def load(_content: bytes) -> list[dict]:
        raise LoadError(f"no reader for this format: {library} isn't installed; pass a loader of your own")

    return load


#: Format -> loader. Readers of page images and PDF need a library; give one as ``loaders={"pdf": ...}``.
LOADERS: dict[str, Loader] = {
    "json": json_text.load,
    "html": html_page.load,
    "htm": html_page.load,
    "csv": tables.load_csv,
    "xlsx": tables.load_xlsx,
    "pbf": tiles.load,
    "txt": plain.load,
    "md": plain.load,
    "pdf": missing("a PDF library"),
    "jpg": missing("an OCR library"),
    "jpeg": missing("an OCR library"),
    "png": missing("an OCR library"),
    "avif": missing("an OCR library"),
}


def format_of(path: Column, content: Column) -> Column:
    """By extension; a .pdf that begins like markup is a web page."""
    extension = F.lower(F.regexp_extract(path, r"\.([^./\\]+)$", 1))
    head = F.ltrim(F.decode(F.substring(content, 1, 64), "ISO-8859-1"))
    page = ~F.decode(F.substring(content, 1, 4), "ISO-8859-1").eqNullSafe("%PDF") & head.startswith("<")
    return F.when((extension == "pdf") & page, "html").otherwise(extension)


_OUT = T.StructType().add("source", "string").add("format", "string").add("text", "string").add("title", "string").add("metadata", T.MapType(T.StringType(), T.StringType())).add("part", "integer").add("error", "string")


def read_files(spark: SparkSession, root: str, loaders: Mapping[str, Loader] | None = None, glob: str = "*") -> DataFrame:
    """All files under ``root``: source (path below it), format, text, title, metadata, part, error."""
    from papyrix.functions.text import normal_path

    known = {**LOADERS, **(loaders or {})}
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    base = root.rstrip("/").split(":", 1)[-1].lstrip("/")
    below = F.regexp_replace(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))), rf"^[^:]*:/*\Q{base}\E/*", "")
    rows = found.filter(~F.col("path").endswith("/.DS_Store")).select(normal_path(below).alias("source"), format_of(F.col("path"), F.col("content")).alias("format"), "content")
    schema = to_arrow_schema(_OUT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source, kind, content in zip(*[batch.column(i) for i in range(3)]):
                kind = kind.as_py()
                try:
                    if kind not in known:
                        raise LoadError(f"unknown format {kind!r}")
                    made = known[kind](content.as_py())
                    out = [{"text": d.get("text", ""), "title": d.get("title"), "metadata": list(shown(d.get("metadata", {})).items()), "part": i, "error": None} for i, d in enumerate(made)]
                except Exception as e:  # noqa: BLE001 - whatever a reader raises is this file's failure
                    out = [{"text": None, "title": None, "metadata": [], "part": 0, "error": f"{type(e).__name__}: {e}"}]
                yield pa.RecordBatch.from_pylist([{"source": source.as_py(), "format": kind, **d} for d in out], schema=schema)

    return rows.mapInArrow(run, _OUT)


def shown(metadata: Mapping) -> dict[str, str]:
    return {str(k): v if isinstance(v, str) else json.dumps(v, ensure_ascii=False, default=str) for k, v in metadata.items() if v is not None}


def documents(files: DataFrame, catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, failures) of the files that the catalog names; the catalog gives id, topic and format."""
    joined = files.join(catalog.select("source", "doc_id", "phenomenon"), "source")
    docs = joined.filter("error is null").select("doc_id", "source", "format", "text", "phenomenon", "title", F.lit(None).cast("string").alias("language"), "metadata")
    return docs, joined.filter("error is not null").select("source", "format", "error")
