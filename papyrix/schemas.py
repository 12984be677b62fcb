"""Explicit schemas of what the stages exchange."""

from pyspark.sql import types as T


def _struct(ddl: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in ddl.items()])


_S, _I, _L, _D, _B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()
_META = T.MapType(_S, _S)

CATALOG = _struct({"doc_id": _S, "source": _S, "phenomenon": _I, "format": _S, "observatory": _S, "type_label": _S})
DOCUMENT = _struct({"doc_id": _S, "source": _S, "format": _S, "text": _S, "phenomenon": _I, "title": _S, "language": _S, "metadata": _META})
CHUNK = _struct(
    {
        "doc_id": _S, "chunk_id": _S, "source": _S, "format": _S, "phenomenon": _I, "position": _I, "num_tokens": _I, "text": _S,
        "language": _S, "title": _S, "metadata": _META, "strategy": _S, "cut_level": _I, "n_units": _I,
    }
)
METADATA = _struct(
    {"doc_id": _S, "chunk_id": _S, "fuente": _S, "formato": _S, "fenomeno": _I, "posicion": _I, "num_tokens": _I, "texto": _S, "idioma": _S, "faiss_id": _L}
)
TRIPLE = _struct(
    {"subject": _S, "subject_type": _S, "relation": _S, "object": _S, "object_type": _S, "evidence": _S, "passive": _B, "doc_id": _S, "chunk_id": _S, "ordinal": _L}
)
FAILURE = _struct({"source": _S, "format": _S, "error": _S})
CANDIDATE = _struct({"query_id": _S, "vec_id": _L, "chunk_id": _S, "doc_id": _S, "score": _D, "text": _S, "language": _S})
RESULT = _struct(
    {
        "query_id": _S,
        "documents": T.ArrayType(_struct({"rank": _I, "doc_id": _S})),
        "fragments": T.ArrayType(_struct({"rank": _I, "chunk_id": _S, "doc_id": _S, "text": _S})),
    }
)
