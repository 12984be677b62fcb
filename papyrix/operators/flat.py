"""One row to several, through Arrow: what the segmentation operators are made of."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

PIECE = 500


def flat_map(df: DataFrame, inputs: list[str], function: Callable[..., Iterable[tuple]], made: T.StructType) -> DataFrame:
    """All columns of ``df`` but those named in ``made``, with the rows that function(*inputs) gives for each row."""
    kept = [f for f in df.schema.fields if f.name not in made.names]
    arrow = to_arrow_schema(made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, PIECE):
                part = batch.slice(low, PIECE)
                at, rows = [], []
                for i, values in enumerate(zip(*[part.column(name).to_pylist() for name in inputs])):
                    new = list(function(*values))
                    at += [i] * len(new)
                    rows += new
                columns = [part.column(f.name).take(pa.array(at, pa.int64())) for f in kept]
                columns += [pa.array([r[k] for r in rows], field.type) for k, field in enumerate(arrow)]
                yield pa.RecordBatch.from_arrays(columns, [*(f.name for f in kept), *made.names])

    return df.mapInArrow(run, T.StructType([*kept, *made.fields]))
