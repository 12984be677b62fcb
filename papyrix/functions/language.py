"""Language tags by a naive Bayes model over character n-grams, made from labelled texts.

The model is made from a bounded sample of labelled texts, so it can be broadcast; texts are scored whole. A text of fewer than MIN_LETTERS letters has no tag and
confidence 0; one below MIN_CONFIDENCE has no tag but keeps its confidence.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papyrix.session import cut, if_small

MIN_LETTERS, MIN_CONFIDENCE = 40, 0.50
#: About so many labelled texts of each language are counted.
SAMPLE = 5_000
_BITS, _MASK = 21, (1 << 21) - 1
_OTHERS = re.compile(r"[\W\d_]+")
_TAG = T.StructType().add("language", "string").add("confidence", "double")


def codes(text: str | None) -> tuple[np.ndarray, int]:
    """The runs of three characters in a text's letters, words marked by one space, as numbers; how many letters."""
    clean = f" {_OTHERS.sub(' ', (text or '').lower()).strip()} "
    points = np.frombuffer(clean.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return (points[:-2] << 2 * _BITS) | (points[1:-1] << _BITS) | points[2:], int((points != 32).sum())


def shown(code: int) -> str:
    return "".join(chr((code >> k * _BITS) & _MASK) for k in (2, 1, 0))


def gram_counts(labelled: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> dict[str, dict[str, int]]:
    """Counts of the grams in about ``sample`` texts of each language, those with the smallest hashes, equal ones together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: dict[str, list[np.ndarray]] = defaultdict(list)
            for name, value in zip(batch.column(0), batch.column(1)):
                parts[name.as_py()].append(codes(value.as_py())[0])
            for name, of in parts.items():
                grams, n = np.unique(np.concatenate(of), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(grams), pa.string()), pa.array(grams), pa.array(n, pa.int64())], ["lang", "gram", "n"])

    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).filter("lang is not null and text is not null")
    sizes = cut(rows.groupBy("lang").agg(F.count("*").alias("_texts")).withColumnRenamed("lang", "_lang"))
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / F.lit(float(1 << 30)) * F.col("_texts") < sample
    chosen = rows.join(if_small(sizes), F.col("lang") == F.col("_lang")).filter(draw).select("lang", "text")
    counted = chosen.mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    out: dict[str, dict[str, int]] = defaultdict(dict)
    for name, gram, n in zip(*[counted[c].to_pylist() for c in ("lang", "gram", "n")]):
        out[name][shown(gram)] = n
    return dict(out)


class Detector:
    def __init__(self, counts: dict[str, dict[str, int]]):
        self.names = sorted(counts)
        code = lambda gram: (ord(gram[0]) << 2 * _BITS) | (ord(gram[1]) << _BITS) | ord(gram[2])
        self.grams = np.array(sorted({code(g) for c in counts.values() for g in c}), np.int64)
        rows = np.full((len(self.grams), len(self.names)), 0.5)
        for k, name in enumerate(self.names):
            rows[np.searchsorted(self.grams, [code(g) for g in counts[name]]), k] += list(counts[name].values())
        self.scores = np.log(rows / rows.sum(axis=0)) if len(self.grams) else rows

    def __call__(self, text: str | None) -> tuple[str | None, float]:
        found, letters = codes(text)
        if letters < MIN_LETTERS or len(self.grams) == 0:
            return None, 0.0
        at = np.minimum(np.searchsorted(self.grams, found), len(self.grams) - 1)
        at = at[self.grams[at] == found]
        if len(at) == 0:
            return None, 0.0
        total = np.bincount(at, minlength=len(self.grams)) @ self.scores / math.sqrt(len(at))
        share = np.exp(total - total.max())
        confidence = float(share.max() / share.sum())
        return (self.names[int(total.argmax())] if confidence >= MIN_CONFIDENCE else None), round(confidence, 4)


def tag(docs: DataFrame, detector: Detector, text: str = "text") -> DataFrame:
    """Adds language and confidence."""
    data = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(detector))

    @F.pandas_udf(_TAG)
    def detect(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        of = cloudpickle.loads(data.value)
        for texts in batches:
            yield pd.DataFrame([of(t) for t in texts], columns=["language", "confidence"])

    out = docs.withColumn("_tag", detect(text))
    return out.withColumn("language", F.col("_tag.language")).withColumn("confidence", F.col("_tag.confidence")).drop("_tag")
