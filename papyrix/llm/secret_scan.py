"""Secret scanning by one combined deterministic automaton.

All rules' expressions, reversed, are compiled into one minimal automaton (subset construction, minimisation, transition
arrays). One pass over a text's bytes, from its end to its beginning, marks every position where a match of some rule
begins. From the marked positions, in order, each rule's own automaton runs forward to the longest match; the next match
of the rule begins at its end or later. That is leftmost, longest, non-overlapping matching for each kind by itself.

A match is dropped, but still covers its text, if the part behind its head (a prefix expression) is shorter than the
rule asks for. Spans are in code points of the whole text, end exclusive. A null or empty text has no spans. Rows that
repeat are scanned each. An empty table gives an empty result. Memory is bounded by the
longest text: at most 16 bytes for each of its bytes, and its spans.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrix.llm.automaton import Dfa, parse, reverse
from papyrix.llm.common import ship, text_batches

_HEAD = r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    fold: bool = False
    head: str = ""
    least: int = 0


#: The first three are the base; {16,} is [0-9a-f]+ with its filter, as a run's matches begin at its start.
BASE = (
    Rule("assign", _HEAD + "[A-Za-z0-9+/_.=-]+", fold=True, head=_HEAD, least=12),
    Rule("access", "AKIA[A-Z0-9]+", least=18),
    Rule("hex", "[0-9a-f]{16,}"),
)
RULES = BASE + (
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", "gh[oprsu]_[A-Za-z0-9]{20,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("stripe", "[rs]k_live_[A-Za-z0-9]{16,}"),
)


class Scanner:
    def __init__(self, rules: Sequence[Rule] = RULES):
        self.rules = tuple(rules)
        trees = [parse(r.pattern, r.fold) for r in self.rules]
        self.starts = Dfa([reverse(t) for t in trees], search=True)
        self.matches = [Dfa([t], search=False) for t in trees]
        self.heads = [Dfa([parse(r.head, r.fold)], search=False) if r.head else None for r in self.rules]

    def marked(self, data: bytes) -> tuple[array, array]:
        """Positions where some rule's match begins, from the last to the first, and the automaton's states there: 16 bytes
        a mark, however many there are."""
        table, accepting, state, n = self.starts.table, self.starts.accepting, 0, len(data) - 1
        positions, states = array("q"), array("q")
        for i, c in enumerate(reversed(data.translate(self.starts.classes))):
            state = table[state + c]
            if state >= accepting:
                positions.append(n - i)
                states.append(state)
        return positions, states

    def byte_spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end) in bytes, ordered."""
        positions, states = self.marked(data)
        if not positions:
            return []
        free = [0] * len(self.rules)
        columns: dict[int, bytes] = {}
        out = []
        for at, state in zip(reversed(positions), reversed(states)):
            for rule in self.starts.accepts[state // self.starts.width]:
                if at < free[rule]:
                    continue
                dfa = self.matches[rule]
                if rule not in columns:
                    columns[rule] = data.translate(dfa.classes)
                end = free[rule] = dfa.ends_of_longest(columns[rule], at)
                head = self.heads[rule]
                behind = head.ends_of_longest(data[at:end].translate(head.classes), 0) + at if head else at
                if end - behind >= self.rules[rule].least:
                    out.append((at, rule, end))
        return sorted(out)

    def spans(self, text: str | None) -> list[tuple[str, int, int]]:
        """(kind, start, end) in code points, by start, then rule."""
        if not text:
            return []
        data = text.encode("utf-8", "surrogatepass")
        found = self.byte_spans(data)
        if len(data) != len(text) and found:
            edges, last, points = {}, 0, 0
            for edge in sorted({x for a, _, b in found for x in (a, b)}):
                points += len(data[last:edge].decode("utf-8", "surrogatepass"))
                last, edges[edge] = edge, points
            found = [(edges[a], rule, edges[b]) for a, rule, b in found]
        return [(self.rules[rule].kind, a, b) for a, rule, b in found]


@lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...] = RULES) -> Scanner:
    return Scanner(rules)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: key, secrets array<struct<kind, start, end>>."""
    shipped = ship(docs.sparkSession, scanner(rules))
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_rules = shipped()
        for batch in text_batches(batches):
            found = [[{"kind": k, "start": a, "end": b} for k, a, b in with_rules.spans(value.as_py())] for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(item))], ["key", "secrets"])

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, secrets array<struct<kind:string,start:bigint,end:bigint>>")
    return out.withColumnRenamed("key", key)


def digest(secrets: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts and digest of the base kinds, and all spans as text, of what scan() gives."""
    base = [r.kind for r in BASE]
    shown = lambda of: F.array_join(F.transform(of, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("bigint")
    of_base = F.filter("secrets", lambda x: x["kind"].isin(base))
    return secrets.select(key, *[count(k).alias(f"n_{k}") for k in base], F.sha2(shown(of_base), 256).alias("base_sha256"), shown(F.col("secrets")).alias("spans"))


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES, mark: str = "[secret]") -> DataFrame:
    """``docs`` with each secret, and secrets that overlap as one, replaced in the text; all columns."""
    shipped = ship(docs.sparkSession, scanner(rules))
    at = docs.columns.index(text)

    def clean(with_rules: Scanner, value: str | None) -> str | None:
        out, last = [], 0
        for _, a, b in with_rules.spans(value):
            if b > last:
                out.append(value[last:a] + mark if a >= last else "")
                last = b
        return value if not out else "".join(out) + value[last:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_rules = shipped()
        for batch in text_batches(batches, column=at):
            columns = batch.columns
            columns[at] = pa.array([clean(with_rules, value.as_py()) for value in batch.column(at)], batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
