"""Regular expressions over bytes as deterministic automata: parse, subset construction, minimisation, arrays.

Syntax: literals, \\ escapes (\\xHH too), [classes] with ranges, ( ) and (?: ), |, ? * + {m} {m,} {m,n}. Bytes above
0x7F occur in no rule. With ``fold`` letters outside classes match in either case.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

# An expression is ("set", frozenset of bytes) | ("cat", parts) | ("or", parts) | ("rep", part, least, most or None)


class _Parser:
    def __init__(self, pattern: str, fold: bool):
        self.s, self.i, self.fold = pattern, 0, fold

    def peek(self) -> str:
        return self.s[self.i : self.i + 1]

    def take(self) -> str:
        self.i += 1
        return self.s[self.i - 1]

    def either(self):
        ways = [self.row()]
        while self.peek() == "|":
            self.take()
            ways.append(self.row())
        return ("or", ways) if len(ways) > 1 else ways[0]

    def row(self):
        parts = []
        while self.peek() not in ("", "|", ")"):
            parts.append(self.counted())
        return ("cat", parts)

    def counted(self):
        part = self.one()
        while (c := self.peek()) and c in "?*+{":
            self.take()
            if c == "{":
                end = self.s.index("}", self.i)
                low, comma, high = self.s[self.i : end].partition(",")
                self.i = end + 1
                part = ("rep", part, int(low), int(high) if high else None if comma else int(low))
            else:
                part = ("rep", part, int(c == "+"), 1 if c == "?" else None)
        return part

    def escaped(self) -> int:
        c = self.take()
        if c == "x":
            self.i += 2
            return int(self.s[self.i - 2 : self.i], 16)
        return ord(c)

    def one(self):
        c = self.take()
        if c == "(":
            if self.s.startswith("?:", self.i):
                self.i += 2
            inside = self.either()
            self.take()
            return inside
        if c == "[":
            found = set()
            while self.peek() != "]":
                low = self.escaped() if (c := self.take()) == "\\" else ord(c)
                if self.peek() == "-" and self.s[self.i + 1] != "]":
                    self.take()
                    high = self.escaped() if (c := self.take()) == "\\" else ord(c)
                    found.update(range(low, high + 1))
                else:
                    found.add(low)
            self.take()
            return ("set", frozenset(found))
        byte = self.escaped() if c == "\\" else ord(c)
        return ("set", frozenset({ord(chr(byte).lower()), ord(chr(byte).upper())} if self.fold else {byte}))


def parse(pattern: str, fold: bool = False):
    return _Parser(pattern, fold).either()


def reverse(node):
    kind = node[0]
    if kind == "cat":
        return ("cat", [reverse(p) for p in reversed(node[1])])
    if kind == "or":
        return ("or", [reverse(p) for p in node[1]])
    return ("rep", reverse(node[1]), *node[2:]) if kind == "rep" else node


class _Nfa:
    def __init__(self):
        self.free: list[list[int]] = []
        self.steps: list[tuple[frozenset, int] | None] = []

    def state(self) -> int:
        self.free.append([])
        self.steps.append(None)
        return len(self.free) - 1

    def add(self, node, start: int) -> int:
        """Builds ``node`` from ``start`` on; gives the state behind it."""
        kind = node[0]
        if kind == "set":
            here, end = self.state(), self.state()
            self.free[start].append(here)
            self.steps[here] = (node[1], end)
            return end
        if kind == "cat":
            for part in node[1]:
                start = self.add(part, start)
            return start
        end = self.state()
        if kind == "or":
            for part in node[1]:
                self.free[self.add(part, start)].append(end)
            return end
        _, part, least, most = node
        for _ in range(least):
            start = self.add(part, start)
        if most is None:
            loop = self.state()
            self.free[start].append(loop)
            self.free[self.add(part, loop)].append(loop)
            self.free[loop].append(end)
            return end
        for _ in range(most - least):
            self.free[start].append(end)
            start = self.add(part, start)
        self.free[start].append(end)
        return end

    def closure(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for x in self.free[todo.pop()]:
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return frozenset(x for x in seen if self.steps[x] or not self.free[x])


class Dfa:
    """classes: byte -> column. table[state * width + column]: next state, already times width. State 0 is the start;
    states from ``accepting`` on (times width) accept, with the rules in accepts[state]. -1: no way on."""

    def __init__(self, nodes: Sequence, search: bool):
        nfa = _Nfa()
        root = nfa.state()
        ends = {nfa.add(node, root): rule for rule, node in enumerate(nodes)}
        start = nfa.closure([root])
        for end in ends:
            nfa.free[end] = []
        sets = sorted({s[0] for s in nfa.steps if s}, key=sorted)
        columns: dict[tuple, int] = {}
        self.classes = bytes(columns.setdefault(tuple(b in s for s in sets), len(columns)) for b in range(256))
        width = len(columns)
        samples = [self.classes.index(c) for c in range(width)]
        names, order, rows = {start: 0}, [start], []
        while len(rows) < len(order):
            here, row = order[len(rows)], []
            for byte in samples:
                to = nfa.closure([s[1] for x in here if (s := nfa.steps[x]) and byte in s[0]]) | (start if search else frozenset())
                row.append(names.setdefault(to, len(order)) if to else -1)
                if to and row[-1] == len(order):
                    order.append(to)
            rows.append(row)
        table = np.array(rows)
        accepts = [frozenset(ends[x] for x in s if x in ends) for s in order]
        # Moore: states stay together while they accept alike and lead to the same blocks
        kinds = {a: i for i, a in enumerate(dict.fromkeys(accepts))}
        block, count = np.array([kinds[a] for a in accepts]), 0
        while True:
            reach = np.where(table >= 0, block[table], -1)
            _, block = np.unique(np.column_stack([block, reach]), axis=0, return_inverse=True)
            block = block.ravel()
            if block.max() + 1 == count:
                break
            count = block.max() + 1
        first = [int(np.flatnonzero(block == k)[0]) for k in range(count)]
        # the start first, accepting states last
        ranked = sorted(range(count), key=lambda k: (bool(accepts[first[k]]), k != block[0], k))
        if accepts[0]:
            raise ValueError("a rule that matches the empty string has no spans")
        rank = {k: i for i, k in enumerate(ranked)}
        self.width = width
        self.table = [rank[int(block[t])] * width if t >= 0 else -1 for k in ranked for t in table[first[k]]]
        self.accepts = [tuple(sorted(accepts[first[k]])) for k in ranked]
        self.accepting = sum(not a for a in self.accepts) * width

    def ends_of_longest(self, columns: bytes, at: int) -> int:
        """End of the longest match that begins at ``at``, -1 if none."""
        state, end, table, accepting = 0, -1, self.table, self.accepting
        for i in range(at, len(columns)):
            state = table[state + columns[i]]
            if state < 0:
                break
            if state >= accepting:
                end = i + 1
        return end
