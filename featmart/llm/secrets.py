"""Secrets in text by one deterministic automaton for all rules.

The rules' expressions become one nondeterministic automaton that may start at any byte; subset construction makes it
deterministic, each state carrying the set of rules that end there; minimisation merges states that no text can tell apart. Scanning
is one table step per byte for all rules together. Where a rule stops accepting, a match ends; the automaton of the reversed
rule, run back from there, finds the leftmost start, not before the end of the rule's match before. A check on the span may then
drop it; a dropped span is not tried again.

Rules must end in a repeated class or in fixed text, so that all matches that overlap end at one place. A null text counts as empty
and gives no spans. Repeated rows get the same spans; an empty table gives no rows. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import text_of

_OPS, _PARSER = re._constants, re._parser
SPANS = "array<struct<kind:string,start:int,end:int>>"


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    keep: Callable[[bytes], bool]
    ignore_case: bool = False


_ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_ASSIGNED = re.compile(_ASSIGN.encode(), re.I)


def _long_value(span: bytes) -> bool:
    return len(_ASSIGNED.fullmatch(span)[2]) >= 6


BASE_KINDS = ("assign", "access", "hex")
RULES = (
    Rule("assign", _ASSIGN, _long_value, ignore_case=True),
    Rule("access", r"AKIA[A-Z0-9]+", lambda s: len(s) >= 20),
    # Eight, not 24, in the automaton: a count multiplies its states, and the check on the span is exact.
    Rule("hex", r"[0-9a-f]{8,}", lambda s: len(s) >= 24),
    Rule("forge_token", r"gh[opsu]_[A-Za-z0-9]+", lambda s: len(s) >= 40),
    Rule("chat_token", r"xox[abps]-[A-Za-z0-9-]+", lambda s: len(s) >= 15),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", lambda s: True),
)


class Automaton:
    """Fragments of a nondeterministic automaton over bytes: `moves[state]` lists (bytes, next), `jumps[state]` free moves."""

    def __init__(self) -> None:
        self.moves: list[list[tuple[frozenset[int], int]]] = []
        self.jumps: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.jumps.append([])
        return len(self.moves) - 1

    def add(self, tree: Iterable, start: int, ignore_case: bool, backward: bool) -> int:
        """Append a parsed expression behind `start`; returns its end."""
        items = list(tree)
        for op, value in reversed(items) if backward else items:
            start = self._item(op, value, start, ignore_case, backward)
        return start

    def _item(self, op, value, start: int, ignore_case: bool, backward: bool) -> int:
        if op is _OPS.SUBPATTERN:
            return self.add(value[3], start, ignore_case, backward)
        if op is _OPS.BRANCH:
            end = self.state()
            for branch in value[1]:
                fork = self.state()
                self.jumps[start].append(fork)
                self.jumps[self.add(branch, fork, ignore_case, backward)].append(end)
            return end
        if op is _OPS.MAX_REPEAT:
            least, most, body = value
            for _ in range(least):
                start = self.add(body, start, ignore_case, backward)
            if most is _OPS.MAXREPEAT:
                loop, end = self.state(), self.state()
                self.jumps[start] += [loop, end]
                self.jumps[self.add(body, loop, ignore_case, backward)] += [loop, end]
                return end
            end = self.state()
            self.jumps[start].append(end)
            for _ in range(most - least):
                start = self.add(body, start, ignore_case, backward)
                self.jumps[start].append(end)
            return end
        end = self.state()
        self.moves[start].append((_bytes_of(op, value, ignore_case), end))
        return end

    def closure(self, states: Iterable[int]) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for following in self.jumps[todo.pop()]:
                if following not in seen:
                    seen.add(following)
                    todo.append(following)
        return frozenset(seen)


def _bytes_of(op, value, ignore_case: bool) -> frozenset[int]:
    if op is _OPS.LITERAL:
        found = {value}
    elif op is _OPS.IN:
        found = set()
        for kind, x in value:
            if kind is _OPS.LITERAL:
                found.add(x)
            elif kind is _OPS.RANGE:
                found.update(range(x[0], x[1] + 1))
            else:
                raise ValueError(f"{kind} in a class")
    else:
        raise ValueError(f"{op} in a rule")
    if ignore_case:
        found |= {ord(f(chr(b))) for b in found for f in (str.lower, str.upper)}
    return frozenset(found)


@dataclass(frozen=True)
class Table:
    """A minimal deterministic automaton: `steps[state, byte]`, and the rules that end in each state as bits."""

    steps: np.ndarray
    ends: np.ndarray


def determinize(automaton: Automaton, start: frozenset[int], finals: dict[int, int], restart: bool) -> Table:
    """Subset construction; with `restart` a match may begin at every byte."""
    known, todo, rows, ends = {start: 0}, [start], [], []
    # Bytes that no rule tells apart share one column while states are built.
    sets = {s for moves in automaton.moves for s, _ in moves}
    columns: dict[tuple[bool, ...], int] = {}
    column_of = np.array([columns.setdefault(tuple(b in s for s in sets), len(columns)) for b in range(256)])
    samples = [int(np.flatnonzero(column_of == c)[0]) for c in range(len(columns))]
    while todo:
        states = todo.pop(0)
        ends.append(sum({1 << finals[s] for s in states if s in finals}))
        row = []
        for byte in samples:
            reached = {end for s in states for accepted, end in automaton.moves[s] if byte in accepted}
            following = automaton.closure(reached) | (start if restart else frozenset())
            if following not in known:
                known[following] = len(known)
                todo.append(following)
            row.append(known[following])
        rows.append(row)
    return Table(np.array(rows)[:, column_of], np.array(ends))


def minimize(table: Table) -> Table:
    """Split states by what they accept, then by where their bytes lead, until nothing splits. The start keeps number 0."""
    label = np.unique(table.ends, return_inverse=True)[1]
    while True:
        refined = np.unique(np.column_stack([label, label[table.steps]]), axis=0, return_inverse=True)[1].ravel()
        if refined.max() == label.max():
            break
        label = refined
    first = np.unique(label, return_index=True)[1]
    order = np.argsort(first, kind="stable")  # by first state seen, so that the start comes first
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return Table(place[label[table.steps[first[order]]]], table.ends[first[order]])


def compile_rules(rules: tuple[Rule, ...]) -> Table:
    automaton, finals = Automaton(), {}
    root = automaton.state()
    for i, rule in enumerate(rules):
        fork = automaton.state()
        automaton.jumps[root].append(fork)
        finals[automaton.add(_PARSER.parse(rule.pattern), fork, rule.ignore_case, False)] = i
    return minimize(determinize(automaton, automaton.closure([root]), finals, restart=True))


def compile_backward(rule: Rule) -> Table:
    automaton = Automaton()
    root = automaton.state()
    end = automaton.add(_PARSER.parse(rule.pattern), root, rule.ignore_case, True)
    return minimize(determinize(automaton, automaton.closure([root]), {end: 0}, restart=False))


class Scanner:
    """All rules over the bytes of a text."""

    def __init__(self, rules: tuple[Rule, ...] = RULES) -> None:
        self.rules = rules
        table = compile_rules(rules)
        # Accepting states last: one comparison tells them.
        order = np.argsort(table.ends != 0, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        rows = [i << 8 for i in range(len(order))]  # one object per number keeps the table small
        self.start = rows[place[0]]
        self.steps = [rows[i] for i in place[table.steps[order]].ravel().tolist()]
        self.ends = table.ends[order].tolist()
        self.accepting = int((table.ends == 0).sum()) << 8
        self.back = [(t.steps.tolist(), t.ends.tolist(), self._dead(t)) for t in map(compile_backward, rules)]

    @staticmethod
    def _dead(table: Table) -> int:
        """The state from which nothing is accepted any more."""
        stuck = (table.steps == np.arange(len(table.steps))[:, None]).all(axis=1) & (table.ends == 0)
        return int(np.flatnonzero(stuck)[0]) if stuck.any() else -1

    def stops(self, data: bytes) -> Iterator[tuple[int, int]]:
        """(rules, end) wherever rules stop accepting: the one pass over all bytes."""
        steps, ends, accepting, state = self.steps, self.ends, self.accepting, self.start
        pairs = enumerate(data)
        for _, byte in pairs:
            state = steps[state + byte]
            if state < accepting:
                continue
            live = ends[state >> 8]
            for i, byte in pairs:
                state = steps[state + byte]
                now = ends[state >> 8]
                if live & ~now:
                    yield live & ~now, i
                live = now
                if not live:
                    break
            else:
                yield live, len(data)

    def _start_of(self, rule: int, data: bytes, end: int, least: int) -> int | None:
        steps, ends, dead = self.back[rule]
        state, found = 0, None
        for i in range(end - 1, least - 1, -1):
            state = steps[state][data[i]]
            if state == dead:
                break
            if ends[state]:
                found = i
        return found

    def find(self, text: str | None) -> list[tuple[str, int, int]]:
        """(kind, start, end) in code points, by start, then by kind as listed."""
        data = (text or "").encode()
        done, spans = [0] * len(self.rules), []
        for stopped, end in self.stops(data):
            for rule in range(len(self.rules)):
                if stopped >> rule & 1:
                    start = self._start_of(rule, data, end, done[rule])
                    if start is not None:
                        done[rule] = end
                        if self.rules[rule].keep(data[start:end]):
                            spans.append((start, rule, end))
        spans.sort()
        points, chars, at = {}, 0, 0
        for place in sorted({p for s, _, e in spans for p in (s, e)}):
            chars, at = chars + len(data[at:place].decode()), place
            points[place] = chars
        return [(self.rules[r].kind, points[s], points[e]) for s, r, e in spans]


@cache
def scanner() -> Scanner:
    """One per worker process."""
    return Scanner()


def secret_spans(text: str) -> Column:
    """An array of (kind, start, end) of the text column."""

    @F.pandas_udf(SPANS)
    def spans(texts: pd.Series) -> pd.Series:
        find = scanner().find
        return pd.Series([[dict(zip(("kind", "start", "end"), s)) for s in find(t)] for t in texts], dtype=object)

    return spans(text_of(text))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id and spans."""
    return docs.select(F.col(id_col), secret_spans(text).alias("spans"))
