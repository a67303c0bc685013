"""Conversations repaired at the least cost, by a Viterbi search that emits edits as soon as all survivors agree on them.

A repaired conversation is empty, or an optional system turn and then user and assistant in turns, by the first letter of the role. Per
row: keep it (cost 0), give it the role user or assistant (1), or delete it (2); anywhere an empty user or assistant turn can be inserted (5).
Blank rows and repetitions must be deleted; a truncated row that stays costs 5 more. Of the cheapest edits those whose letters
(K, R, D, I in order) come first in ASCII order are taken.

The rows of a conversation are read once, in order of their turn. For each of the four states that the roles so far can be in, the cheapest
edits survive, as a path in a tree of edits that share their beginnings. A node is let go when nothing refers to it, and while the oldest
node has one successor, every survivor begins with it, so it is emitted. Ties compare all that is still unresolved; equal cost and rows
rule out that one is the other's beginning, so the comparison is final. A survivor that another state undercuts by more
than it can ever cost to go on from there is dropped, which keeps the tree short. So a conversation of any length needs
the memory of its unresolved edits, some dozens of rows where roles alternate at times; only where they truly stay open to the end, as when all
rows have one role and the parity of their number decides, is that the whole conversation. Rows are sorted by Spark and spill. One
conversation is one task, since its edits depend on all rows before.

Nulls: a null role or text counts as one space; null turns come first and are no turn for the gaps; rows without a conversation
id are a conversation of their own. Rows of equal turn are taken by role and text. Rows that repeat count as repetitions. An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, SYSTEM, USER, ASSISTANT = range(4)
FINAL = (START, ASSISTANT)
KEEP, REROLE, DELETE, INSERT = "KRDI"
RELABEL_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5
AFTER = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
NEXT_ROLE = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
LEGAL_PAIRS = {"su", "ua", "au"}
# At most this much more it costs to go on from the first state as one would from the second: a turn inserted, or a system turn left out.
MORE = {
    (START, SYSTEM): 0, (START, USER): 5, (START, ASSISTANT): 0,
    (SYSTEM, START): 10, (SYSTEM, USER): 5, (SYSTEM, ASSISTANT): 10,
    (USER, START): 7, (USER, SYSTEM): 5, (USER, ASSISTANT): 5,
    (ASSISTANT, START): 2, (ASSISTANT, SYSTEM): 0, (ASSISTANT, USER): 5,
}
BLANK = re.compile(r"[^ \t-\r]").search
LAST = re.compile(r"([^ \t-\r])[ \t-\r]*\Z").search


class Node:
    """One edit after those of its parent; `refs` counts the survivors and nodes that continue it."""

    __slots__ = ("parent", "edit", "role", "text", "depth", "refs", "next")

    def __init__(self, parent: Node | None, edit: str, role: str = "", text: str = "") -> None:
        self.parent, self.edit, self.role, self.text = parent, edit, role, text
        self.depth = parent.depth + 1 if parent else 0
        self.refs = 0
        self.next: list[Node] = []


def comes_before(one: Node, edit: str, other: Node, other_edit: str) -> bool:
    """Whether the edits up to `one` and then `edit` come before those of the other, from where they part."""
    if one is other:
        return edit < other_edit
    left, right = [edit], [other_edit]
    while one is not other:
        if one.depth >= other.depth:
            deeper, one = one, one.parent
            left.append(deeper.edit)
        else:
            deeper, other = other, other.parent
            right.append(deeper.edit)
    return left[::-1] < right[::-1]


class Survivors:
    """The cheapest edits per state; `emit` gets each edit once it is settled."""

    def __init__(self, emit: Callable[[str, str, str], None]) -> None:
        self.emit = emit
        self.base = Node(None, "")
        self.held: dict[int, tuple[int, Node]] = {}
        self._hold(self._inserted({START: (0, self.base)}))

    def _better(self, cost: int, parent: Node, edit: str, best: tuple | None) -> bool:
        if best is None or cost != best[0]:
            return best is None or cost < best[0]
        return comes_before(parent, edit, best[1], best[2])

    def _inserted(self, found: dict[int, tuple[int, Node]]) -> dict[int, tuple[int, Node]]:
        """With inserted turns, where they are cheaper or come first."""
        todo = list(found)
        while todo:
            state = todo.pop()
            cost, node = found[state]
            role, to = NEXT_ROLE[state]
            old = found.get(to)
            if old is None or self._better(cost + INSERT_COST, node, INSERT, (old[0], old[1].parent or old[1], old[1].edit)):
                found[to] = (cost + INSERT_COST, Node(node, INSERT, role))
                todo.append(to)
        return found

    def _hold(self, found: dict[int, tuple[int, Node]]) -> None:
        kept = {s: x for s, x in found.items() if not any((t, s) in MORE and found[t][0] + MORE[t, s] < x[0] for t in found)}
        for _, node in kept.values():
            node.refs += 1
            # A new node is linked to its parent when something holds it.
            while node.refs == 1 and node.parent and node not in node.parent.next:
                node.parent.next.append(node)
                node.parent.refs += 1
                node = node.parent
        for _, node in self.held.values():
            self._release(node)
        self.held = kept
        self._settle()

    def _release(self, node: Node) -> None:
        node.refs -= 1
        while node.refs == 0 and node.parent:
            node.parent.next.remove(node)
            node.parent.refs -= 1
            node = node.parent

    def _settle(self) -> None:
        while self.base.refs == 1 and self.base.next:
            node = self.base.next[0]
            self.emit(node.edit, node.role, node.text)
            node.parent, self.base = None, node

    def row(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        best: dict[int, tuple] = {}

        def offer(state: int, cost: int, parent: Node, edit: str, *turn: str) -> None:
            if self._better(cost, parent, edit, best.get(state)):
                best[state] = (cost, parent, edit, *turn)

        more = TRUNCATED_COST if truncated else 0
        for state, (cost, node) in self.held.items():
            offer(state, cost + DELETE_COST, node, DELETE)
            if not must_go:
                to = AFTER[state].get(role[:1])
                if to is not None:
                    offer(to, cost + more, node, KEEP, role, text)
                new_role, to = NEXT_ROLE[state]
                offer(to, cost + RELABEL_COST + more, node, REROLE, new_role, text)
        self._hold(self._inserted({s: (cost, Node(parent, edit, *turn)) for s, (cost, parent, edit, *turn) in best.items()}))

    def finish(self) -> int:
        """Emit what is left and return the cost."""
        final = None
        for state in FINAL:
            if state in self.held:
                cost, node = self.held[state]
                if final is None or self._better(cost, node, "", (*final, "")):
                    final = (cost, node)
        cost, node = final
        left = []
        while node is not self.base:
            left.append(node)
            node = node.parent
        for node in reversed(left):
            self.emit(node.edit, node.role, node.text)
        return cost


class Conversation:
    """One conversation while its rows come in."""

    def __init__(self, key, emit: Callable[[object, int, str, str, str], None] | None) -> None:
        self.key, self.emit = key, emit
        self.audit: list[str] = []
        self.digest = hashlib.sha256()
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = self.kept = 0
        self.first = self.last = None
        self.initial: str | None = None
        self.survivors = Survivors(self._edit)

    def _edit(self, edit: str, role: str, text: str) -> None:
        self.audit.append(edit)
        if edit != DELETE:
            self.digest.update(f"{chr(10) if self.kept else ''}{role}:{text}".encode())
            self.kept += 1
        if self.emit:
            self.emit(self.key, len(self.audit) - 1, edit, role, text)

    def row(self, turn, role: str, text: str, repeated: bool) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.turns += 1
        blank = not BLANK(text)
        repeated = repeated and not blank
        truncated = not blank and not repeated and LAST(text)[1] not in ".!?"
        self.blank += blank
        self.duplicate += repeated
        self.truncated += truncated
        if self.initial is not None and self.initial + role[:1] not in LEGAL_PAIRS:
            self.illegal += 1
        self.initial = role[:1]
        self.survivors.row(role, text, blank or repeated, truncated)

    def finish(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        cost = self.survivors.finish()
        return self.key, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, "".join(self.audit), self.digest.hexdigest()


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _ordered(rows: DataFrame, conv_id: str, turn: str, role: str, text: str, gone: Column) -> DataFrame:
    """The rows of each conversation together and in order: conv, turn, role, text, gone, repeated. One shuffle by conversation, two sorts."""
    space = F.lit(" ")
    taken = rows.select(
        F.col(conv_id).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(role, space).alias("role"), F.coalesce(text, space).alias("text"),
        F.coalesce(gone, F.lit(False)).alias("gone"),
    )
    seen = Window.partitionBy("conv", "gone", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    marked = taken.repartition("conv").withColumn("repeated", F.row_number().over(seen) > 1)
    return marked.sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text")


def _walk(batches: Iterator[pa.RecordBatch], emit=None) -> Iterator[tuple | None]:
    """Summaries of conversations as they end, and None whenever some rows have been read."""
    now: Conversation | None = None
    for batch in batches:
        for i, (key, turn, role, text, gone, repeated) in enumerate(zip(*(column.to_pylist() for column in batch.columns))):
            if now is None or key != now.key:
                if now is not None:
                    yield now.finish()
                now = Conversation(key, emit)
            if not gone:
                now.row(turn, role, text, repeated)
            if i % 1024 == 1023:
                yield None
    if now is not None:
        yield now.finish()


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 1024) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def repair(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", gone: Column | None = None) -> DataFrame:
    """One row per conversation: id, the counts of its faults, cost, audit (a letter per edit) and repaired_sha256.

    Rows where `gone` holds only say that their conversation is there.
    """
    ordered = _ordered(rows, conv_id, turn, role, text, F.lit(False) if gone is None else gone)
    key = ordered.select("conv").limit(0).toArrow().schema.field(0).type
    schema = pa.schema([("conv", key), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches((row for row in _walk(batches) if row), schema)

    ddl = f"conv {ordered.schema['conv'].dataType.simpleString()}, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired_sha256 string"
    return ordered.mapInArrow(summaries, ddl).withColumnRenamed("conv", conv_id)


def repaired_turns(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", gone: Column | None = None) -> DataFrame:
    """The edits themselves, one row each: id, place, edit, and role and text of the turn where it stays (null where deleted)."""
    ordered = _ordered(rows, conv_id, turn, role, text, F.lit(False) if gone is None else gone)
    key = ordered.select("conv").limit(0).toArrow().schema.field(0).type
    schema = pa.schema([("conv", key), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])

    def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        done: list[tuple] = []

        def emit(key, place: int, edit: str, role: str, text: str) -> None:
            done.append((key, place, edit, None if edit == DELETE else role, None if edit == DELETE else text))

        for _ in _walk(batches, emit):
            yield from done
            done.clear()

    def edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(settled(batches), schema)

    return ordered.mapInArrow(edits, f"conv {ordered.schema['conv'].dataType.simpleString()}, place long, edit string, role string, text string").withColumnRenamed("conv", conv_id)


def damaged(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", out_of: int = 20) -> DataFrame:
    """Test damage by the CRC-32 of `conv_id:turn`: conv_id, turn, role, text and gone (a dropped row)."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col(conv_id).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn).cast("string"), space))
    kind = F.crc32(name.cast("binary")) % out_of
    whole = F.coalesce(text, space)
    hit = rows.select(
        F.col(conv_id), F.col(turn),
        F.when(kind == 4, "user").otherwise(F.coalesce(role, space)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(whole, "[.!?]", "")).otherwise(whole).alias("text"),
        (kind == 0).alias("gone"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_fl_copy"),
    )
    return hit.drop("_fl_copy")
