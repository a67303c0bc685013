"""The trie of conversations that begin alike: members, children, leaves and saved tokens of every common beginning.

A conversation is the sequence of its turns (role, text). Each distinct sequence of first turns is a node, from the root with none.

How it is spread. Turns become codes of 20 bytes, a digest and the text's length, so that sequences are narrow and sort bytewise. Equal
conversations become one row with their number; the hash of their ids is taken over blocks of ids, in order, so very many copies are
no list in any task. Distinct sequences are range-partitioned by their codes, and each range builds a ternary search tree over its own
dictionary of turns, balanced by inserting medians first. Going back through the nodes adds up members, leaves and savings without
recursion. Only nodes on the path of a range's first or last sequence can lie in other ranges too: they leave the range as partial
sums, are merged per first turn, and the root is one aggregate over what they and the ranges report. At most two paths per
range meet in a merge. A conversation's codes must fit in a task, its texts need not.

Nulls: a null role or text counts as empty, a null turn comes first, rows without a conversation id are left out. Rows of equal turn are
taken by role and text, and rows that repeat are turns like others. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workdir import cut, small_side

CODE = 20  # a digest of 16 bytes and a length of 4
ID_BLOCK = 4096
NO_ENDS = hashlib.sha256(b"").hexdigest()
SUMS = ("n_convs", "n_children", "n_leaves", "saved_tokens")


def turn_code(role: Column, text: Column) -> Column:
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    return F.concat(digest, F.unhex(F.lpad(F.hex(F.length(text)), 8, "0")))


def sequences(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, codes): one row per conversation, its turn codes in a row."""
    empty = F.lit("")
    taken = rows.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(role, empty).alias("role"), F.coalesce(text, empty).alias("text")
    )
    ordered = taken.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    coded = ordered.select("conv_id", turn_code(F.col("role"), F.col("text")).alias("code"))

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, codes = None, bytearray()
        for batch in batches:
            ids, whole = [], []
            for key, code in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key != now:
                    if now is not None:
                        ids.append(now)
                        whole.append(bytes(codes))
                    now, codes = key, bytearray()
                codes += code
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(whole, pa.binary())], names=["conv_id", "codes"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([bytes(codes)], pa.binary())], names=["conv_id", "codes"])

    return coded.mapInArrow(put_together, "conv_id long, codes binary")


def with_common_beginnings(made: DataFrame, group: int = 100, heads: int = 6) -> DataFrame:
    """Sequences whose first h turns are those of the first conversation of their group of ids; h is the CRC-32 of the id as text modulo `heads`."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int") * CODE
    longest = (heads - 1) * CODE
    first = made.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("_fl_base"), F.substring("codes", 1, longest).alias("_fl_head"))
    joined = made.join(first, F.col("conv_id") - F.col("conv_id") % group == F.col("_fl_base"), "left")
    head = F.coalesce(F.substring(F.col("_fl_head"), F.lit(1), h), F.lit(b""))
    return joined.select("conv_id", F.concat(head, F.substring(F.col("codes"), h + 1, F.length("codes"))).alias("codes"))


def distinct_sequences(made: DataFrame) -> DataFrame:
    """(codes, n, first_id, ends): equal sequences once, with the hash of their ids in ascending order."""
    block = F.floor(F.col("conv_id") / ID_BLOCK)
    text = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    blocks = made.groupBy("codes", block.alias("block")).agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first_id"), text.alias("ids"))
    ordered = blocks.repartition("codes").sortWithinPartitions("codes", "block")

    def hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        schema = pa.schema([("codes", pa.binary()), ("n", pa.int64()), ("first_id", pa.int64()), ("ends", pa.string())])
        for batch in batches:
            done = []
            for codes, _, n, first, ids in zip(*(column.to_pylist() for column in batch.columns)):
                if now is None or codes != now[0]:
                    if now is not None:
                        done.append((*now, digest.hexdigest()))
                    now, digest = (codes, n, first), hashlib.sha256(ids.encode())
                else:
                    now = (codes, now[1] + n, now[2])
                    digest.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip((*now, digest.hexdigest())), schema)], schema=schema)

    return ordered.mapInArrow(hash_ids, "codes binary, n long, first_id long, ends string")


# --- one range


class Tree:
    """A ternary search tree over sequences of numbers. Each node is one beginning; `lower` and `higher` are its siblings, `inner` its first child."""

    def __init__(self) -> None:
        self.symbol, self.lower, self.higher, self.inner, self.parent, self.depth = [-1], [0], [0], [0], [-1], [0]

    def _new(self, symbol: int, parent: int) -> int:
        self.symbol.append(symbol)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        for links in (self.lower, self.higher, self.inner):
            links.append(0)
        return len(self.symbol) - 1

    def insert(self, sequence: list[int]) -> int:
        """The node of the whole sequence."""
        at = 0
        for symbol in sequence:
            links, i = self.inner, at
            while links[i]:
                i = links[i]
                if symbol == self.symbol[i]:
                    break
                links = self.lower if symbol < self.symbol[i] else self.higher
            else:
                links[i] = self._new(symbol, at)
                i = links[i]
            at = i
        return at


def medians_first(n: int) -> Iterator[int]:
    todo = deque([(0, n)])
    while todo:
        begin, end = todo.popleft()
        if begin < end:
            middle = (begin + end) // 2
            yield middle
            todo += [(begin, middle), (middle + 1, end)]


NODE = pa.schema(
    [
        ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), *[(s, pa.int64()) for s in SUMS], ("ends_sha256", pa.string()),
        ("key", pa.binary()), ("parent_key", pa.binary()), ("top", pa.binary()), ("tokens", pa.int64()), ("shared", pa.bool_()),
    ]
)
NODE_DDL = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, "
    "key binary, parent_key binary, top binary, tokens long, shared boolean"
)


def key_of(codes: bytes) -> bytes:
    return hashlib.md5(codes).digest()


def range_nodes(rows: list[tuple[bytes, int, int, str]]) -> Iterator[tuple]:
    """Rows of NODE for the distinct sequences of one range: finished nodes, and shared ones with what their own nodes below add up to."""
    rows = sorted(rows)
    turns = sorted({codes[i : i + CODE] for codes, *_ in rows for i in range(0, len(codes), CODE)})
    number = {code: i for i, code in enumerate(turns)}
    tree, end_of = Tree(), [0] * len(rows)
    for i in medians_first(len(rows)):
        codes = rows[i][0]
        end_of[i] = tree.insert([number[codes[k : k + CODE]] for k in range(0, len(codes), CODE)])
    n = len(tree.symbol)
    convs, least, ends, seen_in = [0] * n, [None] * n, [NO_ENDS] * n, [0] * n
    for i, node in enumerate(end_of):
        convs[node], least[node], ends[node], seen_in[node] = rows[i][1], rows[i][2], rows[i][3], i
    shared = [False] * n
    for node in (end_of[0], end_of[-1]):
        while node >= 0 and not shared[node]:
            shared[node] = True
            node = tree.parent[node]
    children, leaves, saved = [0] * n, [0] * n, [0] * n
    # A parent is made before its children, so backwards every node is complete when it is met.
    for node in range(n - 1, 0, -1):
        parent = tree.parent[node]
        convs[parent] += convs[node]
        if least[parent] is None or least[node] < least[parent]:
            least[parent] = least[node]
        seen_in[parent] = seen_in[parent] or seen_in[node]
        if not shared[node]:
            leaves[node] = leaves[node] if children[node] else 1
            saved[node] += (convs[node] - 1) * int.from_bytes(turns[tree.symbol[node]][16:], "big")
            children[parent] += 1
            leaves[parent] += leaves[node]
            saved[parent] += saved[node]
    for node in range(n):
        parent, depth = tree.parent[node], tree.depth[node]
        codes = rows[seen_in[node]][0]
        up = parent >= 0 and (shared[node] or shared[parent])
        yield (
            least[node], depth, None if parent < 0 or shared[parent] else least[parent], convs[node], children[node], leaves[node], saved[node], ends[node],
            key_of(codes[: depth * CODE]) if shared[node] else None, key_of(codes[: (depth - 1) * CODE]) if up else None,
            codes[:CODE] if shared[node] and depth else None, int.from_bytes(turns[tree.symbol[node]][16:], "big") if depth else 0, shared[node],
        )


def merged_nodes(rows: list[dict]) -> Iterator[tuple]:
    """Shared nodes under one first turn, put together from the ranges they lie in."""
    nodes: dict[bytes, dict] = {}
    for row in rows:
        have = nodes.setdefault(row["key"], row)
        if have is not row:
            for name in SUMS:
                have[name] += row[name]
            have["conv_id"] = min(have["conv_id"], row["conv_id"])
            if row["ends_sha256"] != NO_ENDS:
                have["ends_sha256"] = row["ends_sha256"]
    for row in sorted(nodes.values(), key=lambda r: -r["depth"]):
        row["n_leaves"] = row["n_leaves"] if row["n_children"] else 1
        row["saved_tokens"] += (row["n_convs"] - 1) * row["tokens"]
        parent = nodes.get(row["parent_key"])
        if parent:
            parent["n_children"] += 1
            parent["n_leaves"] += row["n_leaves"]
            parent["saved_tokens"] += row["saved_tokens"]
        yield tuple(row[f.name] for f in NODE)


def _as_batches(rows: Iterator[tuple], size: int = 4096) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), NODE)], schema=NODE)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), NODE)], schema=NODE)


def prefix_trie(made: DataFrame, per_range: int = 8192) -> DataFrame:
    """One row per node of the trie of the sequences (conv_id, codes): conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256. About `per_range` distinct sequences share a tree."""
    known = cut(distinct_sequences(made), "sequences")
    ranges = max(1, -(-known.count() // per_range))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns))]
        if rows:
            yield from _as_batches(range_nodes(rows))

    def merge(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches(_as_batches(merged_nodes(table.to_pylist())), schema=NODE)

    nodes = cut(known.repartitionByRange(ranges, "codes").mapInArrow(build, NODE_DDL), "trie-nodes")
    partial = nodes.where("shared")
    merged = cut(partial.where("depth > 0").groupBy("top").applyInArrow(merge, NODE_DDL), "trie-merged")
    # The root adds up what ranges report of it and the merged nodes below it.
    reports = partial.where("depth = 0").select("conv_id", *SUMS, F.when(F.col("ends_sha256") != NO_ENDS, F.col("ends_sha256")).alias("ends")).unionByName(
        merged.where("depth = 1").select(
            F.lit(None).cast("long").alias("conv_id"), F.lit(0).alias("n_convs"), F.lit(1).alias("n_children"), "n_leaves", "saved_tokens", F.lit(None).cast("string").alias("ends")
        )
    )
    whole = reports.agg(F.min("conv_id").alias("conv_id"), *[F.sum(s).alias(s) for s in SUMS], F.min("ends").alias("ends")).where("conv_id is not null")
    root = cut(
        whole.select(
            "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children",
            F.when(F.col("n_children") == 0, F.lit(1).cast("long")).otherwise(F.col("n_leaves")).alias("n_leaves"), "saved_tokens",
            F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"), F.unhex(F.md5(F.lit(""))).alias("key"),
        ),
        "trie-root",
    )
    columns = ["conv_id", "depth", "parent_conv_id", *SUMS, "ends_sha256"]
    parents = small_side(merged.select("key", "conv_id").unionByName(root.select("key", "conv_id")).select(F.col("key").alias("_fl_key"), F.col("conv_id").alias("_fl_parent")))
    below = nodes.where("not shared").unionByName(merged)
    known_parent = below.where("parent_key is null").select(*columns)
    joined = below.where("parent_key is not null").join(parents, F.col("parent_key") == F.col("_fl_key"), "left").withColumn("parent_conv_id", F.col("_fl_parent")).select(*columns)
    return root.select(*columns).unionByName(known_parent).unionByName(joined)
