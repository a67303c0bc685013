"""Repeated byte strings by a sparse suffix array: every byte inside a string of `length` bytes that starts twice is found.

A *window* is `length` bytes that start anywhere in one text (UTF-8). Of each window the `GRAM` bytes with the smallest hash, the leftmost
of equals, are its anchor, so equal windows have equal anchors at the same place. Windows next to each other mostly share their
anchor; such a run of windows, with all its bytes, is one context, and only contexts are compared, not every byte's suffix.

How it is spread.

1. Anchors whose bytes occur once cannot lie in a repeat. They are dropped by a bitmap of fixed size; what it lets through by chance is
   dropped later, so its size decides the amount of data moved and never the result.
2. Contexts are suffixes that begin at their anchor, the leading token. Splitters from a sample of them cut their order into
   ranges. Equal contexts travel once per task, with a second mark for the next one, however many there are.
3. Each range is sorted by multikey quicksort, eight bytes to a character, and what neighbours have in common to the right, and in the
   order of the reversed left sides to the left, gives classes of equal windows.
4. Each range looks across its two boundaries: contexts with the leading token of a splitter may have equals in the next range. They are cut
   into narrower runs of windows with longer leading tokens and go round again; the last round has single windows, whose leading token
   is all of them. So a token that a third of all contexts begin with never meets in one task.
5. Runs of repeated windows go back to the texts that hold their context, by digest.

Texts are known by a 128-bit digest, so equal texts are worked out alike. A null text counts as empty. Texts shorter than `length` keep all
bytes. Rows that repeat id and text are copies like others. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workdir import cut
from .rows import text_of

LENGTH, GRAM = 200, 16
FILTER_BITS = 26
SEGMENT_BYTES = 1 << 20
REMEMBERED = 200_000
SMALL_SORT = 48
MAP_SHIFT = 15  # Spark's bitmaps have 2^15 bits
CONTEXT = pa.schema([("bucket", pa.int32()), ("digest", pa.binary()), ("left", pa.int32()), ("bytes", pa.binary())])
CONTEXT_DDL = "bucket int, digest binary, left int, bytes binary"


@dataclass(frozen=True)
class Level:
    """How wide runs of windows may be. Offsets are counted from a window's start to its anchor; runs do not cross multiples of `width`."""

    length: int
    width: int

    @property
    def core(self) -> int:
        """Bytes that all windows of a run have in common, counted from the offset that its block begins with."""
        return self.length - self.width + 1


def levels(length: int) -> list[Level]:
    widest = length - min(GRAM, length) + 1
    widths = [widest, max(1, widest // 12), 1]
    return [Level(length, w) for w in dict.fromkeys(widths)]


def digest_of(data: bytes, seed: int) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(data, seed)


# --- anchors of texts


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 32-bit hash of the `gram` bytes from each place on, put together from halves."""
    hashes = (data.astype(np.uint32) + np.uint32(1)) * np.uint32(0x9E3779B1)
    parts, width, factor, start = [], 1, 0x85EBCA6B, 0
    while True:
        if gram & width:
            parts.append((start, hashes, width))
            start += width
        if 2 * width > gram:
            break
        hashes = hashes[:-width] * np.uint32(factor) + hashes[width:]
        factor = factor * factor & 0xFFFFFFFF
        width *= 2
    n = len(data) - gram + 1
    total = np.zeros(n, np.uint32)
    for start, part, _ in parts:
        total = total * np.uint32(0xC2B2AE35) + part[start : start + n]
    total ^= total >> np.uint32(15)
    total *= np.uint32(0x2C1B3C6D)
    return total ^ (total >> np.uint32(12))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of `width` values from each place on."""
    least, done = values, 1
    while 2 * done <= width:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    if done < width:
        least = np.minimum(least[: len(least) - (width - done)], least[width - done :])
    return least


def segments(offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
    """Stretches of a batch's bytes, (from, to, windows), of bounded size; windows are (text, first start, end of starts)."""
    first, windows = 0, []
    for i in range(len(offsets) - 1):
        begin, end = int(offsets[i]), int(offsets[i + 1])
        if windows and end - first > SEGMENT_BYTES:
            yield first, begin, windows
            windows = []
        if not windows:
            first = begin
        stop = end - length + 1
        while stop - begin > SEGMENT_BYTES:
            if windows:
                yield first, begin, windows
            yield begin, begin + SEGMENT_BYTES + length - 1, [(i, begin, begin + SEGMENT_BYTES)]
            begin += SEGMENT_BYTES
            first, windows = begin, []
        if stop > begin:
            windows.append((i, begin, stop))
    if windows:
        yield first, int(offsets[-1]), windows


def runs(array: pa.Array, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per stretch of the texts: (text, first window, end of windows, place of the anchor, its hash) of every run; places count from the data's start."""
    array = array.cast(pa.large_binary())
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    data = np.frombuffer(array.buffers()[2] or b"", np.uint8)
    gram = min(GRAM, length)
    for begin, end, windows in segments(offsets, length):
        hashes = gram_hashes(data[begin:end], gram)
        ranked = (hashes.astype(np.uint64) << np.uint64(32)) | np.arange(len(hashes), dtype=np.uint64)
        anchors = (sliding_least(ranked, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        changes = np.ones(len(anchors), bool)
        changes[1:] = anchors[1:] != anchors[:-1]
        of_text = np.full(len(anchors), -1)
        for text, start, stop in windows:
            of_text[start - begin : stop - begin] = text
            changes[start - begin] = True
            changes[stop - begin : stop - begin + 1] = True
        starts = np.flatnonzero(changes)
        ends = np.append(starts[1:], len(anchors))
        kept = of_text[starts] >= 0
        starts, ends = starts[kept], ends[kept]
        at = anchors[starts]
        yield of_text[starts], starts + begin, ends + begin, at + begin, hashes[at]


def frequent_slots(texts: DataFrame, length: int, bits: int) -> tuple[bytes, int]:
    """A bitmap of the hash slots that two or more anchors fall into, and how many anchors do."""
    mask = np.uint32((1 << bits) - 1)

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [hashes & mask for *_, hashes in runs(batch.column(0), length)]
            if found:
                slot, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(np.minimum(n, 1 << 30).astype(np.int32))], names=["slot", "n"])

    counted = texts.select("text").mapInArrow(slots, "slot int, n int").groupBy("slot").agg(F.sum("n").alias("n")).where("n > 1")
    maps = counted.groupBy(F.shiftright("slot", MAP_SHIFT).alias("part")).agg(
        F.bitmap_construct_agg(F.col("slot").bitwiseAND(F.lit((1 << MAP_SHIFT) - 1)).cast("long")).alias("bits"), F.sum("n").alias("n")
    )
    # The maps together have 2^bits bits, whatever the number of texts.
    whole, anchors = bytearray(1 << bits - 3), 0
    for part, piece, n in zip(*(column.to_pylist() for column in maps.toArrow().columns)):
        at = part << MAP_SHIFT - 3
        whole[at : at + len(piece)] = piece
        anchors += n
    return bytes(whole), anchors


def passes(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slots = hashes.astype(np.int64) & (8 * len(bitmap) - 1)
    return (bitmap[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1


# --- contexts


@dataclass(frozen=True)
class Order:
    """The order of contexts at one level, cut into ranges by splitters."""

    level: Level
    splitters: list[bytes]

    def key(self, left: int, data: bytes) -> bytes:
        """The suffix that starts at the block's core, then what is left of it, read backwards."""
        before = left - left // self.level.width * self.level.width
        return data[before:] + data[:before][::-1]

    def bucket(self, left: int, data: bytes) -> int:
        return bisect_right(self.splitters, self.key(left, data))

    def edges(self, bucket: int) -> list[bytes]:
        """The leading tokens that this range may have in common with its neighbours."""
        return [s[: self.level.core] for s in self.splitters[max(0, bucket - 1) : bucket + 1]]


def text_contexts(bitmap: bytes, length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[bytes, int, int, bytes]]]:
    """Per stretch: (digest of the text, first window, bytes left of the anchor in the context, context) for runs whose anchor may occur again."""
    bits = np.frombuffer(bitmap, np.uint8)
    for batch in batches:
        array = batch.column(0).cast(pa.large_binary())
        offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
        data = memoryview(array.buffers()[2] or b"")
        known: dict[int, bytes] = {}
        for text, start, end, at, hashes in runs(array, length):
            kept = np.flatnonzero(passes(bits, hashes))
            found = []
            for t, s, e, a in zip(text[kept].tolist(), start[kept].tolist(), end[kept].tolist(), at[kept].tolist()):
                first = int(offsets[t])
                if t not in known:
                    known[t] = digest_of(data[first : int(offsets[t + 1])], 0)
                found.append((known[t], s - first, a - s, bytes(data[s : e + length - 1])))
            yield found


def narrower(level: Level, left: int, data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """A context cut into runs of one level: (windows before it, bytes left of its anchor, its bytes)."""
    least = left - (len(data) - level.length)  # the anchor's offset in the last window
    high = left
    while high >= least:
        low = max(least, high // level.width * level.width)
        yield left - high, high, data[left - high : left - low + level.length]
        high = low - 1


def open_contexts(level: Level, batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[bytes, int, int, bytes]]]:
    """Like `text_contexts`, of contexts left open at the level before: (digest of the context, windows before, left, bytes), as often as it is marked."""
    for batch in batches:
        found = []
        for digest, left, data, marks in zip(*(column.to_pylist() for column in batch.columns)):
            for piece in narrower(level, left, data):
                found.extend([(digest, *piece)] * min(2, marks))
        yield found


def context_digest(left: int, data: bytes) -> bytes:
    return digest_of(data, left + 1)


def sent_contexts(order: Order, stretches: Iterator[list[tuple[bytes, int, int, bytes]]]) -> Iterator[pa.RecordBatch]:
    """Contexts for their ranges: with bytes when a task first meets one, without when it meets it again, and then no more."""
    seen: dict[bytes, int] = {}
    for found in stretches:
        if len(seen) > REMEMBERED:
            seen.clear()
        rows = []
        for _, _, left, data in found:
            digest = context_digest(left, data)
            times = seen.get(digest, 0)
            if times < 2:
                seen[digest] = times + 1
                rows.append((order.bucket(left, data), digest, left, None if times else data))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), CONTEXT)], schema=CONTEXT)


# --- one range


def multikey_quicksort(rows: list[bytes]) -> np.ndarray:
    """The order of byte strings, shorter ones before those they begin. Eight bytes are one character; short stretches go to the built-in sort."""
    n = len(rows)
    words = -(-max(map(len, rows), default=0) // 8)
    table = np.frombuffer(b"".join(r.ljust(8 * words, b"\0") for r in rows), ">u8").reshape(n, words).astype(np.uint64)
    sizes = np.array([len(r) for r in rows])
    order = np.arange(n)
    todo = [(0, n, 0)]
    while todo:
        begin, end, depth = todo.pop()
        if end - begin < 2:
            continue
        part = order[begin:end]
        if depth == words:
            order[begin:end] = part[np.argsort(sizes[part], kind="stable")]
            continue
        if end - begin <= SMALL_SORT:
            order[begin:end] = sorted(part.tolist(), key=rows.__getitem__)
            continue
        characters = table[part, depth]
        pivot = np.sort(characters[:: 1 + len(part) // 9])[(len(characters[:: 1 + len(part) // 9])) // 2]
        less, more = characters < pivot, characters > pivot
        same = ~(less | more)
        one, two = begin + int(less.sum()), end - int(more.sum())
        order[begin:end] = np.concatenate([part[less], part[same], part[more]])
        todo += [(begin, one, depth), (one, two, depth + 1), (two, end, depth)]
    return order


def common_with_next(rows: list[bytes]) -> np.ndarray:
    """How many first bytes each of the sorted rows has in common with the row before it; 0 for the first."""
    if not rows:
        return np.zeros(0, np.int64)
    width = max(map(len, rows)) + 1
    table = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rows), np.uint8).reshape(len(rows), width)
    sizes = np.array([len(r) for r in rows])
    common = np.zeros(len(rows), np.int64)
    for begin in range(1, len(rows), 4096):
        end = min(len(rows), begin + 4096)
        differs = table[begin:end] != table[begin - 1 : end - 1]
        first = np.where(differs.any(1), differs.argmax(1), width)
        common[begin:end] = np.minimum(first, np.minimum(sizes[begin:end], sizes[begin - 1 : end - 1]))
    return common


def repeated_windows(level: Level, lefts: list[int], rows: list[bytes], marks: np.ndarray) -> np.ndarray:
    """Per context and window of the block (by offset from the block's first), whether an equal window is in another context or in a second copy of this one.

    Windows at one offset are equal when their right parts are in one run of the sorted suffixes and their left parts in one run of the
    sorted reversed left sides, both cut where neighbours have less in common than the part is long.
    """
    n, width, length = len(rows), level.width, level.length
    inner = np.array([left % width for left in lefts])  # offset of the first window in its block
    block = np.array([left // width for left in lefts])
    last = inner - (np.array([len(r) for r in rows]) - length)
    rights = [r[i:] for r, i in zip(rows, inner.tolist())]
    before = [r[:i][::-1] for r, i in zip(rows, inner.tolist())]
    by_right, by_left = multikey_quicksort(rights), multikey_quicksort(before)
    right_common = common_with_next([rights[i] for i in by_right.tolist()])
    left_common = common_with_next([before[i] for i in by_left.tolist()])
    hit = np.zeros((n, width), bool)
    right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for offset in range(width):
        there = np.flatnonzero((last <= offset) & (offset <= inner))
        if not len(there):
            continue
        right_class[by_right] = np.cumsum(right_common < length - offset)
        left_class[by_left] = np.cumsum(left_common < offset) if offset else 0
        same = (right_class[there] * (n + 1) + left_class[there]) * (block.max() + 1) + block[there]
        order = np.argsort(same, kind="stable")
        ranked = same[order]
        equal = np.zeros(len(order), bool)
        equal[1:] = ranked[1:] == ranked[:-1]
        twice = equal.copy()
        twice[:-1] |= equal[1:]
        hit[there[order], offset] = twice
        hit[there, offset] |= marks[there] > 1
    return hit


RESOLVED = pa.schema([("digest", pa.binary()), ("first", pa.int32()), ("last", pa.int32()), ("left", pa.int32()), ("bytes", pa.binary()), ("marks", pa.int32())])
RESOLVED_DDL = "digest binary, first int, last int, left int, bytes binary, marks int"


def resolve(order: Order, bucket: int, digests: list[bytes], lefts: list[int], rows: list[bytes | None]) -> list[tuple]:
    """Rows of RESOLVED for one range: runs of repeated windows (first, last), or the context itself where it may have equals in another range."""
    level = order.level
    marks: dict[bytes, int] = {}
    known: dict[bytes, tuple[int, bytes]] = {}
    for digest, left, data in zip(digests, lefts, rows):
        marks[digest] = marks.get(digest, 0) + 1
        if data is not None:
            known[digest] = (left, data)
    token = {d: data[left % level.width :][: level.core] for d, (left, data) in known.items()}
    edges = set(order.edges(bucket)) if level.width > 1 else set()
    out = [(d, None, None, *known[d], marks[d]) for d in known if token[d] in edges]
    shared: dict[bytes, int] = {}
    for d in known:
        shared[token[d]] = shared.get(token[d], 0) + marks[d]
    inside = [d for d in known if token[d] not in edges and shared[token[d]] > 1]
    if not inside:
        return out
    left_of = [known[d][0] for d in inside]
    hit = repeated_windows(level, left_of, [known[d][1] for d in inside], np.array([marks[d] for d in inside]))
    for d, left, row in zip(inside, left_of, hit):
        inner = left % level.width
        # In the order of windows the offset falls from `inner`.
        ordered = np.concatenate([[0], row[: inner + 1][::-1].astype(np.int8), [0]])
        change = np.flatnonzero(np.diff(ordered))
        out += [(d, int(b), int(e) - 1, None, None, None) for b, e in zip(change[::2], change[1::2])]
    return out


# --- rounds


def _repeats(source: DataFrame, stretches, chain: list[Level], n_contexts: int, per_range: int, label: str) -> DataFrame:
    """(digest, first, last): runs of repeated windows of every context that `stretches` makes of the rows of `source`."""
    level, spark = chain[0], source.sparkSession
    ranges = max(1, -(-n_contexts // per_range))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = Order(level, [])
        for found in stretches(batches):
            taken = [order.key(left, data) for _, _, left, data in found if context_digest(left, data)[0] % 8 == 0]
            if taken:
                yield pa.RecordBatch.from_arrays([pa.array(taken, pa.binary())], names=["key"])

    share = min(1.0, 400 * ranges / max(1, n_contexts))
    some = sorted(set(source.sample(share, seed=1).mapInArrow(keys, "key binary").toArrow()["key"].to_pylist())) if ranges > 1 else []
    order = Order(level, [some[i * len(some) // ranges] for i in range(1, ranges)] if len(some) >= ranges else some)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return sent_contexts(order, stretches(batches))

    def settle(table: pa.Table) -> pa.Table:
        rows = resolve(order, table["bucket"][0].as_py(), *(table[c].to_pylist() for c in ("digest", "left", "bytes")))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), RESOLVED)] if rows else [pa.array([], f.type) for f in RESOLVED], schema=RESOLVED)

    resolved = cut(source.mapInArrow(send, CONTEXT_DDL).groupBy("bucket").applyInArrow(settle, RESOLVED_DDL), f"{label}-repeats")
    done = resolved.where("bytes is null").select("digest", "first", "last")
    left = resolved.where("bytes is not null").select("digest", "left", "bytes", "marks")
    n_open = left.count() if len(chain) > 1 else 0
    if not n_open:
        return done
    below = chain[1]
    parts = left.repartition(max(1, -(-n_open // 4096)), "digest")

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[bytes, int, int, bytes]]]:
        return open_contexts(below, batches)

    inner = _repeats(parts, cut_up, chain[1:], n_open * max(1, level.width // below.width), per_range, f"{label}-{below.width}")
    return done.unionByName(_back(parts, cut_up, inner).select(F.col("owner").alias("digest"), "first", "last"))


def _back(source: DataFrame, stretches, found: DataFrame) -> DataFrame:
    """(owner, first, last): runs of windows handed back to the owners of each context. Owners of one context are listed together per stretch."""

    def owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in stretches(batches):
            lists: dict[bytes, list] = {}
            for owner, shift, left, data in rows:
                lists.setdefault(context_digest(left, data), []).append((owner, shift))
            if lists:
                owned = [b"".join(o for o, _ in sorted(set(v))) for v in lists.values()]
                shifts = [np.array([s for _, s in sorted(set(v))], np.int64).tobytes() for v in lists.values()]
                yield pa.RecordBatch.from_arrays([pa.array(list(lists), pa.binary()), pa.array(owned, pa.binary()), pa.array(shifts, pa.binary())], names=["digest", "owners", "shifts"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owned, shifts, first, last = (column.to_pylist() for column in batch.columns)
            rows = []
            for o, s, f, e in zip(owned, shifts, first, last):
                for i, shift in enumerate(np.frombuffer(s, np.int64).tolist()):
                    rows.append((o[16 * i : 16 * i + 16], shift + f, shift + e))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.binary(), pa.int64(), pa.int64()))], names=["owner", "first", "last"])

    owned = source.mapInArrow(owners, "digest binary, owners binary, shifts binary")
    return owned.join(found, "digest").select("owners", "shifts", "first", "last").mapInArrow(spread, "owner binary, first long, last long")


def merged(starts: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Stretches of bytes, end exclusive, covered by the windows first..last."""
    out: list[list[int]] = []
    for first, last in sorted(starts):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last + length)
        else:
            out.append([first, last + length])
    return [tuple(x) for x in out]


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH, per_range: int = 16_384, filter_bits: int = FILTER_BITS
) -> DataFrame:
    """One row per document: id, n_bytes, spans (stretches of removed bytes, end exclusive) and kept (the other bytes, which may cut characters).

    `per_range` contexts of at most 2 * `length` bytes are sorted in one task; `filter_bits` sizes the bitmap that drops anchors that occur once.
    """
    texts = docs.select(text_of(text).cast("binary").alias("text")).where(F.octet_length("text") >= length)
    bitmap, n_contexts = frequent_slots(texts, length, filter_bits)

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[bytes, int, int, bytes]]]:
        return text_contexts(bitmap, length, batches)

    found = _repeats(texts, stretches, levels(length), n_contexts, per_range, "suffix")
    windows = _back(texts, stretches, found).distinct().groupBy("owner").agg(F.collect_list(F.struct("first", "last")).alias("windows"))
    kind = docs.schema[id_col].dataType.simpleString()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [digest_of(t.as_py(), 0) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], names=["id", "text", "owner"])

    def take_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, kept, sizes = [], [], []
            for data, runs_of in zip(batch.column(1), batch.column(2).to_pylist()):
                data = data.as_py()
                gone = merged([(w["first"], w["last"]) for w in runs_of or []], length)
                edges = [0, *(x for span in gone for x in span), len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
                spans.append([{"start": a, "end": b} for a, b in gone])
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                names=["id", "n_bytes", "spans", "kept"],
            )

    keyed = docs.select(F.col(id_col).alias("id"), text_of(text).cast("binary").alias("text")).mapInArrow(digests, f"id {kind}, text binary, owner binary")
    joined = keyed.join(windows, "owner", "left").select("id", "text", "windows")
    return joined.mapInArrow(take_out, f"id {kind}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary").withColumnRenamed("id", id_col)
