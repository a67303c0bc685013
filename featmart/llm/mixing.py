"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Sources in code-point order (null last) get the given weights in turn. Their targets share `total_share` of all words by weight;
a target stops at `max_repeats` times its source's words, and the excess is shared anew until none is above. The words of a source,
its documents in a seeded shuffle one after another, are cut into blocks of `block_words`. The schedule is a row of slots: slot i
takes the golden-ratio point of i, the point picks a source through the cumulative targets, and the slot's rank among those
of its source names the block it takes, from the first again after the last. Every run of slots then holds the sources
nearly in proportion. A source takes its target, to the nearest word: slots beyond it are left out, the slot that reaches it takes the
beginning of its block, and slots that the schedule does not give it, as to sources of a few words, are put in evenly along the row.

A null text has no words. Documents without words are in no block and are taken 0 times; a source without words has target 0.
Documents that repeat id, source and size are interchangeable. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workdir import constant, cut
from .rows import text_key, text_of
from .running import running_total

WORD = r"[^\x20\x09-\x0D]+"
LATTICE = 1 << 31
GOLDEN = 1327217885  # 2^31 divided by the golden ratio, made odd
CHUNK = 1 << 16
_INDEX, _SIZE, _START, _ORDER, _KEY = "_fl_index", "_fl_size", "_fl_start", "_fl_order", "_fl_key"


@dataclass(frozen=True)
class MixPlan:
    """What the driver knows: one entry per source, in order."""

    sources: list[str | None]
    sizes: list[int]
    targets: list[float]


def word_count(text: str) -> Column:
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("long")


def targets(sizes: Sequence[int], weights: Sequence[float], total_share: float, max_repeats: float) -> list[float]:
    """Share by weight, stop at the caps, share the excess again."""
    left, out, active = total_share * sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while active:
        weight = sum(weights[i] for i in active)
        over = {i for i in active if left * weights[i] / weight > max_repeats * sizes[i]}
        for i in sorted(over or active):
            out[i] = float(max_repeats * sizes[i]) if over else left * weights[i] / weight
        if not over:
            break
        left -= sum(out[i] for i in sorted(over))
        active -= over
    return out


def plan_mix(sized: DataFrame, weights: Sequence[float], total_share: float, max_repeats: float, max_sources: int) -> MixPlan:
    totals = sized.groupBy("source").agg(F.sum(_SIZE).alias("n"))
    rows = totals.limit(max_sources + 1).collect()
    if len(rows) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    rows = sorted(((r["source"], r["n"]) for r in rows), key=lambda r: (r[0] is None, r[0] or ""))
    sizes = [n for _, n in rows]
    cycle = [weights[i % len(weights)] for i in range(len(rows))]
    return MixPlan([s for s, _ in rows], sizes, targets(sizes, cycle, total_share, max_repeats))


def lay_out(sized: DataFrame, plan: MixPlan, seed: int) -> DataFrame:
    """Add to each document its source's index and the words of its source that come before it in the seeded shuffle."""
    spark = sized.sparkSession
    index = spark.createDataFrame(list(enumerate(plan.sources)), f"{_INDEX} int, _fl_source string")
    rows = sized.join(F.broadcast(index), F.col("source").eqNullSafe(F.col("_fl_source"))).drop("_fl_source")
    rows = rows.withColumn(_ORDER, F.xxhash64(F.lit(seed), "doc_id", _KEY))
    rows = running_total(rows, [_INDEX, _ORDER, "doc_id", _KEY, _SIZE], _SIZE, _START)
    firsts, first = [], 0
    for size in plan.sizes:
        firsts.append(first)
        first += size
    return rows.withColumn(_START, F.col(_START) - F.get(constant(firsts, "array<bigint>"), F.col(_INDEX)))


def blocks(laid: DataFrame, block_words: int) -> DataFrame:
    """One row per document and block it lies in: source index, block, place in the block, place in the document, words."""
    end = F.col(_START) + F.col(_SIZE)
    size = F.lit(block_words).cast("long")
    first, last = F.floor(F.col(_START) / size), F.floor((end - 1) / size)
    rows = laid.where(F.col(_SIZE) > 0).withColumn("block", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col(_START), F.col("block") * size)
    return rows.select(
        "doc_id", "source", _KEY, _SIZE, _INDEX, _START, "block",
        (begin - F.col("block") * size).alias("place"),
        (begin - F.col(_START)).alias("first_word"),
        (F.least(end, (F.col("block") + 1) * size) - begin).alias("words"),
    )


def slot_count(plan: MixPlan, block_words: int) -> int:
    return round(sum(plan.targets) / block_words)


def slot_sources(plan: MixPlan, block_words: int):
    """A function from a chunk's number to its slots and the source index of each."""
    import numpy as np

    total, slots = sum(plan.targets), slot_count(plan, block_words)
    bounds = np.floor(np.cumsum(plan.targets) / total * LATTICE).astype(np.int64) if total else np.zeros(0, np.int64)
    if total:
        bounds[np.flatnonzero(np.array(plan.targets) > 0)[-1] :] = LATTICE

    def of_chunk(chunk: int) -> tuple[np.ndarray, np.ndarray]:
        slot = np.arange(chunk * CHUNK, min((chunk + 1) * CHUNK, slots), dtype=np.int64)
        point = (slot + 1) % LATTICE * GOLDEN % LATTICE
        return slot, np.searchsorted(bounds, point, side="right")

    return of_chunk


def chunk_counts(spark, plan: MixPlan, block_words: int) -> DataFrame:
    """One row per chunk and source: chunk, index and n, the slots of the source in the chunk."""
    import numpy as np
    import pandas as pd

    of_chunk, n_sources = slot_sources(plan, block_words), len(plan.sources)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for chunk in frame["chunk"]:
                counts = np.bincount(of_chunk(chunk)[1], minlength=n_sources)
                yield pd.DataFrame({"chunk": chunk, "index": np.arange(n_sources), "n": counts})

    chunks = spark.range(0, -(-slot_count(plan, block_words) // CHUNK)).withColumnRenamed("id", "chunk")
    return chunks.mapInPandas(count, "chunk long, index int, n long")


def schedule(spark, plan: MixPlan, block_words: int) -> DataFrame:
    """One row per slot: slot, source index, rank within the source, block.

    Slots are computed chunk by chunk; what is shuffled is one count per chunk and source. Points lie on a lattice of 2^31, so
    the products are exact; after that many slots the points come again, as evenly as before.
    """
    import numpy as np
    import pandas as pd

    of_chunk, n_sources = slot_sources(plan, block_words), len(plan.sources)
    n_blocks = np.array([-(-s // block_words) for s in plan.sizes], dtype=np.int64)

    def fill(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for chunk, pairs in zip(frame["chunk"], frame["before"]):
                before = np.zeros(n_sources, np.int64)
                for p in pairs:
                    before[p["index"]] = p["n"]
                slot, source = of_chunk(chunk)
                by_source = np.argsort(source, kind="stable")
                counts = np.bincount(source, minlength=n_sources)
                rank = np.empty(len(slot), np.int64)
                rank[by_source] = np.arange(len(slot)) - np.repeat(np.cumsum(counts) - counts, counts)
                rank += before[source]
                yield pd.DataFrame({"slot": slot, _INDEX: source.astype(np.int32), "rank": rank, "block": rank % np.maximum(1, n_blocks[source])})

    counts = chunk_counts(spark, plan, block_words)
    earlier = Window.partitionBy("index").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    running = counts.withColumn("n", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    # A list per chunk is as long as there are sources.
    offsets = running.groupBy("chunk").agg(F.collect_list(F.struct("index", "n")).alias("before"))
    return offsets.mapInPandas(fill, f"slot long, {_INDEX} int, rank long, block long")


def quotas(plan: MixPlan, block_words: int) -> tuple[list[int], list[int]]:
    """Per source: the slots that reach its target, and the words that the last of them takes at most."""
    slots, lasts = [], []
    for size, target in zip(plan.sizes, plan.targets):
        passes, rest = divmod(round(target), size) if size else (0, 0)
        slots.append(passes * -(-size // block_words) + -(-rest // block_words))
        lasts.append((rest - 1) % block_words + 1 if rest else block_words)
    return slots, lasts


def taken_slots(spark, plan: MixPlan, block_words: int) -> DataFrame:
    """The slots in use: slot, source index, rank, block, `at` (the place in the row) and `most` (the words it takes at most).

    Ranks of a source that the schedule does not reach get slots numbered on behind it, at even distances along the row.
    """
    needed, lasts = quotas(plan, block_words)
    n_slots = slot_count(plan, block_words)
    numbers, number = [], n_slots
    for n in needed:
        numbers.append(number)
        number += n
    sources = [(i, n, -(-plan.sizes[i] // block_words), numbers[i], (i + 1) * GOLDEN % LATTICE / LATTICE) for i, n in enumerate(needed)]
    sources = spark.createDataFrame(sources, f"{_INDEX} int, needed long, blocks long, number long, phase double")
    have = chunk_counts(spark, plan, block_words).groupBy(F.col("index").alias(_INDEX)).agg(F.sum("n").alias("have"))
    short = sources.join(have, _INDEX, "left").withColumn("have", F.coalesce("have", F.lit(0))).where("have < needed")
    added = short.withColumn("rank", F.explode(F.sequence(F.col("have"), F.col("needed") - 1))).select(
        (F.col("number") + F.col("rank")).alias("slot"),
        _INDEX,
        "rank",
        (F.col("rank") % F.col("blocks")).alias("block"),
        ((F.col("rank") - F.col("have") + F.col("phase")) / (F.col("needed") - F.col("have")) * n_slots).alias("at"),
    )
    last = F.get(constant(needed, "array<bigint>"), F.col(_INDEX)) - 1
    given = schedule(spark, plan, block_words).where(F.col("rank") <= last).withColumn("at", F.col("slot").cast("double"))
    most = F.when(F.col("rank") == last, F.get(constant(lasts, "array<bigint>"), F.col(_INDEX))).otherwise(F.lit(block_words))
    return given.unionByName(added).withColumn("most", most.cast("long"))


@dataclass(frozen=True)
class Mix:
    """`documents`: every document with its source's figures; `pieces`: what each slot takes, in the order at, slot, place."""

    plan: MixPlan
    documents: DataFrame
    pieces: DataFrame


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (3.0, 1.0, 2.0),
    total_share: float = 1.5,
    max_repeats: int = 2,
    block_words: int = 64,
    seed: int = 17,
    max_sources: int = 10_000,
    id_col: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> Mix:
    """The mix of `docs`; `max_sources` bounds the one list that the driver holds (more raise an error)."""
    sized = cut(docs.select(F.col(id_col).alias("doc_id"), F.col(source).cast("string").alias("source"), text_key(text).alias(_KEY), word_count(text).alias(_SIZE)), "sized")
    plan = plan_mix(sized, weights, total_share, max_repeats, max_sources)
    laid = cut(lay_out(sized, plan, seed), "laid-out")
    used = taken_slots(docs.sparkSession, plan, block_words)
    # The planner takes the generated slots for few; they are as many as blocks and must not be broadcast.
    pieces = blocks(laid, block_words).join(used.hint("merge"), [_INDEX, "block"]).where("place < most")
    return Mix(plan, laid, pieces.withColumn("words", F.least("words", F.col("most") - F.col("place"))).drop("most"))


def taken_words(mixed: Mix) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, source and hash of the text."""
    plan = mixed.plan
    place = [_INDEX, _START]  # two documents with words never start at the same place
    taken = mixed.pieces.groupBy(*place).agg(F.sum("words").alias("taken"))
    figures = lambda values, kind: F.get(constant(values, f"array<{kind}>"), F.col(_INDEX))
    rows = mixed.documents.join(taken, place, "left")
    return rows.select(
        "doc_id",
        F.col(_SIZE).alias("size"),
        figures(plan.sizes, "bigint").alias("source_size"),
        figures(plan.targets, "double").alias("target"),
        F.when(F.col(_SIZE) > 0, F.coalesce("taken", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("taken"),
        "source",
        _KEY,
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """`docs` with all its columns, each document as often as the mix takes it, to the nearest whole copy.

    Documents that lie whole in blocks taken once or twice come once or twice; those at the edge of what is taken are rounded.
    Documents without words are in no block and are left out. Rows that repeat id, source and text share their copies evenly.
    """
    taken = taken_words(mix(docs, id_col=id_col, text=text, source=source, **options)).where("taken > 0")
    same = taken.groupBy("doc_id", "source", _KEY).agg(F.sum("taken").alias("_fl_taken"), F.sum("size").alias("_fl_size"))
    copies = cut(same.select(F.col("doc_id").alias("_fl_id"), F.col("source").alias("_fl_source"), F.col(_KEY).alias("_fl_other"), F.round(F.col("_fl_taken") / F.col("_fl_size")).cast("int").alias("_fl_copies")).where("_fl_copies > 0"), "copies")
    on = (
        F.col(id_col).eqNullSafe(F.col("_fl_id"))
        & F.col(source).cast("string").eqNullSafe(F.col("_fl_source"))
        & (text_key(text) == F.col("_fl_other"))
    )
    found = docs.join(copies, on)
    return found.withColumn("_fl_copy", F.explode(F.sequence(F.lit(1), F.col("_fl_copies")))).select(*docs.columns)
