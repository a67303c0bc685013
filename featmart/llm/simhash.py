"""SimHash fingerprints and their near-duplicates by a generalised pigeonhole.

If the 64 bits are cut into m groups with thresholds that add up to d - m + 1, two fingerprints at most d bits apart are within
its threshold in some group (a threshold of -1 means that the group is not looked at). Correlated bits go into one group, so that
the groups are as independent as can be; how many groups there are and which threshold each gets is chosen by dynamic
programming on estimated numbers of candidates. Fingerprints are then probed group by group and candidates verified on all bits.

Work is done on distinct fingerprints, copies only hang on. A null text counts as empty; a text without words has the fingerprint zero
and links like any other. Rows may repeat. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workdir import cut
from .components import components
from .rows import ID, KEY, text_key, text_of, without

BITS = 64
SEED = 42
BUCKET_BLOCK = 2048
_FP, ROOT = "_fl_fp", "_fl_root"
Plan = tuple[tuple[tuple[int, ...], int], ...]  # bits and threshold of each group


def simhash(text: bytes, shingle: int) -> int:
    """The fingerprint of one text in UTF-8: a bit is 1 if it is set in more than half of the shingles' hashes."""
    import xxhash

    words = text.lower().split()  # on bytes this touches A-Z and ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, ends)), np.uint64, len(ends))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[at : at + 4096].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(_fl_id, _fl_key, _fl_fp): id, hash of the text and fingerprint as a signed long."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            found = np.fromiter((simhash(t.as_py(), shingle) for t in texts), np.uint64, len(texts)).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found)], names=[ID, KEY, _FP])

    rows = docs.select(F.col(id_col).alias(ID), text_key(text).alias(KEY), text_of(text).alias("_fl_text"))
    return rows.mapInArrow(of_batches, f"{ID} {rows.schema[ID].dataType.simpleString()}, {KEY} long, {_FP} long")


def bit_pairs(distinct: DataFrame) -> tuple[np.ndarray, int]:
    """How many fingerprints have both of two bits set, for all pairs of bits, and how many fingerprints there are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
            n += len(fps)
        values = np.append(total.ravel(), n).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], names=["at", "n"])

    sums = distinct.select(_FP).mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    values = {r["at"]: r["n"] for r in sums.collect()}  # 64 x 64 + 1 numbers
    flat = np.array([values.get(i, 0) for i in range(BITS * BITS + 1)], dtype=float)
    return flat[:-1].reshape(BITS, BITS), int(flat[-1])


def correlated_groups(pairs: np.ndarray, n: int, m: int) -> list[tuple[int, ...]]:
    """The bits in m groups of even width: each group starts with the bit most correlated with the rest and takes on its like."""
    p = np.diag(pairs) / max(1, n)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    like = np.abs(pairs / max(1, n) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(like, 0)
    left, out = set(range(BITS)), []
    for g in range(m):
        width = BITS // m + (g < BITS % m)
        group = [max(sorted(left), key=lambda b: like[b, sorted(left)].sum())]
        left.remove(group[0])
        while len(group) < width:
            group.append(max(sorted(left), key=lambda b: like[b, group].sum()))
            left.remove(group[-1])
        out.append(tuple(sorted(group)))
    return out


def project(fps: np.ndarray, bits: Sequence[int]) -> np.ndarray:
    """The given bits of each fingerprint, pushed together."""
    out = np.zeros(len(fps), np.uint64)
    for place, bit in enumerate(bits):
        out |= (fps >> np.uint64(bit) & np.uint64(1)) << np.uint64(place)
    return out


def bucket_pairs(distinct: DataFrame, options: Sequence[Sequence[tuple[int, ...]]]) -> dict[tuple[int, int], float]:
    """For each group of each option, how many pairs of fingerprints agree on all its bits, counted over all."""
    groups = [(o, g, bits) for o, option in enumerate(options) for g, bits in enumerate(option)]

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at, (_, _, bits) in enumerate(groups):
                value, n = np.unique(project(fps, bits).view(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(value), at, np.int32)), pa.array(value), pa.array(n.astype(np.int64))], names=["at", "value", "n"])

    counts = distinct.select(_FP).mapInArrow(values, "at int, value long, n long").groupBy("at", "value").agg(F.sum("n").alias("n"))
    sums = counts.groupBy("at").agg(F.sum(F.col("n").cast("double") * (F.col("n") - 1) / 2).alias("pairs")).collect()
    return {groups[r["at"]][:2]: r["pairs"] for r in sums}


def estimate(bits: Sequence[int], agree: float, p: np.ndarray, threshold: int) -> float:
    """Expected pairs within `threshold` on `bits`: those that agree, times how many more differ a little if bits were independent."""
    odds = np.array([1.0])
    for b in bits:
        d = 2 * p[b] * (1 - p[b])
        odds = np.convolve(odds, [1 - d, d])
    return max(agree, 1.0) * odds[: threshold + 1].sum() / max(odds[0], 1e-300)


def allocate(costs: Sequence[Sequence[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds from -1 up, one per group, that add up to `total` at the least cost; `costs[g][t + 1]` is group g at t."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for group in costs:
        following: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for t, more in enumerate(group, -1):
                if spent + t not in following or cost + more < following[spent + t][0]:
                    following[spent + t] = (cost + more, [*chosen, t])
        best = following
    return best[total]


def plan_probes(distinct: DataFrame, max_distance: int, row_cost: float = 30.0) -> Plan:
    """Groups and thresholds of least cost: candidates to verify, and rows to shuffle at `row_cost` candidates each."""
    pairs, n = bit_pairs(distinct)
    options = [correlated_groups(pairs, n, m) for m in range(2, max(2, max_distance + 1) + 1)]
    agree, p = bucket_pairs(distinct, options), np.diag(pairs) / max(1, n)
    plans = []
    for o, groups in enumerate(options):
        costs = [
            [0.0] + [estimate(bits, agree.get((o, g), 0), p, t) + row_cost * n * sum(math.comb(len(bits), k) for k in range(t + 1)) for t in range(max_distance + 1)]
            for g, bits in enumerate(groups)
        ]
        cost, thresholds = allocate(costs, max_distance - len(groups) + 1)
        plans.append((cost, tuple(zip(groups, thresholds))))
    return min(plans)[1]


def probes(distinct: DataFrame, plan: Plan) -> DataFrame:
    """(bucket, fp): where each fingerprint is kept, and where it looks for others."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            for g, (bits, threshold) in enumerate(plan):
                if threshold < 0:
                    continue
                own = project(fps.view(np.uint64), bits)
                for k in range(threshold + 1):
                    for flipped in combinations(range(len(bits)), k):
                        mask = np.uint64(sum(1 << f for f in flipped))
                        bucket = (own ^ mask | np.uint64(g) << np.uint64(56)).view(np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(fps)], names=["bucket", "fp"])

    return distinct.select(_FP).mapInArrow(of_batches, "bucket long, fp long")


def spread_buckets(rows: DataFrame, block: int) -> DataFrame:
    """Add the pair of blocks (lo, hi) a row is compared in: large buckets are cut into blocks, and every two blocks meet somewhere."""
    large = cut(rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block), "large-buckets")
    one = F.lit(0)
    if large.isEmpty():
        return rows.select("bucket", one.alias("lo"), one.alias("hi"), "fp")
    joined = rows.join(large, "bucket", "left").withColumn("blocks", F.coalesce(F.ceil(F.col("n") / block), F.lit(1)).cast("int"))
    own = joined.withColumn("own", F.pmod(F.xxhash64("fp"), "blocks").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return own.select("bucket", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp")


def _near_pairs(run: np.ndarray, fps: np.ndarray, max_distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places in one run whose fingerprints are near, by rising distance of place."""
    lag, at = 1, np.arange(len(run))
    while True:
        at = at[at + lag < len(run)]
        at = at[run[at] == run[at + lag]]
        if not len(at):
            return
        near = at[np.bitwise_count(fps[at] ^ fps[at + lag]) <= max_distance]
        if len(near):
            yield near, near + lag
        lag += 1


def _forest(pairs: Iterator[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
    """The root of each of n places when `pairs` are joined up: links inside what is joined already add nothing."""
    root = np.arange(n)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for left, right in pairs:
        while not np.array_equal(root, root[root]):
            root = root[root]
        apart = root[left] != root[right]
        for a, b in zip(left[apart].tolist(), right[apart].tolist()):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    while not np.array_equal(root, root[root]):
        root = root[root]
    return root


def links(distinct: DataFrame, max_distance: int = 3, block: int = BUCKET_BLOCK, plan: Plan | None = None) -> DataFrame:
    """(a, b): links that join all fingerprints at most `max_distance` bits apart; one per row and bucket, not all pairs."""
    if max_distance < 1:
        return distinct.select(F.col(_FP).alias("a"), F.col(_FP).alias("b")).limit(0)
    rows = cut(probes(distinct, plan or plan_probes(distinct, max_distance)), "probes")
    dealt = spread_buckets(rows, block).repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.zeros((0, 4), np.int64)
        for batch in batches:
            table = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])
            table = np.concatenate([kept, table])
            # The last run may go on in the next batch.
            last = np.flatnonzero((table[:, :3] != table[-1, :3]).any(axis=1))
            cut_at = last[-1] + 1 if len(last) else 0
            kept = table[cut_at:]
            yield linked(table[:cut_at])
        yield linked(kept)

    def linked(table: np.ndarray) -> pa.RecordBatch:
        fresh = np.ones(len(table), bool)
        fresh[1:] = (table[1:, :3] != table[:-1, :3]).any(axis=1)
        fps = np.ascontiguousarray(table[:, 3])
        root = _forest(_near_pairs(np.cumsum(fresh), fps.view(np.uint64), max_distance), len(table))
        moved = np.flatnonzero(fps[root] != fps)
        return pa.RecordBatch.from_arrays([pa.array(fps[moved]), pa.array(fps[root[moved]])], names=["a", "b"])

    return dealt.mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_distance: int = 3, id_col: str = "doc_id", text: str = "text", block: int = BUCKET_BLOCK) -> DataFrame:
    """One row per document: _fl_id, _fl_key, fingerprint as 16 hex digits, component_id (the smallest id reachable by links), _fl_root."""
    rows = cut(fingerprints(docs, shingle, id_col, text), "fingerprints")
    distinct = cut(rows.groupBy(_FP).agg(F.min(ID).alias("_fl_least")), "distinct-fingerprints")
    roots = cut(components(links(distinct, max_distance, block)), "components")
    rooted = distinct.join(roots, distinct[_FP] == roots["node"], "left").select(_FP, "_fl_least", F.coalesce("root", _FP).alias("root"))
    least = rooted.groupBy("root").agg(F.min("_fl_least").alias("component_id"))
    labels = cut(rooted.join(least, "root").select(_FP, F.col("root").alias(ROOT), "component_id"), "labels")
    return rows.join(labels, _FP).select(ID, KEY, F.lower(F.lpad(F.hex(_FP), 16, "0")).alias("fingerprint"), "component_id", ROOT)


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, max_distance: int = 3, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with all its columns, one row of each component: that of the smallest id (of rows that share it, one text)."""
    rows = cut(near_duplicates(docs, shingle, max_distance, id_col, text), "near-duplicates")
    same = F.col(ID).eqNullSafe(F.col("component_id"))
    kept = rows.where(same).groupBy(ROOT).agg(F.min(KEY).alias("_fl_kept"))
    stays = same & (F.col(KEY) == F.col("_fl_kept"))
    per_row = rows.join(kept, ROOT).select(ID, KEY, stays.alias("_fl_stays"))
    marked = cut(per_row.groupBy(ID, KEY).agg(F.max("_fl_stays").alias("_fl_stays"), F.count(F.lit(1)).alias("_fl_n")), "marked")
    return without(docs, marked.where(~F.col("_fl_stays")).select(ID, KEY), marked.where("_fl_stays and _fl_n > 1").select(ID, KEY), id_col, text)
