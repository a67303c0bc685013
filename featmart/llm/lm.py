"""Scoring texts by a bigram model with deleted interpolation.

Tokens are words (runs without ASCII white space, A-Z in lower case) and one end per text; the first token's context is a start. A token's
probability mixes its maximum-likelihood share of what followed its context with its smoothed share of all tokens,

    p(w | h) = a * c(h, w) / c(h) + (1 - a) * (c(w) + 1) / (N + V + 1)

where the weight `a` belongs to the context's frequency bucket, the power of two below c(h), and is 0 for unseen contexts. Weights are
learned by expectation-maximisation on held-out counts: each training token in turn is deleted from the counts and predicted
from the rest. All counts are over all training texts. Words are known by a 64-bit hash.

How it is spread. The most frequent words, a fixed number, are known to all tasks with their counts. Every pair of neighbours goes to one
bucket of pairs: by the pair when both words are frequent, else by its rare word, which then meets its own count there. Pairs
of two rare words also need the context's count, which is joined to them before. Pairs are counted per text first, and travel as
arrays, one row per block of texts and bucket. The same shuffled rows are read twice, for the weights and for the scores.

A null text counts as empty: an end alone. Rows that repeat id and text count each; they get the same score. An empty table gives no rows; without
training texts every token is unknown.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workdir import cut
from .rows import text_of

FREQUENT = (1 << 16) - 1  # with the start, an index of 16 bits
START = FREQUENT
END_KEY = np.uint64(0x9E3779B97F4A7C15)
BLOCK_TEXTS, BLOCK_BYTES = 512, 2_000_000
TRAIN_BIT = 15  # of a text's place in its block
STEPS_PER_OCTAVE = 16
NOTHING = -(1 << 20)
_KEY, _TRAIN = "_fl_key", "_fl_train"
ARRAYS = ("ff_h", "ff_w", "ff_doc", "ff_n", "fr_h", "fr_w", "fr_doc", "fr_n", "rf_h", "rf_w", "rf_doc", "rf_n", "rr_h", "rr_w", "rr_c", "rr_doc", "rr_n")
KINDS = {"h": "<u2", "w": "<u2", "doc": "<u2", "n": "<u4", "c": "<i8"}
HEAD = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("texts", pa.binary())])
PACKED = "bucket int, block long, texts binary, " + ", ".join(f"{a} binary" for a in ARRAYS)


def kind_of(array: str) -> str:
    """Frequent words are indexes, rare ones hashes."""
    pair, what = array.split("_")
    rare = (what == "h" and pair[0] == "r") or (what == "w" and pair[1] == "r")
    return "<u8" if rare else KINDS[what]


@dataclass(frozen=True)
class Vocabulary:
    """Of the training texts: tokens, distinct tokens, and the most frequent ones by rising hash with their counts (the start last)."""

    tokens: int
    distinct: int
    keys: np.ndarray
    counts: np.ndarray

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Places among the frequent words, -1 for others."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)


@dataclass(frozen=True)
class Pairs:
    """Neighbours of one block of texts, counted per text: places in `words`, -1 for the start as context."""

    words: np.ndarray
    doc: np.ndarray
    context: np.ndarray
    word: np.ndarray
    n: np.ndarray


def word_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of the texts, ends included, and the number of tokens of each."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = [t.lower().split() for t in texts]
    sizes = np.array([len(w) + 1 for w in words], np.int64)
    keys = np.full(sizes.sum(), END_KEY, np.uint64)
    inner = np.ones(len(keys), bool)
    inner[np.cumsum(sizes) - 1] = False
    keys[inner] = np.fromiter((digest(x) for w in words for x in w), np.uint64, int(sizes.sum() - len(sizes)))
    return keys, sizes


def neighbours(texts: list[bytes]) -> Pairs:
    keys, sizes = word_keys(texts)
    words, at = np.unique(keys, return_inverse=True)
    before = np.empty(len(at), np.int64)
    before[1:] = at[:-1] + 1
    before[np.cumsum(sizes) - sizes] = 0  # the start
    doc = np.repeat(np.arange(len(texts)), sizes)
    width = int(len(words) + 1).bit_length()
    code, n = np.unique((doc << 2 * width) | (before << width) | at, return_counts=True)
    mask = (1 << width) - 1
    return Pairs(words, code >> 2 * width, ((code >> width) & mask) - 1, code & mask, n)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Batches cut so that a block has a bounded number of texts and, but for single long ones, of bytes."""
    for batch in batches:
        texts = batch.column(batch.num_columns - 1).cast(pa.binary())
        first = held = 0
        taken: list[bytes] = []
        for i, text in enumerate(texts):
            data = text.as_py()
            if taken and (len(taken) == BLOCK_TEXTS or held + len(data) > BLOCK_BYTES):
                yield batch.slice(first, i - first), taken
                first, held, taken = i, 0, []
            taken.append(data)
            held += len(data)
        if taken:
            yield batch.slice(first), taken


def batch_of(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns))


def vocabulary(rows: DataFrame) -> tuple[DataFrame, Vocabulary]:
    """Counts of all training tokens as a table (word, n), and what the driver takes from it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in blocks(batches):
            words, n = np.unique(word_keys(texts)[0], return_counts=True)
            yield batch_of(word=words.view(np.int64), n=n.astype(np.int64))

    counted = rows.where(_TRAIN).select("text").mapInArrow(count, "word long, n long")
    table = cut(counted.groupBy("word").agg(F.sum("n").alias("n")), "unigrams")
    whole = table.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    top = table.orderBy(F.desc("n"), "word").limit(FREQUENT).toArrow()
    keys, counts = (top[c].to_numpy().astype(np.int64) for c in ("word", "n"))
    order = np.argsort(keys.view(np.uint64))
    texts = int(table.where(F.col("word") == int(END_KEY.view(np.int64))).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    with_start = np.zeros(FREQUENT + 1, np.int64)
    with_start[: len(order)] = counts[order]
    with_start[START] = texts
    return table, Vocabulary(int(whole["n"]), int(whole["v"]), keys.view(np.uint64)[order], with_start)


def packed_batch(rows: list[dict]) -> pa.RecordBatch:
    schema = pa.schema([*HEAD, *[(a, pa.binary()) for a in ARRAYS]])
    return pa.RecordBatch.from_pylist([{a: b"" for a in ("texts", *ARRAYS)} | row for row in rows], schema)


def pack_rows(texts: np.ndarray, bucket: np.ndarray, kind: np.ndarray, columns: dict[str, np.ndarray], n_buckets: int) -> pa.RecordBatch:
    """One row per bucket of a block of texts, and one that lists the texts.

    `columns` has h, w, doc and n of all pairs; `kind` is 0 to 2 for the pairs ff, fr and rf.
    """
    import xxhash

    listed = texts.astype("<i8").tobytes()
    block = xxhash.xxh64_intdigest(listed) >> 1
    order = np.lexsort((kind, bucket))
    bounds = np.searchsorted((bucket * 4 + kind)[order], np.arange(4 * n_buckets + 1))
    rows = {int(b): {"bucket": int(b), "block": block} for b in np.unique(bucket)}
    for array in ARRAYS:
        pair, what = array.split("_")
        if pair != "rr":
            at = ("ff", "fr", "rf").index(pair)
            values = columns[what][order].astype(kind_of(array))
            for b, row in rows.items():
                row[array] = values[bounds[4 * b + at] : bounds[4 * b + at + 1]].tobytes()
    return packed_batch([{"bucket": block % n_buckets, "block": block, "texts": listed}, *rows.values()])


def pack_pairs(rows: DataFrame, known: Vocabulary, n_buckets: int) -> DataFrame:
    """All pairs but those of two rare words."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in blocks(batches):
            p = neighbours(texts)
            keys, train = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            place = known.index(p.words)
            h = np.where(p.context < 0, START, place[p.context])
            w = place[p.word]
            kind = 2 * (h < 0) + (w < 0)
            rare = p.words[np.where(w < 0, p.word, p.context)]
            both = (h << 16 | w).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
            bucket = (np.where(kind == 0, both, rare) % np.uint64(n_buckets)).astype(np.int64)
            chosen = kind < 3
            columns = {
                "h": np.where(h < 0, p.words[p.context], h.astype(np.uint64)), "w": np.where(w < 0, p.words[p.word], w.astype(np.uint64)),
                "doc": p.doc | train.astype(np.int64)[p.doc] << TRAIN_BIT, "n": p.n,
            }
            yield pack_rows(keys, bucket[chosen], kind[chosen], {k: v[chosen] for k, v in columns.items()}, n_buckets)

    return rows.select(_KEY, _TRAIN, "text").mapInArrow(pack, PACKED)


def pack_rare_pairs(rows: DataFrame, table: DataFrame, known: Vocabulary, n_buckets: int) -> DataFrame:
    """Pairs of two rare words with the count of the context, joined from the table of all words."""

    def list_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in blocks(batches):
            p = neighbours(texts)
            place = known.index(p.words)
            rare = np.flatnonzero((p.context >= 0) & (place[p.context] < 0) & (place[p.word] < 0))
            keys, train = (part.column(i).to_numpy(zero_copy_only=False)[p.doc[rare]] for i in (0, 1))
            yield batch_of(text=keys, train=train, h=p.words[p.context[rare]].view(np.int64), w=p.words[p.word[rare]].view(np.int64), n=p.n[rare].astype(np.int64))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, train, h, w, n, c = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(6))
            bucket = (w.view(np.uint64) % np.uint64(n_buckets)).astype(np.int64)
            order, used = np.argsort(bucket, kind="stable"), np.unique(bucket)
            made = []
            # These pairs are few and of many texts, so each row lists only its own texts.
            for b, at in zip(used, np.split(order, np.searchsorted(bucket[order], used[1:]))):
                texts, first, doc = np.unique(text[at], return_index=True, return_inverse=True)
                marked = doc | train[at][first].astype(np.int64)[doc] << TRAIN_BIT
                values = {"h": h[at].view(np.uint64), "w": w[at].view(np.uint64), "c": c[at], "doc": marked, "n": n[at]}
                arrays = {a: values[a[3:]].astype(kind_of(a)).tobytes() for a in ARRAYS if a.startswith("rr")}
                made.append({"bucket": int(b), "block": -1 - int(b), "texts": texts.astype("<i8").tobytes(), **arrays})
            yield packed_batch(made)

    pairs = rows.select(_KEY, _TRAIN, "text").mapInArrow(list_pairs, "text long, train boolean, h long, w long, n long")
    counted = pairs.join(table.select(F.col("word").alias("h"), F.col("n").alias("c")), "h", "left")
    return counted.select("text", "train", "h", "w", "n", F.coalesce("c", F.lit(0)).alias("c")).mapInArrow(pack, PACKED)


@dataclass(frozen=True)
class Counted:
    """Pairs of one bucket with all their counts: row and place of the text in it, uses, c(h, w), c(h), c(w), and one of each pair."""

    text: np.ndarray
    n: np.ndarray
    both: np.ndarray
    context: np.ndarray
    word: np.ndarray
    first: np.ndarray


def count_bucket(rows: list[dict], known: Vocabulary) -> Counted:
    """Counts of a whole bucket: every use of its pairs, and of its rare words as tokens, is here."""
    take = lambda a: np.concatenate([np.frombuffer(r[a], kind_of(a)) for r in rows])
    n = {p: take(f"{p}_n") for p in ("ff", "fr", "rf", "rr")}
    doc = {p: take(f"{p}_doc") for p in n}
    used = {p: n[p] * (doc[p] >> TRAIN_BIT) for p in n}  # in training
    # Rare words as tokens.
    fr_w, rr_w, rf_h, rr_h = (take(a) for a in ("fr_w", "rr_w", "rf_h", "rr_h"))
    rare, at = np.unique(np.concatenate([fr_w, rr_w, rf_h, rr_h]), return_inverse=True)
    fr_w, rr_w, rf_h, rr_h = np.split(at, np.cumsum([len(fr_w), len(rr_w), len(rf_h)]))
    counts = np.bincount(np.concatenate([fr_w, rr_w]), weights=np.concatenate([used["fr"], used["rr"]]), minlength=len(rare)).astype(np.int64)
    ff_h, ff_w, fr_h, rf_w = (take(a).astype(np.int64) for a in ("ff_h", "ff_w", "fr_h", "rf_w"))
    code = {"ff": ff_h << 16 | ff_w, "fr": fr_w << 16 | fr_h, "rf": rf_h << 16 | rf_w, "rr": rr_h << 32 | rr_w}
    context = [known.counts[ff_h], known.counts[fr_h], counts[rf_h], take("rr_c")]
    word = [known.counts[ff_w], counts[fr_w], known.counts[rf_w], counts[rr_w]]
    both, first = [], []
    for p in n:
        _, where, place = np.unique(code.pop(p), return_index=True, return_inverse=True)
        both.append(np.bincount(place, weights=used[p], minlength=len(where)).astype(np.int64)[place])
        mark = np.zeros(len(place), bool)
        mark[where] = True
        first.append(mark)
    row = np.concatenate([np.repeat(np.arange(len(rows)), [len(r[f"{p}_doc"]) // 2 for r in rows]) for p in n])
    text = row << 16 | np.concatenate(list(doc.values())) & ((1 << TRAIN_BIT) - 1)
    return Counted(text, np.concatenate(list(n.values())), *map(np.concatenate, (both, context, word, first)))


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[dict], list | None]]:
    """The rows of one bucket after the other, with the weights that came with them, if any."""
    held: list[dict] = []
    bucket, weight = -1, None
    for batch in batches:
        columns = {name: batch.column(name) for name in ("texts", *ARRAYS)}
        for i, (number, block) in enumerate(zip(batch.column("bucket").to_pylist(), batch.column("block").to_pylist())):
            if held and bucket != number:
                yield held, weight
                held = []
            bucket = number
            weight = batch.column("weights")[i].as_py() if not held and "weights" in batch.schema.names else weight
            held.append({"block": block} | {name: column[i].as_buffer() for name, column in columns.items()})
    if held:
        yield held, weight


def frequency_bucket(counts: np.ndarray) -> np.ndarray:
    """The power of two at or below a count, 0 for counts of 0."""
    return np.where(counts > 0, np.frexp(counts.astype(float))[1] - 1, 0).astype(np.int64)


def held_out_counts(packed: DataFrame, known: Vocabulary) -> DataFrame:
    """(bucket, step, n): training tokens by their context's frequency bucket and by the ratio of what the deleted counts of the pair and
    of the word alone give them, on a scale of `STEPS_PER_OCTAVE` steps per factor of two; a table of bounded size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _ in by_bucket(batches):
            c = count_bucket(rows, known)
            use = c.first & (c.both > 0)
            both, context, word = c.both[use], c.context[use], c.word[use]
            alone = word / (known.tokens + known.distinct)
            with np.errstate(divide="ignore", invalid="ignore"):
                ratio = (both - 1) / (context - 1) / alone
                step = np.where((both > 1) & (context > 1), np.rint(STEPS_PER_OCTAVE * np.log2(ratio)), NOTHING).astype(np.int64)
            code, at = np.unique(frequency_bucket(context) << 32 | (step - NOTHING), return_inverse=True)
            n = np.bincount(at, weights=both).astype(np.int64)
            yield batch_of(bucket=(code >> 32).astype(np.int32), step=((code & 0xFFFFFFFF) + NOTHING).astype(np.int32), n=n)

    return packed.mapInArrow(count, "bucket int, step int, n long").groupBy("bucket", "step").agg(F.sum("n").alias("n"))


def learn_weight(ratio: np.ndarray, n: np.ndarray, rounds: int = 200) -> float:
    """The weight of the pair model that makes the held-out counts most probable, by expectation-maximisation."""
    weight = 0.5
    for _ in range(rounds):
        share = weight * ratio / (weight * ratio + 1 - weight)
        following = min(float((n * share).sum() / n.sum()), 1 - 1e-6)
        if abs(following - weight) < 1e-9:
            break
        weight = following
    return following


def weights(held_out: DataFrame) -> DataFrame:
    """One row: an array of (bucket, weight)."""

    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("step")
        step = frame["step"].to_numpy()
        ratio = np.where(step == NOTHING, 0.0, 2.0 ** (np.maximum(step, -20_000) / STEPS_PER_OCTAVE))
        return pd.DataFrame({"bucket": [int(frame["bucket"].iloc[0])], "weight": [learn_weight(ratio, frame["n"].to_numpy(float))]})

    learned = held_out.groupBy("bucket").applyInPandas(learn, "bucket int, weight double")
    return learned.agg(F.sort_array(F.collect_list(F.struct("bucket", "weight"))).alias("weights"))  # at most 64 buckets


def score_texts(packed: DataFrame, known: Vocabulary) -> DataFrame:
    """(text, score, base_score, n_known) summed over tokens; `packed` carries the column weights.

    Sums travel as arrays too, a row per block and bucket, and meet the block's list of texts.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, pairs in by_bucket(batches):
            c = count_bucket(rows, known)
            weight = np.zeros(64)
            for p in pairs or []:
                weight[p["bucket"]] = p["weight"]
            alone = (c.word + 1) / (known.tokens + known.distinct + 1)
            share = np.where(c.context > 0, weight[frequency_bucket(c.context)], 0.0)
            mixed = share * c.both / np.maximum(c.context, 1) + (1 - share) * alone
            text, at = np.unique(c.text, return_inverse=True)
            sums = [np.bincount(at, weights=c.n * x, minlength=len(text)) for x in (np.log10(mixed), np.log10(alone), c.word > 0)]
            bounds = np.searchsorted(text >> 16, np.arange(len(rows) + 1))
            parts = {"at": (text & 0xFFFF).astype("<u2"), "score": sums[0], "base": sums[1], "known": sums[2].astype("<u4")}
            out = [
                {"block": r["block"], "texts": bytes(r["texts"]), **{name: values[a:b].tobytes() for name, values in parts.items()}}
                for r, a, b in zip(rows, bounds, bounds[1:])
            ]
            yield pa.RecordBatch.from_pylist(out, pa.schema([("block", pa.int64()), *[(x, pa.binary()) for x in ("texts", "at", "score", "base", "known")]]))

    def total(frame: pd.DataFrame) -> pd.DataFrame:
        listed, found = None, []
        for texts, at in zip(frame["texts"], frame["at"]):
            if not at:
                listed = np.frombuffer(texts, "<i8")
        for texts, at, score, base, n in zip(*[frame[x] for x in ("texts", "at", "score", "base", "known")]):
            if at:
                keys = np.frombuffer(texts, "<i8") if texts else listed
                found.append((keys[np.frombuffer(at, "<u2")], np.frombuffer(score), np.frombuffer(base), np.frombuffer(n, "<u4")))
        if not found:
            return pd.DataFrame({"text": [], "score": [], "base_score": [], "n_known": []})
        keys, *values = (np.concatenate(x) for x in zip(*found))
        text, at = np.unique(keys, return_inverse=True)
        sums = [np.bincount(at, weights=v) for v in values]
        return pd.DataFrame({"text": text, "score": sums[0], "base_score": sums[1], "n_known": sums[2].astype(np.int64)})

    parts = packed.mapInArrow(score, "block long, texts binary, at binary, score binary, base binary, known binary")
    sums = parts.groupBy("block").applyInPandas(total, "text long, score double, base_score double, n_known long")
    return sums.groupBy("text").agg(F.sum("score").alias("score"), F.sum("base_score").alias("base_score"), F.sum("n_known").alias("n_known"))


def score_documents(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    spark = docs.sparkSession
    n_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_buckets = 3 * n_partitions  # a task counts one bucket at a time
    rows = docs.select(
        F.col(id_col).alias("_fl_id"), held_out.alias("held_out"), F.xxhash64(F.col(id_col).cast("string"), text_of(text)).alias(_KEY),
        (~held_out).alias(_TRAIN), text_of(text).alias("text"),
    )
    table, known = vocabulary(rows)
    # Two pairs of a text that are one row here come from copies of id and text; their sums are divided again below.
    packed = pack_pairs(rows, known, n_buckets).unionByName(pack_rare_pairs(rows, table, known, n_buckets))
    dealt = packed.repartition(n_partitions, "bucket").sortWithinPartitions("bucket")
    learned = weights(held_out_counts(dealt, known))
    scores = cut(score_texts(dealt.withColumn("weights", learned.scalar()), known), "scores")
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    outline = cut(rows.select("_fl_id", "held_out", _KEY, (words + 1).cast("long").alias("n_tokens")), "outline")
    copies = outline.groupBy(_KEY).agg(F.count(F.lit(1)).alias("_fl_copies"))
    per_key = scores.withColumnRenamed("text", _KEY).join(copies, _KEY)
    each = per_key.select(_KEY, (F.col("score") / F.col("_fl_copies")).alias("score"), (F.col("base_score") / F.col("_fl_copies")).alias("base_score"), (F.col("n_known") / F.col("_fl_copies")).cast("long").alias("n_known"))
    return outline.join(each, _KEY).select(
        F.col("_fl_id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(known.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )
