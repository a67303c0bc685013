"""Best-fit packing of token pieces into sequences of a fixed length, with a bounded number of open sequences.

A document is its token ids and one closing id; it is cut only where it is longer than a sequence. Packing is online: a piece
goes into the open sequence with the least free space that still holds it. A bitset keyed by free space finds it in a few
machine words; when more than `open_bins` are open the fullest closes. A null text counts as empty and gives a piece of the
closing id alone. Repeated rows are packed like others. An empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workdir import cut

CACHED_WORDS = 150_000
PIECES = "piece int, start long, length long, ids_crc32 long"


# Letters that are their own lower case and composed form, and marks that never join a letter in one token.
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
MARKS = b".,;:!?"


class WordIds(dict):
    """Token ids of words, and so of texts, as little-endian 32-bit integers.

    For tokenizers that lower-case, cut at white space and drop it, keep letters apart from other marks, and spell bytes as characters,
    so that a text's ids are its words' ids in a row. Words are encoded once and remembered, up to a fixed number. Words of plain small
    letters need no normalization and go straight to the tokenizer's model. Words are looked up in small letters, but for those that hold
    an added token in any case: such tokens are found in the text as it is written.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share the cores already
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.spelling = str.maketrans({c: self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in LETTERS})
        self.plain = re.compile(f"[{LETTERS}]+").fullmatch
        added = [t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.has_added = re.compile(b"|".join(map(re.escape, added)) or b"(?!)").search

    def _spell(self, word: str) -> bytes:
        if self.plain(word):
            ids = [t.id for t in self.model.tokenize(word.translate(self.spelling))]
        else:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def __missing__(self, word: bytes) -> bytes:
        core = word.rstrip(MARKS)
        if core and core != word and (core[-1:].isalpha() or core[-1] >= 128 and core.decode()[-1].isalpha()):
            ids = self[core] + self[word[len(core) :]]
        else:
            ids = self._spell(word.decode())
        self[word] = ids
        return ids

    def encode(self, text: bytes) -> bytes:
        if len(self) > CACHED_WORDS:
            self.clear()
        small = text.lower()
        if self.has_added(small):
            return b"".join(self[w if self.has_added(w.lower()) else w.lower()] for w in text.split())
        return b"".join(map(self.__getitem__, small.split()))


@cache
def word_ids(path: str) -> WordIds:
    """One per worker process, so that its words outlast a task."""
    return WordIds(path)


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text: str = "text", capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32."""
    end = end_id.to_bytes(4, "little")

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer_path)
        step = 4 * capacity
        for batch in batches:
            taken, rows = [], []
            for i, text in enumerate(batch.column(1).cast(pa.binary())):
                ids = words.encode(text.as_py()) + end
                for k in range(0, len(ids), step):
                    piece = ids[k : k + step]
                    taken.append(i)
                    rows.append((k // step, k // 4, len(piece) // 4, zlib.crc32(piece)))
            numbers = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(taken)), *numbers], names=["id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(cut_up, f"id {kind}, {PIECES}").withColumnRenamed("id", id_col)


def best_fit(lengths: list[int], capacity: int, open_bins: int) -> list[tuple[int, int]]:
    """(sequence, offset) of each length, in order of arrival."""
    free = 0  # bit f is set while an open sequence has f places left
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    n_open = n_made = 0
    out = []
    for length in lengths:
        fitting = free >> length
        if fitting:
            left = length + (fitting & -fitting).bit_length() - 1
            stack = by_free[left]
            sequence = stack.pop()
            if not stack:
                free ^= 1 << left
            n_open -= 1
        else:
            left, sequence = capacity, n_made
            n_made += 1
        out.append((sequence, capacity - left))
        left -= length
        if left:
            if not by_free[left]:
                free |= 1 << left
            by_free[left].append(sequence)
            n_open += 1
            if n_open > open_bins:
                fullest = (free & -free).bit_length() - 1
                by_free[fullest].pop(0)
                if not by_free[fullest]:
                    free ^= 1 << fullest
                n_open -= 1
    return out


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text: str = "text",
    capacity: int = 4096,
    end_id: int = 1,
    open_bins: int = 512,
    pieces_per_lane: int = 20_000,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    Pieces are dealt by hash over lanes of about `pieces_per_lane`; each lane packs its own pieces in hash order. Only narrow rows are
    shuffled. What a lane loses are the sequences it leaves open. The place in the written table is part of the hash, so that repeated
    rows spread over the lanes; a table that is laid out otherwise may be packed otherwise.
    """
    import pandas as pd

    cols = [id_col, "piece", "start", "length", "ids_crc32"]
    made = cut(pieces(docs, tokenizer_path, id_col, text, capacity, end_id), "pieces")
    lanes = max(1, -(-made.count() // pieces_per_lane))
    order = F.xxhash64(F.lit(7), *cols)
    dealt = made.withColumn("_fl_order", order).withColumn("_fl_lane", F.pmod(F.xxhash64(F.lit(11), *cols, F.monotonically_increasing_id()), F.lit(lanes)))

    def fill(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["_fl_order", id_col, "piece"], kind="stable")
        placed = best_fit(frame["length"].tolist(), capacity, open_bins)
        lane = int(frame["_fl_lane"].iloc[0])
        frame["sequence_id"] = [lane << 32 | s for s, _ in placed]
        frame["offset"] = [o for _, o in placed]
        return frame[[*cols, "sequence_id", "offset"]]

    kind = made.schema[id_col].dataType.simpleString()
    return dealt.groupBy("_fl_lane").applyInPandas(fill, f"`{id_col}` {kind}, {PIECES}, sequence_id long, offset long")
