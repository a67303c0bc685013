"""Exact duplicates by progressive refinement: length, then hash of the beginning, then hash of the whole text.

Each step only looks at what the step before left in groups of two or more. Two texts are equal when they are the same
characters; a null text counts as empty. Of equal texts the row with the largest id stays, and a null id is below all others.
Rows that repeat both id and text are copies like others, and exactly one of them stays. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workdir import cut, small_side
from .rows import ID, KEY, text_of, without

_N, _HEAD, _DIGEST, _POS = "_fl_n", "_fl_head", "_fl_digest", "_fl_pos"


def _outline(text: str, prefix_chars: int) -> list[Column]:
    return [F.length(text_of(text)).alias(_N), F.xxhash64(F.substring(text_of(text), 1, prefix_chars)).alias(_HEAD)]


def refine(docs: DataFrame, id_col: str = "doc_id", text: str = "text", prefix_chars: int = 64, max_keys: int = 200_000) -> DataFrame:
    """The rows that may have a copy, as (_fl_id, _fl_digest, _fl_key): the whole text is read only for them.

    Pass one keeps a length and a hash of the first characters per row. Rows alone with their length leave, then rows alone
    with length and beginning. While at most `max_keys` such pairs are left they are broadcast and pass two hashes the texts
    they select; beyond that it is cheaper to hash each text where it is read than to move it, and the narrow rows are
    selected after that. Both give the same rows.
    """
    outline = cut(docs.select(*_outline(text, prefix_chars)), "outline")
    lengths = outline.groupBy(_N).agg(F.count(F.lit(1)).alias("_fl_c")).where("_fl_c > 1").select(_N)
    # Lengths are few; where they can be broadcast, a length that very many rows share is not dealt to one task.
    heads = outline.join(small_side(cut(lengths, "lengths")), _N, "left_semi").groupBy(_N, _HEAD).agg(F.count(F.lit(1)).alias("_fl_c")).where("_fl_c > 1")
    keys = cut(heads.select(_N, _HEAD), "outline-keys")
    rows = docs.select(F.col(id_col).alias(ID), text_of(text).alias("_fl_text"), *_outline(text, prefix_chars))
    whole = [F.sha2("_fl_text", 256).alias(_DIGEST), F.xxhash64("_fl_text").alias(KEY)]
    if keys.count() <= max_keys:
        found = rows.join(F.broadcast(keys), [_N, _HEAD], "left_semi").select(ID, *whole)
    else:
        found = rows.select(ID, _N, _HEAD, *whole).join(keys, [_N, _HEAD], "left_semi").select(ID, _DIGEST, KEY)
    return cut(found, "survivors")


def groups(survivors: DataFrame) -> DataFrame:
    """One row per digest that occurs more than once: size, id that stays, and how many rows have that id."""
    per_id = survivors.groupBy(_DIGEST, ID).agg(F.count(F.lit(1)).alias("_fl_c"))
    both = per_id.groupBy(_DIGEST).agg(F.sum("_fl_c").alias("group_size"), F.max(F.struct(ID, "_fl_c")).alias("_fl_top"))
    return both.where("group_size > 1").select(
        _DIGEST, "group_size", F.col(f"_fl_top.{ID}").alias("keep_id"), F.col("_fl_top._fl_c").alias("_fl_same")
    )


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", prefix_chars: int = 64, max_keys: int = 200_000) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept and text_sha256 (of every text, so that sets can be compared)."""
    found = cut(groups(refine(docs, id_col, text, prefix_chars, max_keys)), "copy-groups")
    rows = cut(docs.select(F.col(id_col).alias(ID), F.sha2(text_of(text), 256).alias(_DIGEST), F.monotonically_increasing_id().alias(_POS)), "digests")
    same = F.col(ID).eqNullSafe(F.col("keep_id"))
    joined = rows.join(found, _DIGEST, "left")
    kept = F.col("group_size").isNull() | same
    if not found.where("_fl_same > 1").isEmpty():
        # Rows that repeat id and text: the first of them stays.
        first = joined.where((F.col("_fl_same") > 1) & same).groupBy(_DIGEST).agg(F.min(_POS).alias("_fl_first"))
        joined = joined.join(first, _DIGEST, "left")
        kept = F.col("group_size").isNull() | (same & (F.coalesce("_fl_first", _POS) == F.col(_POS)))
    return joined.select(
        F.col(ID).alias(id_col),
        F.when(F.col("group_size").isNull(), F.col(ID)).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        kept.alias("kept"),
        F.col(_DIGEST).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", prefix_chars: int = 64, max_keys: int = 200_000) -> DataFrame:
    """`docs` with all its columns, one row of each group of equal texts."""
    survivors = refine(docs, id_col, text, prefix_chars, max_keys)
    found = cut(groups(survivors), "copy-groups")
    copies = survivors.join(found, _DIGEST)
    same = F.col(ID).eqNullSafe(F.col("keep_id"))
    dropped = cut(copies.where(~same).select(ID, KEY).distinct(), "dropped")
    repeated = cut(copies.where(same & (F.col("_fl_same") > 1)).select(ID, KEY).distinct(), "repeated")
    return without(docs, dropped, repeated, id_col, text)
