"""Taking rows out of a table of documents by id and text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workdir import small_side

ID, KEY = "_fl_id", "_fl_key"


def text_of(name: str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def text_key(name: str) -> Column:
    return F.xxhash64(text_of(name))


def _match(docs: DataFrame, rows: DataFrame, id_col: str, text: str, how: str) -> DataFrame:
    """Rows of `docs` with the id and text key of one of `rows`, which is broadcast where a count shows it to be small."""
    side = small_side(rows.select(F.col(ID).alias("_fl_other"), F.col(KEY).alias("_fl_other_key")))
    return docs.join(side, F.col(id_col).eqNullSafe(F.col("_fl_other")) & (text_key(text) == F.col("_fl_other_key")), how)


def without(docs: DataFrame, dropped: DataFrame, repeated: DataFrame, id_col: str, text: str) -> DataFrame:
    """`docs` with all its columns, without the rows `dropped` and with each of the rows `repeated` once; both have ID and KEY."""
    left = _match(docs, dropped, id_col, text, "left_anti")
    if repeated.isEmpty():
        return left
    once = _match(left, repeated, id_col, text, "left_semi").withColumn(KEY, text_key(text)).dropDuplicates([id_col, KEY]).drop(KEY)
    return _match(left, repeated, id_col, text, "left_anti").unionByName(once)
