"""Names, identifiers and timestamps as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .hashing import as_column


def file_name(path: Column | str) -> Column:
    return F.regexp_extract(as_column(path), r"([^/]+)$", 1)


def table_name(path: Column | str) -> Column:
    """A file's stem in lower case, with blanks and hyphens as underscores."""
    stem = F.regexp_replace(file_name(path), r"\.[^.]*$", "")
    return F.translate(F.lower(stem), "- ", "__")


def shorten(text: Column | str, limit: int) -> Column:
    """The first `limit` characters followed by `...`, or the text itself when it is not longer."""
    text = as_column(text)
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("..."))).otherwise(text)


def padded_id(number: Column | str, prefix: str = "sample", width: int = 4) -> Column:
    """`sample_0001`; numbers with more digits are kept whole."""
    return F.format_string(f"{prefix}_%0{width}d", as_column(number).cast("long"))


def epoch_text(seconds: Column | str) -> Column:
    """Epoch seconds as `YYYY-MM-DD HH:MM:SS` in UTC, whatever the session's time zone is."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.date_format(F.timestamp_add("SECOND", as_column(seconds).cast("long"), start), "yyyy-MM-dd HH:mm:ss")
