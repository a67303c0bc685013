"""Large JSON files over many tasks: a data source whose partitions are byte ranges.

A file holds one or more JSON objects or arrays; its rows are their top-level entries, as text. A range in the middle of a file does not know whether it
begins inside a string, or how deep. So each range is first summed up for both cases, whether it begins inside a string and by how much
brackets outside strings change the depth; the driver strings these sums together, a few numbers per range, and then every range knows where it stands
and finds the entries that begin in it. The last one is read on beyond the range's end. This is exact for any JSON text, whatever
strings contain.

Files are opened by pyarrow, which knows local, HDFS, S3 and GCS paths. Ranges never begin right behind a backslash. Compressed files
cannot be split and are refused.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

RANGE_BYTES = 64 << 20
READ_ON_BYTES = 1 << 20
QUOTE, BACKSLASH, COMMA = b'"'[0], b"\\"[0], b","[0]
OPENING, CLOSING = np.frombuffer(b"[{", np.uint8), np.frombuffer(b"]}", np.uint8)


@dataclass
class Range(InputPartition):
    """Bytes from `start` to `end` of a file, and what is known of the place: inside a string, and the depth."""

    path: str
    start: int
    end: int
    in_string: bool = False
    depth: int = 0


def quotes(data: np.ndarray) -> np.ndarray:
    """Places of the quotes that begin or end a string."""
    found = np.flatnonzero(data == QUOTE)
    behind = found[(found > 0) & (data[found - 1] == BACKSLASH)]
    if not len(behind):
        return found
    # A quote behind an odd number of backslashes belongs to its string.
    escaped = []
    for at in behind.tolist():
        run = at - 1
        while run >= 0 and data[run] == BACKSLASH:
            run -= 1
        if (at - 1 - run) % 2:
            escaped.append(at)
    return np.setdiff1d(found, np.array(escaped, found.dtype), assume_unique=True)


def outside(places: np.ndarray, marks: np.ndarray, in_string: bool) -> np.ndarray:
    """Those of the places that are not inside a string."""
    return places[(np.searchsorted(marks, places) + in_string) % 2 == 0]


def steps(data: np.ndarray, marks: np.ndarray, in_string: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of brackets outside strings, and 1 or -1 for each."""
    up, down = np.isin(data, OPENING), np.isin(data, CLOSING)
    places = outside(np.flatnonzero(up | down), marks, in_string)
    return places, np.where(up[places], 1, -1)


def summed_up(data: bytes) -> tuple[int, int, int]:
    """Number of quotes, and how the depth changes if the bytes begin outside and inside a string."""
    array = np.frombuffer(data, np.uint8)
    marks = quotes(array)
    return len(marks), *(int(steps(array, marks, inside)[1].sum()) for inside in (False, True))


def entries(data: bytes, size: int, in_string: bool, depth: int, more) -> Iterator[bytes]:
    """Top-level entries that begin among the first `size` bytes; `more` gives further bytes, or none at the file's end."""
    while True:
        array = np.frombuffer(data, np.uint8)
        marks = quotes(array)
        places, change = steps(array, marks, in_string)
        after = depth + np.cumsum(change)
        commas = outside(np.flatnonzero(array == COMMA), marks, in_string)
        level = np.concatenate([[depth], after])[np.searchsorted(places, commas)]
        begins = np.concatenate([places[(change == 1) & (after == 1)], commas[level == 1]])
        ends = np.concatenate([places[(change == -1) & (after == 0)], commas[level == 1]])
        begins, ends = np.sort(begins[begins < size]), np.sort(ends)
        # The last entry's end may lie behind the bytes at hand.
        if not len(begins) or (len(ends) and ends[-1] > begins[-1]):
            break
        further = more()
        if not further:
            break
        data += further
    for begin in begins.tolist():
        k = np.searchsorted(ends, begin, "right")
        entry = data[begin + 1 : ends[k] if k < len(ends) else len(data)].strip()
        if entry:
            yield entry


class SplitJson(DataSource):
    """`format("split_json")`; see `read_entries`."""

    @classmethod
    def name(cls) -> str:
        return "split_json"

    def schema(self) -> str:
        if "ranges" in self.options:
            return "path string, entry string"
        return "path string, start long, end long, quotes long, outside long, inside long"

    def reader(self, schema) -> SplitJsonReader:
        return SplitJsonReader(self.options)


class SplitJsonReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.uri = options["path"]
        self.range_bytes = int(options.get("rangeBytes", RANGE_BYTES))
        self.known = [Range(*r) for r in json.loads(options["ranges"])] if "ranges" in options else None

    def partitions(self) -> list[Range]:
        if self.known is not None:
            return self.known
        system, path = pafs.FileSystem.from_uri(self.uri)
        info = system.get_file_info(path)
        files = [info] if info.type == pafs.FileType.File else system.get_file_info(pafs.FileSelector(path, recursive=True))
        found = []
        for file in sorted(files, key=lambda f: f.path):
            if file.type != pafs.FileType.File or file.base_name.startswith(("_", ".")):
                continue
            if file.base_name.endswith((".gz", ".zst", ".bz2")):
                raise ValueError(f"{file.path} is compressed and cannot be split")
            found += [Range(file.path, s, min(s + self.range_bytes, file.size)) for s in range(0, file.size, self.range_bytes)]
        return found

    def read(self, part: Range | None) -> Iterator[tuple]:
        if part is None:  # no files
            return
        system, _ = pafs.FileSystem.from_uri(self.uri)
        with system.open_input_file(part.path) as file:
            start, end = (self._behind_backslashes(file, at) for at in (part.start, part.end))
            data = file.read_at(max(0, end - start), start)
            if self.known is None:
                yield part.path, part.start, part.end, *summed_up(data)
                return
            at = [start + len(data)]

            def more() -> bytes:
                further = file.read_at(min(READ_ON_BYTES, file.size() - at[0]), at[0])
                at[0] += len(further)
                return further

            for entry in entries(data, len(data), part.in_string, part.depth, more):
                yield part.path, entry.decode()

    @staticmethod
    def _behind_backslashes(file, at: int) -> int:
        """The place from `at` on whose byte before is no backslash, so that no range begins with an escaped character."""
        while 0 < at < file.size() and file.read_at(1, at - 1)[0] == BACKSLASH:
            at += 1
        return at


def read_entries(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, entry): the top-level entries of all JSON documents of a file or folder, `"key": value` of objects and values of arrays."""
    spark.dataSource.register(SplitJson)
    uri = path if "://" in path or path.startswith("file:") else f"file://{path}"
    reader = spark.read.format("split_json").option("path", uri).option("rangeBytes", range_bytes)
    ranges, before, in_string, depth = [], None, False, 0
    # One row of six numbers per range.
    for r in sorted(reader.load().collect(), key=lambda r: (r["path"], r["start"])):
        if r["path"] != before:
            before, in_string, depth = r["path"], False, 0
        ranges.append([r["path"], r["start"], r["end"], in_string, depth])
        depth += r["inside" if in_string else "outside"]
        in_string ^= bool(r["quotes"] % 2)
    if not ranges:
        return spark.createDataFrame([], "path string, entry string")
    return reader.option("ranges", json.dumps(ranges)).load()


def object_entry(entry: Column | str = "entry") -> Column:
    """An object's entry as an object of its own."""
    return F.concat(F.lit("{"), entry, F.lit("}"))
