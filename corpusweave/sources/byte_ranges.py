"""Text files larger than a task, read by byte ranges.

``spark.read.format("text_ranges")`` cuts every file into ranges of ``range_bytes``. A task reads one range, or
its share of the ranges where many small files give more of them than ``tasks``. A range settles its borders
by itself: a unit belongs to the range in which it begins, and its task reads on behind the range to the
unit's end. Units are

``lines``    lines with their line ends
``records``  texts that begin at a token, and what comes before the first token
``parts``    about ``chunks`` parts of a file whose borders are moved on to the next token
``chunks``   chunks of ``size`` bytes; a character that crosses a border goes to the later chunk

Rows are (path, at, text) with the first byte of the unit, or the number of the chunk. Invalid UTF-8 is
dropped, as in the column forms of ``texts``, which give the same units for texts that fit into a row.
"""

from __future__ import annotations

import codecs
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from corpusweave.functions.patterns import END_OF_TEXT
from corpusweave.session import work_partitions

RANGE_BYTES = 64 << 20
# A search for a border reads a little first, then more.
FIRST_BYTES = 1 << 12
READ_BYTES = 1 << 20
ROWS = 4096
ROW_CHARS = 4 << 20


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI as Spark writes it."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:") :]
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


@dataclass
class Range(InputPartition):
    path: str
    begin: int
    end: int
    size: int


@dataclass
class Share(InputPartition):
    """Ranges that one task reads in turn."""

    ranges: list[Range]


def task_count(sizes: list[int], least: int) -> int:
    """Tasks for ranges of these sizes: one each up to ``least``, beyond that as many as the bytes fill."""
    return max(min(len(sizes), max(least, -(-sum(sizes) // RANGE_BYTES))), 1)


class Reader:
    """Bytes of one file by position."""

    def __init__(self, path: str):
        system, inner = file_system(path)
        self.path = path
        self.file = system.open_input_file(inner)
        self.size = self.file.size()

    def read(self, begin: int, end: int) -> bytes:
        begin, end = max(begin, 0), min(end, self.size)
        return self.file.read_at(end - begin, begin) if end > begin else b""

    def find(self, mark: bytes, at: int) -> int:
        """Position of the first mark that begins at or after ``at``; the size of the file without one."""
        step = FIRST_BYTES
        while at < self.size:
            data = self.read(at, at + step + len(mark) - 1)
            found = data.find(mark)
            if found >= 0:
                return at + found
            at, step = at + step, min(2 * step, READ_BYTES)
        return self.size

    def after_line(self, at: int) -> int:
        """First position after the line end at or behind ``at``."""
        return min(self.find(b"\n", at) + 1, self.size)

    def line_borders(self, begin: int, end: int) -> tuple[int, int]:
        """Bytes of all lines that begin in a range."""
        first = 0 if begin == 0 else self.after_line(begin - 1)
        return (first, self.after_line(end - 1)) if first < end else (first, first)


def decoded(data: bytes) -> str:
    return data.decode("utf-8", "ignore")


def lines_of(reader: Reader, begin: int, end: int) -> tuple[int, list[bytes]]:
    first, last = reader.line_borders(begin, end)
    return first, _cut(reader.read(first, last))


def _cut(data: bytes) -> list[bytes]:
    """Lines with their ends; only a line feed ends a line."""
    parts = data.split(b"\n")
    lines = [p + b"\n" for p in parts[:-1]]
    return [*lines, parts[-1]] if parts[-1] else lines


def chunk_text(reader: Reader, number: int, size: int) -> str:
    """Characters that end in a chunk, and begin in it or the one before."""
    begin = number * size
    decoder = codecs.getincrementaldecoder("utf-8")("ignore")
    before = reader.read(begin - 3, begin)
    for k in range(1, len(before) + 1):
        if before[-k] >= 0xC0:
            decoder.decode(before[-k:])
            break
    return decoder.decode(reader.read(begin, begin + size))


class RangeReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.unit = options.get("unit", "lines")
        if self.unit not in ("lines", "records", "parts", "chunks"):
            raise ValueError(f"unknown unit {self.unit!r}")
        self.path = options["path"]
        self.token = options.get("token", END_OF_TEXT).encode()
        self.size = int(options.get("size", 4 << 20))
        self.chunks = int(options.get("chunks", 4))
        self.range_bytes = max(int(options.get("range_bytes", RANGE_BYTES)), 1)
        self.tasks = int(options.get("tasks", 64))
        if self.unit == "chunks":
            # Whole chunks in every range.
            self.range_bytes = max(self.range_bytes // self.size, 1) * self.size

    def partitions(self) -> list[Share]:
        out: list[Range] = []
        for path, size in listed(self.path):
            if not size:
                continue
            step = max(size // self.chunks, 1) if self.unit == "parts" else self.range_bytes
            borders = list(range(0, size, step))
            if self.unit == "parts":
                borders = borders[: self.chunks]
            out += [Range(path, b, e, size) for b, e in zip(borders, [*borders[1:], size], strict=True)]
        sizes = [r.end - r.begin for r in out]
        tasks = task_count(sizes, self.tasks)
        if tasks >= len(out):
            return [Share([r]) for r in out]
        # Neighbours in the list, about the same bytes for each task.
        owner = (np.cumsum(sizes) - 1) * tasks // sum(sizes)
        cuts = [0, *(np.flatnonzero(np.diff(owner)) + 1).tolist(), len(out)]
        return [Share(out[a:b]) for a, b in zip(cuts, cuts[1:])]

    def read(self, partition: Share):
        reader, held, chars = None, [], 0
        for part in partition.ranges:
            if reader is None or reader.path != part.path:
                reader = Reader(part.path)
            for place, text in self.units(reader, part):
                held.append((part.path, place, text))
                chars += len(text)
                if len(held) == ROWS or chars >= ROW_CHARS:
                    yield self._batch(held)
                    held, chars = [], 0
        if held:
            yield self._batch(held)

    def _batch(self, held: list[tuple[str, int, str]]) -> pa.RecordBatch:
        path, at, texts = (list(x) for x in zip(*held, strict=True))
        return pa.record_batch({"path": path, "at": pa.array(at, pa.int64()), "text": pa.array(texts, pa.string())})

    def units(self, reader: Reader, part: Range):
        if self.unit == "chunks":
            for number in range(part.begin // self.size, -(-part.end // self.size)):
                yield number, chunk_text(reader, number, self.size)
        elif self.unit == "lines":
            at, lines = lines_of(reader, part.begin, part.end)
            for line in lines:
                yield at, decoded(line)
                at += len(line)
        else:
            begin = 0 if part.begin == 0 else reader.find(self.token, part.begin)
            last = part.size if part.end == part.size else reader.find(self.token, part.end)
            data, at = reader.read(begin, last), 0
            while at < len(data):
                found = -1 if self.unit == "parts" else data.find(self.token, at + 1)
                end = found if found >= 0 else len(data)
                yield begin + at, decoded(data[at:end])
                at = end


class TextRanges(DataSource):
    """The registered source; options: path, unit, range_bytes, token, size, chunks, tasks."""

    @classmethod
    def name(cls) -> str:
        return "text_ranges"

    def schema(self) -> str:
        return "path string, at long, text string"

    def reader(self, schema) -> RangeReader:
        return RangeReader(self.options)


def listed(path: str) -> list[tuple[str, int]]:
    """(path, bytes) of the files of a folder, or of one file; hidden files are left out."""
    system, inner = file_system(path)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.File:
        found = [info]
    elif info.type == fs.FileType.Directory:
        found = system.get_file_info(fs.FileSelector(inner, recursive=True))
    else:
        raise FileNotFoundError(f"no text files at {path}")
    prefix = path[: len(path) - len(inner.rstrip("/"))] if path.rstrip("/").endswith(inner.rstrip("/")) else ""
    return sorted(
        (prefix + f.path, f.size)
        for f in found
        if f.type == fs.FileType.File and not f.base_name.startswith((".", "_"))
    )


def read_ranges(spark: SparkSession, path: str, unit: str = "lines", **options) -> DataFrame:
    """(path, at, text) of every unit; see the module for units and options."""
    spark.dataSource.register(TextRanges)
    options = {"tasks": work_partitions(spark), **options}
    return spark.read.format("text_ranges").options(path=path, unit=unit, **options).load()


# --- line batches -----------------------------------------------------------------------------


def _closings(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What becomes of an open batch that enters a range of lines.

    Row j stands for the open batches that line j is the first to fill: they need ``need[j]`` characters
    from here, the range then closes ``closed[j]`` batches and leaves one of ``left[j]`` characters open.
    """
    upto = np.concatenate([[0], np.cumsum(lengths)])
    ends = np.searchsorted(upto, upto + size)
    n = len(lengths)
    left, closed = np.zeros(n + 2, np.int64), np.zeros(n + 2, np.int64)
    for s in range(n, -1, -1):
        end = ends[s]
        left[s], closed[s] = (left[end], closed[end] + 1) if end <= n else (upto[n] - upto[s], 0)
    first = int(np.searchsorted(upto, size)) if n else 0
    rows = np.arange(min(first, n)) + 1
    return upto[rows], left[rows], closed[rows] + 1


def line_batches(spark: SparkSession, path: str, batch_size: int = 4096, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Consecutive lines of every file, joined until they hold at least ``batch_size`` characters.

    Which line opens a batch depends on all lines before it. A first pass reads every range and says, for
    each batch that may be open where it begins, what is open where it ends; following the ranges of a file
    through these short tables gives each its beginning, and a second pass cuts the batches that begin in a
    range. Rows are (path, batch_no, batch), as in the column form.
    """
    ranges = [
        (p, b, min(b + range_bytes, size)) for p, size in listed(path) for b in range(0, size, range_bytes)
    ]
    tasks = task_count([e - b for _, b, e in ranges], work_partitions(spark))
    table = spark.createDataFrame(ranges, "path string, begin long, end long")
    table = table.repartition(tasks, "path", "begin")

    def closings(batches):
        for batch in batches:
            for row in batch.to_pylist():
                _, lines = lines_of(Reader(row["path"]), row["begin"], row["end"])
                lengths = np.array([len(decoded(x)) for x in lines], np.int64)
                need, left, closed = _closings(lengths, batch_size)
                yield pa.RecordBatch.from_pylist(
                    [{**row, "total": int(lengths.sum()), "need": need, "left": left, "closed": closed}],
                    pa.schema(
                        [("path", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("total", pa.int64())]
                        + [(c, pa.list_(pa.int64())) for c in ("need", "left", "closed")]
                    ),
                )

    def follow(group: pd.DataFrame) -> pd.DataFrame:
        open_chars, number, rows = 0, 0, []
        for r in group.sort_values("begin").itertuples():
            # Batches that are open here have the number before their successors.
            rows.append((r.path, r.begin, r.end, open_chars, number))
            at = int(np.searchsorted(r.need, batch_size - open_chars))
            if at < len(r.need):
                open_chars, number = int(r.left[at]), number + int(r.closed[at])
            else:
                open_chars += int(r.total)
        return pd.DataFrame(rows, columns=["path", "begin", "end", "open", "number"])

    def cut(batches):
        for batch in batches:
            for row in batch.to_pylist():
                numbers, texts = [], []
                for number, text in _batches_from(Reader(row["path"]), row, batch_size):
                    numbers.append(number)
                    texts.append(text)
                yield pa.record_batch(
                    {"path": pa.array([row["path"]] * len(texts), pa.string()), "batch_no": pa.array(numbers, pa.int32()), "batch": pa.array(texts, pa.string())}
                )

    fields = "path string, begin long, end long, total long, need array<long>, left array<long>, closed array<long>"
    # One short row per range: a file's group holds its ranges, not its lines.
    begun = (
        table.mapInArrow(closings, fields)
        .groupBy("path")
        .applyInPandas(follow, "path string, begin long, end long, open long, number long")
        .repartition(tasks, "path", "begin")
    )
    return begun.mapInArrow(cut, "path string, batch_no int, batch string")


def _batches_from(reader: Reader, row: dict, batch_size: int):
    """(number, text) of the batches that begin in a range; the last one reads on behind it."""
    begin, lines = lines_of(reader, row["begin"], row["end"])
    number, filled, held = row["number"], row["open"], []
    foreign = row["open"] > 0
    end = begin + sum(map(len, lines))
    for line in lines:
        text = decoded(line)
        held.append(text)
        filled += len(text)
        if filled >= batch_size:
            if not foreign:
                yield number, "".join(held)
            number, filled, held, foreign = number + 1, 0, [], False
    while not foreign and held and end < reader.size and filled < batch_size:
        after = reader.after_line(end)
        text = decoded(reader.read(end, after))
        held.append(text)
        filled += len(text)
        end = after
    if not foreign and "".join(held):
        yield number, "".join(held)
