"""Small helpers that the operators of this package share."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusweave.session import scratch_path

# What counts as a word wherever an operator speaks of words: a run without ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WORD = re.compile(WORD_PATTERN)

# Text bytes that one step of a Python task holds as Python objects.
SLICE_BYTES = 1 << 20

# A side may be broadcast when its measured size is at most this many bytes.
BROADCAST_BYTES = 8 << 20


def slices(batch: pa.RecordBatch, column: str, target: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about ``target`` text bytes, and one row at least."""
    if batch.num_rows == 0:
        return
    lengths = pc.binary_length(batch.column(column)).fill_null(0)
    ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, done + target, side="right")), start + 1)
        yield batch.slice(start, stop - start)
        start = stop


def map_slices(
    df: DataFrame, column: str, schema: str, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]
) -> DataFrame:
    """Map a frame in Arrow parts of bounded text size; ``make`` builds the function once a task."""

    def run(batches):
        work = make()
        for batch in batches:
            for part in slices(batch, column):
                yield work(part)

    return df.mapInArrow(run, schema)


def write_and_read(df: DataFrame, name: str, *partition_by: str, rows: int | None = None) -> DataFrame:
    """Cut the lineage with a compressed table in the shared scratch folder.

    ``rows`` bounds the rows of a row group, for rows of megabytes: a group is held when it is written, and
    a reader decodes thousands of its rows at once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.option("compression", "zstd")
    if rows is not None:
        writer = writer.option("parquet.block.row.count.limit", rows).option("parquet.page.size.row.check.min", 1)
    writer.parquet(path)
    return spark.read.parquet(path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder through the file system that Spark knows it by."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def broadcast_if_bytes(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast if the measured bytes of all rows stay below the limit.

    For a frame that is written or checkpointed; each value counts as its text and 16 bytes.
    """
    width = sum(
        (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in df.columns),
        F.lit(16),
    )
    size = df.agg(F.sum(width.cast("long")).alias("size")).first()["size"] or 0
    return F.broadcast(df) if size <= limit else df


def fresh(df: DataFrame, *names: str) -> dict[str, str]:
    """Names for helper columns that no column of the frame has."""
    taken = {c.lower() for c in df.columns}
    made = {}
    for name in names:
        made[name] = f"_{name}"
        while made[name].lower() in taken:
            made[name] = f"_{made[name]}"
        taken.add(made[name].lower())
    return made


def struct_of(columns: Sequence[str]) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in columns])
