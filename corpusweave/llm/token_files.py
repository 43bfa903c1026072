"""Token ids in Arrow stream files of fixed-size lists, readable at random without copying.

A file is an Arrow stream whose record batches hold the same number of sequences, each of the same
length, with a mask that is false on the filling behind the last id. Batches of one shape take the
same number of bytes, so batch k of a file starts at ``head + k * stride``, and a reader maps the file
and reads a sequence in place. Ids of documents follow each other in ascending order of the key, first
over the files and then inside them; an index has the place of each document.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusweave.llm.batches import slices, write_and_read

SEQUENCE = 1024
BATCH_SEQUENCES = 64
END_ID = 2
CACHE_UNITS = 800_000
# A space with white space on both sides, or before it and the end behind.
UNSAFE = re.compile(r"\s (?:\s|$)")


class Places(dict):
    """Number of each unit in order of its first sight; ``new`` has the units that have no ids yet."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        self.new.append(unit)
        self[unit] = len(self)
        return len(self) - 1


class UnitEncoder:
    """Ids of whole texts, through the library's ids of each distinct unit of a text.

    The byte-level vocabulary splits a text before any merge, and always in front of a space unless
    white space stands on both sides of it. So the ids of a text are those of the units that begin at
    its spaces, in order. A text with a space of the other kind, or that holds the content of an added
    token which the library looks for, is encoded whole. Units seen lately
    are kept; new ones are encoded together, as one text, and told apart by their lengths in bytes.
    """

    def __init__(self, path: str, *, encode_special_tokens: bool = True):
        # A task has a core of its own; the library's threads would only add memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        # Whether strings of special tokens in a text are ordinary text; by the library's default they aren't.
        self.tokenizer.encode_special_tokens = encode_special_tokens
        # Added tokens are found before any split and may take the space around them.
        added = self.tokenizer.get_added_tokens_decoder().values()
        contents = [t.content for t in added if not (encode_special_tokens and t.special)]
        self.added = re.compile("|".join(map(re.escape, contents))) if contents else None
        tokens = sorted(self.tokenizer.get_vocab(with_added_tokens=False).items(), key=lambda t: t[1])
        # Each character of a token stands for one byte.
        self.token_bytes = np.zeros(tokens[-1][1] + 1, np.int64)
        self.token_bytes[[i for _, i in tokens]] = [len(t) for t, _ in tokens]
        self.forget()

    def forget(self) -> None:
        self.place = Places()
        self.ids = np.zeros(1 << 16, np.uint32)
        self.ends = np.zeros(1 << 16, np.int64)
        self.known = 0

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def learn(self) -> None:
        """Find the ids of the new units, each behind the space that it had in its text."""
        units, self.place.new = self.place.new, []
        # Units that begin with white space, and the empty one of two spaces, have to stand alone.
        alone = np.fromiter((not u or u[0].isspace() for u in units), bool, len(units))
        sizes = np.fromiter((len(u.encode()) + 1 for u in units), np.int64, len(units))
        cuts = np.unique(np.concatenate([[0, len(units)], np.flatnonzero(alone), np.flatnonzero(alone) + 1]))
        for start, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            self.keep(self.whole("".join([f" {u}" for u in units[start:end]])), np.cumsum(sizes[start:end]))

    def keep(self, found: np.ndarray, wanted: np.ndarray) -> None:
        """Store the ids of units that end at the wanted bytes behind those stored so far."""
        borders = np.cumsum(self.token_bytes[found])
        ends = np.searchsorted(borders, wanted) + 1
        if (borders[ends - 1] != wanted).any():
            raise ValueError("a token crosses the border of a unit")
        n, used = self.known, int(self.ends[self.known])
        if used + len(found) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), len(found)), np.uint32)])
        if n + len(wanted) >= len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros(max(len(self.ends), len(wanted)), np.int64)])
        self.ids[used : used + len(found)] = found
        self.ends[n + 1 : n + 1 + len(wanted)] = used + ends
        self.known = n + len(wanted)

    def encode(self, texts: list[str], end_id: int = END_ID) -> list[np.ndarray]:
        if len(self.place) > CACHE_UNITS:
            self.forget()
        out: list[np.ndarray | None] = [None] * len(texts)
        split = {}
        for k, text in enumerate(texts):
            head, *rest = text.split(" ")
            # Units that hold or lead into other white space may lean on what comes before them.
            if not rest or UNSAFE.search(text) or (self.added and self.added.search(text)):
                out[k] = np.append(self.whole(text), np.uint32(end_id))
            else:
                split[k] = head, np.fromiter(map(self.place.__getitem__, rest), np.int64, len(rest))
        self.learn()
        for k, (head, at) in split.items():
            starts, sizes = self.ends[at], self.ends[at + 1] - self.ends[at]
            ends = np.cumsum(sizes)
            places = np.arange(ends[-1]) + np.repeat(starts - ends + sizes, sizes)
            first = self.whole(head) if head else np.zeros(0, np.uint32)
            out[k] = np.concatenate([first, self.ids[places], np.array([end_id], np.uint32)])
        return out


@lru_cache(maxsize=1)
def unit_encoder(path: str) -> UnitEncoder:
    """One encoder for the tasks that a Python worker runs in turn, with the library's default for special tokens."""
    return UnitEncoder(path, encode_special_tokens=False)


def schema(sequence: int = SEQUENCE, wide: bool = False) -> pa.Schema:
    ids = pa.uint32() if wide else pa.uint16()
    return pa.schema([("ids", pa.list_(ids, sequence)), ("mask", pa.list_(pa.bool_(), sequence))])


class StreamWriter:
    """Fills sequences of one file; all batches but the last have the same shape."""

    def __init__(self, sink, sequence: int, batch_sequences: int, wide: bool):
        self.sink, self.sequence, self.rows = sink, sequence, batch_sequences
        self.schema = schema(sequence, wide)
        self.kind = np.uint32 if wide else np.uint16
        self.writer = pa.ipc.new_stream(sink, self.schema)
        self.parts: list[np.ndarray] = []
        self.held = self.total = 0
        self.offsets: list[int] = []

    def add(self, ids: np.ndarray) -> None:
        self.parts.append(ids.astype(self.kind))
        self.held += len(ids)
        self.total += len(ids)
        full = self.sequence * self.rows
        if self.held >= full:
            flat = np.concatenate(self.parts)
            for k in range(len(flat) // full):
                self.write(flat[k * full : (k + 1) * full], full)
            rest = flat[len(flat) // full * full :]
            self.parts, self.held = [rest], len(rest)

    def write(self, ids: np.ndarray, used: int) -> None:
        mask = np.arange(len(ids)) < used
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(ids), self.sequence),
            pa.FixedSizeListArray.from_arrays(pa.array(mask), self.sequence),
        ]
        self.offsets.append(self.sink.tell())
        self.writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))

    def close(self) -> tuple[int, int]:
        """Head and stride in bytes: where batches start and how far apart they are."""
        if self.held:
            ids = np.concatenate(self.parts)
            filled = np.zeros(-(-len(ids) // self.sequence) * self.sequence, self.kind)
            filled[: len(ids)] = ids
            self.write(filled, len(ids))
        # The schema message goes out with the first batch or at the end.
        self.offsets.append(self.sink.tell())
        self.writer.close()
        head = self.offsets[0]
        if head == 0:
            head = self.head()
        stride = self.offsets[1] - head if len(self.offsets) > 1 else 0
        return head, stride

    def head(self) -> int:
        buffer = pa.BufferOutputStream()
        with pa.ipc.new_stream(buffer, self.schema):
            size = buffer.tell()
        return size or len(self.schema.serialize())


class StreamFile:
    """Random access to one file by head and stride; a mapped file is read without copying."""

    def __init__(self, file: pa.NativeFile, head: int, stride: int, sequence: int, batch_sequences: int, wide: bool):
        self.file, self.head_bytes, self.stride = file, head, stride
        self.sequence, self.rows = sequence, batch_sequences
        self.schema = schema(sequence, wide)

    def batch(self, k: int) -> pa.RecordBatch:
        self.file.seek(self.head_bytes + k * self.stride)
        return pa.ipc.read_record_batch(pa.ipc.read_message(self.file), self.schema)

    def sequence_at(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of one sequence. The ids lie in the mapped file."""
        batch = self.batch(k // self.rows)
        at = k % self.rows
        ids = batch.column("ids").flatten().to_numpy(zero_copy_only=True)
        mask = batch.column("mask").flatten().slice(at * self.sequence, self.sequence)
        return ids[at * self.sequence : (at + 1) * self.sequence], mask.to_numpy(zero_copy_only=False)

    def tokens(self, n_batches: int) -> Iterator[np.ndarray]:
        """The ids of the file in order, without filling, a batch at a time."""
        for k in range(n_batches):
            batch = self.batch(k)
            ids = batch.column("ids").flatten().to_numpy(zero_copy_only=True)
            if k + 1 == n_batches:
                ids = ids[batch.column("mask").flatten().to_numpy(zero_copy_only=False)]
            yield ids


def open_file(uri: str) -> pa.NativeFile:
    """A file of any store that Arrow knows; on a mounted one it is mapped into memory."""
    store, path = pafs.FileSystem.from_uri(uri)
    return pa.memory_map(path) if isinstance(store, pafs.LocalFileSystem) else store.open_input_file(path)


INDEX = "part int, doc_id {kind}, local_start long, n_tokens long"
FILES = (
    "part int, file string, n_batches long, n_sequences long, file_tokens long, head long, stride long, "
    "doc_ids array<{kind}>, doc_tokens array<int>"
)


def write(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    *,
    key: str = "doc_id",
    text: str = "text",
    sequence: int = SEQUENCE,
    batch_sequences: int = BATCH_SEQUENCES,
    end_id: int = END_ID,
    parts: int | None = None,
) -> DataFrame:
    """Encode every document, write the files below ``folder`` and return the index of the files.

    One row per file and run of documents: (part, file, sizes, head, stride, doc_ids, doc_tokens), in
    the order of the stream. A null text counts as empty, a null key comes first, and rows that repeat a
    key are in order of their text. A task writes to a name of its own try, and only files that a
    finished task reported are in the index, so a lost executor leaves at most a file nobody reads.
    """
    spark = docs.sparkSession
    plain = docs.select(
        F.col(f"`{key}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text")
    )
    kind = plain.schema["doc_id"].dataType.simpleString()
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The hash and the row's place spread the rows of a key that repeats.
    order = ["doc_id", "tie", "row"]
    placed = (
        plain.withColumn("tie", F.xxhash64("text"))
        .withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .select(F.spark_partition_id().alias("part"), "doc_id", "text")
    )
    wide = Tokenizer.from_file(tokenizer_path).get_vocab_size() > 1 << 16 or end_id >= 1 << 16
    store, base = pafs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)
    files_schema = FILES.format(kind=kind)

    def run(batches):
        encoder = unit_encoder(tokenizer_path)
        store, base = pafs.FileSystem.from_uri(folder)
        writer, file, sink, part, key_type = None, None, None, None, None
        ids, sizes = [], []

        def row(last: bool):
            n_batches, n_sequences, tokens, head, stride = 0, 0, 0, 0, 0
            if last:
                head, stride = writer.close()
                sink.close()
                tokens = writer.total
                n_sequences, n_batches = -(-tokens // sequence), len(writer.offsets) - 1
            values = [part, f"{folder}/{file}", n_batches, n_sequences, tokens, head, stride]
            kinds = [pa.int32(), pa.string(), *[pa.int64()] * 5]
            arrays = [pa.array([v], k) for v, k in zip(values, kinds, strict=True)]
            arrays.append(pa.array([ids], pa.list_(key_type)))
            arrays.append(pa.array([sizes], pa.list_(pa.int32())))
            names = [c.split()[0] for c in files_schema.split(", ")]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                key_type, part = batch.schema.field("doc_id").type, batch.column("part")[0].as_py()
                file = f"tokens-{part:05d}-{uuid.uuid4().hex}.arrow"
                sink = store.open_output_stream(f"{base}/{file}")
                writer = StreamWriter(sink, sequence, batch_sequences, wide)
            for some in slices(batch, "text"):
                for found in encoder.encode(some.column("text").to_pylist(), end_id):
                    writer.add(found)
                    sizes.append(len(found))
                ids += some.column("doc_id").to_pylist()
        if writer is not None:
            yield row(True)

    return write_and_read(placed.mapInArrow(run, files_schema), "token-index")


def read_back(files: DataFrame, *, sequence: int = SEQUENCE, batch_sequences: int = BATCH_SEQUENCES, wide: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files.

    ``start`` counts the ids of all documents before. The table of files has one row per partition of
    the write, so their totals are added up on the driver.
    """
    totals = sorted((r["part"], r["file_tokens"]) for r in files.select("part", "file_tokens").collect())
    before = dict(zip([p for p, _ in totals], accumulate([0, *[n for _, n in totals]]), strict=False))
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in batch.schema.names}
                sizes = row["doc_tokens"].values.to_numpy()
                ends = np.cumsum(sizes)
                checks = np.zeros(len(sizes), np.int64)
                with open_file(row["file"].as_py()) as opened:
                    reader = StreamFile(
                        opened, row["head"].as_py(), row["stride"].as_py(), sequence, batch_sequences, wide
                    )
                    doc, at = 0, 0
                    for ids in reader.tokens(row["n_batches"].as_py()):
                        done = 0
                        while done < len(ids):
                            take = min(int(ends[doc]) - at, len(ids) - done)
                            data = ids[done : done + take].astype("<u4").tobytes()
                            checks[doc] = zlib.crc32(data, int(checks[doc]))
                            done, at = done + take, at + take
                            doc += at == ends[doc]
                starts = before[row["part"].as_py()] + ends - sizes
                yield pa.RecordBatch.from_arrays(
                    [row["doc_ids"].values, pa.array(starts), pa.array(sizes.astype(np.int64)), pa.array(checks)],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    # One file to a task: a row is small, but stands for a file.
    spread = files.repartition(max(len(totals), 1), F.xxhash64("part"))
    columns = ["part", "file", "n_batches", "head", "stride", "doc_ids", "doc_tokens"]
    return spread.select(*columns).mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def folder_uri(spark: SparkSession, folder: str) -> str:
    """The folder as a URI with a scheme, as Arrow wants it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file:///") else uri
