"""Removal of repeated passages by super-k-mer partitioning.

A window is ``window`` consecutive words of one document. Its minimiser is the least hash of the
``minimiser`` word runs inside it, so equal windows have equal minimisers. Consecutive windows that share
their minimiser travel as one packed string, their words joined by spaces, to the bucket of the minimiser.
There the windows are cut out again and sorted; all but the earliest of equal windows are repeats. Equal
hashes are compared word by word, so the answer is exact.

Three things keep groups of copies and frequent passages from meeting in one task:

* A task sends equal packed strings once, from their earliest place; the later ones it knows to be repeats.
  What it sends to one target, a fixed share of the buckets, is one compressed row, for packed strings
  overlap and are longer than the texts. There are as many targets as the corpus needs for each to be small.
* Minimisers that are frequent in the corpus are counted first. Windows of a frequent one travel
  singly, by a hash of the whole window, and equal ones are again sent once by every task.
* Only repeats come back, as runs of windows. They are tied to the documents by key.

The order of places is (key, digest of the text, word): null keys come last, rows that have key and text in
common are one document and get equal results, and a copy under another key is removed as a repeat.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusweave.llm.batches import SLICE_BYTES, fresh, map_slices, slices, write_and_read
from corpusweave.llm.spans import (
    WHITE_SPACE,
    Powers,
    byte_set,
    mix,
    range_hashes,
    ranges,
    rows_of,
    text_array,
    text_bytes,
    word_spans,
)
from corpusweave.session import work_partitions

WINDOW = 20
MINIMISER = 5
# A minimiser is frequent from so many super-k-mers on.
FREQUENT = 4096
# At most so many frequent minimisers are shared with the tasks (8 MB); the limit doubles until they fit.
SHARED = 1 << 20
# Windows in one packed string, so that a text of one repeated word is cut too.
LONGEST_RUN = 512
# Words of one step, bytes of packed strings in which a task looks for equal ones, bytes of a target, windows
# compared and minimisers counted at a time.
STEP_WORDS = 1 << 16
COMBINE_BYTES = 12 << 20
TARGET_BYTES = 8 << 20
COMPARED = 1 << 15
COUNTED = 1 << 20

LEVEL = 6

# Bytes of packed strings for each byte of text, about.
SPREAD = 3
PARCEL = "target int, rows int, docs int, body binary"
RUNS = "doc long, copy long, start int, n int"
SEPARATORS = byte_set(WHITE_SPACE)
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64))
BYTE_POWERS, WORD_POWERS = Powers(0xD6E8FEB86659FD93), Powers(0xA0761D6478BD642F)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` consecutive values, from leasts of powers of two."""
    least, have = values, 1
    while 2 * have <= width:
        least, have = np.minimum(least[:-have], least[have:]), 2 * have
    rest = width - have
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


class Words:
    """Words of a batch: where they lie, which document holds them and how many come before them in it."""

    def __init__(self, texts: pa.Array):
        self.data, borders = text_bytes(texts)
        self.begins, self.ends = word_spans(self.data, borders, SEPARATORS)
        self.doc = rows_of(self.begins, borders)
        self.first = np.searchsorted(self.doc, np.arange(len(texts) + 1))
        self.counts = np.diff(self.first)

    def hashes(self, lo: int, hi: int) -> np.ndarray:
        base, end = self.begins[lo], self.ends[hi - 1]
        return range_hashes(
            BYTE_VALUES[self.data[base:end]], self.begins[lo:hi] - base, self.ends[lo:hi] - base, BYTE_POWERS
        )

    def joined(self, lo: int, hi: int) -> tuple[bytes, np.ndarray]:
        """Words joined by single spaces, and the first byte of each."""
        base = self.begins[lo]
        lengths = self.ends[lo:hi] - self.begins[lo:hi] + 1
        data = np.append(self.data[base : self.ends[hi - 1]], np.uint8(0x20))
        out = data[ranges(self.begins[lo:hi] - base, lengths)]
        at = np.concatenate([[0], np.cumsum(lengths)])
        out[at[1:] - 1] = 0x20
        return out.tobytes(), at


def runs_of_windows(words: Words, window: int, minimiser: int):
    """(first word, windows, minimiser, word hashes, lo) of all super-k-mers, step by step."""
    total = len(words.begins)
    for lo in range(0, total - window + 1, STEP_WORDS):
        hi = min(lo + STEP_WORDS + window - 1, total)
        hashes = words.hashes(lo, hi)
        n = hi - lo - window + 1
        grams = np.zeros(hi - lo - minimiser + 1, np.uint64)
        for k in range(minimiser):
            grams = (grams ^ hashes[k : k + len(grams)]) * WORD_POWERS.base
        least = sliding_least(mix(grams), window - minimiser + 1)
        inside = np.flatnonzero(words.doc[lo : lo + n] == words.doc[lo + window - 1 : hi])
        if not len(inside):
            continue
        doc, value = words.doc[lo + inside], least[inside]
        new = np.ones(len(inside), bool)
        new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1]) | (inside[1:] != inside[:-1] + 1)
        heads = np.flatnonzero(new)
        place = np.arange(len(inside)) - np.repeat(heads, np.diff(np.append(heads, len(inside))))
        heads = np.flatnonzero(place % LONGEST_RUN == 0)
        yield lo + inside[heads], np.diff(np.append(heads, len(inside))), value[heads], hashes, lo


def minimiser_counts(docs: DataFrame, text: str, window: int, minimiser: int) -> DataFrame:
    """(minimiser, n) of the minimisers that a task meets at least twice.

    One that every task meets at most once has at most one super-k-mer a task, which no bucket minds.
    """

    def table(values: np.ndarray) -> pa.RecordBatch:
        found, n = np.unique(values, return_counts=True)
        return pa.record_batch({"key": found[n > 1].view(np.int64), "n": n[n > 1].astype(np.int64)})

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, text):
                for _, _, value, _, _ in runs_of_windows(Words(part.column(text)), window, minimiser):
                    held.append(value)
                    size += len(value)
                if size >= COUNTED:
                    yield table(np.concatenate(held))
                    held, size = [], 0
        if held:
            yield table(np.concatenate(held))

    return docs.select(text).mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def frequent_minimisers(docs: DataFrame, text: str, window: int, minimiser: int, frequent: int) -> np.ndarray:
    """Sorted minimisers of at least ``frequent`` super-k-mers, at most SHARED of them."""
    counts = minimiser_counts(docs, text, window, minimiser).filter(F.col("n") >= frequent)
    counts = write_and_read(counts, "frequent-minimisers")
    limit = frequent
    while counts.filter(F.col("n") >= limit).count() > SHARED:
        limit *= 2
    found = counts.filter(F.col("n") >= limit).select("key").toArrow().column(0).to_numpy()
    return np.sort(found.view(np.uint64))


class Places:
    """Places (doc, copy, start) of packed strings, which compare in the order of the documents."""

    def __init__(self, table: pa.Table):
        doc = table.column("doc").combine_chunks()
        late = doc.is_null().to_numpy(zero_copy_only=False)
        doc = doc.fill_null(0).to_numpy(zero_copy_only=False)
        copy = table.column("copy").to_numpy()
        self.start = table.column("start").to_numpy().astype(np.int64)
        self.n = table.column("n").to_numpy().astype(np.int64)
        self.order = np.lexsort((self.start, copy, doc, late))
        fields = [x[self.order] for x in (late, doc, copy)]
        new = np.zeros(len(self.order), np.int64)
        for field in fields:
            new[1:] |= field[1:] != field[:-1]
        # Rank of the document of every row, whatever the order of rows.
        self.rank = np.empty(len(self.order), np.int64)
        self.rank[self.order] = np.cumsum(new)


def combined(table: pa.Table) -> pa.Table:
    """Equal packed strings once, from their earliest place; later ones become runs of repeats (no string)."""
    places = Places(table)
    codes = table.column("packed").combine_chunks().dictionary_encode().indices.to_numpy()
    order = places.order
    _, heads = np.unique(codes[order], return_index=True)
    earliest = np.zeros(codes.max() + 1, np.int64)
    earliest[codes[order[heads]]] = order[heads]
    earliest = earliest[codes]
    later = (places.rank != places.rank[earliest]) | (places.start != places.start[earliest])
    travel = table.take(pa.array(order[heads]))
    repeats = order[later[order]]
    if not len(repeats):
        return travel
    rank, start, n = places.rank[repeats], places.start[repeats], places.n[repeats]
    joins = np.zeros(len(repeats), bool)
    joins[1:] = (rank[1:] == rank[:-1]) & (start[1:] == start[:-1] + n[:-1])
    heads = np.flatnonzero(~joins)
    told = table.take(pa.array(repeats[heads]))
    size = np.add.reduceat(n, heads)
    told = pa.table(
        {
            "key": told.column("copy"),
            "packed": pa.nulls(len(heads), pa.string()),
            "doc": told.column("doc"),
            "copy": told.column("copy"),
            "start": told.column("start"),
            "n": pa.array(size, pa.int32()),
        }
    )
    return pa.concat_tables([travel, told])


def parcels(table: pa.Table, targets: int):
    """(target, rows, docs, body): the rows of every target, each document of them once, compressed."""
    places = Places(table)
    key = table.column("key").to_numpy()
    target = (key.view(np.uint64) % np.uint64(targets)).astype(np.int64)
    # Rows of a target in the order of the documents, which compresses best.
    order = places.order[np.argsort(target[places.order], kind="stable")]
    table, target, rank = table.take(pa.array(order)).combine_chunks(), target[order], places.rank[order]
    packed = table.column("packed").combine_chunks()
    data, borders = text_bytes(packed)
    data = memoryview(np.ascontiguousarray(data))
    lengths = np.where(packed.is_null().to_numpy(zero_copy_only=False), -1, np.diff(borders)).astype(np.int32)
    doc, copy = table.column("doc").combine_chunks(), table.column("copy").to_numpy()
    null, doc = doc.is_null().to_numpy(zero_copy_only=False), doc.fill_null(0).to_numpy(zero_copy_only=False)
    start, n = table.column("start").to_numpy(), table.column("n").to_numpy()
    numbers, heads = np.unique(target, return_index=True)
    packer = zstandard.ZstdCompressor(level=LEVEL)
    out = []
    for number, lo, hi in zip(numbers.tolist(), heads.tolist(), np.append(heads[1:], len(target)).tolist(), strict=True):
        new = np.append(True, rank[lo + 1 : hi] != rank[lo : hi - 1])
        at = lo + np.flatnonzero(new)
        fields = [doc[at], copy[at], null[at].astype(np.uint8)]
        fields += [np.diff(at, append=hi).astype(np.int32), start[lo:hi], n[lo:hi], lengths[lo:hi]]
        body = b"".join([*[f.tobytes() for f in fields], data[borders[lo] : borders[hi]]])
        out.append((number, hi - lo, len(at), packer.compress(body)))
    columns = list(zip(*out, strict=True))
    types = (pa.int32(), pa.int32(), pa.int32(), pa.binary())
    arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=["target", "rows", "docs", "body"])


def unpacked(rows: int, docs: int, body: bytes) -> pa.RecordBatch:
    """The rows of one parcel."""
    data = zstandard.ZstdDecompressor().decompress(body)
    at = 0

    def take(kind, count: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(data, kind, count, at)
        at += found.nbytes
        return found

    doc, copy, null = take("<i8", docs), take("<i8", docs), take("u1", docs)
    per_doc, start, n, lengths = (take("<i4", k) for k in (docs, rows, rows, rows))
    row = np.repeat(np.arange(docs), per_doc)
    borders = np.concatenate([[0], np.cumsum(np.maximum(lengths, 0), dtype=np.int64)])
    packed = text_array(np.frombuffer(data, np.uint8, offset=at), borders).cast(pa.string())
    packed = pc.if_else(pa.array(lengths >= 0), packed, pa.scalar(None, pa.string()))
    arrays = [packed, pa.array(doc[row], mask=null[row] > 0), copy[row], start, n]
    return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["packed", "doc", "copy", "start", "n"])


def super_kmers(docs: DataFrame, text: str, window: int, minimiser: int, frequent: np.ndarray) -> DataFrame:
    """Parcels of packed strings by target; ``docs`` has doc, copy and the text."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    targets = -(-max(size * SPREAD, 1) // TARGET_BYTES)

    def packed_rows(part: pa.RecordBatch):
        words, singles = Words(part.column(text)), shared.value
        for head, n, value, hashes, lo in runs_of_windows(words, window, minimiser):
            at = np.searchsorted(singles, value)
            often = np.zeros(len(value), bool) if not len(singles) else singles[np.minimum(at, len(singles) - 1)] == value
            single = ranges(head[often], n[often])
            key = range_hashes(hashes, single - lo, single - lo + window, WORD_POWERS)
            head, n = np.append(head[~often], single), np.append(n[~often], np.ones(len(single), np.int64))
            key = np.append(value[~often], key)
            joined, at = words.joined(lo, min(lo + STEP_WORDS + window - 1, len(words.begins)))
            begins, ends = at[head - lo].tolist(), (at[head - lo + n + window - 1] - 1).tolist()
            doc = words.doc[head]
            yield pa.table(
                {
                    "key": pa.array(key.view(np.int64)),
                    "packed": pa.array([joined[a:b] for a, b in zip(begins, ends, strict=True)], pa.binary()).cast(pa.string()),
                    "doc": part.column("doc").take(pa.array(doc)),
                    "copy": part.column("copy").take(pa.array(doc)),
                    "start": pa.array((head - words.first[doc]).astype(np.int32)),
                    "n": pa.array(n.astype(np.int32)),
                }
            )

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, text):
                for table in packed_rows(part):
                    held.append(table)
                    size += table.nbytes
                if size >= COMBINE_BYTES:
                    yield parcels(combined(pa.concat_tables(held)), targets)
                    held, size = [], 0
        if held:
            yield parcels(combined(pa.concat_tables(held)), targets)

    return docs.select("doc", "copy", text).mapInArrow(run, PARCEL)


def equal_windows(ids: np.ndarray, at: np.ndarray, window: int, place: np.ndarray, bits: int = 64):
    """Windows in the order of (words, place), and which of them begin a group of equal ones.

    ``ids`` are word numbers, ``at`` the first word of each window. Windows are sorted by hash; neighbours
    of one hash are compared word by word, and a hash that different windows share is sorted by words.
    """
    key = range_hashes(mix(ids.astype(np.uint64) + np.uint64(1)), at, at + window, WORD_POWERS) >> np.uint64(64 - bits)
    order = np.argsort(place, kind="stable")
    order = order[np.argsort(key[order], kind="stable")]
    same = key[order[1:]] == key[order[:-1]]
    step, differ = np.arange(window), []
    pairs = np.flatnonzero(same)
    for lo in range(0, len(pairs), COMPARED):
        k = pairs[lo : lo + COMPARED]
        differs = (ids[at[order[k], None] + step] != ids[at[order[k + 1], None] + step]).any(1)
        differ.append(k[differs])
    first = np.append(True, ~same)[: len(order)]
    differ = np.concatenate(differ) if differ else pairs
    if len(differ):
        heads = np.flatnonzero(first)
        for group in np.unique(np.searchsorted(heads, differ, side="right") - 1):
            lo, hi = heads[group], heads[group + 1] if group + 1 < len(heads) else len(order)
            members = order[lo:hi]
            _, label = np.unique(ids[at[members, None] + step], axis=0, return_inverse=True)
            label = label.ravel()
            by_words = np.argsort(label, kind="stable")
            order[lo:hi] = members[by_words]
            first[lo:hi] = np.diff(label[by_words], prepend=-1) != 0
    return order, first


def repeats_in(table: pa.Table, window: int) -> pa.Table:
    """Runs of windows of whole buckets that have an equal, earlier window."""
    places = Places(table)
    texts = pc.split_pattern(table.column("packed").combine_chunks(), " ")
    ids = texts.flatten().dictionary_encode().indices.to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(places.n)), places.n)
    offset = ranges(np.zeros(len(places.n), np.int64), places.n)
    at = texts.offsets.to_numpy()[row] - texts.offsets[0].as_py() + offset
    place = (places.rank[row] << 32) + places.start[row] + offset
    order, first = equal_windows(ids, at, window, place)
    heads = np.flatnonzero(first)
    earliest = np.repeat(place[order[heads]], np.diff(np.append(heads, len(order))))
    repeated = np.zeros(len(order), bool)
    repeated[order] = place[order] != earliest
    found = np.flatnonzero(repeated)
    if not len(found):
        return table.select(["doc", "copy", "start", "n"]).slice(0, 0)
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1] + 1) | (row[found[1:]] != row[found[:-1]])
    heads = np.flatnonzero(new)
    told = table.take(pa.array(row[found[heads]]))
    return pa.table(
        {
            "doc": told.column("doc"),
            "copy": told.column("copy"),
            "start": pa.array((places.start[row[found[heads]]] + offset[found[heads]]).astype(np.int32)),
            "n": pa.array(np.diff(np.append(heads, len(found))).astype(np.int32)),
        }
    )


def repeated_runs(sent: DataFrame, window: int) -> DataFrame:
    """(doc, copy, start, n): all runs of windows that an equal window precedes. A task goes target by target."""

    def run(batches):
        held, now = [], None

        def settle():
            table = pa.Table.from_batches([unpacked(*parcel) for parcel in held])
            known = table.filter(pc.is_null(table.column("packed")))
            yield from known.select(["doc", "copy", "start", "n"]).to_batches()
            travel = table.filter(pc.is_valid(table.column("packed")))
            del table
            if travel.num_rows:
                yield from repeats_in(travel, window).to_batches()

        for batch in batches:
            for k in range(batch.num_rows):
                target, *parcel = (batch.column(c)[k].as_py() for c in ("target", "rows", "docs", "body"))
                if held and target != now:
                    yield from settle()
                    held = []
                now = target
                held.append(parcel)
        if held:
            yield from settle()
        # A worker goes on to other tasks; it need not keep what this one needed.
        pa.default_memory_pool().release_unused()

    parts = work_partitions(sent.sparkSession)
    dealt = sent.repartitionById(parts, F.col("target") % parts).sortWithinPartitions("target")
    return dealt.mapInArrow(run, RUNS)


def deduplicate(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    minimiser: int = MINIMISER,
    frequent: int = FREQUENT,
) -> DataFrame:
    """Add ``n_words``, ``n_removed`` and ``kept_text``: the words that no repeated window covers.

    ``key`` is a whole number. A text without words, null included, keeps an empty text. Columns of the
    documents stay, those with the name of a result are replaced. One row comes out for every row.
    """
    if not 1 <= minimiser <= window:
        raise ValueError("a minimiser has at least one word and fits into a window")
    results = ("n_words", "n_removed", "kept_text")
    kept = [c for c in docs.columns if c.lower() not in results]
    names = fresh(docs, "body", "doc", "copy", "runs")
    body, doc, copy, runs = names["body"], names["doc"], names["copy"], names["runs"]
    source = docs.select(
        *[F.col(f"`{c}`") for c in kept if c != text],
        F.col(f"`{text}`").cast("string").alias(body),
        F.col(f"`{key}`").cast("long").alias(doc),
    ).withColumn(copy, F.xxhash64(F.coalesce(body, F.lit(""))))
    plain = source.select(
        F.col(doc).alias("doc"), F.col(copy).alias("copy"), F.coalesce(body, F.lit("")).alias("text")
    )
    often = frequent_minimisers(plain, "text", window, minimiser, frequent)
    found = repeated_runs(super_kmers(plain, "text", window, minimiser, often), window)
    # As many runs as a document has repeated passages: bounded by the document itself.
    found = found.groupBy("doc", "copy").agg(F.collect_list(F.struct("start", "n")).alias(runs))
    found = found.select(F.col("doc").alias("_run_doc"), F.col("copy").alias("_run_copy"), runs)

    columns = source.columns

    def squeeze(part: pa.RecordBatch) -> pa.RecordBatch:
        packer = zstandard.ZstdCompressor(level=3)
        texts = part.column(body).cast(pa.binary()).to_pylist()
        squeezed = pa.array([t if t is None else packer.compress(t) for t in texts], pa.binary())
        arrays = [squeezed if c == body else part.column(c) for c in columns]
        return pa.RecordBatch.from_arrays(arrays, names=columns)

    kinds = [
        f"`{f.name}` {'binary' if f.name == body else f.dataType.simpleString()}" for f in source.schema.fields
    ]
    carried = map_slices(source, body, ", ".join(kinds), lambda: squeeze)
    joined = carried.join(
        found, F.col(doc).eqNullSafe(F.col("_run_doc")) & (F.col(copy) == F.col("_run_copy")), "left"
    ).drop(doc, copy, "_run_doc", "_run_copy")
    joined = joined.select(
        "*", F.col(f"{runs}.start").alias(f"{runs}_start"), F.col(f"{runs}.n").alias(f"{runs}_n")
    ).drop(runs)
    fields = [f"`{c}` {'string' if c == text else joined.schema[c].dataType.simpleString()}" for c in kept]

    def cut(part: pa.RecordBatch) -> pa.RecordBatch:
        unpacker = zstandard.ZstdDecompressor()
        texts = [t if t is None else unpacker.decompress(t) for t in part.column(body).to_pylist()]
        texts = pa.array(texts, pa.binary()).cast(pa.string())
        words = Words(texts)
        starts, sizes = part.column(f"{runs}_start"), part.column(f"{runs}_n")
        per_row = pc.list_value_length(starts).fill_null(0).to_numpy(zero_copy_only=False)
        at = np.repeat(words.first[:-1], per_row) + starts.flatten().to_numpy(zero_copy_only=False)
        cover = np.zeros(len(words.begins) + 1, np.int64)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + sizes.flatten().to_numpy(zero_copy_only=False) + window - 1, -1)
        stays = np.cumsum(cover[:-1]) == 0
        removed = words.counts - np.bincount(words.doc[stays], minlength=part.num_rows)
        # Kept words, each with a byte before it that becomes a space unless the word is the first.
        lengths = words.ends[stays] - words.begins[stays]
        row = words.doc[stays]
        gap = np.ones(len(row), np.int64)
        gap[:1] = 0
        gap[1:] = row[1:] == row[:-1]
        ends = np.cumsum(lengths + gap)
        out = np.full(int(ends[-1]) if len(ends) else 0, 0x20, np.uint8)
        out[ranges(ends - lengths, lengths)] = words.data[ranges(words.begins[stays], lengths)]
        borders = np.concatenate([[0], ends])[np.searchsorted(row, np.arange(part.num_rows + 1))]
        arrays = [texts if c == text else part.column(c) for c in kept]
        arrays += [pa.array(words.counts, pa.int64()), pa.array(removed, pa.int64())]
        arrays.append(text_array(out, borders).cast(pa.string()))
        return pa.RecordBatch.from_arrays(arrays, names=[*kept, *results])

    def run(batches):
        for batch in batches:
            for part in slices(batch, body, SLICE_BYTES // 4):
                yield cut(part)

    return joined.mapInArrow(run, ", ".join([*fields, "n_words long", "n_removed long", "kept_text string"]))
