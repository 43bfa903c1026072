"""Quality rules: word and line counts, and zstandard compression bands.

Text that repeats itself compresses far below prose, and noise hardly compresses at all. Every
document is compressed whole and in fixed chunks, the last one shorter; the ratio of compressed to
plain bytes has to lie in a band whose limits depend on the length, because short texts give the
compressor less to reuse.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from corpusweave.llm.batches import WORD, fresh, map_slices

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

LEVEL = 3
CHUNK_BYTES = 4096
# (plain bytes, lowest and highest ratio) of pieces of so many bytes from the distinct texts of sf0.1 that
# pass the base rules: all pieces of a text that start at multiples of the larger of the length and 2,048.
CLEAN = (
    (64, 0.812, 1.141),
    (128, 0.664, 0.969),
    (256, 0.578, 0.812),
    (512, 0.500, 0.725),
    (1024, 0.438, 0.603),
    (2048, 0.410, 0.529),
    (4096, 0.381, 0.484),
    (8192, 0.361, 0.457),
    (16384, 0.347, 0.438),
    (32768, 0.347, 0.420),
)
# Margins: a text may fall to this share of the lowest clean ratio and exceed the highest by so much.
LOW_SHARE = 0.75
HIGH_MARGIN = 0.07
# Limits at these lengths; between them they change evenly with the logarithm of the length.
WHOLE_BANDS = tuple((size, LOW_SHARE * low, high + HIGH_MARGIN) for size, low, high in CLEAN)
# Band of a full chunk, and the share of chunks that may lie outside of theirs.
CHUNK_BAND = next((low, high) for size, low, high in WHOLE_BANDS if size == CHUNK_BYTES)
MAX_BAD_CHUNKS = 0.1
# A shorter rest is measured together with the bytes before it, for noise shows only from some length on.
LEAST_REST = 512

COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "whole_ratio double, n_chunks long, n_bad_chunks long, base_failed boolean, kept boolean"
)


def repeat_words(words: list[str]) -> int:
    """Words that lie in a 3-word window found twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[str, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    size = len(ids)
    pairs = a[:-1] * size + a[1:]
    if size >= 2_000_000:
        pairs = np.unique(pairs, return_inverse=True)[1]
    keys = pairs[:-1] * size + a[2:]
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    again = np.zeros(len(keys), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    covered[:-2] |= again
    covered[1:-1] |= again
    covered[2:] |= again
    return int(covered.sum())


def dup_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = text.split("\n")
    if len(set(lines)) == len(lines):
        return 0
    seen, found = set(), 0
    for line in lines:
        if line in seen:
            found += WORD.search(line) is not None
        else:
            seen.add(line)
    return found


def band_of(size: int, bands: Sequence[tuple[int, float, float]]) -> tuple[float, float]:
    sizes, lows, highs = zip(*bands, strict=True)
    at, places = np.log2(size), np.log2(sizes)
    return float(np.interp(at, places, lows)), float(np.interp(at, places, highs))


def compression(
    data: bytes,
    compressor: zstandard.ZstdCompressor,
    chunk_bytes: int,
    chunk_band: tuple[float, float],
    bands: Sequence[tuple[int, float, float]] = WHOLE_BANDS,
) -> tuple[float | None, int, int]:
    """Whole ratio, chunks and chunks outside of their band. The rest is a chunk with the band of its length."""
    if not data:
        return None, 0, 0
    whole = len(compressor.compress(data)) / len(data)
    n, bad = -(-len(data) // chunk_bytes), 0
    view = memoryview(data)
    for k in range(n):
        start, end = k * chunk_bytes, min((k + 1) * chunk_bytes, len(data))
        if end - start < chunk_bytes:
            start = max(min(start, end - LEAST_REST), 0)
        size = end - start
        ratio = whole if size == len(data) else len(compressor.compress(view[start:end])) / size
        low, high = chunk_band if size == chunk_bytes else band_of(size, bands)
        bad += not low <= ratio <= high
    return whole, n, bad


def score(
    docs: DataFrame,
    text: str = "text",
    *,
    whole_bands: Sequence[tuple[int, float, float]] = WHOLE_BANDS,
    chunk_bytes: int = CHUNK_BYTES,
    chunk_band: tuple[float, float] = CHUNK_BAND,
    max_bad_chunks: float = MAX_BAD_CHUNKS,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Counts and the verdict of every document, in one map pass over whole texts.

    ``keep`` names the columns that go along (all by default; clashing names get the counts only,
    so rename first). A null text counts as one without words, which fails the base rules. A
    document that passes them, whose ratio is in its band and of whose chunks at most a tenth are not, is kept. Rows are never joined or
    compared, so repeated rows get the same verdict each.
    """
    keep = list(docs.columns if keep is None else keep)
    made = {c.split()[0] for c in COLUMNS.split(", ")}
    keep = [c for c in keep if c not in made]
    body = fresh(docs, "body")["body"]
    source = docs.select(*[f"`{c}`" for c in keep], docs[f"`{text}`"].cast("string").alias(body))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields if f.name != body]
    schema = ", ".join([*fields, COLUMNS])

    def make():
        compressor = zstandard.ZstdCompressor(level=LEVEL)

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for value in part.column(body).to_pylist():
                value = value or ""
                words = WORD.findall(value)
                n, repeated = len(words), repeat_words(words)
                data = value.encode("utf-8", "surrogatepass")
                whole, chunks, bad = compression(data, compressor, chunk_bytes, chunk_band, whole_bands)
                failed = n < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * n
                good = not failed
                if good:
                    low, high = band_of(len(data), whole_bands)
                    good = low <= whole <= high and bad <= max_bad_chunks * chunks
                symbols = sum(value.count(c) for c in SYMBOLS)
                rows.append(
                    (n, sum(map(len, words)), symbols, dup_lines(value), repeated, whole, chunks, bad, failed, good)
                )
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64()] * 5 + [pa.float64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
            arrays = [part.column(c) for c in keep]
            arrays += [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            names = [*keep, *[c.split()[0] for c in COLUMNS.split(", ")]]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        return work

    return map_slices(source, body, schema, make)


def accepted(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that pass, with the columns they came with."""
    renamed = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    at = f"c{docs.columns.index(text)}"
    return score(renamed, at).filter("kept").select(*renamed.columns).toDF(*docs.columns)
