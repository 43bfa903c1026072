"""SentencePiece encoding that keeps the way back to the bytes of the source.

A text is normalised here, by longest-prefix steps through the model's compiled character map, and
every normalised byte remembers the source byte it came from. A copy of the model without any
normalisation of its own then cuts the normalised text into pieces, and the remembered positions
project each piece to its span of source bytes.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusweave.llm.batches import fresh, map_slices

SPACE = "▁"
UNKNOWN, CONTROL, USER_DEFINED, BYTE = 2, 3, 4, 6

# Field numbers of the published model format.
MODEL_PIECES, MODEL_TRAINER, MODEL_NORMALIZER = 1, 2, 3
MAP_FIELD, DUMMY_FIELD, EXTRA_FIELD, ESCAPE_FIELD = 2, 3, 4, 5
SUFFIX_FIELD = 24


def read_fields(data: bytes):
    """(field number, value, start, end) of each field of a protocol buffer message."""
    at = 0

    def number():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        start = at
        tag = number()
        if tag & 7 == 0:
            value = number()
        else:
            size = {1: 8, 5: 4}.get(tag & 7)
            size = number() if size is None else size
            value = data[at : at + size]
            at += size
        yield tag >> 3, value, start, at


def as_number(value: int) -> bytes:
    out = bytearray()
    while value >= 128:
        out.append(value & 127 | 128)
        value >>= 7
    return bytes([*out, value])


class CharacterMap:
    """The compiled map: a double-array trie over UTF-8 prefixes and a pool of replacements.

    The blob is the trie's size in bytes, its 32-bit units, then zero-ended replacements.
    """

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if size else []
        self.pool = blob[4 + size :]
        self.starts = re.compile(f"[{''.join(map(re.escape, self.first_characters()))}]") if self.units else None

    def child(self, node: int, label: int) -> int | None:
        """The node below ``node`` by one byte. A node is the place of its unit."""
        unit = self.units[node]
        place = node ^ (unit >> 10 << ((unit >> 9 & 1) << 3)) ^ label
        if place < len(self.units) and self.units[place] & 0x800000FF == label:
            return place
        return None

    def value(self, node: int) -> bytes | None:
        unit = self.units[node]
        if not unit >> 8 & 1:
            return None
        leaf = self.units[node ^ (unit >> 10 << ((unit >> 9 & 1) << 3))] & 0x7FFFFFFF
        return self.pool[leaf : self.pool.index(b"\0", leaf)]

    def first_characters(self) -> list[str]:
        """Characters that some prefix begins with; other text is copied as it stands."""
        found, stack = [], [(0, b"")]
        while stack:
            node, seen = stack.pop()
            if seen:
                lead = seen[0]
                need = 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                if len(seen) == need:
                    found.append(seen.decode("utf-8", "ignore"))
                    continue
            stack += [(below, seen + bytes([b])) for b in range(1, 256) if (below := self.child(node, b)) is not None]
        return [c for c in found if c] or ["\0"]

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """Replacement and length of the longest prefix of ``data[at:]`` in the map."""
        node, best = 0, None
        for k in range(at, len(data)):
            if (node := self.child(node, data[k])) is None:
                break
            if (value := self.value(node)) is not None:
                best = value, k + 1 - at
        return best


@dataclass
class Normalizer:
    """Text to normalised text and, for each of its bytes and its end, the source byte."""

    charmap: CharacterMap
    dummy_prefix: bool = True
    squeeze: bool = False
    escape: bool = True
    suffix: bool = False
    verbatim: list[str] = field(default_factory=list)

    def __post_init__(self):
        longest_first = sorted(self.verbatim, key=len, reverse=True)
        self.whole = re.compile("|".join(map(re.escape, longest_first))) if longest_first else None
        self.plain = self.charmap.starts is None and self.whole is None and not self.squeeze

    def steps(self, text: str):
        """(normalised chunk, source byte, source bytes used, one byte per source byte?)."""
        data = text.encode("utf-8", "replace")
        if self.charmap.starts is None and self.whole is None:
            yield data, 0, len(data), True
            return
        starts = self.charmap.starts.finditer(text) if self.charmap.starts is not None else ()
        kept = {m.start(): m.end() for m in self.whole.finditer(text)} if self.whole else {}
        stops = sorted({*(m.start() for m in starts), *kept})
        # Source byte of every character where a step may start or a verbatim string ends.
        offsets, chars, size = {}, 0, 0
        for stop in sorted({*stops, *kept.values()}):
            size += len(text[chars:stop].encode("utf-8", "replace"))
            chars, offsets[stop] = stop, size
        at = 0
        for stop in stops:
            start = offsets[stop]
            if start < at:
                continue
            if stop in kept:
                end = offsets[kept[stop]]
                replaced = data[start:end]
            else:
                found = self.charmap.longest(data, start)
                if found is None:
                    continue
                replaced, end = found[0], start + found[1]
            if start > at:
                yield data[at:start], at, start - at, True
            yield replaced, start, end - start, False
            at = end
        if at < len(data):
            yield data[at:], at, len(data) - at, True

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        space = SPACE.encode() if self.escape else b" "
        if not text:
            return "", np.zeros(1, np.int64)
        out, source = [], []
        for chunk, start, used, same in self.steps(text):
            out.append(chunk)
            if same:
                # Every byte of a character comes from the character's first byte.
                codes = np.frombuffer(chunk, np.uint8)
                place = np.arange(start, start + len(codes), dtype=np.int32)
                place[codes & 0xC0 == 0x80] = 0
                source.append(np.maximum.accumulate(place))
            else:
                source.append(np.full(len(chunk), start, np.int64))
        data = np.frombuffer(b"".join(out), np.uint8)
        align = source[0] if len(source) == 1 else np.concatenate([np.zeros(0, np.int64), *source])
        end = len(text.encode("utf-8", "replace"))
        blank = data == 32
        if self.squeeze:
            keep = ~blank | np.concatenate([[False], ~blank[:-1]])
            if not keep.any() or blank.all():
                return "", np.zeros(1, np.int64)
            kept = np.flatnonzero(keep)
            if blank[kept[-1]]:
                end, kept = align[kept[-1]], kept[:-1]
            data, align, blank = data[kept], align[kept], blank[kept]
        if self.escape:
            width = np.where(blank, len(space), 1)
            wide = np.repeat(data, width)
            at = (np.cumsum(width) - width)[blank]
            for k, byte in enumerate(space):
                wide[at + k] = byte
            data, align = wide, np.repeat(align, width)
        text_out = data.tobytes()
        if self.dummy_prefix and self.suffix:
            text_out, align = text_out + space, np.concatenate([align, np.full(len(space), end)])
        elif self.dummy_prefix:
            head = align[0] if len(align) else 0
            text_out, align = space + text_out, np.concatenate([np.full(len(space), head), align])
        return text_out.decode("utf-8", "replace"), np.append(align, end)


class Pieces:
    """A model file as a normaliser of ours and the library's segmentation of normalised text."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            data = file.read()
        kinds, sizes, verbatim, rest = [], [], [], []
        options: dict[int, object] = {MAP_FIELD: b"", DUMMY_FIELD: 1, EXTRA_FIELD: 1, ESCAPE_FIELD: 1}
        suffix = 0
        for number, value, start, end in read_fields(data):
            if number == MODEL_PIECES:
                piece = {n: v for n, v, _, _ in read_fields(value)}
                kind = piece.get(3, 1)
                kinds.append(kind)
                sizes.append(1 if kind == BYTE else len(piece[1]))
                if kind == USER_DEFINED:
                    verbatim.append(piece[1].decode())
            if number == MODEL_NORMALIZER:
                options |= {n: v for n, v, _, _ in read_fields(value)}
                continue
            if number == MODEL_TRAINER:
                suffix = {n: v for n, v, _, _ in read_fields(value)}.get(SUFFIX_FIELD, 0)
            rest.append(data[start:end])
        off = b"".join(as_number(f << 3) + b"\0" for f in (DUMMY_FIELD, EXTRA_FIELD, ESCAPE_FIELD))
        bare = b"".join(rest) + as_number(MODEL_NORMALIZER << 3 | 2) + as_number(len(off)) + off
        self.cutter = sentencepiece.SentencePieceProcessor(model_proto=bare)
        self.decoder = sentencepiece.SentencePieceProcessor(model_file=path)
        self.sizes = np.array(sizes)
        self.unknown = np.array(kinds) == UNKNOWN
        self.normalize = Normalizer(
            CharacterMap(options[MAP_FIELD]),
            bool(options[DUMMY_FIELD]),
            bool(options[EXTRA_FIELD]),
            bool(options[ESCAPE_FIELD]),
            bool(suffix),
            verbatim,
        )

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, begins, ends) of each text, spans in source bytes, without begin and end ids."""
        made = [self.normalize(t) for t in texts]
        out = []
        for text, align in made:
            ids = np.asarray(self.cutter.encode(text, return_type="numpy"), np.int32)
            sizes = self.sizes[ids]
            if self.unknown[ids].any():
                # Only the text itself tells how long an unknown piece is.
                pieces = self.cutter.encode(text, out_type=str)
                sizes = np.where(self.unknown[ids], [len(p.encode()) for p in pieces], sizes)
            ends = np.cumsum(sizes)
            if len(ends) and ends[-1] != len(align) - 1:
                raise ValueError("pieces do not add up to the normalised text")
            out.append((ids, align[ends - sizes], align[ends]))
        return out


ENCODED = "ids array<int>, begins array<int>, ends array<int>"


def _schema(df: DataFrame, made: str) -> tuple[list[str], str]:
    names = {c.split()[0] for c in made.split(", ")}
    kept = [c for c in df.columns if c not in names]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in kept]
    return kept, ", ".join([*fields, made])


def encode(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """Add ``ids`` with begin and end id, and the source bytes ``begins`` and ``ends`` of each id.

    The begin id spans nothing at the start, the end id nothing at the end of the text. A null text
    counts as an empty one. Columns of the three names are replaced; other columns go along.
    """
    body = fresh(docs, "body")["body"]
    kept, schema = _schema(docs, ENCODED)
    source = docs.select(*[f"`{c}`" for c in kept], F.col(f"`{text}`").cast("string").alias(body))

    def make():
        pieces = Pieces(model_path)
        first, last = pieces.decoder.bos_id(), pieces.decoder.eos_id()

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or "" for t in part.column(body).to_pylist()]
            rows = []
            for t, (ids, begins, ends) in zip(texts, pieces.encode(texts), strict=True):
                size = len(t.encode("utf-8", "replace"))
                rows.append((np.r_[first, ids, last], np.r_[0, begins, size], np.r_[0, ends, size]))
            columns = [_lists([r[k] for r in rows]) for k in range(3)]
            return pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in kept], *columns], names=[*kept, "ids", "begins", "ends"]
            )

        return work

    return map_slices(source, body, schema, make)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    values = np.concatenate(rows).astype(np.int32) if rows else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def decode(encoded: DataFrame, model_path: str, ids: str = "ids") -> DataFrame:
    """Replace or add ``decoded``: the text of the ids; null ids give an empty text."""
    kept, schema = _schema(encoded, "decoded string")
    source = encoded.select(*[f"`{c}`" for c in {**dict.fromkeys(kept), ids: None}])

    def run(batches):
        decoder = sentencepiece.SentencePieceProcessor(model_file=model_path)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = [decoder.decode(i or []) for i in part.column(ids).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in kept], pa.array(texts, pa.string())], names=[*kept, "decoded"]
                )

    return source.mapInArrow(run, schema)


DIGESTS = (
    "n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long, spans_cover boolean"
)


def digests(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """Encode and decode in one pass, keeping digests in place of texts and ids.

    ``spans_cover`` tells whether the spans of the ids follow each other from the first to the last
    byte of the text without a gap.
    """
    body = fresh(docs, "body")["body"]
    kept, schema = _schema(docs.drop(text), DIGESTS)
    source = docs.select(*[f"`{c}`" for c in kept], F.col(f"`{text}`").cast("string").alias(body))

    def make():
        pieces = Pieces(model_path)
        first, last = pieces.decoder.bos_id(), pieces.decoder.eos_id()

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or "" for t in part.column(body).to_pylist()]
            rows = []
            for t, (ids, begins, ends) in zip(texts, pieces.encode(texts), strict=True):
                whole = np.concatenate([[first], ids, [last]])
                size = len(t.encode("utf-8", "replace"))
                cover = bool((begins[1:] == ends[:-1]).all() and begins[0] == 0 and ends[-1] == size) if len(ids) else size == 0
                decoded = pieces.decoder.decode(whole.tolist())
                rows.append(
                    (
                        len(whole),
                        hashlib.sha256(whole.astype("<u4").tobytes()).hexdigest(),
                        hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest(),
                        size,
                        cover,
                    )
                )
            columns = zip(*rows, strict=True)
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            names = [c.split()[0] for c in DIGESTS.split(", ")]
            return pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], *arrays], names=[*kept, *names])

        return work

    return map_slices(source, body, schema, make)


def piece_at(begins: list[int], byte: int) -> int:
    """Index of the piece that a source byte lies in, by its begins."""
    return max(bisect_left(begins, byte + 1) - 1, 0)
