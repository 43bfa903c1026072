"""Fill-in-the-middle by displacement scatter, and the exact way back.

A batch of texts is one run of bytes. Its line ends are scanned once and give every text two cuts.
Between two cuts all bytes move by the same distance, so a difference array that is non-zero at cuts
only describes the whole batch: its cumulative sum is the shift of every byte, one numpy scatter
writes all outputs, and marks fill the places left over. The way back finds the marks in an output,
computes the same shifts and gathers the bytes from where the scatter put them.

Null texts count as empty, empty texts and texts that hold a mark stay plain. The draw depends on the
key alone, so repeated rows and reruns agree; rows with a null key share the draw of an empty key.
Columns of the documents are kept, those with the name of a result are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusweave.llm.batches import fresh, slices
from corpusweave.llm.spans import text_array, text_bytes

SEED = 7
# Percent of the texts that are transformed, and of those the percent in the order suffix, prefix, middle.
RATE = 100
SPM_SHARE = 50
FORMS = ("plain", "psm", "spm")
RESULTS = ("n", "form", "prefix_chars", "middle_chars", "output")
# Bytes whose shifts are held at a time, however long a text is.
BLOCK = 1 << 20
LINE_END = 0x0A


@dataclass(frozen=True)
class Marks:
    """The three control strings. No mark may begin inside another, so that outputs read one way only."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        marks = [self.prefix, self.suffix, self.middle]
        wrong = len(set(marks)) < 3 or "" in marks
        for a in marks:
            for b in marks:
                wrong |= a != b and b in a
                wrong |= any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b))))
        if wrong:
            raise ValueError(f"marks {marks} are empty, equal or overlap")

    def order(self, form: int) -> tuple[tuple[bytes, int], ...]:
        """(mark, part) as they stand in the output; parts are 0 prefix, 1 middle, 2 suffix."""
        p, s, m = (x.encode() for x in (self.prefix, self.suffix, self.middle))
        return ((p, 0), (s, 2), (m, 1)) if form == 1 else ((s, 2), (p, 0), (m, 1))


@dataclass(frozen=True)
class Layout:
    """Where the parts of every text lie in its bytes and in the output, all in bytes of the batch."""

    source: np.ndarray  # n x 3: first byte of prefix, middle, suffix
    size: np.ndarray  # n x 3
    target: np.ndarray  # n x 3
    marks: list[tuple[bytes, np.ndarray]]  # a mark and the places where it is written
    borders: np.ndarray  # of the outputs


def layout(borders: np.ndarray, cuts: np.ndarray, forms: np.ndarray, marks: Marks) -> Layout:
    """Places of all parts. ``cuts`` (n x 2) are offsets in the text; a plain text is all suffix."""
    lengths = np.diff(borders)
    size = np.stack([cuts[:, 0], cuts[:, 1] - cuts[:, 0], lengths - cuts[:, 1]], 1)
    source = borders[:-1, None] + np.cumsum(size, 1) - size
    longer = sum(len(mark) for mark, _ in marks.order(1))
    out = np.concatenate([[0], np.cumsum(lengths + longer * (forms > 0))])
    target, placed = source - borders[:-1, None] + out[:-1, None], []
    for form in (1, 2):
        rows, at = forms == form, out[:-1][forms == form].copy()
        for mark, part in marks.order(form):
            placed.append((mark, at.copy()))
            target[rows, part] = at + len(mark)
            at += len(mark) + size[rows, part]
    return Layout(source, size, target, placed, out)


def shifts(plan: Layout, total: int):
    """(first byte, output place of each byte) of one block after the other: a running sum of differences."""
    used = plan.size.ravel() > 0
    starts, distance = plan.source.ravel()[used], (plan.target - plan.source).ravel()[used]
    change = np.diff(distance, prepend=0)
    carried = 0
    for first in range(0, total, BLOCK):
        length = min(BLOCK, total - first)
        inside = slice(*np.searchsorted(starts, [first, first + length]))
        difference = np.zeros(length, np.int64)
        difference[starts[inside] - first] = change[inside]
        difference[0] += carried
        shift = np.cumsum(difference)
        carried = int(shift[-1])
        yield first, shift + np.arange(first, first + length)


def scatter(data: np.ndarray, plan: Layout) -> np.ndarray:
    out = np.empty(int(plan.borders[-1]), np.uint8)
    for first, places in shifts(plan, len(data)):
        out[places] = data[first : first + len(places)]
    for mark, at in plan.marks:
        for k, byte in enumerate(mark):
            out[at + k] = byte
    return out


def gather(out: np.ndarray, plan: Layout, total: int) -> np.ndarray:
    data = np.empty(total, np.uint8)
    for first, places in shifts(plan, total):
        data[first : first + len(places)] = out[places]
    return data


def line_cuts(data: np.ndarray, borders: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines of every text and its two cuts in bytes, from two draws (n x 2)."""
    lengths = np.diff(borders)
    ends = np.flatnonzero(data == LINE_END) + 1
    before = np.searchsorted(ends, borders, side="right")
    whole = np.diff(before)
    filled = lengths > 0
    open_line = np.zeros(len(lengths), bool)
    open_line[filled] = data[borders[1:][filled] - 1] != LINE_END
    n = whole + open_line
    lines = np.sort((draws % (n[:, None] + 1)).astype(np.int64), 1)
    # The end of line k, of the text for the last line, 0 for no line.
    padded = np.concatenate([ends, [0]])
    found = padded[np.minimum(before[:-1, None] + np.maximum(lines, 1) - 1, len(ends))] - borders[:-1, None]
    cuts = np.where(lines == 0, 0, np.where(lines > whole[:, None], lengths[:, None], found))
    return n, cuts


def holds(column: pa.Array, marks: Marks) -> np.ndarray:
    found = np.zeros(len(column), bool)
    for mark in (marks.prefix, marks.suffix, marks.middle):
        found |= pc.find_substring(column, mark).to_numpy(zero_copy_only=False) >= 0
    return found


def code_points(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Code points of byte ranges that are in order."""
    out = np.zeros(len(starts), np.int64)
    for first in range(0, len(data), BLOCK):
        sums = np.concatenate([[0], np.cumsum((data[first : first + BLOCK] & 0xC0) != 0x80)])
        inside = lambda at: np.clip(at - first, 0, len(sums) - 1)
        out += sums[inside(starts + sizes)] - sums[inside(starts)]
    return out


def draw(key: Column, seed: int = SEED) -> Column:
    """The first four 32-bit numbers of the digest of seed and key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)])


def transform(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    marks: Marks | None = None,
    seed: int = SEED,
    rate: int = RATE,
    spm_share: int = SPM_SHARE,
) -> DataFrame:
    """Add n (lines), form, prefix_chars, middle_chars (null if plain) and output. Map-only."""
    marks = marks or Marks()
    kept = [c for c in docs.columns if c.lower() not in RESULTS]
    names = fresh(docs, "body", "draws")
    body, draws = names["body"], names["draws"]
    source = docs.select(
        *[F.col(f"`{c}`") for c in kept],
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias(body),
        draw(F.col(f"`{key}`"), seed).alias(draws),
    )
    fields = [f"`{c}` {source.schema[c].dataType.simpleString()}" for c in kept]

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = part.column(body)
        data, borders = text_bytes(texts)
        drawn = np.asarray(part.column(draws).flatten()).reshape(-1, 4)
        n, cuts = line_cuts(data, borders, drawn[:, :2])
        plain = (np.diff(borders) == 0) | holds(texts, marks) | (drawn[:, 2] % 100 >= rate)
        forms = np.where(plain, 0, np.where(drawn[:, 3] % 100 < spm_share, 2, 1))
        cuts[plain] = 0
        plan = layout(borders, cuts, forms, marks)
        counts = [pa.array(code_points(data, plan.source[:, k], plan.size[:, k]), mask=plain) for k in (0, 1)]
        out = text_array(scatter(data, plan), plan.borders).cast(pa.string())
        arrays = [part.column(c) for c in kept]
        arrays += [pa.array(n, pa.int64()), pa.array(FORMS).take(pa.array(forms)), *counts, out]
        return pa.RecordBatch.from_arrays(arrays, names=[*kept, *RESULTS])

    def run(batches):
        for batch in batches:
            for part in slices(batch, body):
                yield work(part)

    made = ["n long", "form string", "prefix_chars long", "middle_chars long", "output string"]
    return source.mapInArrow(run, ", ".join([*fields, *made]))


def parts_of(column: pa.Array, forms: np.ndarray, marks: Marks) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the texts behind outputs and their cuts, from the places of the marks alone."""
    lengths = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    cuts = np.zeros((len(column), 2), np.int64)
    for form in (1, 2):
        rows = np.flatnonzero(forms == form)
        (a, _), (b, _), (c, _) = marks.order(form)
        chosen = column.take(pa.array(rows))
        first, second, third = (
            pc.find_substring(chosen.cast(pa.binary()), m).to_numpy(zero_copy_only=False) for m in (a, b, c)
        )
        if (first != 0).any() or (second < len(a)).any() or (third < second + len(b)).any():
            raise ValueError(f"an output of form {FORMS[form]} lacks its marks")
        one, two = second - len(a), third - second - len(b)
        middle = lengths[rows] - third - len(c)
        prefix = one if form == 1 else two
        lengths[rows] -= len(a) + len(b) + len(c)
        cuts[rows] = np.stack([prefix, prefix + middle], 1)
    return lengths, cuts


def restore(formed: DataFrame, *, output: str = "output", form: str = "form", marks: Marks | None = None) -> DataFrame:
    """Add ``restored``: the text of before, rebuilt from output and form alone. Map-only."""
    marks = marks or Marks()
    kept = [c for c in formed.columns if c.lower() != "restored"]
    fields = [f"`{c}` {formed.schema[c].dataType.simpleString()}" for c in kept]
    known = pa.array(FORMS)

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        out, _ = text_bytes(part.column(output))
        forms = pc.index_in(part.column(form), known).fill_null(0).to_numpy(zero_copy_only=False)
        lengths, cuts = parts_of(part.column(output).fill_null(""), forms, marks)
        borders = np.concatenate([[0], np.cumsum(lengths)])
        plan = layout(borders, cuts, forms, marks)
        texts = text_array(gather(out, plan, int(borders[-1])), borders).cast(pa.string())
        return pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], texts], names=[*kept, "restored"])

    def run(batches):
        for batch in batches:
            for part in slices(batch, output):
                yield work(part)

    return formed.mapInArrow(run, ", ".join([*fields, "restored string"]))
