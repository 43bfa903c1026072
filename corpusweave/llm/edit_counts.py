"""Token counts that follow edits without counting whole documents anew.

A document is kept as its pre-tokens in runs of ``LEAF`` pieces, with a tree of sums (characters and
tokens) above the runs. An edit finds its place by going down the tree, re-reads the touched pieces
with as much context as the split pattern can look at, stops as soon as the new pieces fall in step
with the old ones, and updates the sums on the way up.
"""

from __future__ import annotations

import base64
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusweave.llm.batches import fresh, map_slices

LEAF = 64
# The pattern decides a piece by at most this many characters after the piece: a contraction needs
# two, and white space keeps back its last character for a word that follows.
LOOK_AHEAD = 2
# Pieces whose token count a task keeps.
CACHE_PIECES = 500_000

EDIT = "struct<start:bigint,length:bigint,text:string>"


class Counter:
    """Token counts of pre-tokens of a rank file, with a bounded memory of pieces seen."""

    def __init__(self, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.known: dict[str, int] = {}

    def counts(self, pieces: list[str]) -> list[int]:
        known = self.known
        new = {p for p in pieces if p not in known}
        if new:
            if len(known) + len(new) > CACHE_PIECES:
                known.clear()
                new = set(pieces)
            encode = self.encoding.encode_ordinary
            for piece in new:
                known[piece] = len(encode(piece))
        return [known[p] for p in pieces]


@dataclass
class Leaf:
    """A run of pre-tokens: characters and tokens of each."""

    chars: list[int]
    tokens: list[int]


class SegmentTree:
    """Sums of characters and tokens over the leaves of one document."""

    def __init__(self, leaves: list[Leaf]):
        self.load(leaves)

    def load(self, leaves: list[Leaf]) -> None:
        self.leaves = leaves or [Leaf([], [])]
        self.size = 1 << max(len(self.leaves) - 1, 0).bit_length()
        self.sums = np.zeros((2 * self.size, 2), np.int64)
        for k, leaf in enumerate(self.leaves):
            self.sums[self.size + k] = sum(leaf.chars), sum(leaf.tokens)
        for node in range(self.size - 1, 0, -1):
            self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]

    @property
    def chars(self) -> int:
        return int(self.sums[1, 0])

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def find(self, char: int) -> tuple[int, int]:
        """The leaf that holds a character, or the last one with any, and the leaf's first character."""
        node, before = 1, 0
        while node < self.size:
            left = int(self.sums[2 * node, 0])
            # Past the end, stay with the last leaf that holds something.
            if char < before + left or self.sums[2 * node + 1, 0] == 0:
                node = 2 * node
            else:
                before += left
                node = 2 * node + 1
        return min(node - self.size, len(self.leaves) - 1), before

    def put(self, at: int, leaf: Leaf) -> None:
        """Replace a leaf and the sums above it."""
        self.leaves[at] = leaf
        node = self.size + at
        self.sums[node] = sum(leaf.chars), sum(leaf.tokens)
        while node > 1:
            node //= 2
            self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]


def split_leaves(chars: list[int], tokens: list[int]) -> list[Leaf]:
    return [Leaf(chars[k : k + LEAF], tokens[k : k + LEAF]) for k in range(0, len(chars), LEAF)]


class Document:
    """A text with its tree; ``recounted`` says how many characters edits made it read again."""

    def __init__(self, text: str, counter: Counter):
        self.text, self.counter, self.recounted = text, counter, 0
        pieces = counter.pattern.findall(text)
        self.tree = SegmentTree(split_leaves([len(p) for p in pieces], counter.counts(pieces)))

    def edit(self, start: int, length: int, new: str) -> None:
        """Replace ``length`` characters from ``start``; both are cut to the text."""
        old = self.text
        start = min(max(start, 0), len(old))
        stop = min(start + max(length, 0), len(old))
        text = old[:start] + new + old[stop:]
        tree, shift = self.tree, len(new) - (stop - start)

        # Pieces that end early enough before the edit stand; the first other one is read again.
        first, at = tree.find(max(start - LOOK_AHEAD, 0))
        while first and at + LOOK_AHEAD > start:
            first -= 1
            at = at - int(tree.sums[tree.size + first, 0])
        leaf = tree.leaves[first]
        keep = 0
        while keep < len(leaf.chars) and at + leaf.chars[keep] + LOOK_AHEAD <= start:
            at += leaf.chars[keep]
            keep += 1

        # Walk the old borders and the new pieces side by side until they agree behind the edit.
        last, index, border = first, keep, at
        pieces, place = [], at
        for match in self.counter.pattern.finditer(text, at):
            if place >= start + len(new):
                while border + shift < place and last < len(tree.leaves):
                    if index < len(tree.leaves[last].chars):
                        border += tree.leaves[last].chars[index]
                        index += 1
                    else:
                        last, index = last + 1, 0
                if border >= stop and border + shift == place:
                    break
            pieces.append(match.group())
            place = match.end()
        else:
            last, index = len(tree.leaves), 0

        self.recounted += place - at
        chars = leaf.chars[:keep] + [len(p) for p in pieces]
        tokens = leaf.tokens[:keep] + self.counter.counts(pieces)
        if last < len(tree.leaves):
            chars += tree.leaves[last].chars[index:]
            tokens += tree.leaves[last].tokens[index:]
        self.text = text
        stops = min(last + 1, len(tree.leaves))
        if len(chars) > 4 * LEAF:
            tree.load(tree.leaves[:first] + split_leaves(chars, tokens) + tree.leaves[stops:])
            return
        tree.put(first, Leaf(chars, tokens))
        for k in range(first + 1, stops):
            tree.put(k, Leaf([], []))


def ordered_edits(edits: list[dict | None] | None) -> list[tuple[int, int, str]]:
    """Edits from the end of the text to its start, so that positions are those of the given text.

    Nulls in an edit count as position 0, length 0 and no text. Of edits that overlap, the one that
    starts first holds, and the later one is left out; at one position, insertions keep their order.
    """
    known = [(max(e["start"] or 0, 0), max(e["length"] or 0, 0), e["text"] or "") for e in edits or [] if e]
    taken, free = [], 0
    for start, length, text in sorted(known, key=lambda e: e[0]):
        if start >= free:
            taken.append((start, length, text))
            free = start + length
    return taken[::-1]


MADE = "tokens_before long, tokens_after long, chars_after long, n_edits long, recounted_chars long"


def count(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    *,
    text: str = "text",
    edits: str = "edits",
    keep: list[str] | None = None,
    with_text: bool = False,
) -> DataFrame:
    """Count tokens before and after the edits of each document, in one map pass.

    ``edits`` is an array of (start, length, text) in characters of the given text. ``keep`` names
    the columns that go along. A null text counts as an empty one and null edits as none. Rows stand
    for themselves, so repeated rows get the same counts. With ``with_text`` the edited text comes
    along as ``edited``.
    """
    made = MADE + (", edited string" if with_text else "")
    names = [c.split()[0] for c in made.split(", ")]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in names]
    at = fresh(docs, "body", "changes")
    body, changes = at["body"], at["changes"]
    source = docs.select(
        *[f"`{c}`" for c in kept],
        F.col(f"`{text}`").cast("string").alias(body),
        F.col(f"`{edits}`").cast(f"array<{EDIT}>").alias(changes),
    )
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields if f.name in kept]

    def make():
        counter = Counter(ranks_path, pattern)

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for value, listed in zip(
                part.column(body).to_pylist(), part.column(changes).to_pylist(), strict=True
            ):
                document = Document(value or "", counter)
                before = document.tree.tokens
                todo = ordered_edits(listed)
                for start, length, new in todo:
                    document.edit(start, length, new)
                tree = document.tree
                row = (before, tree.tokens, tree.chars, len(todo), document.recounted)
                rows.append((*row, document.text) if with_text else row)
            arrays = [part.column(c) for c in kept]
            kinds = [pa.int64()] * 5 + [pa.string()] * with_text
            arrays += [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=[*kept, *names])

        return work

    return map_slices(source, body, ", ".join([*fields, made]), make)


def edit_lists(edits: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, edits) from a table of one edit a row: columns start, length, text and the key.

    The edits of a document are bounded by its length, apart from insertions at one place.
    """
    return edits.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("start", "length", "text").cast(EDIT))).alias("edits")
    )


def sample_edits(key: Column, text: Column) -> Column:
    """Three edits by a hash of the key: a deletion, an insertion and a replacement by own text."""
    size = F.length(text)
    place = [F.pmod(F.xxhash64(key, F.lit(k)), F.greatest(size, F.lit(1))).cast("long") for k in range(3)]
    piece = F.substring(text, (place[0] + 1).cast("int"), F.lit(40))
    return F.array(
        F.struct(place[0].alias("start"), F.lit(25).cast("long").alias("length"), F.lit("").alias("text")),
        F.struct(place[1].alias("start"), F.lit(0).cast("long").alias("length"), F.concat(F.lit(" "), piece).alias("text")),
        F.struct(place[2].alias("start"), F.lit(12).cast("long").alias("length"), F.reverse(piece).alias("text")),
    )
