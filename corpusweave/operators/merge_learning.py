"""Learning merges by signed changes of a kept pair table.

Sequences are packed into blocks: one array of symbol ids with a separator behind every sequence, and one
weight per sequence. Pairs are counted once. From then on a merge is looked up in each block, and only the
places around its occurrences count: -n for the pairs that vanish there, +n for those that appear. These
changes, summed per pair, are added to the kept table of pair counts, which stays in Spark, dealt to parts
by a hash of the pair and packed like the blocks.

A round looks ahead along a drafted list of merges. Changes carry the step of the draft at which they
happen, so a part knows its best pair after every step, ties included, and the merges are those up to the
first one that the draft did not foresee. The result is that of one merge per pass. The driver holds the
merges, one winner per part and step, and the bounded sample that drafts come from.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusweave.functions import symbols as S
from corpusweave.session import durable, work_partitions

SEPARATOR = np.uint32(0xFFFFFFFF)
BASE_SIZE = 256
# Symbols of a block; a longer sequence is a block of its own.
BLOCK_SYMBOLS = 1 << 18
# Symbols that a task of a round has at least, if every core has a task: rounds are many and short.
TASK_SYMBOLS = 1 << 21
# Changes that a task holds before it sums them up.
HELD_CHANGES = 1 << 20
# Merges drafted ahead per round, up to so many while drafts come true, and the bounded sample they come from.
DRAFT_STEPS = 32
LONGEST_DRAFT = 256
SAMPLE_ROWS = 65536
SAMPLE_SEQUENCE_LENGTH = 64
# Pairs of the sample that are looked up beforehand, for each merge drafted.
LIKELY_PAIRS = 8
# Pairs of the kept table that correct the sample's counts.
KNOWN_PAIRS = 512
# Rounds between refreshes of the blocks.
REFRESH_ROUNDS = 6

Merge = tuple[int, int, int]


class Block:
    """Sequences of symbol ids, each closed by a separator, and their weights."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray):
        self.ids, self.weights = ids, weights

    def weights_at(self, places: np.ndarray) -> np.ndarray:
        return self.weights[np.searchsorted(np.flatnonzero(self.ids == SEPARATOR), places)]

    def pairs_at(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys and weights of the pairs that begin at the places, without those over a border."""
        left, right = self.ids[places].astype(np.uint64), self.ids[places + 1].astype(np.uint64)
        inside = (left != SEPARATOR) & (right != SEPARATOR)
        return (left[inside] << np.uint64(32)) | right[inside], self.weights_at(places[inside])

    def all_pairs(self) -> tuple[np.ndarray, np.ndarray]:
        return self.pairs_at(np.arange(len(self.ids) - 1))

    def merge(self, left: int, right: int, new: int) -> tuple[np.ndarray, np.ndarray]:
        """Merge a pair left to right, without overlap; its places before and after."""
        at = np.flatnonzero((self.ids[:-1] == left) & (self.ids[1:] == right))
        if left == right and len(at):
            # In a run of equal symbols every second pair overlaps the one before.
            begins = np.flatnonzero(np.diff(at, prepend=-2) > 1)
            rank = np.arange(len(at)) - np.repeat(begins, np.diff(np.append(begins, len(at))))
            at = at[rank % 2 == 0]
        if not len(at):
            return at, at
        keep = np.ones(len(self.ids), bool)
        keep[at + 1] = False
        self.ids[at] = new
        self.ids = self.ids[keep]
        return at, at - np.arange(len(at))

    def changes(self, left: int, right: int, new: int) -> tuple[np.ndarray, np.ndarray]:
        """Merge, and give the signed weights of all pairs that vanish or appear."""
        before = Block(self.ids.copy(), self.weights)
        was, now = self.merge(left, right, new)
        if not len(was):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        gone, gone_n = before.pairs_at(_around(was, 1, len(before.ids)))
        made, made_n = self.pairs_at(_around(now, 0, len(self.ids)))
        return np.concatenate([gone, made]), np.concatenate([-gone_n, made_n])

    def without_singles(self) -> Block:
        """Drop sequences that have no pair left."""
        ends = np.flatnonzero(self.ids == SEPARATOR)
        lengths = np.diff(ends, prepend=-1)
        long = lengths > 2
        return Block(self.ids[np.repeat(long, lengths)], self.weights[long])


class LiveBlock:
    """A block of which some merges are known beforehand: their places are looked up once, and no symbol moves.

    Neighbours are linked, so these merges cost as much as their occurrences; others look through the block. Pairs of
    symbols that the block already has can only vanish; a pair with a symbol made here stands where that symbol was made.
    """

    GONE = np.uint32(0xFFFFFFFE)

    def __init__(self, block: Block, merges: list[Merge]):
        # A separator on either side is everybody's neighbour.
        border = np.array([SEPARATOR], np.uint32)
        self.ids, self.weights = np.concatenate([border, block.ids, border]), block.weights
        self.after = np.arange(1, len(self.ids) + 1, dtype=np.int32)
        self.before = np.arange(-1, len(self.ids) - 1, dtype=np.int32)
        self.sequence = np.cumsum(self.ids[:-1] == SEPARATOR, dtype=np.int32) - 1
        self.made: dict[int, np.ndarray] = {}
        self.found = self._places(merges)

    def _places(self, merges: list[Merge]) -> dict[int, np.ndarray]:
        """Places by the key of the pair."""
        keys = np.unique(np.array([left << 32 | right for left, right, _ in merges], np.uint64))
        if not len(keys):
            return {}
        size = int(max(keys.max() >> np.uint64(32), (keys & np.uint64(0xFFFFFFFF)).max())) + 2
        starts, ends = np.zeros(size, bool), np.zeros(size, bool)
        starts[(keys >> np.uint64(32)).astype(np.int64)] = True
        ends[(keys & np.uint64(0xFFFFFFFF)).astype(np.int64)] = True
        # Symbols that no pair has share the last place, which is False.
        known = np.minimum(self.ids, np.uint32(size - 1))
        at = np.flatnonzero(starts[known[:-1]] & ends[known[1:]])
        pairs = (self.ids[at].astype(np.uint64) << np.uint64(32)) | self.ids[at + 1]
        number = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)
        at, number = at[keys[number] == pairs], number[keys[number] == pairs]
        order = np.argsort(number, kind="stable")
        borders = np.searchsorted(number[order], np.arange(len(keys) + 1))
        return {k: at[order[borders[i] : borders[i + 1]]] for i, k in enumerate(keys.tolist())}

    def _standing(self, left: int, right: int) -> np.ndarray:
        """Where the pair begins now, in order."""
        if left in self.made:
            at = self.made[left]
        elif right in self.made:
            at = self.made[right]
            at = self.before[at[self.ids[at] == right]]
        else:
            at = self.found.get(left << 32 | right)
            if at is None:
                at = np.flatnonzero(self.ids[1:-1] == left) + 1
        at = at[self.ids[at] == left]
        return at[self.ids[self.after[at]] == right]

    def _pairs(self, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        left, right = self.ids[heads], self.ids[self.after[heads]]
        inside = (left != SEPARATOR) & (right != SEPARATOR)
        keys = (left[inside].astype(np.uint64) << np.uint64(32)) | right[inside]
        return keys, self.weights[self.sequence[heads[inside]]]

    def merge(self, left: int, right: int, new: int, told: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Merge a pair left to right, without overlap; if ``told``, the signed weights of pairs that vanish or appear."""
        at = self._standing(left, right)
        if left == right and len(at):
            # In a run of equal symbols every second pair overlaps the one before.
            begins = np.flatnonzero(np.append(True, self.after[at[:-1]] != at[1:]))
            rank = np.arange(len(at)) - np.repeat(begins, np.diff(np.append(begins, len(at))))
            at = at[rank % 2 == 0]
        # A symbol may be made by several pairs.
        self.made[new] = np.union1d(self.made[new], at) if new in self.made else at
        if not len(at):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        second = self.after[at]
        if told:
            gone, gone_n = self._pairs(np.unique(np.concatenate([self.before[at], at, second])))
        third = self.after[second]
        self.ids[at], self.ids[second] = new, self.GONE
        self.after[at], self.before[third] = third, at
        if not told:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        fresh, fresh_n = self._pairs(np.unique(np.concatenate([self.before[at], at])))
        return np.concatenate([gone, fresh]), np.concatenate([-gone_n, fresh_n])

    def block(self) -> Block:
        ids = self.ids[1:-1]
        return Block(ids[ids != self.GONE], self.weights)


def _around(at: np.ndarray, after: int, size: int) -> np.ndarray:
    """Places of the pairs from the one before ``at`` to the one ``after`` it, each once."""
    places = np.unique(np.concatenate([at + k for k in range(-1, after + 1)]))
    return places[(places >= 0) & (places < size - 1)]


def summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with exact sums, zeros left out."""
    if not len(keys):
        return keys, weights
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    sums = np.add.reduceat(weights, heads)
    return keys[heads][sums != 0], sums[sums != 0]


def packed_ids(texts: list[str]) -> np.ndarray:
    """Symbol ids of the texts, a separator behind each."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    ids = np.where(points >= S.SURROGATE_START + S.SURROGATE_COUNT, points - np.uint32(S.SURROGATE_COUNT), points)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    return np.insert(ids, ends, SEPARATOR)


def pack(sequences: DataFrame, parts: int | None = None) -> DataFrame:
    """(ids, weights): blocks of all rows (symbols, n) of two or more symbols."""

    def flush(held):
        ids = np.concatenate([i for i, _ in held])
        weights = np.concatenate([w for _, w in held])
        return pa.record_batch({"ids": pa.array([ids.tobytes()]), "weights": pa.array([weights.tobytes()])})

    def run(batches):
        held, size = [], 0
        for batch in batches:
            symbols, weights = batch.column("symbols"), batch.column("n").to_numpy()
            # Rows of about a block at a time: as Python strings and index arrays they take many times their bytes.
            ends, lo = np.cumsum(pc.binary_length(symbols).to_numpy(zero_copy_only=False)), 0
            while lo < len(symbols):
                upto = (ends[lo - 1] if lo else 0) + BLOCK_SYMBOLS
                hi = max(int(np.searchsorted(ends, upto, side="right")), lo + 1)
                ids = packed_ids(symbols[lo:hi].to_pylist())
                held.append((ids, weights[lo:hi]))
                lo = hi
                size += len(ids)
                if size >= BLOCK_SYMBOLS:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    # As many partitions as there is work for: a table of distinct pieces is small in bytes.
    rows = sequences.filter(F.length("symbols") > 1)
    rows = rows.repartition(parts or work_partitions(sequences.sparkSession))
    return rows.mapInArrow(run, "ids binary, weights binary")


def _blocks(batches):
    for batch in batches:
        for ids, weights in zip(batch.column("ids"), batch.column("weights"), strict=True):
            yield Block(np.frombuffer(ids.as_buffer(), np.uint32).copy(), np.frombuffer(weights.as_buffer(), np.int64))


def merged_blocks(state: DataFrame, merges: list[Merge]) -> DataFrame:
    """The blocks after some merges."""

    def run(batches):
        for block in _blocks(batches):
            live = LiveBlock(block, merges)
            for merge in merges:
                live.merge(*merge)
            block = live.block().without_singles()
            if len(block.weights):
                yield pa.record_batch(
                    {"ids": pa.array([block.ids.tobytes()]), "weights": pa.array([block.weights.tobytes()])}
                )

    return state.mapInArrow(run, "ids binary, weights binary")


def pair_changes(state: DataFrame, pending: list[Merge], steps: list[Merge], whole: bool, parts: int) -> DataFrame:
    """Changes of pair counts along the steps, after the pending merges; with ``whole`` all pairs at step 0.

    A task sums its changes and sends each part one row.
    """

    def rows(held):
        listed = [(step, *summed(*(np.concatenate(x) for x in zip(*found, strict=True)))) for step, found in held.items()]
        if not listed:
            return
        keys = np.concatenate([k for _, k, _ in listed])
        counts = np.concatenate([n for _, _, n in listed])
        at = np.concatenate([np.full(len(k), step, np.int32) for step, k, _ in listed])
        part = part_of(keys, parts)
        for number in np.unique(part).tolist():
            own = part == number
            yield _row(number, CHANGED, keys[own], counts[own], at[own])

    def run(batches):
        held, size = {}, 0
        for block in _blocks(batches):
            live = LiveBlock(block, pending + steps)
            for merge in pending:
                live.merge(*merge)
            found = [(0, live.block().all_pairs())] if whole else []
            found += [(k, live.merge(*merge, told=True)) for k, merge in enumerate(steps, 1)]
            for step, change in found:
                held.setdefault(step, []).append(change)
                size += len(change[0])
            if size >= HELD_CHANGES:
                held = {step: [summed(*(np.concatenate(x) for x in zip(*some, strict=True)))] for step, some in held.items()}
                size = sum(len(some[0][0]) for some in held.values())
                if size >= HELD_CHANGES // 2:
                    yield from rows(held)
                    held, size = {}, 0
        yield from rows(held)

    return state.mapInArrow(run, PACKED)


KEPT, CHANGED = 0, 1
PACKED = "part int, kind int, keys binary, counts binary, steps binary"
WON = (
    "part int, keys binary, counts binary, changed binary, changes binary, steps binary, best array<bigint>, "
    "guide array<bigint>, guide_counts array<bigint>"
)


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    mixed = (keys ^ (keys >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(40)) % np.uint64(parts)).astype(np.int64)


def _row(part: int, kind: int, keys: np.ndarray, counts: np.ndarray, steps: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch(
        {
            "part": pa.array([part], pa.int32()),
            "kind": pa.array([kind], pa.int32()),
            "keys": pa.array([keys.tobytes()]),
            "counts": pa.array([counts.tobytes()]),
            "steps": pa.array([steps.tobytes()]),
        }
    )


def best_pair(keys: np.ndarray, counts: np.ndarray, order: np.ndarray | None) -> list[int]:
    """(left, right, count) of the best pair, or (-1, -1, 0) without one.

    Among the most frequent pairs, those with the largest bytes of the left and then of the right part win,
    by the place of their ids in ``order``, then the largest ids; without an order the smallest ids do.
    """
    top = int(counts.max(initial=0))
    if top <= 0:
        return [-1, -1, 0]
    ties = keys[counts == top]
    left, right = (ties >> np.uint64(32)).astype(np.int64), (ties & np.uint64(0xFFFFFFFF)).astype(np.int64)
    if order is None:
        at = np.lexsort((right, left))[0]
    else:
        at = np.lexsort((right, left, order[right], order[left]))[-1]
    return [int(left[at]), int(right[at]), top]


def byte_order(vocab: dict[int, bytes]) -> np.ndarray:
    """Place of every id when tokens are sorted by their bytes; equal bytes have one place."""
    places = {b: k for k, b in enumerate(sorted(set(vocab.values())))}
    order = np.zeros(max(vocab) + 1, np.int64)
    for token_id, token in vocab.items():
        order[token_id] = places[token]
    return order


def kept_pairs(won: DataFrame, step: int) -> DataFrame:
    """The packed pair table after a step."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts = np.frombuffer(row["keys"], np.uint64), np.frombuffer(row["counts"], np.int64)
                changed, n = np.frombuffer(row["changed"], np.uint64), np.frombuffer(row["changes"], np.int64)
                done = np.frombuffer(row["steps"], np.int32) <= step
                keys, counts = summed(np.concatenate([keys, changed[done]]), np.concatenate([counts, n[done]]))
                yield _row(row["part"], KEPT, keys, counts, np.zeros(0, np.int32))

    return won.select("part", "keys", "counts", "changed", "changes", "steps").mapInArrow(run, PACKED)


def judged(packed: DataFrame, parts: int, first: int, steps: int, order: np.ndarray | None, guide: int) -> DataFrame:
    """Every part with its kept counts, its changes and its best pair after each of the steps from ``first`` on.

    ``guide_counts`` has the counts of some frequent pairs after each of these steps, for the next draft.
    """

    def settle(part: int, rows: list[dict]):
        column = lambda kind, name, dtype: np.concatenate(
            [np.frombuffer(r[name], dtype) for r in rows if r["kind"] == kind] or [np.zeros(0, dtype)]
        )
        keys, counts = column(KEPT, "keys", np.uint64), column(KEPT, "counts", np.int64)
        changed, n, at = (
            column(CHANGED, c, d) for c, d in (("keys", np.uint64), ("counts", np.int64), ("steps", np.int32))
        )
        every = np.unique(np.concatenate([keys, changed]))
        now = np.zeros(len(every), np.int64)
        now[np.searchsorted(every, keys)] = counts
        by_step = np.argsort(at, kind="stable")
        place = np.searchsorted(every, changed[by_step])
        borders = np.searchsorted(at[by_step], np.arange(steps + 2))
        best, seen = [], []
        final = now.copy()
        np.add.at(final, place, n[by_step])
        some = np.argsort(-np.maximum(now, final), kind="stable")[:guide]
        for step in range(steps + 1):
            cut = slice(borders[step], borders[step + 1])
            np.add.at(now, place[cut], n[by_step][cut])
            if step >= first:
                best += best_pair(every, now, order)
                seen.append(now[some])
        return pa.record_batch(
            {
                "part": pa.array([part], pa.int32()),
                **{
                    name: pa.array([values.tobytes()])
                    for name, values in (("keys", keys), ("counts", counts), ("changed", changed), ("changes", n), ("steps", at))
                },
                "best": pa.array([best], pa.list_(pa.int64())),
                "guide": pa.array([every[some].view(np.int64)], pa.list_(pa.int64())),
                "guide_counts": pa.array([np.concatenate(seen)], pa.list_(pa.int64())),
            }
        )

    def run(batches):
        rows: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if rows and rows[0]["part"] != row["part"]:
                    yield settle(rows[0]["part"], rows)
                    rows = []
                rows.append(row)
        if rows:
            yield settle(rows[0]["part"], rows)

    dealt = packed.repartitionById(parts, F.col("part")).sortWithinPartitions("part")
    return dealt.mapInArrow(run, WON)


# --- drafts -----------------------------------------------------------------------------------


def _fragments(sequences: DataFrame) -> Block:
    """A bounded sample of the heaviest sequences; of a long one a part stands for the whole."""
    # Few sequences leave room for longer parts of each.
    most = F.lit(max(SAMPLE_SEQUENCE_LENGTH, SAMPLE_ROWS * SAMPLE_SEQUENCE_LENGTH // max(sequences.count(), 1)))
    length = F.length("symbols")
    begin = F.lit(1) + F.pmod(F.xxhash64("symbols"), F.greatest(length - most + 1, F.lit(1))).cast("int")
    part = sequences.filter(length > 1).select(
        F.substring(F.col("symbols"), begin, most).alias("symbols"),
        F.ceil(F.col("n") * F.greatest(length, most) / most).cast("long").alias("n"),
    )
    # Classes of weights, as many of the heaviest as have room, and of the next one a share that stands for the whole.
    level = F.floor(F.log2(F.col("n").cast("double")) * 16)
    sizes = part.groupBy(level.alias("level")).agg(F.sum(F.length("symbols") + 1).alias("size")).orderBy(F.col("level").desc()).collect()
    # A table that has room is its own sample; of a larger one a part guesses as well, in less time.
    room, last, share = SAMPLE_ROWS * SAMPLE_SEQUENCE_LENGTH, -1, 1.0
    if sum(row["size"] for row in sizes) > room:
        room //= 4
    for row in sizes:
        last, share = row["level"], min(1.0, room / row["size"])
        room -= row["size"]
        if room <= 0:
            break
    drawn = F.pmod(F.xxhash64(F.lit("drawn"), "symbols"), F.lit(1 << 20)) < int(share * (1 << 20))
    some = part.filter((level > last) | ((level == last) & drawn))
    weight = F.when(level == last, F.ceil(F.col("n") / share)).otherwise(F.col("n")).cast("long")
    rows = some.select("symbols", weight.alias("n")).toArrow()
    return Block(packed_ids(rows.column("symbols").to_pylist()), rows.column("n").to_numpy())


def draft(
    sample: Block,
    known: dict[int, int],
    ahead: list[Merge],
    steps: int,
    vocab: dict[int, bytes],
    next_id: int,
    tie: str,
    most: float = np.inf,
) -> list[Merge]:
    """Guess the merges after those ``ahead`` from the sample; every one is checked against exact counts later.

    ``known`` holds exact counts of current pairs and corrects the sample for the part it does not see. No other
    current pair occurs more than ``most`` times.
    """
    if steps <= 0 or len(sample.ids) < 3:
        return []
    vocab, guess = dict(vocab), []
    keys, counts = summed(*sample.all_pairs())
    place = dict(zip(keys.tolist(), range(len(keys)), strict=True))
    exact = [(place[k], n) for k, n in known.items() if k in place]
    usual = sum(n for _, n in exact) / max(1, int(counts[[at for at, _ in exact]].sum())) if exact else 1.0
    scale = np.minimum(usual, most / counts)
    for at, n in exact:
        scale[at] = n / counts[at]
    likely = keys[np.argsort(-counts * scale)[: LIKELY_PAIRS * steps]].tolist()
    block = LiveBlock(sample, [*ahead, *((pair >> 32, pair & 0xFFFFFFFF, 0) for pair in likely)])
    for k, new in enumerate(range(next_id - len(ahead), next_id + steps)):
        if k < len(ahead):
            left, right, _ = ahead[k]
        else:
            estimate = counts * scale
            top = estimate.max(initial=0)
            if top <= 0:
                break
            ties = keys[estimate == top]
            order = byte_order(vocab) if tie == "bytes" and len(ties) > 1 else None
            if tie == "bytes" and order is None:
                order = np.zeros(max(vocab) + 1, np.int64)
            left, right, _ = best_pair(ties, np.ones(len(ties), np.int64), order)
            vocab[new] = vocab[left] + vocab[right]
            guess.append((left, right, new))
        pair = left << 32 | right
        grown = scale[place[pair]] if pair in place else usual
        changed, n = summed(*block.merge(left, right, new, told=True))
        at = np.array([place.setdefault(k, len(place)) for k in changed.tolist()], np.int64)
        fresh = at >= len(keys)
        keys = np.append(keys, changed[fresh])
        counts = np.append(counts, np.zeros(int(fresh.sum()), np.int64))
        # A pair that a merge makes is as much rarer in the sample as the merged pair was.
        scale = np.append(scale, np.full(int(fresh.sum()), grown))
        counts[at] += n
    return guess


# --- learning ---------------------------------------------------------------------------------


def learn_merges(
    sequences: DataFrame,
    n_merges: int,
    *,
    symbols: str = "symbols",
    weight: str = "n",
    tie: str = "bytes",
    min_frequency: int = 1,
    draft_steps: int = DRAFT_STEPS,
    known_pairs: int = KNOWN_PAIRS,
) -> list[Merge]:
    """Learn merges from a table of (symbols, weight).

    ``tie='bytes'``: among equally frequent pairs the lexicographically largest bytes win.
    ``tie='ids'``: the smallest ids win. Learning stops early when no pair is left or the best
    one occurs fewer than ``min_frequency`` times.
    """
    if tie not in ("bytes", "ids"):
        raise ValueError(f"unknown tie rule {tie!r}")
    rows = durable(sequences.select(F.col(symbols).alias("symbols"), F.col(weight).cast("long").alias("n")))
    if rows.isEmpty():
        raise ValueError("the training table has no text")
    vocab = {i: bytes([i]) for i in range(BASE_SIZE)}
    merges: list[Merge] = []
    cores = sequences.sparkSession.sparkContext.defaultParallelism
    size = rows.agg(F.sum(F.length("symbols"))).first()[0] or 0
    parts = min(work_partitions(sequences.sparkSession), max(cores, -(-size // TASK_SYMBOLS)))
    guided = -(-known_pairs // parts)
    state = durable(pack(rows, parts))
    sample = _fragments(rows)
    # ``pending`` merges are decided but not in the blocks, ``ahead`` ones not in the kept counts either.
    kept, pending, ahead = None, [], []
    known, most, rounds, reach = {}, np.inf, 0, draft_steps
    while len(merges) < n_merges:
        next_id, room = BASE_SIZE + len(merges), n_merges - len(merges)
        guess = ahead + draft(sample, known, ahead, min(reach, room - 1), vocab, next_id, tie, most)
        spell = {**vocab}
        for left, right, new in guess:
            spell[new] = spell[left] + spell[right]
        order = byte_order(spell) if tie == "bytes" else None
        packed = pair_changes(state, pending, guess, kept is None, parts)
        packed = packed if kept is None else packed.unionByName(kept)
        # Written out each round, so that the plan of a round does not grow with the rounds before it.
        # A checkpoint computes its rows twice, unless they are kept meanwhile.
        judgement = judged(packed, parts, len(ahead), len(guess), order, guided).persist()
        won = durable(judgement)
        judgement.unpersist()
        told = won.select("best", "guide", "guide_counts").collect()
        found = [np.array(r["best"], np.int64).reshape(-1, 3) for r in told]
        batch, over, step, first = [], False, len(ahead), len(ahead)
        for k in range(len(guess) - len(ahead) + 1):
            rows_ = np.array([f[k] for f in found])
            keys = (rows_[:, 0].astype(np.uint64) << np.uint64(32)) | (rows_[:, 1].astype(np.uint64) & np.uint64(0xFFFFFFFF))
            left, right, n = best_pair(keys, rows_[:, 2], order)
            if n < max(min_frequency, 1):
                over = True
                break
            batch.append((left, right, next_id + len(batch)))
            if len(batch) == room or step == len(guess) or batch[-1] != guess[step]:
                break
            step += 1
        merges.extend(batch)
        reach = max(draft_steps, min(2 * len(batch), LONGEST_DRAFT))
        if over or len(merges) >= n_merges:
            break
        for left, right, new in batch:
            vocab[new] = vocab[left] + vocab[right]
        for merge in guess[:step]:
            sample.merge(*merge)
        pending = pending + guess[:step]
        ahead = (ahead + batch)[step:]
        kept = kept_pairs(won, step)
        known, most = {}, 0
        for row in told:
            seen = np.array(row["guide_counts"], np.int64).reshape(-1, max(len(row["guide"]), 1))
            # A part tells the most frequent of its pairs, before or after the draft.
            if len(row["guide"]) == guided:
                most = max(most, int(np.maximum(seen[0], seen[-1]).min()))
            counts = seen[step - first]
            known.update((k, n) for k, n in zip(row["guide"], counts.tolist(), strict=False) if n > 0)
        rounds += 1
        if rounds % REFRESH_ROUNDS == 0:
            state, pending = durable(merged_blocks(state, pending)), []
    return merges
