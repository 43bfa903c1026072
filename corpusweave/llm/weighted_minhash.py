"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

1. Shingles of five words weigh term frequency times inverse document frequency, ``1 + ln(N / df)``.
   Exact copies are one text for the frequencies. Every shingle is counted: slices of texts send
   their shingles to buckets of hashes, and a bucket answers each slice with those that more than
   one text has. Slices and buckets are bounded in size, and only hashes and counts travel.
2. A consistent weighted sample draws from each text the same shingle as from a similar one with a
   probability that equals their weighted Jaccard similarity. ``BANDS`` bands of ``ROWS`` samples
   make the buckets. A pair at 0.8 shares no bucket with a probability of 3 in 100,000.
3. The members of a bucket are screened by their whole samples, and linked members form candidate
   groups. A group is verified by the weighted Jaccard similarity of whole texts. Buckets and groups
   beyond one block are dealt in pairs of blocks, so no task holds one whole, no pair is left out,
   and a task gives back at most one link for each of its members.
4. Verified links join texts into classes.
"""

from __future__ import annotations

import math
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusweave.llm.batches import slices, write_and_read

SHINGLE_WORDS = 5
THRESHOLD = 0.8
# Bound of N / df in the weights: none, so every shingle has an inverse frequency of its own.
SATURATION = math.inf
BANDS = 20
ROWS = 4
SAMPLES = BANDS * ROWS
# Samples of 80 that must agree for a pair to be verified; at 0.8, 50 or more agree but for 1 in 15,000.
SCREEN = 50
BLOCK = 512
GROUP_BLOCK = 512
# Bytes of text whose shingles are asked for together, and whose shingles a bucket of hashes is made for.
SLICE_TEXT = 4 << 20
BUCKET_TEXT = 8 << 20
# Answers of a row group of their table; a reader decodes thousands of rows at once.
ANSWER_ROWS = 1024
SKETCH = 1 << 16
# Weights that get tables of their own in one call, and the least number of shingles for one.
LEVELS = 4
LEVEL_SHINGLES = 1024
SEED = 11
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

U = np.uint64
ODD = U(0x9E3779B97F4A7C15)
MIX = U(0xD6E8FEB86659FD93)
SHINGLE_STEP = U(0xA24BAED4963EE407)


def _inverse(odd: int) -> int:
    """Inverse of an odd number modulo 2**64."""
    return pow(odd, -1, 1 << 64)


class Powers:
    """Powers of a base and of its inverse, so that word hashes come from one running sum."""

    base = 0x5851F42D4C957F2D

    def __init__(self):
        self.up = self.down = np.ones(1, U)

    def reach(self, size: int) -> None:
        if len(self.up) >= size:
            return
        size = 1 << (size - 1).bit_length()
        up, down = np.full(size, U(self.base)), np.full(size, U(_inverse(self.base)))
        up[0] = down[0] = U(1)
        self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)


POWERS = Powers()
SPACE_BYTES = np.zeros(256, bool)
SPACE_BYTES[[9, 10, 11, 12, 13, 32]] = True


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of every shingle in order of the texts.

    A text of one to four words has one shingle of them all, a text without words none.
    """
    joined = b" ".join([*texts, b""])
    data = np.frombuffer(joined, np.uint8)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    borders = np.cumsum(sizes)
    space = SPACE_BYTES[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, U), np.zeros(0, np.int64)
    POWERS.reach(len(data) + 1)
    total = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(1)) * POWERS.up[: len(data)], out=total[1:])
    words = (total[ends] - total[starts]) * POWERS.down[starts]
    words = (words ^ words >> U(29)) * MIX
    words ^= words >> U(32)
    owner = np.searchsorted(borders, starts, side="right")
    count = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(count) - count
    # Windows of five words that stay in one text.
    keys, at = [], []
    n = len(words) - SHINGLE_WORDS + 1
    if n > 0:
        key = np.zeros(n, U)
        for k in range(SHINGLE_WORDS):
            key = key * SHINGLE_STEP + words[k : k + n]
        inside = owner[:n] == owner[SHINGLE_WORDS - 1 :]
        keys.append(key[inside])
        at.append(owner[:n][inside])
    for d in np.flatnonzero((count > 0) & (count < SHINGLE_WORDS)):
        key = U(count[d])
        with np.errstate(over="ignore"):
            for w in words[first[d] : first[d] + count[d]]:
                key = key * SHINGLE_STEP + w
        keys.append(np.array([key]))
        at.append(np.array([d]))
    key, at = np.concatenate(keys), np.concatenate(at)
    key = (key ^ key >> U(31)) * ODD
    key ^= key >> U(30)
    order = np.argsort(at, kind="stable")
    return key[order], at[order]


def counted(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text index, times), every shingle of a text once, by text and hash."""
    key, at = shingles(texts)
    order = np.lexsort((key, at))
    key, at = key[order], at[order]
    if not len(key):
        return key, at, np.zeros(0, np.int64)
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (at[1:] != at[:-1])])
    places = np.flatnonzero(new)
    return key[places], at[places], np.diff(np.append(places, len(key)))


class Weights:
    """Term frequency times inverse document frequency; shingles that are not told are in one text."""

    def __init__(self, n_texts: int, shared: dict[int, int]):
        self.n_texts = max(n_texts, 1)
        self.rare = 1 + math.log(min(self.n_texts, SATURATION))
        self.tell(np.array(list(shared), U), np.array(list(shared.values()), np.int64))

    def tell(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Take the numbers of texts of the shared shingles; a key may come twice with the same number."""
        self.keys, first = np.unique(keys, return_index=True)
        self.counts = counts[first]

    def frequencies(self, key: np.ndarray) -> np.ndarray:
        found = np.ones(len(key), np.int64)
        if len(self.keys):
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = self.keys[place] == key
            found[known] = self.counts[place[known]]
        return found

    def weigh(self, frequency: np.ndarray, times: np.ndarray) -> np.ndarray:
        weight = np.full(len(frequency), self.rare)
        shared = frequency > 1
        weight[shared] = 1 + np.log(np.minimum(self.n_texts / frequency[shared], SATURATION))
        return weight * times

    def __call__(self, key: np.ndarray, times: np.ndarray) -> np.ndarray:
        return self.weigh(self.frequencies(key), times)


class Sampler:
    """Improved consistent weighted sampling.

    For a shingle of weight S and each sample, r and c are Gamma(2, 1) and b is uniform, drawn from
    the shingle's hash; t = floor(ln S / r + b), and the shingle with the least
    ln c - r (t - b + 1) is the sample, together with its t. The draws come from tables of 65,536
    values, c through 16 bits of the hash and the pair (r, b) through 16 others. For the weights that
    many shingles of a call have, t and r (t - b + 1) come from tables too.
    """

    def __init__(self, rare: float):
        rng = np.random.default_rng(SEED)
        self.odd = rng.integers(1 << 63, size=SAMPLES, dtype=np.uint64) * U(2) + U(1)
        self.log_c = np.log(rng.gamma(2.0, 1.0, SKETCH)).astype(np.float32)
        self.r = rng.gamma(2.0, 1.0, SKETCH).astype(np.float32)
        self.b = rng.uniform(size=SKETCH).astype(np.float32)
        self.known: dict[float, np.ndarray] = {}
        self.table(rare)

    def level(self, log_weight: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The mark of t in 32 bits and r (t - b + 1)."""
        r, b = self.r[at], self.b[at]
        t = np.floor(log_weight / r + b)
        mark = t.astype(np.int64).view(U) * MIX
        return (mark ^ mark >> U(32)).astype(np.uint32), r * (t - b + np.float32(1))

    def table(self, weight: float) -> np.ndarray:
        """Of every draw the two numbers of ``level`` in one: the bits of the second, then the mark."""
        if weight not in self.known:
            if len(self.known) >= 2 * LEVELS:
                self.known.clear()
            log_weight = np.log(np.full(SKETCH, weight)).astype(np.float32)
            mark, part = self.level(log_weight, np.arange(SKETCH))
            self.known[weight] = part.view(np.uint32).astype(U) << U(32) | mark
        return self.known[weight]

    def __call__(self, key: np.ndarray, at: np.ndarray, weight: np.ndarray, n_texts: int) -> np.ndarray:
        """One row of 32-bit fingerprints of (shingle, t) per text; the row of an empty text is zero."""
        out = np.zeros((n_texts, SAMPLES), np.uint32)
        if not len(key):
            return out
        starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        levels, level, n = np.unique(weight, return_inverse=True, return_counts=True)
        often = np.argsort(-n, kind="stable")[:LEVELS]
        often = often[(n[often] >= LEVEL_SHINGLES) | (np.arange(len(often)) == 0)]
        tables = np.concatenate([self.table(float(levels[k])) for k in often])
        place = np.full(len(levels), -1)
        place[often] = np.arange(len(often)) * SKETCH
        base = place[level]
        other = np.flatnonzero(base < 0)
        base[other] = 0
        log_other = np.log(weight[other]).astype(np.float32)
        low = U(0xFFFFFFFF)
        x, high = np.empty_like(key), np.empty_like(key)
        for j in range(SAMPLES):
            np.multiply(key, self.odd[j], out=x)
            np.right_shift(x, U(29), out=high)
            x ^= high
            x *= MIX
            np.right_shift(x, U(32), out=high)
            # The fingerprint is the halves of the hash, exclusive or, with the mark of t.
            x ^= high
            x &= low
            log_c = self.log_c.take((high >> U(16)).view(np.int64))
            high &= U(0xFFFF)
            r_at = high.view(np.int64)
            pair = tables.take(base + r_at)
            value = log_c - (pair >> U(32)).astype(np.uint32).view(np.float32)
            pair &= low
            if len(other):
                pair[other], part = self.level(log_other, r_at[other])
                value[other] = log_c[other] - part
            x ^= pair
            # The order of positive floats is that of their bits; values lie well above -200.
            value += np.float32(200)
            packed = value.view(np.uint32).astype(U)
            packed <<= U(32)
            packed |= x
            out[at[starts], j] = np.minimum.reduceat(packed, starts).astype(np.uint32)
        return out


def _texts(part: pa.RecordBatch, column: str) -> list[bytes]:
    return [t or b"" for t in part.column(column).cast(pa.binary()).to_pylist()]


def text_digest(text) -> object:
    return F.unhex(F.md5(text.cast("binary")))


def _readable(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, text, node) of the documents that have a key and at least one word.

    The node of a text is the digest of it, so exact copies are one node from the start.
    """
    return (
        docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
        .filter(F.col("doc_id").isNotNull() & F.col("text").rlike(r"[^\x20\x09-\x0D]"))
        .withColumn("node", text_digest(F.col("text")))
    )


def in_slices(rows: DataFrame) -> DataFrame:
    """(slice, node, text): every distinct text once, in runs of about SLICE_TEXT bytes named by a node of theirs."""

    def run(batches):
        name, held = None, 0
        for batch in batches:
            for part in slices(batch, "text"):
                size = pc.sum(pc.binary_length(part.column("text"))).as_py()
                if name is None or held + size > SLICE_TEXT:
                    name, held = part.column("node")[0], 0
                held += size
                names = pa.array([name.as_py()] * part.num_rows, pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [names, part.column("node"), part.column("text")], names=["slice", "node", "text"]
                )

    # Copies of a text meet in the aggregate.
    texts = rows.groupBy("node").agg(F.first("text").alias("text"))
    return texts.mapInArrow(run, "slice binary, node binary, text string")


def requests(texts: DataFrame, n_buckets: int) -> DataFrame:
    """(bucket, slice, shingles, counts): the shingles of a slice by range of hash, with their texts in it."""

    def run(batches):
        for batch in batches:
            names = batch.column("slice").to_pylist()
            starts = [k for k in range(len(names)) if k == 0 or names[k] != names[k - 1]]
            for start, stop in zip(starts, [*starts[1:], len(names)], strict=True):
                parts = slices(batch.slice(start, stop - start), "text")
                key, counts = np.unique(
                    np.concatenate([counted(_texts(part, "text"))[0] for part in parts]), return_counts=True
                )
                # Hashes ascend, and so do their buckets.
                bucket = ((key >> U(32)) * U(n_buckets) >> U(32)).astype(np.int64)
                full, first = np.unique(bucket, return_index=True)
                ends = pa.array(np.append(first, len(key)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(full),
                        pa.array([names[start]] * len(full), pa.binary()),
                        pa.ListArray.from_arrays(ends, pa.array(key.view(np.int64))),
                        pa.ListArray.from_arrays(ends, pa.array(counts.astype(np.int32))),
                    ],
                    names=["bucket", "slice", "shingles", "counts"],
                )

    return texts.select("slice", "text").mapInArrow(
        run, "bucket long, slice binary, shingles array<long>, counts array<int>"
    )


def shared_shingles(asked: DataFrame) -> DataFrame:
    """(slice, shingles, counts): of the shingles of a slice those of more than one text, with all their texts."""

    def answer(bucket: pa.Table) -> pa.Table:
        asked = bucket.combine_chunks()
        key = _flat(asked.column("shingles")).view(U)
        counts = _flat(asked.column("counts")).astype(np.int64)
        ends = np.append(0, np.cumsum(pc.list_value_length(asked.column("shingles")).to_numpy()))
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
        total = np.empty(len(key), np.int64)
        total[order] = np.repeat(np.add.reduceat(counts[order], first), np.diff(np.append(first, len(key))))
        shared = total > 1
        left = pa.array(np.append(0, np.cumsum(shared))[ends].astype(np.int32))
        found = [
            pa.ListArray.from_arrays(left, pa.array(key[shared].view(np.int64))),
            pa.ListArray.from_arrays(left, pa.array(total[shared])),
        ]
        told = pa.table([asked.column("slice"), *found], names=["slice", "shingles", "counts"])
        return told.filter(pc.greater(pc.list_value_length(told.column("shingles")), 0))

    return asked.groupBy("bucket").applyInArrow(answer, "slice binary, shingles array<long>, counts array<long>")


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    parts = [chunk.flatten().to_numpy(zero_copy_only=False) for chunk in column.chunks]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def signatures(texts: DataFrame, shared: DataFrame, n_texts: int) -> DataFrame:
    """(node, samples, frequencies) of every text: its weighted samples as 32-bit numbers, and the number of
    texts of each of its shingles in the order of ``counted``."""

    def work(own: pa.Table, told: pa.Table) -> pa.Table:
        weights = Weights(n_texts, {})
        weights.tell(_flat(told.column("shingles")).astype(np.int64).view(U), _flat(told.column("counts")))
        sampler = Sampler(weights.rare)
        made = []
        for batch in own.to_batches():
            for part in slices(batch, "text"):
                key, at, times = counted(_texts(part, "text"))
                frequency = weights.frequencies(key)
                samples = sampler(key, at, weights.weigh(frequency, times), part.num_rows)
                ends = np.searchsorted(at, np.arange(part.num_rows + 1)).astype(np.int32)
                made.append(
                    pa.RecordBatch.from_arrays(
                        [
                            part.column("node"),
                            pa.array([row.tobytes() for row in samples], pa.binary()),
                            pa.ListArray.from_arrays(pa.array(ends), pa.array(frequency)),
                        ],
                        names=["node", "samples", "frequencies"],
                    )
                )
        schema = pa.schema(
            [("node", pa.binary()), ("samples", pa.binary()), ("frequencies", pa.list_(pa.int64()))]
        )
        return pa.Table.from_batches(made, schema)

    both = texts.groupBy("slice").cogroup(shared.groupBy("slice"))
    return both.applyInArrow(work, "node binary, samples binary, frequencies array<long>")


def band_keys(nodes: DataFrame) -> DataFrame:
    """(bucket, node): one row per node and band."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            made = np.frombuffer(b"".join(batch.column("samples").to_pylist()), np.uint32)
            made = made.reshape(-1, BANDS, ROWS).astype(U)
            key = np.arange(1, BANDS + 1, dtype=U)[None, :] * ODD + np.zeros((len(made), 1), U)
            for k in range(ROWS):
                key = (key ^ made[:, :, k]) * MIX
                key ^= key >> U(31)
            node = batch.column("node").take(pa.array(np.repeat(np.arange(len(made)), BANDS)))
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), node], names=["bucket", "node"])

    return nodes.select("node", "samples").mapInArrow(run, "bucket long, node binary")


def in_blocks(members: DataFrame, group: str, size: str, block: int) -> DataFrame:
    """Deal the members of each group to cells, so that every pair of members meets in one.

    A group of up to ``block`` members is one cell. A larger one is cut into blocks by a hash of the
    node, and each pair of blocks is a cell, so a member goes to as many cells as there are blocks.
    """
    blocks = F.ceil(F.col(size) / block).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    dealt = members.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return dealt.select(
        "*", F.least("_own", "_other").alias("_low"), F.greatest("_own", "_other").alias("_high")
    ).drop("_other")


def cells(df: DataFrame, keys: list[str], schema: str, work) -> DataFrame:
    """Run ``work`` on the rows of each cell; cells are of bounded size and many to a task."""
    spread = df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
    ordered = spread.sortWithinPartitions(*keys, "node")

    def run(batches):
        kept: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [np.array(batch.column(k).to_pylist(), object) for k in keys]
            change = np.zeros(batch.num_rows, bool)
            for c in columns:
                change[1:] |= c[1:] != c[:-1]
            starts = [0, *np.flatnonzero(change)]
            for start, stop in zip(starts, [*starts[1:], batch.num_rows], strict=True):
                name = tuple(c[start] for c in columns)
                if last is not None and name != last:
                    yield work(pa.Table.from_batches(kept))
                    kept = []
                last = name
                kept.append(batch.slice(start, stop - start))
        if kept:
            yield work(pa.Table.from_batches(kept))

    return ordered.mapInArrow(run, schema)


class Labels:
    """Components of the members of a cell, one label for each position."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def join(self, a: int, b: int) -> bool:
        """Whether the link was needed."""
        if self.of[a] == self.of[b]:
            return False
        self.of[self.of == self.of[b]] = self.of[a]
        return True


EDGE = "a binary, b binary"


def _edges(nodes: list[bytes], pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([nodes[i] for i, _ in pairs], pa.binary()), pa.array([nodes[j] for _, j in pairs], pa.binary())],
        names=["a", "b"],
    )


def screen(cell: pa.Table) -> pa.RecordBatch:
    """Links of a bucket's cell: members of which enough samples agree, as a forest."""
    nodes = cell.column("node").to_pylist()
    made = np.frombuffer(b"".join(cell.column("samples").to_pylist()), np.uint32).reshape(-1, SAMPLES)
    own = np.array(cell.column("_own").to_pylist())
    low, high = cell.column("_low")[0].as_py(), cell.column("_high")[0].as_py()
    labels, pairs = Labels(len(nodes)), []
    left = np.flatnonzero(own == low) if low != high else np.arange(len(nodes))
    right = np.flatnonzero(own == high)
    for i in left:
        others = right if low != high else right[right > i]
        # Members that a chain of links joins already need no link of their own.
        others = others[labels.of[others] != labels.of[i]]
        agree = (made[others] == made[i]).sum(1) >= SCREEN
        pairs += [(int(i), int(j)) for j in others[agree] if labels.join(i, j)]
    return _edges(nodes, pairs)


def verifier(weights: Weights, threshold: float):
    """Links of a group's cell: pairs whose weighted Jaccard similarity reaches the threshold."""

    def verify(cell: pa.Table) -> pa.RecordBatch:
        nodes = cell.column("node").to_pylist()
        own = np.array(cell.column("_own").to_pylist())
        low, high = cell.column("_low")[0].as_py(), cell.column("_high")[0].as_py()
        key, at, times = counted([t or b"" for t in cell.column("text").cast(pa.binary()).to_pylist()])
        weight = weights.weigh(_flat(cell.column("frequencies")), times)
        total = np.bincount(at, weights=weight, minlength=len(nodes))
        _, key = np.unique(key, return_inverse=True)
        first = np.searchsorted(at, np.arange(len(nodes) + 1))
        # Postings: for each shingle the texts that have it.
        order = np.argsort(key, kind="stable")
        post_at, post_weight = at[order], weight[order]
        post_first = np.searchsorted(key[order], np.arange(key.max() + 2 if len(key) else 1))
        labels, pairs = Labels(len(nodes)), []
        for i in np.flatnonzero(own == low) if low != high else range(len(nodes)):
            open_to = labels.of != labels.of[i]
            open_to &= (own == high) if low != high else (np.arange(len(nodes)) > i)
            if not open_to.any():
                continue
            mine = slice(first[i], first[i + 1])
            starts, ends = post_first[key[mine]], post_first[key[mine] + 1]
            n = ends - starts
            places = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts, n)
            shared = np.minimum(post_weight[places], np.repeat(weight[mine], n))
            common = np.bincount(post_at[places], weights=shared, minlength=len(nodes))
            union = total + total[i] - common
            close = open_to & (union > 0) & (common >= threshold * union - 1e-9)
            pairs += [(int(i), int(j)) for j in np.flatnonzero(close) if labels.join(i, j)]
        return _edges(nodes, pairs)

    return verify


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root): the least node of every connected component, for all nodes with an edge.

    Alternates two steps that keep the components and make their trees flatter: every larger
    neighbour of a node is tied to the node's least neighbour, then every node and its smaller
    neighbours are. Both are an aggregate and a join on the node; it ends when a round changes
    nothing. Each round is written to the shared folder.
    """
    ends = F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")
    now = write_and_read(edges.filter("a <> b").select(*ends).distinct(), name)
    mark = None if now.limit(1).count() else (0, None)
    while mark != (0, None):
        both = now.select("a", "b").unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        below = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(below, "a").select("a", "b", "m")
        ties = small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = write_and_read(ties.unionAll(below.select("a", F.col("m").alias("b"))).distinct(), name)
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Let Spark drop the shuffle files of every write inside when it ends; each result is read from its table."""
    before = spark.conf.get(DROP_SHUFFLES)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Classes of near-duplicates, see ``_classes``; the texts are shuffled three times, one after another."""
    with shuffles_dropped(docs.sparkSession):
        return _classes(docs, key, text, threshold)


def _classes(docs: DataFrame, key: str, text: str, threshold: float) -> DataFrame:
    """(node, n_docs, copy_id, class_id, class_texts, class_docs): one row per distinct text with a word.

    ``copy_id`` is the least key among exact copies of the text, ``class_id`` the least key of its
    class of near-duplicates. Documents without key, text or words take no part. A key that repeats
    with different texts stands in each text's row.
    """
    rows = _readable(docs, key, text)
    texts = write_and_read(in_slices(rows), "minhash-texts")
    sizes = texts.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    n_texts, n_bytes = sizes[0], sizes[1] or 0
    cores = docs.sparkSession.sparkContext.defaultParallelism
    # The answers are a table, so the shuffled requests are gone before the texts move to their answers.
    shared = shared_shingles(requests(texts, max(cores, math.ceil(n_bytes / BUCKET_TEXT))))
    shared = write_and_read(shared, "minhash-shared", rows=ANSWER_ROWS)
    nodes = write_and_read(signatures(texts, shared, n_texts), "minhash-nodes")
    copies = rows.groupBy("node", "doc_id").agg(F.count(F.lit(1)).alias("n_rows"))
    copies = copies.groupBy("node").agg(
        F.min("doc_id").alias("copy_id"),
        F.min_by("n_rows", "doc_id").alias("copy_rows"),
        F.sum("n_rows").alias("n_docs"),
    )
    copies = write_and_read(copies, "minhash-copies")
    buckets = write_and_read(band_keys(nodes), "minhash-buckets")
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    dealt = in_blocks(buckets.join(sizes, "bucket"), "bucket", "n", BLOCK)
    dealt = dealt.join(nodes.select("node", "samples"), "node")
    screened = cells(dealt, ["bucket", "_low", "_high"], EDGE, screen)
    groups = write_and_read(components(screened, "minhash-groups"), "minhash-group")
    sizes = groups.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    dealt = in_blocks(groups.join(sizes, "root"), "root", "n", GROUP_BLOCK)
    chosen = dealt.join(nodes.select("node", "frequencies"), "node").join(texts.select("node", "text"), "node")
    links = cells(
        chosen.select("root", "_low", "_high", "_own", "node", "text", "frequencies"),
        ["root", "_low", "_high"],
        EDGE,
        verifier(Weights(n_texts, {}), threshold),
    )
    joined = components(links, "minhash-links")
    named = copies.join(joined, "node", "left").withColumn("root", F.coalesce("root", "node"))
    per_class = named.groupBy("root").agg(
        F.min("copy_id").alias("class_id"),
        F.min_by("node", F.struct("copy_id", "node")).alias("class_node"),
        F.count(F.lit(1)).alias("class_texts"),
        F.sum("n_docs").alias("class_docs"),
    )
    return write_and_read(named.join(per_class, "root").drop("root"), "minhash-classes")


def assign(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, copy_id, class_id, class_texts, class_docs), one row per row of ``docs``.

    ``class_texts`` and ``class_docs`` count the distinct texts and the rows of the class. A row that
    takes no part is a class of its own, with itself as the only text and row.
    """
    found = classes(docs, key, text, threshold)
    own = docs.select(F.col(f"`{key}`").alias("doc_id"), text_digest(F.col(f"`{text}`").cast("string")).alias("node"))
    # Texts without a word have a digest, but no class.
    one = F.lit(1).cast("long")
    return own.join(found, "node", "left").select(
        "doc_id",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("copy_id", "doc_id")).alias("copy_id"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class_texts", one)).otherwise(one).alias("class_texts"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class_docs", one)).otherwise(one).alias("class_docs"),
    )


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class, with all its columns; rows that take no part stay.

    The document with the least key stays; of rows that repeat it, one.
    """
    columns = [f"c{k}" for k in range(len(docs.columns))]
    plain = docs.toDF(*columns)
    key, text = (columns[docs.columns.index(c)] for c in (key, text))
    found = classes(plain, key, text, threshold)
    best = found.filter(F.col("node") == F.col("class_node")).select("node", "copy_id", "copy_rows")
    in_part = F.col(key).isNotNull() & F.coalesce(F.col(text).cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    marked = plain.withColumn("own_node", text_digest(F.col(text).cast("string")))
    same = (F.col("own_node") == F.col("node")) & (F.col(key) == F.col("copy_id"))
    kept = marked.filter(in_part).join(best, same)
    single = kept.filter("copy_rows = 1").select(*columns)
    repeated = kept.filter("copy_rows > 1").dropDuplicates(["own_node"]).select(*columns)
    return plain.filter(~in_part).unionAll(single).unionAll(repeated).toDF(*docs.columns)
