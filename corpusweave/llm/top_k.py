"""Exact top-k by inner product with block-at-a-time pruning.

Documents are packed in blocks with a forward index, the whole-number components of their vectors,
and with the maximum of every term in the block. A component may be negative, so each dimension is
two terms, the component and its negative, of which a query weighs one. The sum over a query's terms
of weight times block maximum bounds every score in the block. A query scores blocks in the order of
their bounds until the next bound falls below its k-th best score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusweave.llm.batches import write_and_read
from corpusweave.session import work_partitions

SCALE = 256
BLOCK = 64
# Vectors that are ordered by likeness before they are cut into blocks, and that a task scores at once.
SHARD = 4096
QUERY_SHARD = 256
# Query packs that a task holds while shards pass by, and shards that may pass one such group in one task.
PACKS = 16
SHARDS = 16
K = 5
# The id of a place that no vector takes.
NONE = np.iinfo(np.int64).max


def quantised(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, vector): floor(scale * component) of every vector that is whole.

    Null keys, null vectors and vectors with null, NaN or infinite components are left out. Vectors of
    different widths are compared as if zeros filled the shorter one.
    """
    x = F.col("vector")
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (
        vectors.select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
        .filter(F.col("vec_id").isNotNull() & x.isNotNull())
        .filter(whole)
        .withColumn("vector", F.transform(x, lambda v: F.floor(v * scale).cast("long")))
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column, filled with zeros to the widest."""
    sizes = np.diff(column.offsets.to_numpy())
    width = int(sizes.max()) if len(sizes) else 0
    out = np.zeros((len(sizes), width), np.int64)
    flat = column.flatten().to_numpy()
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _chunks(batches, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) of up to ``size`` rows, across batch borders."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, size - count)
            held.append(part)
            count, at = count + part.num_rows, at + part.num_rows
            if count == size:
                yield _joined(held)
                held, count = [], 0
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    table = pa.Table.from_batches(held).combine_chunks()
    return table.column("vec_id").to_numpy(), _matrix(table.column("vector").combine_chunks())


def likeness_order(matrix: np.ndarray) -> np.ndarray:
    """An order in which vectors of one block are alike: by signs, the most spread dimension first."""
    if not matrix.size:
        return np.arange(len(matrix))
    first = np.argsort(-matrix.astype(float).var(0), kind="stable")[:16]
    signs = matrix[:, first] > np.median(matrix[:, first], axis=0)
    return np.lexsort(signs.T[::-1])


PACKED = "shard string, n int, width int, ids binary, forward binary"


def pack(vectors: DataFrame, size: int, order: bool) -> DataFrame:
    """Rows of up to ``size`` vectors as they come from the scan; nothing is moved."""

    def run(batches):
        for ids, matrix in _chunks(batches, size):
            if order:
                at = likeness_order(matrix)
                ids, matrix = ids[at], matrix[at]
            name = f"{ids.min()}-{ids.max()}-{len(ids)}"
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name]),
                    pa.array([len(ids)], pa.int32()),
                    pa.array([matrix.shape[1]], pa.int32()),
                    pa.array([ids.astype("<i8").tobytes()]),
                    pa.array([_narrow(matrix).tobytes()]),
                ],
                names=["shard", "n", "width", "ids", "forward"],
            )

    return vectors.mapInArrow(run, PACKED)


def _narrow(matrix: np.ndarray) -> np.ndarray:
    """The same whole numbers in as few bytes as hold them all."""
    low, high = matrix.min(initial=0), matrix.max(initial=0)
    return matrix.astype(next(k for k in ("<i2", "<i4", "<i8") if np.iinfo(k).min <= low and high <= np.iinfo(k).max))


def _unpacked(ids: bytes, forward: bytes, n: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    kind = f"<i{len(forward) // (n * width)}" if width else "<i8"
    return np.frombuffer(ids, "<i8"), np.frombuffer(forward, kind).reshape(n, width).astype(np.int64)


def search(
    query_ids: np.ndarray,
    queries: np.ndarray,
    ids: np.ndarray,
    vectors: np.ndarray,
    k: int,
    block: int = BLOCK,
    before: tuple[np.ndarray, np.ndarray] | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query row, vec_id, score) of the k best of a shard for each query, and the blocks scored.

    Ties go to the smaller id. A query never finds a row with its own id. All queries go on together,
    each in its own order of blocks, so a round is one stacked product. ``before`` has the k best
    (vec_ids, scores) of other shards for each query, places without one as ``NONE``; they stay among
    the k best, and their last is the first threshold.
    """
    width = max(queries.shape[1], vectors.shape[1])
    queries = np.pad(queries, ((0, 0), (0, width - queries.shape[1])))
    vectors = np.pad(vectors, ((0, 0), (0, width - vectors.shape[1])))
    bound = max(int(np.abs(queries).max(initial=0)), 1) * max(int(np.abs(vectors).max(initial=0)), 1) * max(width, 1)
    # Doubles add whole numbers exactly up to 2**53; beyond that Python's own integers do.
    kind = float if bound < 1 << 53 else object
    queries, vectors = queries.astype(kind), vectors.astype(kind)
    n_blocks = math.ceil(len(ids) / block)
    starts = np.arange(n_blocks) * block
    term_max = np.maximum.reduceat(vectors, starts)
    term_min = np.minimum.reduceat(vectors, starts)
    positive = np.where(queries > 0, queries, 0)
    bounds = positive @ term_max.T + (queries - positive) @ term_min.T
    order = np.argsort(-bounds, axis=1, kind="stable")

    blocks = [slice(s, min(s + block, len(ids))) for s in starts]
    least = -(bound + 1)
    best = np.full((len(queries), k), least, kind)
    best_ids = np.full((len(queries), k), NONE)
    if before is not None:
        best_ids = before[0].copy()
        best = np.where(best_ids == NONE, best, before[1].astype(kind))
    live = np.arange(len(queries))
    scored = 0
    for step in range(n_blocks):
        at = order[live, step]
        live, at = live[(go := bounds[live, at] >= best[live, -1])], at[go]
        if not len(live):
            break
        for b in np.unique(at):
            rows = live[at == b]
            scored += len(rows)
            found = queries[rows] @ vectors[blocks[b]].T
            names = np.broadcast_to(ids[blocks[b]], found.shape)
            found = np.where(names == query_ids[rows, None], least, found)
            # Rows without a score that reaches their k-th best stay as they are.
            better = (found >= best[rows, -1:]).any(1)
            if not better.any():
                continue
            rows, found, names = rows[better], found[better], names[better]
            scores = np.concatenate([best[rows], found], axis=1)
            names = np.concatenate([best_ids[rows], names], axis=1)
            names = np.where(scores == least, NONE, names)
            if scores.shape[1] > 4 * k and kind is float:
                # Whatever ties with the k-th score stays in the sort.
                kth = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
                width_kept = int((scores >= kth[:, None]).sum(1).max())
                near = np.argpartition(-scores, min(width_kept, scores.shape[1] - 1), axis=1)[:, :width_kept]
                scores, names = np.take_along_axis(scores, near, 1), np.take_along_axis(names, near, 1)
            chosen = np.lexsort((names, -scores), axis=1)[:, :k]
            best[rows] = np.take_along_axis(scores, chosen, 1)
            best_ids[rows] = np.take_along_axis(names, chosen, 1)
    row, rank = np.nonzero(best_ids != NONE)
    return row, best_ids[row, rank], best[row, rank].astype(np.int64), scored


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of ``vectors`` for each of ``queries``.

    Both have (vec_id, vector) as ``quantised`` makes them. Groups of query packs and rows of shards make
    cells, and a pack meets each shard once, in the task of their cell: it holds the packs of one group while
    the shards pass by, each with the threshold of those before. A shard travels once for every group of
    ``PACKS`` packs, a pack once for every row of shards, and a cell gives back k rows a query. A repeated
    vec_id in ``vectors`` counts as often as it comes; repeated queries are one query, and of different
    vectors with one id the least is asked.
    """
    spark = vectors.sparkSession
    asked = queries.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    shards = write_and_read(pack(vectors, SHARD, True), "topk-shards")
    packs = write_and_read(pack(asked, QUERY_SHARD, False), "topk-queries")
    tasks = work_partitions(spark)
    groups = max(-(-packs.count() // PACKS), 1)
    rows = max(min(shards.count(), tasks), -(-shards.count() // SHARDS), 1)

    def dealt(packed: DataFrame, own: str, n_own: int, other: str, n_other: int, kind: int) -> DataFrame:
        everywhere = F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other)
        own_place = F.pmod(F.xxhash64("shard"), F.lit(n_own)).cast("int").alias(own)
        placed = packed.select("n", "width", "ids", "forward", own_place, F.lit(kind).alias("kind"))
        return placed.select("*", everywhere).select("group", "row", "kind", "n", "width", "ids", "forward")

    # Every cell's packs come before its shards.
    cells = dealt(packs, "group", groups, "row", rows, 0).unionByName(dealt(shards, "row", rows, "group", groups, 1))
    parts = min(groups * rows, max(tasks, rows))
    cells = cells.repartitionById(parts, F.expr(f"int((bigint(row) * {groups} + group) % {parts})"))
    cells = cells.sortWithinPartitions("group", "row", "kind")

    def run(batches):
        cell, held, state = None, [], []

        def settled():
            for (query_ids, _), (names, scores) in zip(held, state, strict=True):
                at, rank = np.nonzero(names != NONE)
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(query_ids[at]), pa.array(names[at, rank]), pa.array(scores[at, rank])],
                        names=["query_id", "vec_id", "score"],
                    )

        for batch in batches:
            for row in range(batch.num_rows):
                value = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
                if cell != (value["group"], value["row"]):
                    yield from settled()
                    cell, held, state = (value["group"], value["row"]), [], []
                ids, found = _unpacked(value["ids"], value["forward"], value["n"], value["width"])
                if value["kind"] == 0:
                    held.append((ids, found))
                    state.append((np.full((len(ids), k), NONE), np.zeros((len(ids), k), np.int64)))
                    continue
                for number, (query_ids, asked) in enumerate(held):
                    at, names, scores, _ = search(query_ids, asked, ids, found, k, before=state[number])
                    # Rows come in order, the best first.
                    place = np.arange(len(at)) - np.searchsorted(at, at)
                    best_names, best_scores = np.full((len(query_ids), k), NONE), np.zeros((len(query_ids), k), np.int64)
                    best_names[at, place], best_scores[at, place] = names, scores
                    state[number] = best_names, best_scores
        yield from settled()

    found = cells.mapInArrow(run, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
