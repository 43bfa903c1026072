"""Embedding vectors: lookup, positions, rotation, similarity and pooling."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusweave.functions import arrays as A

NORM_EPS = 1e-5
FREQUENCY_BASE = 10000.0
# Queries and keys that one task has at most, about, and rows dealt to balls at a time.
QUERY_BATCH = 4096
SHARD_KEYS = 1 << 15
BALL_ROWS = 1 << 13


def lookup(rows: DataFrame, ids: str, vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Attach the vector of an id; adaptive execution picks the join by the bytes of both sides."""
    return rows.join(vectors.select(F.col(key).alias(ids), vector), ids)


def context_features(
    rows: DataFrame, seq: str, pos: str, vector: str, k: int
) -> DataFrame:
    """One feature row per position: the vectors of the k positions up to it, concatenated.

    Every vector is sent to the k rows that need it and a group has at most k members, so long
    sequences spread over all tasks. Positions must be dense.
    """
    sent = rows.select(
        seq, F.col(vector).alias("_v"), F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda j: F.col(pos) + j)).alias("_back", pos)
    )
    groups = sent.groupBy(seq, pos).agg(
        F.count(F.lit(1)).alias("_n"),
        F.array_sort(F.collect_list(F.struct((-F.col("_back")).alias("_o"), "_v"))).alias("_g"),
        F.min("_back").alias("_own"),
    )
    # Rows past the end of a sequence lack their own vector, early rows lack predecessors.
    full = groups.filter((F.col("_n") == k) & (F.col("_own") == 0))
    return full.select(seq, pos, F.flatten(F.transform("_g", lambda g: g["_v"])).alias("features"))


def _angle(pos: Column, i: Column, width: int) -> Column:
    pair = (i - i % 2).cast("double")
    return pos * F.pow(F.lit(FREQUENCY_BASE), -pair / width)


def positional(pos: Column, width: int) -> Column:
    """Sinusoidal encoding: sine at even, cosine at odd dimensions of the same angle."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(width - 1)),
        lambda i: F.when(i % 2 == 0, F.sin(_angle(pos, i, width))).otherwise(F.cos(_angle(pos, i, width))),
    )


def add_positions(vector: Column, pos: Column, width: int, max_len: int) -> Column:
    checked = F.when(
        pos >= max_len, F.raise_error(F.lit(f"position is beyond the maximum length {max_len}"))
    ).otherwise(pos)
    return F.zip_with(A.doubles(vector), positional(checked, width), lambda a, b: a + b)


def rotate(vector: Column, pos: Column, width: int) -> Column:
    """Rotary encoding: each (even, odd) pair is turned by its angle, which keeps its norm."""
    if width % 2:
        raise ValueError("the width must be even")

    def turned(i):
        a = _angle(pos, i, width)
        here, other = F.get(vector, i), F.get(vector, F.when(i % 2 == 0, i + 1).otherwise(i - 1))
        return here * F.cos(a) + F.when(i % 2 == 0, -other).otherwise(other) * F.sin(a)

    return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), turned)


def layer_norm(
    rows: DataFrame, vector: str, gamma: list[float] | None = None, beta: list[float] | None = None,
    eps: float = NORM_EPS, name: str = "normed",
) -> DataFrame:
    """Zero mean and unit population variance per vector, then scale and shift."""
    out = A.standardize(A.doubles(vector), eps)
    for values, join in ((gamma, lambda a, b: a * b), (beta, lambda a, b: a + b)):
        if values is not None:
            constants = F.array(*[F.lit(float(g)) for g in values])
            checked = F.when(
                F.size(vector) != len(values), F.raise_error(F.lit(f"width must be {len(values)}"))
            ).otherwise(constants)
            out = F.zip_with(out, checked, join)
    return rows.withColumn(name, out)


def similarity(a: Column, b: Column, scaled: bool = False) -> Column:
    score = A.dot(a, b)
    return score / F.sqrt(F.size(a).cast("double")) if scaled else score


def _packed(table: pa.Table, ident: str, vector: str) -> tuple[np.ndarray, np.ndarray]:
    ids = table.column(ident).to_numpy()
    values = table.column(vector).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return ids, values.astype(np.float64).reshape(len(ids), -1)


def _balls(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order of rows, first row of each ball, centres, radii): rows dealt to about sqrt(n) centres.

    Centres are evenly chosen rows, moved once to the mean of their rows. Any dealing is right; a good
    one only makes radii small.
    """
    n = len(matrix)
    centres = matrix[np.linspace(0, n - 1, max(math.isqrt(n), 1)).astype(np.int64)]
    for _ in range(2):
        own = np.empty(n, np.int64)
        for lo in range(0, n, BALL_ROWS):
            part = matrix[lo : lo + BALL_ROWS]
            own[lo : lo + BALL_ROWS] = ((centres**2).sum(1) - 2 * part @ centres.T).argmin(1)
        order = np.argsort(own, kind="stable")
        used, heads = np.unique(own[order], return_index=True)
        sizes = np.diff(np.append(heads, n))
        centres = np.add.reduceat(matrix[order], heads) / sizes[:, None]
    away = np.sqrt(((matrix[order] - np.repeat(centres, sizes, axis=0)) ** 2).sum(1))
    # A little room, so that rounding never puts a key outside its ball.
    return order, np.append(heads, n), centres, np.maximum.reduceat(away, heads) * (1 + 1e-9) + 1e-12


def _search(ids: np.ndarray, matrix: np.ndarray, names: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int):
    """(query row, key, score, balls looked at) of the k best keys of every query, ties to the smaller key.

    A ball cannot hold a score above q * centre + |q| * radius. Balls are taken in the order of these
    bounds, and a query stops when the next one is below its k-th score, or below ``floors``.
    """
    order, heads, centres, radii = _balls(matrix)
    matrix, ids = matrix[order], ids[order]
    bounds = queries @ centres.T + np.sqrt((queries**2).sum(1))[:, None] * radii
    slack = 1e-9 * (1 + np.abs(bounds))
    ranked = np.argsort(-bounds, axis=1, kind="stable")
    out = []
    for q, query in enumerate(queries):
        best_s, best_i, least, looked = np.empty(0), np.empty(0, ids.dtype), floors[q], 0
        for ball in ranked[q]:
            if bounds[q, ball] + slack[q, ball] < least:
                break
            looked += 1
            lo, hi = heads[ball], heads[ball + 1]
            best_s = np.concatenate([best_s, matrix[lo:hi] @ query])
            best_i = np.concatenate([best_i, ids[lo:hi]])
            if len(best_s) > k:
                # All ties with the k-th score stay in the choice.
                cut = np.partition(best_s, len(best_s) - k)[len(best_s) - k]
                keep = best_s >= cut
                best_s, best_i = best_s[keep], best_i[keep]
            if len(best_s) >= k:
                least = max(least, best_s.min())
        top = np.lexsort((best_i, -best_s))[:k]
        out.append((np.full(len(top), q), best_i[top], best_s[top], looked))
    return out, len(radii)


def _searched(keys: DataFrame, queries: DataFrame, k: int, shards: int, groups: int) -> DataFrame:
    """The k best of every query in every shard, with the balls there were and those looked at.

    Keys are dealt to shards and queries to groups, both of bounded size; a task has one of each.
    """
    spread_to = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    dealt = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    left = keys.select("key", "vector", dealt("key", shards).alias("s"), spread_to(groups, "g"))
    right = queries.select("query", "vector", "floor", dealt("query", groups).alias("g"), spread_to(shards, "s"))

    def run(held: pa.Table, asked: pa.Table) -> pa.Table:
        columns: list[list] = [[], [], [], [], []]
        if held.num_rows and asked.num_rows:
            ids, matrix = _packed(held, "key", "vector")
            names, wanted = _packed(asked, "query", "vector")
            floors = asked.column("floor").fill_null(-np.inf).to_numpy()
            found, balls = _search(ids, matrix, names, wanted, floors, k)
            for q, (at, best, scores, looked) in enumerate(found):
                # The effort of a query stands on a row of its own, which holds no key.
                columns[0].append(np.append(names[at], names[q]))
                columns[1].append(pa.array([*best.tolist(), None], pa.int64()))
                columns[2].append(np.append(scores, np.nan))
                columns[3].append(np.append(np.zeros(len(at), np.int64), balls))
                columns[4].append(np.append(np.zeros(len(at), np.int64), looked))
        join = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
        return pa.table(
            {
                "query": pa.array(join(columns[0], np.int64), pa.int64()),
                "key": pa.chunked_array(columns[1], pa.int64()),
                "score": pa.array(join(columns[2], float), pa.float64()),
                "balls": pa.array(join(columns[3], np.int64), pa.int64()),
                "looked": pa.array(join(columns[4], np.int64), pa.int64()),
            }
        )

    schema = "query long, key long, score double, balls long, looked long"
    return left.groupBy("s", "g").cogroup(right.groupBy("s", "g")).applyInArrow(run, schema)


def _ready(rows: DataFrame, ident: str, vector: str, name: str) -> DataFrame:
    return rows.select(F.col(ident).cast("long").alias(name), A.doubles(vector).alias("vector")).dropna()


def _prepared(keys: DataFrame, queries: DataFrame, k: int, shard: int) -> tuple[DataFrame, DataFrame, int, int]:
    shards = max(-(-keys.count() // shard), 1)
    groups = max(-(-queries.count() // QUERY_BATCH), 1)
    queries = queries.withColumn("floor", F.lit(None).cast("double"))
    if shards > 1:
        # The k-th score among a part of the keys is a floor for the k-th among all.
        some = keys.filter(F.pmod(F.xxhash64("key", F.lit(1)), F.lit(shards)) == 0)
        first = _searched(some, queries, k, 1, groups).filter("key IS NOT NULL")
        floors = first.groupBy("query").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")).filter(F.col("n") == k)
        queries = queries.join(floors.select("query", "least"), "query", "left").select(
            "query", "vector", F.col("least").alias("floor")
        )
    return keys, queries, shards, groups


def best_matches(
    keys: DataFrame,
    queries: DataFrame,
    k: int,
    key_id: str = "vec_id",
    vector: str = "embedding",
    query_id: str = "query_id",
    query_vector: str = "query",
    shard: int = SHARD_KEYS,
) -> DataFrame:
    """The k keys with the largest dot product for every query: (query_id, key_id, score, place).

    Both sides stay tables: shards of keys meet groups of queries in tasks of bounded size. Inside a shard
    keys lie in balls, and a query skips the balls that cannot reach its k-th score (``match_effort`` tells
    how many). k rows per query and shard are shuffled. Ties go to the smaller key; rows with a null id or
    vector take no part.
    """
    keys, queries, shards, groups = _prepared(
        _ready(keys, key_id, vector, "key"), _ready(queries, query_id, query_vector, "query"), k, shard
    )
    found = _searched(keys, queries, k, shards, groups)
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "key")
    placed = found.filter("key IS NOT NULL").withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)
    return placed.select(F.col("query").alias(query_id), F.col("key").alias(key_id), "score", "place")


def match_effort(
    keys: DataFrame,
    queries: DataFrame,
    k: int,
    key_id: str = "vec_id",
    vector: str = "embedding",
    query_id: str = "query_id",
    query_vector: str = "query",
    shard: int = SHARD_KEYS,
) -> DataFrame:
    """(query_id, balls, skipped): balls of keys there are, and those the search of ``best_matches`` skips."""
    keys, queries, shards, groups = _prepared(
        _ready(keys, key_id, vector, "key"), _ready(queries, query_id, query_vector, "query"), k, shard
    )
    found = _searched(keys, queries, k, shards, groups).filter("key IS NULL")
    return found.groupBy(F.col("query").alias(query_id)).agg(
        F.sum("balls").alias("balls"), F.sum(F.col("balls") - F.col("looked")).alias("skipped")
    )


def vector_sums(rows: DataFrame, by: list[str], vector: str, weight: Column | None = None) -> DataFrame:
    """Weighted sum per group and dimension: (by, dim, total, weight); pre-aggregated per task."""
    w = F.lit(1.0) if weight is None else weight
    long = rows.select(*by, w.alias("_w"), F.posexplode(A.doubles(vector)).alias("dim", "_v"))
    return long.groupBy(*by, "dim").agg(
        F.sum(F.col("_v") * F.col("_w")).alias("total"), F.sum("_w").alias("weight")
    )


def group_means(rows: DataFrame, by: str, vector: str) -> DataFrame:
    """Mean vector per group as (by, mean ARRAY<DOUBLE>)."""
    sums = vector_sums(rows, [by], vector)
    return sums.groupBy(by).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("dim", (F.col("total") / F.col("weight")).alias("m")))),
            lambda s: s["m"],
        ).alias("mean")
    )


def soft_lookup(rows: DataFrame, by: str, score: str, vector: str) -> DataFrame:
    """Softmax-weighted mean vector per group: (by, dim, value).

    The group maximum and the weighted sums are both pre-aggregated; no group is collected.
    """
    tops = rows.groupBy(by).agg(F.max(score).alias("_top"))
    weighted = rows.join(tops, by).withColumn("_w", F.exp(F.col(score) - F.col("_top")))
    sums = vector_sums(weighted, [by], vector, F.col("_w"))
    return sums.select(by, "dim", (F.col("total") / F.col("weight")).alias("value"))


def causal_lookup(
    rows: DataFrame, seq: str, pos: str, vector: str, max_len: int, block: int = 4096
) -> DataFrame:
    """Every position attends to itself and the ``max_len - 1`` before it: (seq, pos, pooled).

    Scores are scaled dot products. Sequences are cut into position blocks with a halo of
    ``max_len - 1`` rows, so a long sequence runs in many tasks and a frame never exceeds
    ``max_len`` vectors. Positions must be dense.
    """
    at = F.col(pos).cast("long")
    own = F.floor(at / block).cast("long")
    later = F.floor((at + max_len - 1) / block).cast("long")
    # The row goes to its own block and, as halo, to the blocks it reaches into.
    placed = rows.select(
        seq, pos, A.doubles(vector).alias("_v"), own.alias("_own"), F.explode(F.sequence(own, later)).alias("_b")
    )
    frame = Window.partitionBy(seq, "_b").orderBy(pos).rowsBetween(-(max_len - 1), Window.currentRow)
    seen = placed.withColumn("_k", F.collect_list("_v").over(frame)).filter(F.col("_own") == F.col("_b"))
    scores = A.let(
        F.sqrt(F.size("_v").cast("double")),
        lambda root: F.transform("_k", lambda k: A.dot(F.col("_v"), k) / root),
    )
    pooled = A.let(A.softmax(scores), lambda w: A.weighted_sum(w, F.col("_k")))
    return seen.select(seq, pos, pooled.alias("pooled"))


def activation_report(rows: DataFrame, by: str, vector: str) -> DataFrame:
    """Share of zeros after ReLU, mean sigmoid and mean SiLU per group."""
    ready = rows.select(by, A.doubles(vector).alias("_v"))
    sig = F.transform("_v", lambda x: 1 / (1 + F.exp(-x)))
    return ready.groupBy(by).agg(
        (F.sum(F.size(F.filter("_v", lambda x: F.greatest(x, F.lit(0.0)) == 0))) / F.sum(F.size("_v"))).alias("zero_share"),
        (F.sum(A.total(sig)) / F.sum(F.size("_v"))).alias("mean_sigmoid"),
        (F.sum(A.dot(sig, F.col("_v"))) / F.sum(F.size("_v"))).alias("mean_silu"),
    )


