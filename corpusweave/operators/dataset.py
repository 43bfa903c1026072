"""Token streams, windows, splits and batches for training sets.

A token dataset is a table (doc_id, ids ARRAY<INT>) with distinct keys. The flat stream, all documents in the
order of their keys, is never sorted as tokens: documents get an offset by a prefix sum over their lengths.
What has to move is one row per document or per draw; windows find their documents by an as-of join on
offsets, and blocks are cut while documents pass by in order.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusweave.functions.draws import digest_number, permuted
from corpusweave.functions.ordered import row_index, with_ordered
from corpusweave.session import work_partitions, written

# Ids that a task cuts at a time.
CUT_IDS = 1 << 20


def stream_offsets(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """Position of every document in the flat stream as (key, start, n)."""
    size = F.col("n") if "n" in tokens.columns else F.size("ids")
    sized = tokens.select(key, size.cast("long").alias("n"))
    placed = with_ordered(sized, [], [key], sums={"_end": F.col("n")})
    return placed.select(key, (F.col("_end") - F.col("n")).alias("start"), "n")


def held_tokens(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, ids, n) as a scratch table: what made the tokens runs once, and sizes are read without them."""
    return written(tokens.select(key, "ids", F.size("ids").cast("long").alias("n")), "tokens")


def with_offsets(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, ids, start, n): the ids move once, to the short rows of offsets."""
    held = held_tokens(tokens, key)
    return held.select(key, "ids").join(stream_offsets(held, key).hint("shuffle_hash"), key)


def stream_length(tokens: DataFrame) -> int:
    size = F.col("n") if "n" in tokens.columns else F.size("ids").cast("long")
    return tokens.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first()["n"]


def token_stream(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per token with its global position."""
    placed = with_offsets(tokens, key)
    return placed.select(key, "start", F.posexplode("ids").alias("at", "token_id")).select(
        (F.col("start") + F.col("at")).alias("pos"), key, F.col("at"), "token_id"
    )


def stream_blocks(tokens: DataFrame, size: int, overlap: int = 0, key: str = "doc_id") -> DataFrame:
    """Blocks ``[b*size, b*size + size + overlap)`` of the flat stream as (block, ids).

    Documents move once, to the range of their key, and arrive there in the order of the stream; the
    first key of each range and its offset are known from the short table of offsets. Blocks inside a
    range are cut while its documents pass by. Only blocks over a border of ranges, or over the batches of
    a task, are put together from parts, and a block holds at most ``size + overlap`` ids.
    """
    held = held_tokens(tokens, key)
    spark = held.sparkSession
    offsets = stream_offsets(held, key).filter("n > 0")
    n_ranges, total = work_partitions(spark), stream_length(held)
    width = max(-(-total // n_ranges), 1)
    span = F.expr(f"start div {width}")
    # One row per range.
    borders = offsets.groupBy(span.alias("r")).agg(F.min(F.struct("start", key)).alias("b")).orderBy("r").collect()
    keys = np.array([r["b"][key] for r in borders], dtype=object if isinstance(_first_key(borders, key), str) else None)
    begins = np.array([r["b"]["start"] for r in borders], np.int64)

    @F.pandas_udf("int")
    def range_of(values: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(keys, values.to_numpy(), side="right") - 1)

    moved = (
        held.filter("n > 0")
        .withColumn("_range", range_of(key))
        .repartitionById(max(len(borders), 1), F.col("_range"))
        .sortWithinPartitions(key)
    )

    def cut(batches):
        at = None
        for batch in batches:
            for lo, hi in _slices(batch.column("n").to_numpy()):
                part = batch.slice(lo, hi - lo)
                at = int(begins[part.column("_range")[0].as_py()]) if at is None else at
                lists = part.column("ids")
                ids = lists.flatten()
                n = len(ids)
                first, last = max(at - overlap, 0) // size, -(-(at + n) // size)
                blocks = np.arange(first, last)
                since = np.maximum(blocks * size, at)
                until = np.minimum(blocks * size + size + overlap, at + n)
                some = until > since
                blocks, since, until = blocks[some], since[some], until[some]
                takes = pa.array(_places(since - at, until - since))
                cuts = pa.array(np.concatenate([[0], np.cumsum(until - since)]).astype(np.int32))
                parts = pa.ListArray.from_arrays(cuts, ids.take(takes))
                yield pa.record_batch({"block": blocks, "since": since, "part": parts})
                at += n

    element = held.schema["ids"].dataType.simpleString()
    parts = moved.select("_range", "n", "ids").mapInArrow(cut, f"block long, since long, part {element}")
    whole = F.size("part") == F.least(F.lit(size + overlap), F.lit(total) - F.col("block") * size)
    done = parts.filter(whole).select("block", F.col("part").alias("ids"))
    ordered = F.array_sort(F.collect_list(F.struct("since", "part")))
    open_ = parts.filter(~whole).groupBy("block").agg(F.flatten(F.transform(ordered, lambda p: p["part"])).alias("ids"))
    return done.unionByName(open_)


def _first_key(borders, key):
    return borders[0]["b"][key] if borders else 0


def _slices(sizes: np.ndarray):
    """Row ranges of about CUT_IDS ids each, one row at least."""
    ends, lo = np.cumsum(sizes), 0
    while lo < len(sizes):
        hi = max(int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + CUT_IDS, side="right")), lo + 1)
        yield lo, hi
        lo = hi


def _places(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def next_tokens(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """Inputs and targets of every document: y is x shifted by one."""
    n = F.size("ids")
    return tokens.filter(n > 1).select(
        key,
        F.slice("ids", F.lit(1), n - 1).alias("x"),
        F.slice("ids", F.lit(2), n - 1).alias("y"),
    )


def strided_blocks(tokens: DataFrame, seq: int, key: str = "doc_id") -> DataFrame:
    """Blocks of each document at 0, seq, 2*seq, ... below len-seq-1, with shifted targets."""
    n = F.size("ids")
    starts = F.sequence(F.lit(0), n - seq - 2, F.lit(seq))
    made = F.transform(
        starts,
        lambda i: F.struct(
            i.alias("start"),
            F.slice("ids", i + 1, F.lit(seq)).alias("x"),
            F.slice("ids", i + 2, F.lit(seq)).alias("y"),
        ),
    )
    # sequence would count down for a short text, so those are filtered first.
    return tokens.filter(n - seq - 2 >= 0).select(key, F.inline(made))


def stream_strided_blocks(tokens: DataFrame, seq: int, key: str = "doc_id") -> DataFrame:
    """The same blocks over the flat stream, which may cross documents."""
    blocks = stream_blocks(tokens, seq, 1, key)
    start = F.col("block") * seq
    # A block of seq + 1 ids that is not the last of the stream: start < total - seq - 1.
    last = blocks.agg(F.max(start + F.size("ids"))).first()[0] or 0
    return blocks.filter(start < last - seq - 1).select(
        start.alias("start"),
        F.slice("ids", 1, seq).alias("x"),
        F.slice("ids", 2, seq).alias("y"),
    )


def sliding_windows(tokens: DataFrame, k: int, key: str = "doc_id") -> DataFrame:
    """Every context of k tokens with the token that follows; len-k rows per document.

    The tokens of a window stand next to each other in moved copies of the ids, so no window is sliced.
    """
    n = F.size("ids")
    moved = F.arrays_zip(*[F.slice("ids", F.lit(j + 1), n - k).alias(f"t{j}") for j in range(k + 1)])
    made = tokens.filter(n - k - 1 >= 0).select(key, F.posexplode(moved).alias("start", "_w"))
    context = F.array(*[F.col(f"_w.t{j}") for j in range(k)]).cast(tokens.schema["ids"].dataType)
    return made.select(key, "start", context.alias("context"), F.col(f"_w.t{k}").alias("target"))


def draw_start(k: Column, seed: int, max_start: int) -> Column:
    """Reproducible start of draw k, uniform below ``max_start`` (which is never drawn itself)."""
    return F.pmod(digest_number(k, seed), F.lit(max_start).cast("long"))


def covering_documents(offsets: DataFrame, windows: DataFrame, window: str, size: int, key: str = "doc_id") -> DataFrame:
    """As-of join: the documents that each window ``[since, since + size)`` of the stream runs over.

    ``offsets`` is (key, start, n), ``windows`` is (window, since). Both sides are dealt to equal spans of
    the stream, where windows find their first document by binary search in the sorted offsets. A document
    is one row, and one more for every span border inside it; the same holds for a window. Rows are
    (window, since, key, at, from, n): n ids from position ``from`` (1-based) of the document, at stream
    position ``at``.
    """
    offsets = offsets.filter("n > 0")
    spans = 4 * work_partitions(offsets.sparkSession)
    total = offsets.agg(F.max(F.col("start") + F.col("n"))).first()[0] or 0
    width = max(-(-total // spans), size)
    dealt = lambda first, last: F.explode(F.sequence(F.expr(f"{first} div {width}"), F.expr(f"({last}) div {width}")))
    left = offsets.select(F.col(key).alias("doc"), "start", "n", dealt("start", "start + n - 1").alias("span"))
    right = windows.select(F.col(window).alias("window"), "since", dealt("since", f"since + {size} - 1").alias("span"))
    kinds = {c: f.schema[n].dataType.simpleString() for c, f, n in (("window", windows, window), ("doc", offsets, key))}
    schema = f"window {kinds['window']}, since long, doc {kinds['doc']}, at long, `from` int, n int"

    def match(docs: pa.Table, drawn: pa.Table) -> pa.Table:
        docs = docs.sort_by("start")
        start, n = docs.column("start").to_numpy(), docs.column("n").to_numpy()
        since = drawn.column("since").to_numpy()
        # Only the part of a window inside this span: its other parts are found in theirs.
        low = drawn.column("span").to_numpy() * width
        begin, end = np.maximum(since, low), np.minimum(since + size, low + width)
        first = np.searchsorted(start, begin, side="right") - 1
        last = np.searchsorted(start, end, side="left")
        row = np.repeat(np.arange(len(since)), last - first)
        doc = _places(first, last - first)
        at = np.maximum(begin[row], start[doc])
        until = np.minimum(end[row], start[doc] + n[doc])
        return pa.table(
            {
                "window": drawn.column("window").take(pa.array(row)),
                "since": pa.array(since[row]),
                "doc": docs.column("doc").take(pa.array(doc)),
                "at": pa.array(at),
                "from": pa.array((at - start[doc] + 1).astype(np.int32)),
                "n": pa.array((until - at).astype(np.int32)),
            }
        )

    found = left.groupBy("span").cogroup(right.groupBy("span")).applyInArrow(match, schema)
    return found.filter("n > 0").withColumnsRenamed({"window": window, "doc": key})


def random_windows(
    tokens: DataFrame, draws: DataFrame, draw: str, seq: int, seed: int = 0, key: str = "doc_id"
) -> DataFrame:
    """A window of the flat stream for every draw number: (draw, start, x, y).

    Draws and offsets meet in an as-of join, and only the slices that a window needs leave their
    documents. No group has more than ``seq + 1`` tokens.
    """
    held = held_tokens(tokens, key)
    size, total = seq + 1, stream_length(held)
    if total - size <= 0:
        raise ValueError("the stream is shorter than one window")
    placed = draws.select(draw, draw_start(F.col(draw), seed, total - size).alias("since"))
    cuts = covering_documents(stream_offsets(held, key), placed, draw, size, key)
    taken = held.select(key, "ids").join(cuts, key).select(
        draw, "since", "at", F.slice("ids", F.col("from"), F.col("n")).alias("part")
    )
    whole = taken.groupBy(draw, "since").agg(F.array_sort(F.collect_list(F.struct("at", "part"))).alias("_parts"))
    ids = F.flatten(F.transform("_parts", lambda p: p["part"]))
    return whole.select(
        draw, F.col("since").alias("start"), F.slice(ids, 1, seq).alias("x"), F.slice(ids, 2, seq).alias("y")
    )


def ordered_split(
    tokens: DataFrame, fraction: float, overlap: int = 0, key: str = "doc_id"
) -> DataFrame:
    """Train and validation parts of the stream cut at int(fraction * length), as (part, key, start, ids).

    With ``overlap`` the validation part starts that many tokens earlier. Documents that cross the
    cut are divided. The length comes from the sizes; ids are made once and move once.
    """
    held = held_tokens(tokens, key)
    cut = int(fraction * stream_length(held))
    begin = max(0, cut - overlap)
    placed = held.select(key, "ids").join(stream_offsets(held, key).hint("shuffle_hash"), key)
    end = F.col("start") + F.col("n")
    head = F.slice("ids", F.lit(1), F.least(F.col("n"), F.greatest(F.lit(0), cut - F.col("start"))).cast("int"))
    skip = F.greatest(F.lit(0), begin - F.col("start"))
    tail = F.slice("ids", (skip + 1).cast("int"), (F.col("n") - skip).cast("int"))
    parts = F.array(
        F.when(F.col("start") < cut, F.struct(F.lit("train").alias("part"), F.col("start").alias("start"), head.alias("ids"))),
        F.when(end > begin, F.struct(F.lit("val").alias("part"), (F.col("start") + skip).alias("start"), tail.alias("ids"))),
    )
    return placed.filter("n > 0").select(key, F.inline(F.array_compact(parts))).select("part", key, "start", "ids")


def shuffled_batches(
    examples: DataFrame, key: str, batch_size: int, seed: int = 0, position: str | None = None
) -> DataFrame:
    """Examples with ``batch_id`` from a seeded permutation of their row numbers.

    The row number, counted in the order of the key or given as the column ``position``, goes through a
    keyed permutation of 0..n-1, so neighbours part, batches are full whatever the keys are, and nothing is sorted by a random number. With ``position`` no row moves at all.
    """
    placed = row_index(examples, [key], "_at") if position is None else examples.withColumn("_at", F.col(position))
    # Counting rows reads no columns.
    n = examples.count()
    placed = placed.withColumn("_to", permuted(F.col("_at"), n, seed))
    return placed.withColumn("batch_id", F.expr(f"_to div {batch_size}")).drop("_at", "_to")


def left_pad(ids: Column, k: int, pad: int = 0) -> Column:
    """The last k tokens, padded on the left."""
    return F.slice(F.concat(F.array_repeat(F.lit(pad), k), ids), -k, k)


def last_tokens(ids: Column, max_len: int) -> Column:
    n = F.least(F.size(ids), F.lit(max_len))
    return F.when(n == 0, ids).otherwise(F.slice(ids, F.size(ids) - n + 1, n))


def batches_per_epoch(tokens: DataFrame, batch: int, seq: int, by: list[str] | None = None) -> DataFrame:
    sized = tokens.groupBy(*(by or [])).agg(F.sum(F.size("ids").cast("long")).alias("tokens"))
    return sized.withColumn("batches", F.expr(f"tokens div {batch * seq}"))


def uniform_baseline(tokens: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Loss ln(V) and perplexity V of guessing uniformly over the tokens seen."""
    by = by or []
    # Distinct tokens first: the shuffle carries one row per token, not per occurrence.
    seen = tokens.select(*by, F.explode(F.array_distinct("ids")).alias("token_id")).distinct()
    return seen.groupBy(*by).agg(F.count(F.lit(1)).alias("vocab_size")).withColumn(
        "loss", F.log(F.col("vocab_size").cast("double"))
    )
