"""N-gram language models as count tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from corpusweave.functions.draws import digest_number
from corpusweave.functions.ordered import with_ordered
from corpusweave.operators.text import WORD_SPACE, text_slices
from corpusweave.session import durable

MAX_LOSS = 20.0
# Rows of a context that a draw looks through after it has found their block.
BLOCK_ROWS = 256
# Text bytes and windows that a task counts at a time.
COUNTED_BYTES = 4 << 20
WINDOWS = 1 << 22


def char_ngrams(text: Column, n: int, include_last: bool = False) -> Column:
    """All windows of n characters, found in one pass; without ``include_last`` the final one is left out.

    The pattern consumes one code point at a time and looks ahead for the window.
    """
    tail = "" if include_last else "."
    return F.regexp_extract_all(text, F.lit(rf"(?s)(?=(.{{{n}}}){tail})."), F.lit(1))


def _counted_windows(texts: list[str], n: int, include_last: bool):
    """(grams, counts) of the windows of n characters of some texts, a bounded number of windows at a time."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    windows = np.maximum(sizes - n + include_last, 0)
    ends = np.cumsum(windows)
    seen = np.zeros(0x110000, bool)
    seen[points] = True
    alphabet = np.flatnonzero(seen).astype("<u4")
    ranks = np.zeros(0x110000, np.int32)
    ranks[alphabet] = np.arange(len(alphabet))
    ids, base = ranks[points], len(alphabet)
    moves = np.cumsum(sizes) - sizes - (ends - windows)
    for lo in range(0, int(ends[-1]) if len(ends) else 0, WINDOWS):
        at = np.arange(lo, min(lo + WINDOWS, int(ends[-1])))
        at += moves[np.searchsorted(ends, at, side="right")]
        codes, bound, exact = ids[at].astype(np.int64), base, True
        for k in range(1, n):
            if bound * base >= 1 << 62:
                # Too many characters for one number: what was seen so far is numbered anew.
                found, codes = np.unique(codes, return_inverse=True)
                bound, exact = len(found), False
            codes *= base
            codes += ids[at + k]
            bound *= base
        if exact:
            found, counts = np.unique(codes, return_counts=True)
            made = np.zeros((len(found), n), "<u4")
            for k in reversed(range(n)):
                found, digit = np.divmod(found, base)
                made[:, k] = alphabet[digit]
        else:
            _, first, counts = np.unique(codes, return_index=True, return_counts=True)
            made = points[at[first][:, None] + np.arange(n)]
        whole = made.tobytes().decode("utf-32-le", "surrogatepass")
        yield [whole[k : k + n] for k in range(0, len(whole), n)], counts


def char_ngram_counts(
    docs: DataFrame, n: int, text: str = "text", include_last: bool = False
) -> DataFrame:
    """Counts of (context, next) with a context of n-1 characters.

    Tasks count the windows of a few megabytes of text as numbers, so a row is made for each distinct window
    of those and not for each character.
    """
    if n < 1:
        raise ValueError("n must be at least 1")

    def count(batches):
        for batch in batches:
            for part in text_slices(batch.column("text"), COUNTED_BYTES):
                for grams, counts in _counted_windows(part.drop_null().to_pylist(), n, include_last):
                    yield pa.record_batch({"gram": pa.array(grams, pa.string()), "cnt": pa.array(counts, pa.int64())})

    partial = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "gram string, cnt long")
    counts = partial.groupBy("gram").agg(F.sum("cnt").alias("cnt"))
    return counts.select(
        F.substring("gram", 1, n - 1).alias("context"), F.substring("gram", n, 1).alias("next"), "cnt"
    )


def word_ngram_counts(
    docs: DataFrame, n: int, text: str = "text", lower: bool = True, include_last: bool = False
) -> DataFrame:
    """The same over words; the context is the words joined by a blank.

    Words are parted by one blank each, and a pattern consumes a word at a time and looks ahead for the window,
    so a window is one string from the start.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    source = F.lower(text) if lower else F.col(text)
    parted = F.concat(F.trim(F.regexp_replace(source, WORD_SPACE, " ")), F.lit(" "))
    word, beyond = "[^ ]++", "" if include_last else "[^ ]"
    window = rf"(?<![^ ])(?=({word}(?: {word}){{{n - 1}}}) {beyond}){word}"
    grams = docs.select(F.explode(F.regexp_extract_all(parted, F.lit(window), F.lit(1))).alias("gram"))
    counts = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("cnt"))
    last = F.substring_index("gram", " ", -1)
    context = F.left("gram", F.length("gram") - F.length(last) - 1) if n > 1 else F.lit("")
    return counts.select(context.alias("context"), last.alias("next"), "cnt")


def with_probability(counts: DataFrame) -> DataFrame:
    """Adds ``total`` of the context and ``p`` = cnt / total.

    Totals are aggregated and joined instead of windowed: a frequent context is then a skewed join
    key that AQE can split, not one task.
    """
    totals = counts.groupBy("context").agg(F.sum("cnt").alias("total"))
    return counts.join(totals, "context").withColumn("p", F.col("cnt") / F.col("total"))


def top_next(counts: DataFrame, k: int) -> DataFrame:
    """The k most likely next tokens of every context; ties go to the smaller token."""
    order = Window.partitionBy("context").orderBy(F.col("cnt").desc(), "next")
    return counts.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def _generator(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cumulative ranges of the next tokens of every context, on two levels.

    Rows of a context are ordered by (cnt descending, next) and get the range [low, high) of draws that
    choose them, and a block number. Running sums come from range partitions, so the rows of one context
    lie in many tasks. The first table has one row per block, (context, block, from, to, total).
    """
    rows = counts.select("context", "next", "cnt", (-F.col("cnt")).alias("_order"))
    placed = with_ordered(
        rows, ["context"], ["_order", "next"], index="_at", sums={"high": F.col("cnt")}, totals={"total": F.col("cnt")}
    )
    ranges = durable(
        placed.select(
            "context", "next", F.expr(f"_at div {BLOCK_ROWS}").alias("block"),
            (F.col("high") - F.col("cnt")).alias("low"), "high", "total",
        )
    )
    blocks = ranges.groupBy("context", "block").agg(
        F.min("low").alias("from"), F.max("high").alias("to"), F.first("total").alias("total")
    )
    return durable(blocks), ranges.drop("total")


def generate(
    counts: DataFrame,
    prompts: DataFrame,
    n: int,
    steps: int,
    key: str = "item_id",
    text: str = "text",
    greedy: bool = False,
    seed: int = 0,
) -> DataFrame:
    """Extend all prompts at once, two joins per step; a prompt with an unseen context stops.

    Sampling draws an integer below the context total from (key, step, seed), so it is
    reproducible. Greedy takes the most frequent next character. A draw first finds its block of the
    context, then its row among the at most BLOCK_ROWS rows of the block.
    """
    blocks, ranges = _generator(counts)
    state = prompts.select(key, F.col(text).alias("_t"), F.lit(True).alias("_live"))
    for step in range(steps):
        draw = F.lit(0) if greedy else F.pmod(digest_number(F.col(key), step, seed), F.col("total"))
        context = F.when(F.col("_live") & (F.length("_t") >= n - 1), F.right("_t", F.lit(n - 1)))
        hit = (draw >= F.col("from")) & (draw < F.col("to"))
        found = state.withColumn("_c", context).join(blocks, (F.col("_c") == F.col("context")) & hit, "left").select(
            key, "_t", "_c", F.col("block").alias("_b"), draw.alias("_u")
        )
        inside = (F.col("_u") >= F.col("low")) & (F.col("_u") < F.col("high"))
        state = found.join(
            ranges, (F.col("_c") == F.col("context")) & (F.col("_b") == F.col("block")) & inside, "left"
        ).select(
            key,
            F.concat("_t", F.coalesce("next", F.lit(""))).alias("_t"),
            F.col("next").isNotNull().alias("_live"),
        )
    return state.select(key, F.col("_t").alias("generated"))


def held_out_loss(
    counts: DataFrame, held_out: DataFrame, alpha: float | None = None, vocab_size: int | None = None
) -> DataFrame:
    """Mean loss and perplexity of held-out (context, next, cnt) rows under a count model.

    Unseen windows have no probability and are counted apart, unless ``alpha`` smooths them.
    """
    totals = counts.groupBy("context").agg(F.sum("cnt").alias("total"))
    known = counts.select("context", "next", F.col("cnt").alias("seen"))
    both = held_out.join(known, ["context", "next"], "left").join(totals, "context", "left")
    if alpha is None:
        p = F.col("seen") / F.col("total")
    else:
        if vocab_size is None:
            raise ValueError("smoothing needs the vocabulary size")
        p = (F.coalesce("seen", F.lit(0)) + alpha) / (F.coalesce("total", F.lit(0)) + alpha * vocab_size)
    scored = both.withColumn("_nll", -F.log(p))
    sums = scored.agg(
        F.sum("cnt").alias("windows"),
        F.sum(F.when(F.col("_nll").isNull(), F.col("cnt")).otherwise(0)).alias("unseen"),
        (F.sum(F.col("_nll") * F.col("cnt")) / F.sum(F.when(F.col("_nll").isNotNull(), F.col("cnt")))).alias("loss"),
    )
    return sums.withColumn("perplexity", F.exp(F.least("loss", F.lit(MAX_LOSS))))
