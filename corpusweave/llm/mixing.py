"""Mixing sources to target weights, with DataFrame functions only.

Words per source give the targets, a target over its source's words is the repetition rate, and each
document is emitted floor(rate) times plus once more if a hash of it falls below the fraction. No
row looks at another one after the totals per source are known.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusweave.llm.batches import WORD_PATTERN, broadcast_if_bytes, fresh, write_and_read

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = "mix-1"
EXACT = "decimal(38,0)"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def draw(key: Column, seed: str = SEED) -> Column:
    """Uniform number in [0, 1) from the first 13 hex digits of a digest of seed and key."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("null")))
    digits = F.substring(F.md5(text.cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """Target of every source from its words; one row per source in and out.

    Sources in code-point order, null last, weigh ``weights`` over and over and share the words of
    all. A target that passes ``max_repeats`` times its source's words stops there, and the excess
    goes to the others by weight, until none is above. That is water-filling: with the sources in
    order of words per weight, exactly a prefix stops, and one level serves the rest. Sums are whole
    numbers, so the result does not depend on the order of addition.

    The windows run over one row per source, which is the size of a list of sources, not of the data.
    """
    all_rows = Window.partitionBy(F.lit(0))
    by_name = all_rows.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    position = (F.row_number().over(by_name) - 1) % len(weights)
    ranked = sizes.select(
        "source",
        "source_size",
        F.element_at(cycle, (position + 1).cast("int")).cast(EXACT).alias("weight"),
        (F.col("source_size").cast(EXACT) * max_repeats).cast(EXACT).alias("cap"),
    )
    before = all_rows.orderBy(
        (F.col("source_size").cast("double") / F.col("weight").cast("double")), F.col("source").asc_nulls_last()
    ).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast(EXACT)
    walked = ranked.select(
        "*",
        F.sum(F.col("source_size").cast(EXACT)).over(all_rows).cast(EXACT).alias("words"),
        F.sum("weight").over(all_rows).cast(EXACT).alias("weights"),
        F.coalesce(F.sum("weight").over(before).cast(EXACT), zero).alias("weight_before"),
        F.coalesce(F.sum("cap").over(before).cast(EXACT), zero).alias("cap_before"),
    )
    left_weight = F.col("weights") - F.col("weight_before")
    left_words = F.col("words") - F.col("cap_before")
    stopped = walked.withColumn("stops", F.col("cap") * left_weight < F.col("weight") * left_words)
    level_words = F.col("words") - F.coalesce(F.sum(F.when(F.col("stops"), F.col("cap"))).over(all_rows), zero)
    level_weight = F.sum(F.when(~F.col("stops"), F.col("weight"))).over(all_rows)
    level = level_words.cast("double") / level_weight.cast("double")
    return stopped.select(
        "source",
        "source_size",
        F.when(F.col("stops"), F.col("cap").cast("double"))
        .otherwise(F.col("weight").cast("double") * level)
        .alias("target"),
    )


def plan(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    seed: str = SEED,
) -> DataFrame:
    """Add ``size``, ``source_size``, ``target`` and ``copies`` to every row.

    Columns of these names are replaced. A null or empty text has size 0; a null source is a source
    of its own, last in order; a null key draws as the word null does, and repeated rows draw alike.
    The draw depends on key and seed only, so reruns and lost executors change nothing.
    """
    made = ("size", "source_size", "target", "copies")
    kept = docs.select(*[f"`{c}`" for c in docs.columns if c not in made or c in (key, text, source)])
    at = fresh(kept, "mix_source", "mix_size")
    name, size = at["mix_source"], at["mix_size"]
    sized = kept.withColumn(size, word_count(F.col(f"`{text}`"))).withColumn(name, F.col(f"`{source}`"))
    totals = sized.groupBy(F.col(name).alias("source")).agg(F.sum(size).alias("source_size"))
    # The written table makes its size known before anything is broadcast.
    targets = write_and_read(source_targets(totals, weights, max_repeats), "mix-targets")
    side = broadcast_if_bytes(targets.select(F.col("source").alias(f"{name}2"), "source_size", "target"))
    joined = sized.join(side, F.col(name).eqNullSafe(F.col(f"{name}2")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(rate)
    extra = (draw(F.col(f"`{key}`"), seed) < rate - whole).cast("long")
    return joined.select(
        *[F.col(f"`{c}`") for c in kept.columns if c not in made],
        F.col(size).alias("size"),
        "source_size",
        "target",
        F.least(whole + extra, F.lit(max_repeats).cast("long")).alias("copies"),
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """Every document as often as its plan says, with the columns it came with."""
    renamed = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    names = {role: f"c{docs.columns.index(options.pop(role, role_name))}" for role, role_name in
             (("key", "doc_id"), ("text", "text"), ("source", "source"))}
    planned = plan(renamed, **names, **options)
    emitted = planned.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return emitted.select(*renamed.columns).toDF(*docs.columns)
