"""Ordered computations that hold up when one key owns a large part of the rows.

A plain ``Window.partitionBy(key).orderBy(ts)`` sends all rows of a key to one task. Here rows are
range-partitioned on (key, order), so a hot key spreads over many blocks. Each block computes its
local value, the per-block totals (one row per key and block) are scanned once, and the carry of
the earlier blocks is added. Only keys that cross a block border need a carry, and each block has
at most two of those, so the carry table has at most ``2 * blocks`` rows and may be broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from corpusweave.session import durable

BLOCK = "_block"


@dataclass(frozen=True)
class Fold:
    """A state of all rows up to one, that two parts of the rows can be put together to.

    ``local(window)`` is the state over a window of one block, ``block`` the aggregate of a whole block,
    ``carry(states)`` the state of an array of blocks, and ``joined(carry, local)`` that of both.
    """

    local: Callable[[WindowSpec], Column]
    block: Column
    carry: Callable[[Column], Column]
    joined: Callable[[Column, Column], Column]


def _range_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def row_index(df: DataFrame, order: Sequence[str], name: str = "row_index") -> DataFrame:
    """Global 0-based position of every row in ``order``, without a single-task sort."""
    mask = (1 << 33) - 1
    placed = durable(
        df.repartitionByRange(_range_parts(df), *order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    local = placed.select(
        "*",
        F.shiftright("_mid", 33).alias(BLOCK),
        F.col("_mid").bitwiseAND(F.lit(mask)).alias("_local"),
    )
    # One row per block: bounded by the number of range partitions.
    sizes = local.groupBy(BLOCK).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(F.lit(0)).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        BLOCK, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    return (
        local.join(F.broadcast(offsets), BLOCK)
        .withColumn(name, F.col("_offset") + F.col("_local"))
        .drop(BLOCK, "_mid", "_local", "_offset")
    )


def with_ordered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    index: str | None = None,
    sums: Mapping[str, Column] | None = None,
    totals: Mapping[str, Column] | None = None,
    last: Mapping[str, Column] | None = None,
    lag: Mapping[str, Column] | None = None,
    lead: Mapping[str, Column] | None = None,
    folds: Mapping[str, Fold] | None = None,
) -> DataFrame:
    """Add ordered columns per key.

    ``index``   0-based position of the row inside its key
    ``sums``    running sum up to and including the row
    ``totals``  sum over the whole key, on every row
    ``last``    latest non-null value up to and including the row (forward fill)
    ``lag`` / ``lead``  value of the previous / next row
    ``folds``   states up to and including the row, see ``Fold``

    ``order`` must make the rows of a key distinct.
    """
    sums, totals = dict(sums or {}), dict(totals or {})
    last, lag, lead, folds = dict(last or {}), dict(lag or {}), dict(lead or {}), dict(folds or {})
    if index:
        sums[index] = F.lit(1)
    inputs = {
        **{f"_s_{k}": v for k, v in sums.items()},
        **{f"_t_{k}": v for k, v in totals.items()},
        **{f"_f_{k}": v for k, v in last.items()},
        **{f"_g_{k}": v for k, v in lag.items()},
        **{f"_d_{k}": v for k, v in lead.items()},
    }
    rows = durable(
        df.select("*", *[v.alias(k) for k, v in inputs.items()])
        .repartitionByRange(_range_parts(df), *keys, *order)
        .withColumn(BLOCK, F.spark_partition_id())
    )
    cell = [*keys, BLOCK]
    position = F.struct(*order)

    summary = rows.groupBy(*cell).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(f"_s_{k}").alias(f"_s_{k}") for k in sums],
        *[F.sum(f"_t_{k}").alias(f"_t_{k}") for k in totals],
        *[
            F.max_by(f"_f_{k}", F.when(F.col(f"_f_{k}").isNotNull(), position)).alias(f"_f_{k}")
            for k in last
        ],
        *[F.max_by(F.struct(f"_g_{k}"), position).alias(f"_g_{k}") for k in lag],
        *[F.min_by(F.struct(f"_d_{k}"), position).alias(f"_d_{k}") for k in lead],
        *[f.block.alias(f"_a_{k}") for k, f in folds.items()],
    )
    across = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    ranked = across.orderBy(BLOCK)
    before = ranked.rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        summary.withColumn("_blocks", F.count(F.lit(1)).over(across))
        .filter("_blocks > 1")
        .select(
            *cell,
            *[F.sum(f"_s_{k}").over(before).alias(f"_cs_{k}") for k in sums],
            *[F.sum(f"_t_{k}").over(across).alias(f"_ct_{k}") for k in totals],
            *[F.last(f"_f_{k}", ignorenulls=True).over(before).alias(f"_cf_{k}") for k in last],
            *[F.lag(f"_g_{k}").over(ranked).alias(f"_cg_{k}") for k in lag],
            *[F.lead(f"_d_{k}").over(ranked).alias(f"_cd_{k}") for k in lead],
            # At most one state per block.
            *[f.carry(F.collect_list(f"_a_{k}").over(before)).alias(f"_ca_{k}") for k, f in folds.items()],
        )
    )

    inside = Window.partitionBy(*cell)
    local = inside.orderBy(*order)
    upto = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.row_number().over(local) == 1
    final = F.lead(F.lit(1)).over(local).isNull()
    out = rows.select(
        "*",
        *[F.sum(f"_s_{k}").over(upto).alias(f"_ls_{k}") for k in sums],
        *[F.sum(f"_t_{k}").over(inside).alias(f"_lt_{k}") for k in totals],
        *[F.last(f"_f_{k}", ignorenulls=True).over(upto).alias(f"_lf_{k}") for k in last],
        *[F.lag(f"_g_{k}").over(local).alias(f"_lg_{k}") for k in lag],
        *[F.lead(f"_d_{k}").over(local).alias(f"_ld_{k}") for k in lead],
        *[f.local(upto).alias(f"_la_{k}") for k, f in folds.items()],
        *([first.alias("_first")] if lag else []),
        *([final.alias("_final")] if lead else []),
    )
    out = out.join(F.broadcast(carry), cell, "left")
    columns = [c for c in df.columns]
    made = []
    for k in sums:
        value = F.coalesce(f"_ls_{k}", F.lit(0)) + F.coalesce(f"_cs_{k}", F.lit(0))
        made.append((value - 1 if k == index else value).alias(k))
    for k in totals:
        made.append(F.coalesce(f"_ct_{k}", f"_lt_{k}").alias(k))
    for k in last:
        made.append(F.coalesce(f"_lf_{k}", f"_cf_{k}").alias(k))
    for k in lag:
        made.append(
            F.when(F.col("_first"), F.col(f"_cg_{k}")[f"_g_{k}"]).otherwise(F.col(f"_lg_{k}")).alias(k)
        )
    for k in lead:
        made.append(
            F.when(F.col("_final"), F.col(f"_cd_{k}")[f"_d_{k}"]).otherwise(F.col(f"_ld_{k}")).alias(k)
        )
    for k, f in folds.items():
        joined = f.joined(F.col(f"_ca_{k}"), F.col(f"_la_{k}"))
        made.append(F.when(F.col(f"_ca_{k}").isNull(), F.col(f"_la_{k}")).otherwise(joined).alias(k))
    return out.select(*columns, *made)
