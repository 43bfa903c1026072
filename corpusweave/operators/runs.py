"""Run tracking: configurations, histories, metrics and manifests."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusweave.functions.ordered import with_ordered
from corpusweave.session import durable

NAN = float("nan")
PERPLEXITY_LIMIT = 20.0
# Cells of a histogram and rounds of narrowing; more than the logarithm of the smallest double, negated.
CELLS = 4096
MOST_TURNS = 64
LOG_ROOM = 750.0

# Configuration fields and their defaults.
DEFAULTS = {
    "num_layers": "4",
    "num_attention_heads": "8",
    "model_dim": "384",
    "max_sequence_length": "256",
    "batch_size": "32",
    "learning_rate": "0.001",
    "num_steps": "2000",
    "weight_decay": "1e-05",
    "beta1": "0.9",
    "beta2": "0.999",
    "learning_rate_schedule": "true",
    "clip_gradients": "true",
    "warmup_steps": "50",
    "max_grad_norm": "1.0",
    "eval_interval": "100",
    "eval_examples": "16",
    "val_split": "0.95",
    "train_data_path": "",
    "token_path": "",
    "checkpoint_path": "",
    "vocab_size": "",
}


def unknown_overrides(overrides: DataFrame, defaults: Mapping[str, str] = DEFAULTS) -> DataFrame:
    """Override fields that no default knows, from rows (run, field, value)."""
    known = overrides.sparkSession.createDataFrame([(f,) for f in defaults], "field string")
    return overrides.join(F.broadcast(known), "field", "left_anti")


def resolve_configs(
    overrides: DataFrame, vocab_size: int | None = None, defaults: Mapping[str, str] = DEFAULTS
) -> DataFrame:
    """One map of all fields per run: defaults, the vocabulary size, then the overrides.

    Unknown fields are an error that lists them sorted.
    """
    # The names meet sorted in one message; how often each comes does not matter.
    unknown = unknown_overrides(overrides, defaults).agg(F.array_join(F.sort_array(F.collect_set("field")), ", ")).first()[0]
    if unknown:
        raise ValueError(f"column field names no setting of a run: {unknown}; settings are {', '.join(sorted(defaults))}")
    values = dict(defaults)
    if vocab_size is not None:
        values["vocab_size"] = str(vocab_size)
    base = F.create_map(*[F.lit(x) for kv in values.items() for x in kv])
    # A run has at most one row per known field, so its map is bounded by the field list.
    given = overrides.groupBy("run").agg(
        F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("_given")
    )
    merged = F.map_from_entries(
        F.transform(
            F.map_entries(base),
            lambda e: F.struct(
                e["key"].alias("key"), F.coalesce(F.col("_given")[e["key"]], e["value"]).alias("value")
            ),
        )
    )
    return given.select("run", merged.alias("config"))


def event_history(events: DataFrame) -> DataFrame:
    """Histories from the event table: a user is a run, an event a step, ordered by time.

    The value is the training loss; a view event carries an evaluation, which is NaN for errors.
    """
    val = F.when(F.col("event_type") == "error", F.lit(NAN)).when(
        F.col("event_type") == "view", F.col("value")
    )
    return events.select(
        F.col("user_id").alias("run"), "ts", "event_id", F.col("value").alias("train_loss"), val.alias("val_seen")
    )


def carry_validation(
    history: DataFrame, run: str = "run", order: tuple[str, ...] = ("ts", "event_id")
) -> DataFrame:
    """``val_loss``: the latest evaluation so far, NaN before the first one."""
    out = with_ordered(history, [run], list(order), last={"val_loss": F.col("val_seen")})
    return out.withColumn("val_loss", F.coalesce("val_loss", F.lit(NAN)))


def run_metrics(history: DataFrame, run: str = "run", order: tuple[str, ...] = ("ts", "event_id")) -> DataFrame:
    """Summary of every run.

    ``train_tail`` is the mean of the last max(1, steps div 5) training losses, ``val_min`` leaves
    NaN out and is NaN when nothing is finite. Status: NaN when a training loss is NaN, DIVERGE
    when the last exceeds the first, else ok.
    """
    placed = with_ordered(
        history,
        [run],
        list(order),
        index="_at",
        totals={"_steps": F.lit(1)},
        last={"_val": F.col("val_seen")},
    )
    tail = F.col("_at") >= F.col("_steps") - F.greatest(F.lit(1), F.expr("_steps div 5"))
    finite = F.when(~F.isnan("_val") & (F.abs("_val") != float("inf")), F.col("_val"))
    sums = placed.groupBy(run).agg(
        F.max_by("train_loss", "_at").alias("final_train"),
        F.min_by("train_loss", "_at").alias("_first"),
        F.avg(F.when(tail, F.col("train_loss"))).alias("train_tail"),
        F.min(finite).alias("_val_min"),
        F.max(F.isnan("train_loss")).alias("_nan"),
        F.count(F.lit(1)).alias("num_steps"),
        F.min(order[0]).alias("_begin"),
        F.max(order[0]).alias("_end"),
    )
    status = (
        F.when(F.col("_nan"), F.lit("NaN"))
        .when(F.col("final_train") > F.col("_first"), F.lit("DIVERGE"))
        .otherwise(F.lit("ok"))
    )
    return sums.select(
        run,
        "final_train",
        F.coalesce("_val_min", F.lit(NAN)).alias("val_min"),
        "train_tail",
        status.alias("status"),
        "num_steps",
        F.expr("timestampdiff(SECOND, _begin, _end)").alias("seconds"),
    )


def manifest(metrics: DataFrame, run: str = "run", overrides: Column | None = None) -> DataFrame:
    """Manifest rows with metrics to four decimals and the overrides as JSON."""
    given = overrides if overrides is not None else F.map_from_arrays(F.array(F.lit("num_steps")), F.array(F.col("num_steps")))
    return metrics.select(
        F.concat(F.lit("run_"), F.col(run).cast("string")).alias("name"),
        "status",
        F.round("final_train", 4).alias("final_train"),
        F.round("val_min", 4).alias("val_min"),
        F.round("train_tail", 4).alias("train_tail"),
        "num_steps",
        "seconds",
        F.to_json(given).alias("overrides"),
    )


def best_run(runs: DataFrame, name: str = "name") -> DataFrame:
    """The run with the smallest (train_tail, name) among those that are ok."""
    best = F.min(F.struct("train_tail", F.col(name).alias("name")))
    return runs.filter("status = 'ok'").agg(best.alias("b")).filter("b IS NOT NULL").select("b.name", "b.train_tail")


def _narrowed(value: Column, low: Column, high: Column, linear: bool) -> Column:
    """Number of the histogram cell of a value between two borders; cells follow the order of values."""
    if not linear:
        # Even steps of the logarithm, for values of many magnitudes.
        value, low, high = (
            F.when(v == 0, 0.0).otherwise(F.signum(v) * (F.log(F.abs(v)) + LOG_ROOM)) for v in (value, low, high)
        )
    # Halves first: the width of the whole range of doubles would be infinite.
    share = (value / 2 - low / 2) / (high / 2 - low / 2)
    return F.least(F.floor(F.coalesce(share, F.lit(0.0)) * CELLS), F.lit(CELLS - 1)).cast("int")


def exact_medians(rows: DataFrame, by: str, value: str) -> DataFrame:
    """(by, median): the mean of the two middle values of every group, null for a group without values.

    The two ranks are narrowed down by histograms. A round counts the values that are left in CELLS cells
    between the borders of each group and keeps the cell with the rank; its least and greatest value are
    the next borders. It ends when they are equal. A group never has more than CELLS rows in one place,
    whatever its size; each round reads the values once. Infinities and NaN count as the
    numbers at the ends of the range.
    """
    known = rows.select(F.col(by).alias("g"), F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull())
    top = float(np.finfo(np.float64).max)
    known = known.withColumn("v", F.when(F.isnan("v") | (F.col("v") > top), top).when(F.col("v") < -top, -top).otherwise(F.col("v")))
    first = known.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    ranks = F.array(F.expr("(n - 1) div 2"), F.expr("n div 2"))
    state = first.select("g", "low", "high", F.posexplode(ranks).alias("which", "rank"))
    state = durable(state)
    for turn in range(MOST_TURNS):
        if state.filter("low < high").isEmpty():
            break
        open_ = state.filter("low < high").withColumnRenamed("g", "og")
        seen = known.join(open_, F.col("g").eqNullSafe(F.col("og")) & F.col("v").between(F.col("low"), F.col("high")))
        cell = _narrowed(F.col("v"), F.col("low"), F.col("high"), turn % 4 < 2)
        cells = seen.select("og", "which", "rank", "v", cell.alias("cell")).groupBy("og", "which", "rank", "cell").agg(
            F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
        )
        # At most CELLS rows of a group and rank.
        before = Window.partitionBy("og", "which").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        placed = cells.withColumn("skipped", F.coalesce(F.sum("n").over(before), F.lit(0)))
        found = placed.filter((F.col("rank") >= F.col("skipped")) & (F.col("rank") < F.col("skipped") + F.col("n")))
        next_ = found.select(F.col("og").alias("g"), "low", "high", "which", (F.col("rank") - F.col("skipped")).alias("rank"))
        state = durable(state.filter("low >= high").unionByName(next_))
    else:
        raise RuntimeError("the histograms did not come to an end")
    return state.groupBy(F.col("g").alias(by)).agg(F.avg("low").alias("median"))


def summarize_trials(trials: DataFrame, by: str) -> DataFrame:
    """Groups of (iterations, converged, final_loss, final_distance, grad_norm) rows.

    Iteration statistics cover converged trials only and are NaN when there are none.
    """
    done = F.col("converged")
    sums = trials.groupBy(by).agg(
        (100.0 * F.avg(done.cast("double"))).alias("convergence_rate"),
        F.coalesce(F.avg(F.when(done, F.col("iterations"))), F.lit(NAN)).alias("mean_iterations"),
        F.avg("final_loss").alias("mean_final_loss"),
        F.avg("final_distance").alias("mean_final_distance"),
        F.avg("grad_norm").alias("mean_grad_norm"),
    )
    middle = exact_medians(trials.filter(done), by, "iterations").withColumnRenamed(by, "_by")
    return (
        sums.join(middle, F.col(by).eqNullSafe(F.col("_by")), "left")
        .select(
            by, "convergence_rate", "mean_iterations", F.coalesce("median", F.lit(NAN)).alias("median_iterations"),
            "mean_final_loss", "mean_final_distance", "mean_grad_norm",
        )
        # Spark orders NaN after every number, which is the wanted place.
        .orderBy("mean_iterations", by)
    )


def perplexity(loss: Column) -> Column:
    return F.exp(F.least(loss, F.lit(PERPLEXITY_LIMIT)))


def loss_reduction(history: DataFrame, run: str = "run", order: tuple[str, ...] = ("ts", "event_id")) -> DataFrame:
    """First and last loss of every run and the reduction in percent.

    A run that begins at a loss of zero has an infinite reduction, or NaN if it stays there.
    """
    at = F.struct(*order)
    ends = history.groupBy(run).agg(
        F.min_by("train_loss", at).alias("first_loss"), F.max_by("train_loss", at).alias("last_loss")
    )
    first, change = F.col("first_loss"), 100.0 * (F.col("first_loss") - F.col("last_loss"))
    # The division operator refuses zero; the power of -1 is the infinity of its sign.
    by_zero = change * F.pow(first, F.lit(-1.0))
    return ends.withColumn("reduction_pct", F.when(first == 0, by_zero).otherwise(change / first))


def epoch_losses(batches: DataFrame, epoch: str = "epoch") -> DataFrame:
    """Loss of every epoch weighted by batch rows, from rows (epoch, loss, rows)."""
    return batches.groupBy(epoch).agg(
        (F.sum(F.col("loss") * F.col("rows")) / F.sum("rows")).alias("epoch_loss"),
        F.sum("rows").alias("rows"),
    )


def best_epoch(epochs: DataFrame, epoch: str = "epoch") -> DataFrame:
    best = F.min(F.struct("epoch_loss", F.col(epoch).alias("epoch")))
    return epochs.agg(best.alias("b")).select("b.epoch", "b.epoch_loss")
