"""Gradient fitting over tables.

The rows stay in Spark. A step is one pre-aggregated pass that sums the gradient of every setting;
only the parameter vectors, a few numbers per setting, live on the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPS = 1e-8
CLIP_EPS = 1e-6
BLOCK_ROWS = 1 << 14


@dataclass(frozen=True)
class Setting:
    """One configuration of a fit."""

    name: str
    rule: str = "sgd"
    rate: float = 0.01
    schedule: Callable[[int], float] | None = None
    clip: float | None = None
    options: dict = field(default_factory=dict)


@dataclass
class Fit:
    theta: list[float]
    losses: list[float]

    @property
    def steps(self) -> int:
        return len(self.losses)

    @property
    def first_loss(self) -> float:
        return self.losses[0]

    @property
    def last_loss(self) -> float:
        return self.losses[-1]


# --- update rules: state and gradient in, change of the parameters out -------------------------


def _sgd(g, theta, state, rate, t, decay=False):
    return -(rate / math.sqrt(t) if decay else rate) * g


def _momentum(g, theta, state, rate, t, momentum=0.9):
    state["v"] = momentum * state.get("v", 0.0) - rate * g
    return state["v"]


def _adagrad(g, theta, state, rate, t):
    state["s"] = state.get("s", 0.0) + g**2
    return -rate * g / (np.sqrt(state["s"]) + EPS)


def _rmsprop(g, theta, state, rate, t, beta=0.9):
    state["s"] = beta * state.get("s", 0.0) + (1 - beta) * g**2
    return -rate * g / (np.sqrt(state["s"]) + EPS)


def _moments(g, state, t, beta1, beta2):
    state["m"] = beta1 * state.get("m", 0.0) + (1 - beta1) * g
    state["v"] = beta2 * state.get("v", 0.0) + (1 - beta2) * g**2
    return state["m"] / (1 - beta1**t), np.sqrt(state["v"] / (1 - beta2**t)) + EPS


def _adam(g, theta, state, rate, t, beta1=0.9, beta2=0.999):
    mean, root = _moments(g, state, t, beta1, beta2)
    return -rate * mean / root


def _adamw(g, theta, state, rate, t, beta1=0.9, beta2=0.999, weight_decay=0.001):
    mean, root = _moments(g, state, t, beta1, beta2)
    return -rate * (mean / root + weight_decay * theta)


RULES = {
    "sgd": _sgd,
    "momentum": _momentum,
    "adagrad": _adagrad,
    "rmsprop": _rmsprop,
    "adam": _adam,
    "adamw": _adamw,
}


def clip_factor(norm: float, max_norm: float) -> float:
    """Scale that brings a gradient of this norm down to ``max_norm``; never above 1."""
    return min(1.0, max_norm / (norm + CLIP_EPS))


def clip_groups(vectors: DataFrame, group: str, vector: str, max_norm: float = 1.0) -> DataFrame:
    """Global norm of all vectors of a group and the factor that clips it."""
    square = F.aggregate(vector, F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
    norms = vectors.groupBy(group).agg(F.sqrt(F.sum(square)).alias("norm"))
    return norms.withColumn("factor", F.least(F.lit(1.0), F.lit(max_norm) / (F.col("norm") + CLIP_EPS)))


def warmup_cosine(step: Column, warmup: int, total: int, high: float, low: float) -> Column:
    """Learning rate of a 0-based step: linear warm-up, cosine decay, then the low rate."""
    k = step + 1
    fall = F.cos(F.lit(math.pi) * (k - warmup) / (total - warmup))
    return (
        F.when(k < warmup, high * k / warmup)
        .when(k <= total, low + 0.5 * (high - low) * (1 + fall))
        .otherwise(F.lit(low))
    )


def warmup_cosine_value(step: int, warmup: int, total: int, high: float, low: float) -> float:
    """The same schedule for one step, used inside a fit."""
    k = step + 1
    if k < warmup:
        return high * k / warmup
    if k > total:
        return low
    return low + 0.5 * (high - low) * (1 + math.cos(math.pi * (k - warmup) / (total - warmup)))


# --- the fit ------------------------------------------------------------------------------------


def _residual_and_loss(loss: str, score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if loss == "squared":
        e = score - y
        return 2 * e, e * e
    if loss == "logistic":
        p = 1 / (1 + np.exp(-np.clip(score, -700, 700)))
        kept = np.clip(p, 1e-15, 1 - 1e-15)
        return p - y, -(y * np.log(kept) + (1 - y) * np.log(1 - kept))
    raise ValueError(f"unknown loss {loss!r}")


def gradient_step(
    rows: DataFrame, thetas: Sequence[Sequence[float]], loss: str, x: str = "x", y: str = "y"
) -> list[tuple[np.ndarray, float]]:
    """Mean gradient and loss at every parameter vector, in one pass over the rows.

    Tasks score blocks of rows against all vectors at once and send one sum per number. The parameters are
    data of the task, so every step runs the same plan. Rows with a null x or y, or a null in x, are left out.
    """
    points = np.array(thetas, dtype=float)
    settings, width = points.shape

    def run(batches):
        total = np.zeros(settings * (width + 1) + 1)
        for batch in batches:
            listed, target = batch.column("x"), batch.column("y").to_numpy(zero_copy_only=False)
            for lo in range(0, batch.num_rows, BLOCK_ROWS):
                part = listed.slice(lo, BLOCK_ROWS)
                flat = part.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(part), -1)
                wide = np.column_stack([np.ones(len(flat)), flat])
                error, value = _residual_and_loss(loss, wide @ points.T, target[lo : lo + BLOCK_ROWS, None])
                total[:-1] += np.column_stack([error.T @ wide, value.sum(0)]).ravel()
                total[-1] += len(flat)
        yield pa.record_batch({"i": np.arange(len(total)), "v": total})

    known = rows.select(F.col(x).cast("array<double>").alias("x"), F.col(y).cast("double").alias("y")).dropna()
    known = known.filter(F.size("x") == width - 1).filter(~F.exists("x", lambda v: v.isNull()))
    sums = known.mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    found = np.array([v for _, v in sorted((r["i"], r["v"]) for r in sums)])
    means = (found[:-1] / max(found[-1], 1)).reshape(settings, width + 1)
    return [(row[:-1], float(row[-1])) for row in means]


def fit_many(
    rows: DataFrame,
    settings: Sequence[Setting],
    steps: int,
    loss: str = "squared",
    start: Sequence[float] | None = None,
) -> list[Fit]:
    """Fit all settings side by side on rows (x ARRAY<DOUBLE>, y), full batch, cached once."""
    for s in settings:
        if s.rate < 0:
            raise ValueError(f"setting {s.name!r} has the rate {s.rate}; it must be 0 or more")
        if s.rule not in RULES:
            raise ValueError(f"unknown update rule {s.rule!r}")
    data = rows.persist()
    try:
        if start is None:
            start = [0.0] * (1 + data.select(F.size("x")).first()[0])
        thetas = [np.array(start, dtype=float) for _ in settings]
        states: list[dict] = [{} for _ in settings]
        fits = [Fit([], []) for _ in settings]
        for step in range(steps):
            found = gradient_step(data, [t.tolist() for t in thetas], loss)
            for i, (s, (g, value)) in enumerate(zip(settings, found)):
                if s.clip is not None:
                    g = g * clip_factor(float(np.sqrt((g**2).sum())), s.clip)
                rate = s.schedule(step) if s.schedule else s.rate
                thetas[i] = thetas[i] + RULES[s.rule](g, thetas[i], states[i], rate, step + 1, **s.options)
                fits[i].losses.append(value)
        for f, t in zip(fits, thetas):
            f.theta = t.tolist()
        return fits
    finally:
        data.unpersist()


def fit(rows: DataFrame, setting: Setting, steps: int, loss: str = "squared", start=None) -> Fit:
    return fit_many(rows, [setting], steps, loss, start)[0]
