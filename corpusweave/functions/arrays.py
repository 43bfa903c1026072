"""Numeric array expressions that stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(v: Column | str) -> Column:
    return (F.col(v) if isinstance(v, str) else v).cast("array<double>")


def total(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it many times in ``body``.

    A lambda evaluates everything inside it for every element, so anything constant over the
    elements has to be bound outside.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def softmax(z: Column, temperature: float = 1.0) -> Column:
    """Stable softmax of z / temperature."""
    if temperature <= 0:
        raise ValueError("temperature must be positive")
    scaled = z if temperature == 1.0 else F.transform(z, lambda x: x / temperature)
    return let(
        scaled,
        lambda v: let(
            F.array_max(v),
            lambda top: let(
                F.transform(v, lambda x: F.exp(x - top)),
                lambda e: let(total(e), lambda s: F.transform(e, lambda x: x / s)),
            ),
        ),
    )


def log_sum_exp(z: Column) -> Column:
    return let(
        F.array_max(z),
        lambda top: top + F.log(F.aggregate(z, F.lit(0.0), lambda a, x: a + F.exp(x - top))),
    )


def standardize(v: Column, eps: float) -> Column:
    """Zero mean and unit population variance."""
    return let(
        total(v) / F.size(v),
        lambda mean: let(
            F.transform(v, lambda x: x - mean),
            lambda c: let(
                F.pow(dot(c, c) / F.size(c) + eps, F.lit(-0.5)),
                lambda s: F.transform(c, lambda x: x * s),
            ),
        ),
    )


def weighted_sum(weights: Column, vectors: Column) -> Column:
    """Sum of vectors[i] * weights[i], one pass over the vectors."""
    pairs = F.arrays_zip(weights.alias("w"), vectors.alias("v"))
    start = F.transform(F.get(vectors, F.lit(0)), lambda x: F.lit(0.0))
    return F.aggregate(
        pairs, start, lambda acc, p: F.zip_with(acc, p["v"], lambda a, x: a + p["w"] * x)
    )
