"""Losses and prediction metrics over tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusweave.functions import arrays as A
from corpusweave.functions.draws import digest_number

CLIP = 1e-15
LOG_FLOOR = 1e-12


def regression_errors(rows: DataFrame, y: str, p: str, by: list[str] | None = None, delta: float = 1.0) -> DataFrame:
    """MAE, MSE, RMSE and Huber loss per group in one pass."""
    e = F.col(y) - F.col(p)
    size = F.abs(e)
    huber = F.when(size <= delta, 0.5 * e * e).otherwise(delta * (size - 0.5 * delta))
    return rows.groupBy(*(by or [])).agg(
        F.avg(size).alias("mae"),
        F.avg(e * e).alias("mse"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(huber).alias("huber"),
    )


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def binary_cross_entropy(rows: DataFrame, y: str, p: str, by: list[str] | None = None) -> DataFrame:
    kept = F.greatest(F.lit(CLIP), F.least(F.lit(1 - CLIP), F.col(p)))
    loss = -(F.col(y) * F.log(kept) + (1 - F.col(y)) * F.log(1 - kept))
    return rows.groupBy(*(by or [])).agg(F.avg(loss).alias("bce"), F.count(F.lit(1)).alias("n"))


def probability_loss(probabilities: Column, target: Column) -> Column:
    """-ln of the probability of the target class."""
    return -F.log(F.greatest(F.get(probabilities, target), F.lit(LOG_FLOOR)))


def logit_loss(logits: Column, target: Column) -> Column:
    """Cross-entropy of one row straight from its logits."""
    return A.log_sum_exp(logits) - F.get(logits, target)


def cross_entropy(rows: DataFrame, logits: str, target: str, by: list[str] | None = None) -> DataFrame:
    # The arrays are cast once below the expressions that use them.
    ready = rows.select(*(by or []), A.doubles(logits).alias("_z"), F.col(target).alias("_t"))
    return ready.groupBy(*(by or [])).agg(
        F.avg(logit_loss(F.col("_z"), F.col("_t"))).alias("loss"), F.count(F.lit(1)).alias("n")
    )


def probabilities(rows: DataFrame, logits: str, temperature: float = 1.0, name: str = "probs") -> DataFrame:
    return rows.withColumn("_z", A.doubles(logits)).withColumn(
        name, A.softmax(F.col("_z"), temperature)
    ).drop("_z")


def predicted_class(logits: Column, temperature: float = 0.0, u: Column | None = None) -> Column:
    """Class of a row: the first largest logit at temperature 0, else drawn from softmax(z/T).

    ``u`` is the draw in [0, 1); the class is the first whose cumulative probability reaches it.
    """
    if temperature < 0:
        raise ValueError(f"a temperature of {temperature} is below 0")
    if temperature == 0:
        return (F.array_position(logits, F.array_max(logits)) - 1).cast("int")
    if u is None:
        raise ValueError("sampling needs a draw")
    start = F.struct(F.lit(0.0).alias("upto"), F.lit(0).alias("below"))

    def add(s, p):
        upto = s["upto"] + p
        return F.struct(upto.alias("upto"), (s["below"] + F.when(upto < u, 1).otherwise(0)).alias("below"))

    below = F.aggregate(A.softmax(logits, temperature), start, add, lambda s: s["below"])
    return F.least(below, F.size(logits) - 1)


def seeded_draw(key: Column, seed: int = 0) -> Column:
    """Reproducible number in (0, 1) from 52 bits of a digest of the key."""
    return (F.shiftright(digest_number(key, seed), 8) + 0.5) / float(1 << 52)


def top_classes(rows: DataFrame, logits: str, k: int, key: str) -> DataFrame:
    """The k most probable classes of every row: (key, place, class, prob); ties to the smaller class."""
    probs = rows.select(key, A.softmax(A.doubles(logits)).alias("_p"))
    pairs = F.transform("_p", lambda p, i: F.struct((-p).alias("neg"), i.alias("class")))
    best = F.slice(F.array_sort(pairs), 1, k)
    return probs.select(key, F.posexplode(best).alias("place", "b")).select(
        key, "place", F.col("b.class").alias("class"), (-F.col("b.neg")).alias("prob")
    )


def logit_gradient(logits: Column, target: Column) -> Column:
    """softmax - one-hot of one row; divide by the row count for the mean loss."""
    return F.transform(
        A.softmax(logits), lambda p, i: p - F.when(i == target, F.lit(1.0)).otherwise(F.lit(0.0))
    )


def bias_gradient(rows: DataFrame, logits: str, target: str) -> DataFrame:
    """Mean logit gradient per class, the gradient of an output bias."""
    g = rows.select(logit_gradient(A.doubles(logits), F.col(target)).alias("g"))
    return g.select(F.posexplode("g").alias("class", "v")).groupBy("class").agg(F.avg("v").alias("gradient"))
