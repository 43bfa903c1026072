"""Linear models from one Gram matrix (M2, M3, M8) and logistic models from Newton sums (M4).

Tasks multiply blocks of rows into small matrices, whose entries are summed in Spark. Every penalty and
every degree is then solved on the driver from the same matrix, so a whole curve costs one scan. A matrix
has (features + 2) squared entries, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 1 << 15
# Coordinate descent and Newton steps stop when nothing moves by more than this share.
TOLERANCE = 1e-13
MOST_ROUNDS = 100_000
NEWTON_ROUNDS = 50


def matrix_sums(rows: DataFrame, columns: Sequence[str], block: Callable[[np.ndarray], np.ndarray], by: str | None = None) -> dict:
    """Sum of ``block(values)`` over blocks of rows, per value of ``by``: {group: array}.

    Rows with a null among the columns are left out.
    """
    chosen = rows.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)], *([F.col(by).alias("g")] if by else []))
    chosen = chosen.dropna(subset=[f"v{i}" for i in range(len(columns))])
    names = [f"v{i}" for i in range(len(columns))]

    def run(batches):
        total: dict = {}
        for batch in batches:
            groups = batch.column("g").to_numpy(zero_copy_only=False) if by else np.zeros(batch.num_rows, np.int8)
            values = np.stack([batch.column(c).to_numpy() for c in names], 1)
            for group in dict.fromkeys(groups.tolist()):
                part = values[groups == group]
                for lo in range(0, len(part), BLOCK_ROWS):
                    made = block(part[lo : lo + BLOCK_ROWS])
                    total[group] = made if group not in total else total[group] + made
        for group, made in total.items():
            flat = made.ravel()
            yield pa.record_batch(
                {"g": [None if not by else group] * len(flat), "i": np.arange(len(flat)), "v": flat.astype(float)},
                schema=pa.schema([("g", pa.string()), ("i", pa.int64()), ("v", pa.float64())]),
            )

    found = chosen.mapInArrow(run, "g string, i long, v double").groupBy("g", "i").agg(F.sum("v").alias("v")).collect()
    out: dict = {}
    for r in found:
        out.setdefault(r["g"], {})[r["i"]] = r["v"]
    return {g: np.array([cells[i] for i in range(len(cells))]) for g, cells in out.items()}


def centred_gram(rows: DataFrame, features: Sequence[str], y: str) -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, means, sums of centred products) of the features and, last, y.

    Centring first keeps products of large means out of the sums.
    """
    names = [*features, y]
    whole = rows.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(names)]).dropna()
    first = whole.agg(F.count(F.lit(1)), *[F.avg(f"v{i}") for i in range(len(names))]).first()
    if not first[0]:
        raise ValueError("a linear model needs rows without nulls")
    means = np.array(first[1:])
    k = len(names)

    def products(values: np.ndarray) -> np.ndarray:
        off = values - means
        return off.T @ off

    sums = matrix_sums(rows, names, products)[None]
    return int(first[0]), means, sums.reshape(k, k)


def ridge_weights(gram: np.ndarray, alpha: float) -> np.ndarray:
    """Minimum of the sum of squares plus ``alpha`` times the squared weights; the intercept is free."""
    xx, xy = gram[:-1, :-1], gram[:-1, -1]
    return np.linalg.solve(xx + alpha * np.eye(len(xx)), xy)


def lasso_weights(gram: np.ndarray, alpha: float) -> np.ndarray:
    """Minimum of the sum of squares plus ``alpha`` times the absolute weights, by coordinate descent."""
    xx, xy = gram[:-1, :-1], gram[:-1, -1]
    w = np.zeros(len(xx))
    for _ in range(MOST_ROUNDS):
        moved = 0.0
        for j in range(len(w)):
            if xx[j, j] <= 0:
                continue
            rest = xy[j] - xx[j] @ w + xx[j, j] * w[j]
            new = np.sign(rest) * max(abs(rest) - alpha / 2, 0.0) / xx[j, j]
            moved = max(moved, abs(new - w[j]))
            w[j] = new
        if moved <= TOLERANCE * max(np.abs(w).max(), 1e-300):
            break
    return w


def penalized_fit(rows: DataFrame, features: list[str], y: str, alphas: Sequence[float], lasso: bool = False) -> DataFrame:
    """(alpha, term, value) for every penalty, from one scan for the means and one for the products."""
    _, means, gram = centred_gram(rows, features, y)
    out = []
    for alpha in alphas:
        w = (lasso_weights if lasso else ridge_weights)(gram, alpha)
        out.append((float(alpha), "intercept", float(means[-1] - w @ means[:-1])))
        out += [(float(alpha), f, float(v)) for f, v in zip(features, w, strict=True)]
    return rows.sparkSession.createDataFrame(out, "alpha double, term string, value double")


# --- polynomials ------------------------------------------------------------------------------


def polynomial_grams(rows: DataFrame, x: str, y: str, degree: int, split: str = "split") -> dict[str, tuple[float, np.ndarray]]:
    """{split: (centre of y, Gram matrix)} of Legendre polynomials up to ``degree`` and, last, y.

    The polynomials are orthogonal on [-1, 1], so the matrix stays well conditioned where powers of x do not.
    """
    centre = rows.agg(F.avg(F.col(y).cast("double"))).first()[0] or 0.0

    def products(values: np.ndarray) -> np.ndarray:
        basis = np.polynomial.legendre.legvander(values[:, 0], degree)
        wide = np.column_stack([basis, values[:, 1] - centre])
        return wide.T @ wide

    found = matrix_sums(rows, [x, y], products, split)
    return {g: (centre, m.reshape(degree + 2, degree + 2)) for g, m in found.items()}


def _powers_of_legendre(degree: int) -> np.ndarray:
    """Row k: the coefficients of x**k, k >= 1, in terms of Legendre coefficients."""
    powers = np.zeros((degree + 1, degree + 1))
    for k in range(degree + 1):
        one = np.zeros(degree + 1)
        one[k] = 1
        listed = np.polynomial.legendre.leg2poly(one)
        powers[: len(listed), k] = listed
    return powers[1:]


def polynomial_risk(rows: DataFrame, x: str, y: str, degrees: Sequence[int], ridge: float = 0.0) -> DataFrame:
    """Train and test MSE by degree on rows with ``split``; ``x`` should be scaled to [-1, 1].

    ``ridge`` weighs the squares of the coefficients of x, x**2, ..., not of the constant. The matrix of a
    lower degree is a corner of that of the highest one, so all degrees come from one scan. A split without
    rows has a null risk.
    """
    grams = polynomial_grams(rows, x, y, max(degrees))
    if "train" not in grams:
        raise ValueError("no row of the split 'train' has both x and y")
    out = []
    for degree in degrees:
        keep = [*range(degree + 1), max(degrees) + 1]
        corner = {g: m[np.ix_(keep, keep)] for g, (_, m) in grams.items()}
        xx, xy = corner["train"][:-1, :-1], corner["train"][:-1, -1]
        powers = _powers_of_legendre(degree)
        w = np.linalg.solve(xx + ridge * powers.T @ powers, xy)
        weights = np.append(-w, 1.0)
        # Legendre polynomial 0 is 1, so its square sums to the number of rows.
        mse = {g: float(weights @ m @ weights / m[0, 0]) for g, m in corner.items()}
        out.append((degree, mse.get("train"), mse.get("test")))
    return rows.sparkSession.createDataFrame(out, "degree int, train_mse double, test_mse double")


# --- logistic ---------------------------------------------------------------------------------


def logistic_weights(rows: DataFrame, features: Sequence[str], label: str, c: float = 1.0) -> np.ndarray:
    """(intercept, weights): minimum of the sum of losses plus the squared weights over 2c, by Newton steps.

    Each step is one scan that sums gradient and curvature; parameters travel with the task, not in its code.
    Steps are halved while the loss would grow. Labels are 0 and 1; rows with nulls are left out.
    """
    k = len(features) + 1
    at, pull = np.zeros(k), np.append(0.0, np.full(k - 1, 1.0 / c))

    def sums_at(point: np.ndarray):
        def block(values: np.ndarray) -> np.ndarray:
            wide = np.column_stack([np.ones(len(values)), values[:, :-1]])
            margin, y = wide @ point, values[:, -1]
            p = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
            loss = np.logaddexp(0, margin).sum() - y @ margin
            return np.concatenate([[loss], wide.T @ (p - y), (wide.T @ (wide * (p * (1 - p))[:, None])).ravel()])

        found = matrix_sums(rows, [*features, label], block)
        if not found:
            raise ValueError("a logistic model needs rows without nulls")
        s = found[None]
        curve = s[k + 1 :].reshape(k, k) + np.diag(pull)
        return s[0] + pull @ point**2 / 2, s[1 : k + 1] + pull * point, curve

    loss, slope, curve = sums_at(at)
    for _ in range(NEWTON_ROUNDS):
        step = np.linalg.solve(curve + 1e-12 * np.eye(k), slope)
        if np.abs(step).max() <= 1e-11 * max(1.0, np.abs(at).max()):
            break
        share = 1.0
        while True:
            new = sums_at(at - share * step)
            if new[0] <= loss + 1e-9 * abs(loss) or share < 1e-6:
                break
            share /= 2
        at = at - share * step
        loss, slope, curve = new
    return at


def logistic_probability(rows: DataFrame, features: list[str], label: str, c: float = 1.0) -> DataFrame:
    """Adds the fitted probability of class 1; null where a feature is null."""
    at = logistic_weights(rows, features, label, c).tolist()
    margin: Column = F.lit(at[0])
    for weight, name in zip(at[1:], features, strict=True):
        margin = margin + F.lit(weight) * F.col(name)
    return rows.withColumn("p", 1 / (1 + F.exp(-margin)))
