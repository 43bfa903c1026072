"""Class densities and centres as data.

Parameters of classes are tables. They go to the tasks as packed arrays, scored block by block with numpy,
so neither the plan nor its code grows with the number of classes, and there is no largest number.
More classes than one shared part holds are gone through in several parts, with the best so far kept.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusweave.functions.ordered import row_index
from corpusweave.operators.vectors import group_means
from corpusweave.session import written

LOG_2PI = math.log(2 * math.pi)
# Classes of one shared part (numbers of four columns: 32 MB), numbers of one block of scores.
PART_CLASSES = 1 << 20
BLOCK_CELLS = 1 << 22
EM_POINTS = 1 << 14


def class_gaussians(rows: DataFrame, label: str, x: str) -> DataFrame:
    """(class, mean, sigma, prior) of every class. Rows without label or x belong to none."""
    known = rows.select(F.col(label).alias("class"), F.col(x).cast("double").alias("x")).dropna()
    stats = known.groupBy("class").agg(
        F.avg("x").alias("mean"), F.stddev_pop("x").alias("sigma"), F.count(F.lit(1)).alias("n")
    )
    total = known.count()
    return stats.select("class", "mean", "sigma", (F.col("n") / F.lit(float(max(total, 1)))).alias("prior"))


def _parts(classes: DataFrame, part: int) -> Iterator[pa.Table]:
    """The table of classes in order, in parts of a fixed size."""
    n = classes.count()
    if n <= part:
        yield classes.orderBy("class").toArrow()
        return
    placed = row_index(classes, ["class"], "_at")
    for low in range(0, n, part):
        yield placed.filter((F.col("_at") >= low) & (F.col("_at") < low + part)).orderBy("_at").drop("_at").toArrow()


def log_scores(x: np.ndarray, mean: np.ndarray, sigma: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """Log prior plus log density of values (rows) under classes (columns).

    A class without spread is a point: infinite at its mean and minus infinite elsewhere.
    """
    point = sigma <= 0
    spread = np.where(point, 1.0, sigma)
    z = (x[:, None] - mean) / spread
    scores = -0.5 * z * z - np.log(spread) - 0.5 * LOG_2PI + np.log(prior)
    if point.any():
        scores[:, point] = np.where(x[:, None] == mean[point], np.inf, -np.inf)
    return scores


def _chosen(rows: DataFrame, value: str, classes: DataFrame, name: str, part: int, scores: Callable) -> DataFrame:
    """Add the class of the highest score to every row, null where the value is; ties to the smaller class.

    ``scores(values, part of the table)`` gives a matrix of values by classes. With several parts the rows
    pass by once for each, with the best class so far.
    """
    kind = classes.schema["class"].dataType.simpleString()
    kept = [c for c in rows.columns if c != name]
    out = rows.select(*[F.col(f"`{c}`") for c in kept]).withColumns(
        {"_best": F.lit(None).cast("double"), "_class": F.lit(None).cast(kind)}
    )
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields)
    columns, context = out.columns, rows.sparkSession.sparkContext

    def passed(frame: DataFrame, table: pa.Table) -> DataFrame:
        # A part has a fixed number of classes.
        shared = context.broadcast(table)

        def run(batches):
            table = shared.value
            listed = table.column("class").combine_chunks()
            step = max(BLOCK_CELLS // max(table.num_rows, 1), 1)
            for batch in batches:
                known = batch.column(value).is_valid().to_numpy(zero_copy_only=False)
                at = np.flatnonzero(known)
                best, where = np.full(len(at), -np.inf), np.zeros(len(at), np.int64)
                values = batch.column(value).take(pa.array(at))
                for lo in range(0, len(at), step):
                    made = scores(values.slice(lo, step), table)
                    where[lo : lo + step] = made.argmax(1)
                    best[lo : lo + step] = made[np.arange(len(made)), where[lo : lo + step]]
                old = batch.column("_best")
                had = old.is_valid().to_numpy(zero_copy_only=False)
                before = np.where(had, old.fill_null(0).to_numpy(zero_copy_only=False), -np.inf)
                # A part behind another one only wins with a higher score.
                wins = ~had[at] | (best > before[at])
                pick = np.full(batch.num_rows, -1)
                pick[at[wins]] = where[wins]
                before[at[wins]] = best[wins]
                fresh = listed.take(pa.array(pick, mask=pick < 0))
                classes_now = pa.array(
                    [f if p >= 0 else o for f, p, o in zip(fresh.to_pylist(), pick.tolist(), batch.column("_class").to_pylist(), strict=True)],
                    listed.type,
                ) if had.any() else fresh
                arrays = [batch.column(c) for c in columns[:-2]]
                arrays += [pa.array(before, mask=~(had | known)), classes_now]
                yield pa.RecordBatch.from_arrays(arrays, names=columns)

        return frame.mapInArrow(run, fields)

    for number, table in enumerate(_parts(classes, part)):
        if table.num_rows:
            out = passed(written(out, "class-scores") if number else out, table)
    return out.withColumnRenamed("_class", name).drop("_best")


def classify(rows: DataFrame, x: str, classes: DataFrame, name: str = "predicted", part: int = PART_CLASSES) -> DataFrame:
    """Add the class with the largest log prior plus log density of ``x`` under the table of ``class_gaussians``."""
    source = rows.withColumn("_x", F.col(x).cast("double"))

    def scores(values: pa.Array, table: pa.Table) -> np.ndarray:
        columns = [table.column(c).to_numpy() for c in ("mean", "sigma", "prior")]
        return log_scores(values.to_numpy(zero_copy_only=False), *columns)

    return _chosen(source, "_x", classes, name, part, scores).drop("_x")


def decision_boundary(m0: float, s0: float, p0: float, m1: float, s1: float, p1: float) -> float:
    """Border of two classes of equal spread, from their means, spreads and priors."""
    return (m0 + m1) / 2 + s0**2 / (m1 - m0) * math.log((p1 * s0) / (p0 * s1))


def bayes_error(classes: DataFrame, low: float, high: float, points: int, part: int = PART_CLASSES) -> float:
    """Integral of 1 - max over classes of prior times density, by the trapezoid rule on a grid.

    Classes without spread have no density and are left out. The grid is a table; sums and maxima over the
    classes of a part are kept with it.
    """
    spark = classes.sparkSession
    step = (high - low) / (points - 1)
    grid = spark.range(points).withColumns({"total": F.lit(0.0), "most": F.lit(0.0)})

    def passed(frame: DataFrame, table: pa.Table) -> DataFrame:
        shared = spark.sparkContext.broadcast(table)

        def run(batches):
            columns = [shared.value.column(c).to_numpy() for c in ("mean", "sigma", "prior")]
            size = max(BLOCK_CELLS // len(columns[0]), 1)
            for batch in batches:
                for lo in range(0, batch.num_rows, size):
                    cut = batch.slice(lo, size)
                    density = np.exp(log_scores(low + cut.column("id").to_numpy() * step, *columns))
                    total = cut.column("total").to_numpy() + density.sum(1)
                    most = np.maximum(cut.column("most").to_numpy(), density.max(1))
                    yield pa.RecordBatch.from_arrays([cut.column("id"), pa.array(total), pa.array(most)], names=["id", "total", "most"])

        return frame.mapInArrow(run, "id long, total double, most double")

    for number, table in enumerate(_parts(classes.filter("sigma > 0"), part)):
        if table.num_rows:
            grid = passed(written(grid, "class-grid") if number else grid, table)
    weight = F.when((F.col("id") == 0) | (F.col("id") == points - 1), 0.5).otherwise(1.0)
    return grid.agg(F.sum(weight * (F.col("total") - F.col("most")) * step)).first()[0]


# --- centres ----------------------------------------------------------------------------------


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def squared_distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Matrix of squared distances, dimension by dimension, without cancellation."""
    out = np.zeros((len(points), len(centres)))
    for k in range(points.shape[1]):
        out += (points[:, k : k + 1] - centres[:, k]) ** 2
    return out


def nearest_centre(rows: DataFrame, vector: str, centres: DataFrame, name: str = "cluster", part: int | None = None) -> DataFrame:
    """Add the class of the closest centre; ``centres`` is (class, centre array). Ties to the smaller class."""
    # A part holds as many numbers, whatever the length of a vector.
    part = part or max(PART_CLASSES // max(centres.select(F.max(F.size("centre"))).first()[0] or 1, 1), 1)

    def scores(values: pa.Array, table: pa.Table) -> np.ndarray:
        return -squared_distances(_matrix(values), _matrix(table.column("centre").combine_chunks()))

    return _chosen(rows, vector, centres, name, part, scores)


def _class_sums(rows: DataFrame, vector: str, label: str) -> DataFrame:
    """(class, n, sums) from one partial sum per task and class."""
    return group_means(rows.filter(F.col(label).isNotNull()), label, vector).select(
        F.col(label).alias("class"), F.col("mean").alias("centre")
    )


def kmeans(rows: DataFrame, vector: str, start: DataFrame, rounds: int = 100, name: str = "cluster") -> tuple[DataFrame, DataFrame]:
    """Lloyd's rounds from the centres ``start`` (class, centre): (rows with their cluster, centres).

    Stops at the fixed point, when no centre moves. A centre that loses all its rows stays where it is.
    Centres are a table throughout; sums are one row per task and class.
    """
    centres = written(start, "centres")
    for _ in range(rounds):
        assigned = nearest_centre(rows, vector, centres, name)
        moved = _class_sums(assigned, vector, name).withColumnRenamed("centre", "new")
        after = written(
            centres.join(moved, "class", "left").select("class", F.coalesce("new", F.col("centre").cast("array<double>")).alias("centre")),
            "centres",
        )
        both = centres.join(after.withColumnRenamed("centre", "new"), "class")
        shift = F.aggregate(F.zip_with("centre", "new", lambda a, b: F.abs(a - b)), F.lit(0.0), lambda a, b: F.greatest(a, b))
        still = (both.agg(F.max(shift)).first()[0] or 0.0) <= 1e-12
        centres = after
        if still:
            break
    return nearest_centre(rows, vector, centres, name), centres


# --- mixtures ---------------------------------------------------------------------------------

# Added to the diagonal of every covariance, so that a component of few rows keeps one.
COVARIANCE_FLOOR = 1e-6
EM_ROUNDS = 200


@dataclass(frozen=True)
class Mixture:
    """Weights (k), means (k x d) and covariances (k x d x d); a few numbers whatever the rows."""

    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray

    def log_joint(self, points: np.ndarray) -> np.ndarray:
        """Log weight plus log density of points (rows) under components (columns)."""
        out = np.empty((len(points), len(self.weights)))
        for k, (weight, mean, covariance) in enumerate(zip(self.weights, self.means, self.covariances, strict=True)):
            root = np.linalg.cholesky(covariance)
            z = np.linalg.solve(root, (points - mean).T)
            half = np.log(np.diag(root)).sum() + 0.5 * len(mean) * LOG_2PI
            out[:, k] = np.log(weight) - half - 0.5 * (z * z).sum(0)
        return out

    def responsibilities(self, points: np.ndarray) -> tuple[np.ndarray, float]:
        joint = self.log_joint(points)
        top = joint.max(1, keepdims=True)
        share = np.exp(joint - top)
        total = share.sum(1, keepdims=True)
        return share / total, float((top + np.log(total)).sum())


def _point_sums(rows: DataFrame, vector: str, block: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of ``block(points)`` over all rows with a vector, summed in tasks and then in Spark."""

    def run(batches):
        total = None
        for batch in batches:
            known = batch.column(0).drop_null()
            for lo in range(0, len(known), EM_POINTS):
                made = block(_matrix(known.slice(lo, EM_POINTS)))
                total = made if total is None else total + made
        if total is not None:
            yield pa.record_batch({"i": np.arange(len(total)), "v": total})

    found = rows.select(vector).mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v"))
    listed = sorted((r["i"], r["v"]) for r in found.collect())
    return np.array([v for _, v in listed])


def fit_mixture(
    rows: DataFrame, vector: str, start: np.ndarray, rounds: int = EM_ROUNDS, tolerance: float = 1e-8
) -> Mixture:
    """Gaussian mixture with full covariances from the means ``start``, by expectation and maximisation.

    A round is one scan that sums responsibilities, first and second moments around the overall mean. It
    ends at a fixed point: when no weight moves by more than ``tolerance`` and no mean by more than that share
    of the overall deviation. A component that has lost all rows keeps its parameters and a vanishing weight.
    """
    k, d = start.shape
    n, *sums = _point_sums(rows, vector, lambda p: np.concatenate([[len(p)], p.sum(0)]))
    centre = np.array(sums) / n
    square = _point_sums(rows, vector, lambda p: ((p - centre).T @ (p - centre)).ravel()).reshape(d, d) / n
    floor = COVARIANCE_FLOOR * np.eye(d)
    model = Mixture(np.full(k, 1 / k), start - centre, np.repeat((square + floor)[None], k, axis=0))
    scale = np.sqrt(np.diag(square) + COVARIANCE_FLOOR)
    for _ in range(rounds):
        now = model

        def block(points: np.ndarray) -> np.ndarray:
            off = points - centre
            share, likelihood = now.responsibilities(off)
            second = [(off * share[:, [j]]).T @ off for j in range(k)]
            return np.concatenate([[likelihood], share.sum(0), (share.T @ off).ravel(), np.ravel(second)])

        s = _point_sums(rows, vector, block)
        mass, first, second = s[1 : k + 1], s[k + 1 : k + 1 + k * d].reshape(k, d), s[k + 1 + k * d :].reshape(k, d, d)
        alive = mass > 1e-8
        safe = np.where(alive, mass, 1.0)
        means = np.where(alive[:, None], first / safe[:, None], now.means)
        spread = second / safe[:, None, None] - means[:, :, None] * means[:, None, :] + floor
        model = Mixture(np.maximum(mass / n, 1e-300), means, np.where(alive[:, None, None], spread, now.covariances))
        moved = max(np.abs(model.weights - now.weights).max(), np.abs((model.means - now.means) / scale).max())
        if moved <= tolerance:
            break
    return Mixture(model.weights, model.means + centre, model.covariances)


def mixture(rows: DataFrame, vector: str, model: Mixture) -> DataFrame:
    """Adds the component and all responsibilities; null where the vector is."""
    names = [c for c in rows.columns if c not in ("component", "responsibilities")]
    source = rows.select(*names)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields]

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, EM_POINTS):
                part = batch.slice(lo, EM_POINTS)
                known = part.column(vector).is_valid().to_numpy(zero_copy_only=False)
                at = np.cumsum(known) - 1
                share = model.responsibilities(_matrix(part.column(vector).drop_null()))[0] if known.any() else np.zeros((0, 1))
                pick = pa.array(at, mask=~known)
                offsets = pa.array(np.arange(len(share) + 1, dtype=np.int32) * share.shape[1])
                lists = pa.ListArray.from_arrays(offsets, pa.array(share.ravel()))
                first = pa.array(share.argmax(1).astype(np.int32))
                arrays = [*[part.column(c) for c in names], first.take(pick), lists.take(pick)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*names, "component", "responsibilities"])

    return source.mapInArrow(run, ", ".join([*fields, "component int, responsibilities array<double>"]))
