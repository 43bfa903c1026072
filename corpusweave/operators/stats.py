"""Statistical learning as aggregates over tables."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusweave.functions.draws import DIGEST_DIGITS, digest, digest_number
from corpusweave.functions.ordered import Fold, row_index, with_ordered
from corpusweave.operators import gram

LOG_2PI = math.log(2 * math.pi)


# --- lines and splits -----------------------------------------------------------------------------


def line_fit(rows: DataFrame, x: str, y: str, by: list[str]) -> DataFrame:
    """Least-squares line and residual standard deviation per group, from one aggregation."""
    sums = rows.groupBy(*by).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.var_pop(y).alias("_vy"),
        F.var_pop(x).alias("_vx"),
        F.count(F.lit(1)).alias("n"),
    )
    left = F.greatest(F.lit(0.0), F.col("_vy") - F.col("slope") * F.col("slope") * F.col("_vx"))
    return sums.select(*by, "slope", "intercept", F.sqrt(left).alias("sigma"), "n")


def line_band(rows: DataFrame, fits: DataFrame, x: str, by: list[str]) -> DataFrame:
    """Prediction of every row with a band of two standard deviations."""
    out = rows.join(fits.select(*by, "slope", "intercept", "sigma"), by)
    predicted = F.col("slope") * F.col(x) + F.col("intercept")
    return out.select(
        *rows.columns,
        predicted.alias("predicted"),
        (predicted - 2 * F.col("sigma")).alias("low"),
        (predicted + 2 * F.col("sigma")).alias("high"),
    )


def hash_split(rows: DataFrame, key: str, test_fraction: float, seed: int = 0) -> DataFrame:
    """``split`` train or test from the key alone: stable however the rows are partitioned."""
    cut = int(test_fraction * 16**DIGEST_DIGITS)
    return rows.withColumn(
        "split", F.when(digest_number(F.col(key), seed) < cut, F.lit("test")).otherwise(F.lit("train"))
    )


def risk_by_split(rows: DataFrame, x: str, y: str) -> DataFrame:
    """Squared risk of the line fitted on the train rows, on both splits, and the gap."""
    fit = line_fit(rows.filter("split = 'train'"), x, y, []).first()
    error = F.col(y) - (fit["slope"] * F.col(x) + fit["intercept"])
    risks = rows.agg(
        F.avg(F.when(F.col("split") == "train", error * error)).alias("train_risk"),
        F.avg(F.when(F.col("split") == "test", error * error)).alias("test_risk"),
    )
    return risks.withColumn("gap", F.col("test_risk") - F.col("train_risk"))


def penalized_fit(rows: DataFrame, features: list[str], y: str, alpha: float, lasso: bool = False) -> DataFrame:
    """Ridge or lasso coefficients; ``alpha`` weighs the sum of squares, not their mean."""
    return gram.penalized_fit(rows, features, y, [alpha], lasso).drop("alpha")


def learning_curve(
    rows: DataFrame, x: str, y: str, order: list[str], folds: int = 5, steps: int = 10
) -> DataFrame:
    """Train and validation MSE of a line over growing training sets, k contiguous folds.

    All fits come from one aggregation: rows are summed per segment between the borders of folds
    and training sets, and every fit adds up its segments.
    """
    # Sums around the means: squares of large values would cancel.
    total, mean_x, mean_y = rows.agg(F.count(F.lit(1)), F.avg(x), F.avg(y)).first()
    placed = row_index(
        rows.select(*order, (F.col(x) - mean_x).alias("_x"), (F.col(y) - mean_y).alias("_y")), order, "_at"
    )
    starts = [f * (total // folds) + min(f, total % folds) for f in range(folds + 1)]
    spans = list(zip(starts, starts[1:]))
    most = total - (spans[0][1] - spans[0][0])
    sizes = [int((i + 1) / steps * most + 1e-9) for i in range(steps)]
    ends = {m if m <= a else m + (b - a) for m in sizes for a, b in spans}
    borders = sorted({*starts, *ends} - {0})
    segment = sum((F.when(F.col("_at") >= b, 1).otherwise(0) for b in borders), F.lit(0))
    sums = placed.select(segment.alias("_seg"), "_x", "_y").groupBy("_seg").agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.sum("_x").alias("x"),
        F.sum("_y").alias("y"),
        F.sum(F.col("_x") * F.col("_x")).alias("xx"),
        F.sum(F.col("_x") * F.col("_y")).alias("xy"),
        F.sum(F.col("_y") * F.col("_y")).alias("yy"),
    )
    found = {r["_seg"]: tuple(r[c] for c in ("n", "x", "y", "xx", "xy", "yy")) for r in sums.collect()}
    lows = [0, *borders]

    def add(keep):
        chosen = [found[s] for s, low in enumerate(lows) if s in found and keep(low)]
        return tuple(map(sum, zip(*chosen)))

    def risk(s, slope, intercept):
        n, sx, sy, sxx, sxy, syy = s
        sse = syy - 2 * slope * sxy - 2 * intercept * sy + slope**2 * sxx + 2 * slope * intercept * sx + n * intercept**2
        return sse / n

    results = []
    for m in sizes:
        train, val = [], []
        for a, b in spans:
            end = m if m <= a else m + (b - a)
            s = add(lambda low: low < end and not a <= low < b)
            n, sx, sy, sxx, sxy, _ = s
            slope = (n * sxy - sx * sy) / (n * sxx - sx * sx)
            intercept = (sy - slope * sx) / n
            train.append(risk(s, slope, intercept))
            val.append(risk(add(lambda low: a <= low < b), slope, intercept))
        row = [m]
        for errors in (train, val):
            mean = sum(errors) / folds
            row += [mean, math.sqrt(sum((e - mean) ** 2 for e in errors) / folds)]
        results.append(tuple(row))
    return rows.sparkSession.createDataFrame(
        results, "train_size long, train_mean double, train_std double, val_mean double, val_std double"
    )


# --- densities ------------------------------------------------------------------------------


def normal_log_density(x: Column, mean, sigma) -> Column:
    z = (x - mean) / sigma
    log_sigma = math.log(sigma) if isinstance(sigma, float) else F.log(sigma)
    return -0.5 * z * z - log_sigma - 0.5 * LOG_2PI


def moments(rows: DataFrame, x: str, by: list[str]) -> DataFrame:
    """Mean and both variances (divided by n and by n-1)."""
    return rows.groupBy(*by).agg(
        F.avg(x).alias("mean"), F.var_pop(x).alias("var_n"), F.var_samp(x).alias("var_n1"), F.count(F.lit(1)).alias("n")
    )


def estimator_quality(rows: DataFrame, x: str, key: str, replicates: int, shift: float = 0.5, seed: int = 0) -> DataFrame:
    """Bias, variance and MSE of the mean and of a shifted mean over replicates drawn by digests of the key."""
    truth = rows.agg(F.avg(x).alias("theta")).first()["theta"]
    means = rows.groupBy((digest_number(F.col(key), seed) % replicates).alias("_r")).agg(F.avg(x).alias("_m"))
    listed = means.select(
        F.inline(
            F.array(
                F.struct(F.lit("mean").alias("estimator"), F.col("_m").alias("_e")),
                F.struct(F.lit("shifted").alias("estimator"), (F.col("_m") + shift).alias("_e")),
            )
        )
    )
    out = listed.groupBy("estimator").agg(
        (F.avg("_e") - truth).alias("bias"), F.var_pop("_e").alias("variance")
    )
    return out.withColumn("mse", F.col("bias") * F.col("bias") + F.col("variance"))


def resample_weight(key: Column, replicate: Column) -> Column:
    """Poisson(1) weight of a row in a replicate, drawn anew for each pair of row and replicate.

    The hex digits of a digest order as its number does, so they are compared with the borders as they are.
    """
    borders = [f"{c:0{DIGEST_DIGITS}x}" for c in poisson_cuts()]

    def weight(drawn: Column) -> Column:
        found = F.when(drawn < borders[0], 0)
        for k, border in enumerate(borders[1:], 1):
            found = found.when(drawn < border, k)
        return found.otherwise(len(borders))

    # The array of one holds the digest, so that it is taken once and not for every border.
    return F.transform(F.array(digest(key, replicate)), weight)[0]


def poisson_cuts() -> list[int]:
    """Borders of the Poisson(1) distribution on the range of ``digest_number``."""
    upto, cuts = 0.0, []
    for k in range(18):
        upto += math.exp(-1) / math.factorial(k)
        cuts.append(round(upto * 16**DIGEST_DIGITS))
    return [c for c in cuts if c < 16**DIGEST_DIGITS]


def bias_variance(rows: DataFrame, x: str, y: str, key: str, at: float, replicates: int) -> DataFrame:
    """Bias, variance and noise of a line's prediction at ``at`` over resampled training sets.

    One aggregation serves all replicates; the truth is the mean of y where x equals ``at``.
    """
    spot = rows.agg(
        F.avg(F.when(F.col(x) == at, F.col(y))).alias("truth"),
        F.var_pop(F.when(F.col(x) == at, F.col(y))).alias("noise"),
    ).first()
    drawn = rows.select(
        F.col(x).alias("_x"), F.col(y).alias("_y"), F.col(key).cast("long").alias("_k"),
        F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("_r"),
    ).withColumn("_w", resample_weight(F.col("_k"), F.col("_r").cast("long")))
    # A filter by the weight would draw it twice, so rows without weight are left out of the sums instead.
    w, vx, vy = F.when(F.col("_w") > 0, F.col("_w")), F.col("_x"), F.col("_y")
    fits = drawn.groupBy("_r").agg(
        F.sum(w).alias("n"), F.sum(w * vx).alias("sx"), F.sum(w * vy).alias("sy"),
        F.sum(w * vx * vx).alias("sxx"), F.sum(w * vx * vy).alias("sxy"),
    ).filter("n > 0")
    slope = F.expr("(n * sxy - sx * sy) / (n * sxx - sx * sx)")
    predicted = fits.withColumn("_b", slope).select((F.expr("(sy - _b * sx) / n") + F.col("_b") * at).alias("_p"))
    out = predicted.agg(F.avg("_p").alias("_mean"), F.var_pop("_p").alias("variance"))
    bias = F.col("_mean") - spot["truth"]
    return out.select(
        (bias * bias).alias("bias2"), "variance", F.lit(spot["noise"]).alias("noise"),
        (bias * bias + F.col("variance") + spot["noise"]).alias("mse"),
    )


# --- likelihood and posteriors -----------------------------------------------------------------------


def fit_families(rows: DataFrame, x: str, event: Column, by: list[str]) -> DataFrame:
    """Maximum-likelihood parameters per group: Normal, Exponential and Bernoulli of an event."""
    return rows.groupBy(*by).agg(
        F.avg(x).alias("mean"),
        F.stddev_pop(x).alias("sigma"),
        (1 / F.avg(x)).alias("rate"),
        F.avg(event.cast("double")).alias("p"),
        F.count(F.lit(1)).alias("n"),
    )


def score_families(rows: DataFrame, x: str, event: Column, by: list[str]) -> DataFrame:
    """Mean log-likelihood per group under each fitted family, and the better one for ``x``."""
    fits = fit_families(rows, x, event, by)
    both = rows.withColumn("_event", event).join(fits, by)
    normal = normal_log_density(F.col(x), F.col("mean"), F.col("sigma"))
    exponential = F.when(F.col(x) >= 0, F.log("rate") - F.col("rate") * F.col(x)).otherwise(F.lit(float("-inf")))
    bernoulli = F.when(F.col("_event"), F.log("p")).otherwise(F.log(1 - F.col("p")))
    out = both.groupBy(*by).agg(
        F.avg(normal).alias("normal"), F.avg(exponential).alias("exponential"), F.avg(bernoulli).alias("bernoulli")
    )
    return out.withColumn(
        "family", F.when(F.col("normal") >= F.col("exponential"), F.lit("normal")).otherwise(F.lit("exponential"))
    )


def _grid(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def gaussian_grid(rows: DataFrame, x: str, by: list[str], means: Sequence[float], sigmas: Sequence[float]) -> DataFrame:
    """Log-likelihood on a grid from n, mean and variance: the rows are read once, and no large squares cancel."""
    v = F.col(x).cast("double")
    stats = rows.groupBy(*by).agg(F.count(v).alias("n"), F.avg(v).alias("m"), F.var_pop(v).alias("v"))
    cells = stats.withColumn("mu", F.explode(_grid(means))).withColumn("sigma", F.explode(_grid(sigmas)))
    return cells.select(
        *by, "mu", "sigma",
        F.expr(
            f"-n * ln(sigma) - 0.5D * n * {LOG_2PI}D - n * (v + (m - mu) * (m - mu)) / (2 * sigma * sigma)"
        ).alias("log_likelihood"),
    )


def line_grid(
    rows: DataFrame, x: str, y: str, by: list[str], intercepts: Sequence[float], slopes: Sequence[float], sigma: float
) -> DataFrame:
    """Log-likelihood of a line with known noise on a grid, from the means and centred second moments."""
    both = rows.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    stats = both.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(x).alias("mx"), F.avg(y).alias("my"),
        F.var_pop(x).alias("vx"), F.var_pop(y).alias("vy"), F.covar_pop(x, y).alias("cxy"),
    )
    cells = stats.withColumn("b0", F.explode(_grid(intercepts))).withColumn("b1", F.explode(_grid(slopes)))
    off = "(my - b0 - b1 * mx)"
    sse = f"n * (vy - 2 * b1 * cxy + b1 * b1 * vx + {off} * {off})"
    return cells.select(
        *by, "b0", "b1",
        F.expr(f"-n * ln({sigma}D) - 0.5D * n * {LOG_2PI}D - {sse} / (2 * {sigma}D * {sigma}D)").alias("log_likelihood"),
    )


def _with_part(state: Column, part: Column) -> Column:
    """Count, mean and sum of squared deviations of two parts together."""
    n = state["n"] + part["n"]
    gap = part["m"] - state["m"]
    return F.when(part["n"] == 0, state).when(state["n"] == 0, part).otherwise(
        F.struct(
            n.alias("n"),
            (state["m"] + gap * part["n"] / n).alias("m"),
            (state["q"] + part["q"] + gap * gap * state["n"] * part["n"] / n).alias("q"),
        )
    )


def running_mle(rows: DataFrame, key: str, order: list[str], x: str) -> DataFrame:
    """Mean and standard deviation of every prefix of a key: adds n, mu and sigma.

    Deviations are taken from running means, inside a block of rows and between blocks, so large values with
    a small spread keep their digits. A null value counts in neither.
    """
    v = F.col(x).cast("double")
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("m"), F.lit(0.0).alias("q"))

    def part(n: Column, m: Column, s: Column) -> Column:
        return F.struct(n.alias("n"), F.coalesce(m, F.lit(0.0)).alias("m"), F.coalesce(s * n, F.lit(0.0)).alias("q"))

    out = with_ordered(
        rows, [key], order,
        folds={
            "_p": Fold(
                lambda over: part(F.count(v).over(over), F.avg(v).over(over), F.var_pop(v).over(over)),
                part(F.count(v), F.avg(v), F.var_pop(v)),
                lambda parts: F.aggregate(parts, zero, _with_part),
                _with_part,
            )
        },
    )
    return out.select(
        *rows.columns, F.col("_p.n").alias("n"), F.when(F.col("_p.n") > 0, F.col("_p.m")).alias("mu"),
        F.when(F.col("_p.n") > 0, F.sqrt(F.col("_p.q") / F.col("_p.n"))).alias("sigma"),
    )


def _posterior(n: Column, heads: Column, alpha: float, beta: float) -> list[Column]:
    a, b = heads + alpha, n - heads + beta
    return [
        a.alias("alpha"),
        b.alias("beta"),
        F.when(a + b > 2, (a - 1) / (a + b - 2)).otherwise(F.lit(0.5)).alias("map"),
        (a / (a + b)).alias("posterior_mean"),
        F.when(n > 0, heads / n).otherwise(F.lit(0.5)).alias("mle"),
    ]


def sequential_beta(
    rows: DataFrame, key: str, order: list[str], success: Column, alpha: float = 2.0, beta: float = 2.0
) -> DataFrame:
    """Beta-Binomial posterior after every observation of a key."""
    out = with_ordered(rows, [key], order, index="_at", sums={"_h": success.cast("long")})
    n = F.col("_at") + 1
    return out.select(*rows.columns, n.alias("n"), F.col("_h").alias("heads"), *_posterior(n, F.col("_h"), alpha, beta))


def group_beta(rows: DataFrame, by: list[str], success: Column, alpha: float = 2.0, beta: float = 2.0) -> DataFrame:
    """Posterior after all observations of a group; needs only sums, so order does not matter."""
    sums = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(success.cast("long")).alias("heads"))
    return sums.select(*by, "n", "heads", *_posterior(F.col("n"), F.col("heads"), alpha, beta))


def slope_posterior(rows: DataFrame, x: str, y: str, by: list[str], tau: float, sigma: float, at: float) -> DataFrame:
    """Normal posterior of the slope of y = b*x and the predictive deviation at ``at``."""
    u, v = F.col(x), F.col(y)
    sums = rows.groupBy(*by).agg(F.sum(u * u).alias("sxx"), F.sum(u * v).alias("sxy"))
    out = sums.withColumn("post_var", 1 / (1 / (tau * tau) + F.col("sxx") / (sigma * sigma)))
    return out.select(
        *by, "post_var", (F.col("post_var") * F.col("sxy") / (sigma * sigma)).alias("post_mean"),
        F.sqrt(F.col("post_var") * at * at + sigma * sigma).alias("predictive_sd"),
    )


def series_gradient(rows: DataFrame, key: str, x: str, y: str, forward: bool = False) -> DataFrame:
    """Numerical derivative of y by x along every key; x must be distinct within a key.

    Inside, second-order central differences for unequal spacing; one-sided at both ends.
    ``forward`` gives plain forward differences, null at the end.
    """
    here = F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    out = with_ordered(rows, [key], [x], lag={"_p": here}, lead={"_n": here})
    hs, hd = F.col(x) - F.col("_p.x"), F.col("_n.x") - F.col(x)
    ahead, behind = (F.col("_n.y") - F.col(y)) / hd, (F.col(y) - F.col("_p.y")) / hs
    inside = (hs * hs * F.col("_n.y") + (hd * hd - hs * hs) * F.col(y) - hd * hd * F.col("_p.y")) / (hs * hd * (hd + hs))
    value = ahead if forward else F.coalesce(inside, ahead, behind)
    return out.select(*rows.columns, value.alias("gradient"))
