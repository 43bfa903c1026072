"""Registered queries for statistical learning."""

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusweave.functions.draws import DIGEST_DIGITS, digest_sql
from corpusweave.functions import arrays as A
from corpusweave.operators import classes, gram
from corpusweave.operators import stats as M
from corpusweave.operators.vectors import group_means
from corpusweave.plans.registry import query, table


def lineitem(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag",
        F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("key"),
    )


LINE = "SELECT l_orderkey * 8 + l_linenumber AS key, l_returnflag, l_quantity AS x, l_extendedprice AS y FROM lineitem"


def rounded(df, digits, *columns):
    return df.select(*[(F.round(c, digits) + F.lit(0.0)).alias(c) if c in columns else F.col(c) for c in df.columns])


FITS = f"""
    r AS ({LINE}),
    f AS (SELECT l_returnflag, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, count(*) AS n FROM r GROUP BY l_returnflag),
    e AS (SELECT l_returnflag, y - slope * x - intercept AS e FROM r JOIN f USING (l_returnflag)),
    s AS (SELECT l_returnflag, sqrt(avg(e * e)) AS sigma FROM e GROUP BY l_returnflag)
"""


@query(
    "m1_line_fit",
    f"WITH {FITS} SELECT l_returnflag, round(slope, 4) AS slope, round(intercept, 3) AS intercept, round(sigma, 3) AS sigma, n FROM f JOIN s USING (l_returnflag)",
)
def line_fit(spark, sf):
    out = M.line_fit(lineitem(spark, sf), "x", "y", ["l_returnflag"])
    return rounded(rounded(out, 4, "slope"), 3, "intercept", "sigma")


@query(
    "m1_line_band",
    f"""
    WITH {FITS} SELECT l_returnflag, count(*) AS n, count(*) FILTER (abs(e) <= 2 * sigma) AS inside
    FROM e JOIN s USING (l_returnflag) GROUP BY l_returnflag
    """,
)
def line_band(spark, sf):
    rows = lineitem(spark, sf)
    band = M.line_band(rows, M.line_fit(rows, "x", "y", ["l_returnflag"]), "x", ["l_returnflag"])
    return band.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("y").between(F.col("low"), F.col("high"))).alias("inside")
    )


def scaled(spark, sf):
    rows = M.hash_split(lineitem(spark, sf), "key", 0.4, 1)
    return rows.select(((F.col("x") - 25.5) / 24.5).alias("x"), (F.col("y") / 1000).alias("y"), "split")


SPLIT = (
    f"r AS (SELECT *, CASE WHEN {digest_sql('key', '1')} < {int(0.4 * 16**DIGEST_DIGITS)} THEN 'test' ELSE 'train' END AS split "
    f"FROM ({LINE}))"
)


@query(
    "m2_polynomial_degree_1",
    f"""
    WITH {SPLIT}, q AS (SELECT (x - 25.5) / 24.5 AS x, y / 1000 AS y, split FROM r),
    f AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM q WHERE split = 'train'),
    e AS (SELECT split, (y - a - b * x) * (y - a - b * x) AS e FROM q, f)
    SELECT 1 AS degree, round(avg(e) FILTER (split = 'train'), 4) AS train_mse, round(avg(e) FILTER (split = 'test'), 4) AS test_mse FROM e
    """,
)
def polynomial_one(spark, sf):
    return rounded(gram.polynomial_risk(scaled(spark, sf), "x", "y", [1]), 4, "train_mse", "test_mse")


def orthogonal_sql(degrees):
    """Least squares by polynomials that are orthogonal over the train rows, built from one another in SQL.

    p0 = 1 and p(k+1) = (x - a) pk - b p(k-1); the fit of a degree adds up the projections on its polynomials.
    """
    top = max(degrees)
    out = [
        f"{SPLIT}, q AS (SELECT (x - 25.5) / 24.5 AS x, y / 1000 AS y, split FROM r)",
        "t0 AS MATERIALIZED (SELECT x, y, split, 0.0::DOUBLE AS o, 1.0::DOUBLE AS p, 0.0::DOUBLE AS f0 FROM q)",
    ]
    for k in range(top + 1):
        out.append(
            f"s{k} AS MATERIALIZED (SELECT sum(y * p) / sum(p * p) AS c, sum(x * p * p) / sum(p * p) AS a, "
            f"sum(p * p) AS h FROM t{k} WHERE split = 'train')"
        )
        kept = ", ".join(f"f{d}" for d in range(k + 1))
        back = f"- s.h / (SELECT h FROM s{k - 1}) * o" if k else ""
        out.append(
            f"t{k + 1} AS MATERIALIZED (SELECT x, y, split, p AS o, {kept}, f{k} + s.c * p AS f{k + 1}, "
            f"(x - s.a) * p {back} AS p FROM t{k}, s{k} s)"
        )
    risk = " UNION ALL ".join(
        f"SELECT {d} AS degree, round(avg((y - f{d + 1}) * (y - f{d + 1})) FILTER (split = 'train'), 4) AS train_mse, "
        f"round(avg((y - f{d + 1}) * (y - f{d + 1})) FILTER (split = 'test'), 4) AS test_mse FROM t{top + 1}"
        for d in degrees
    )
    return "WITH " + ",\n".join(out) + "\n" + risk


@query("m2_polynomial_risk", orthogonal_sql([1, 3, 7]))
def polynomial(spark, sf):
    return rounded(gram.polynomial_risk(scaled(spark, sf), "x", "y", [1, 3, 7]), 4, "train_mse", "test_mse")


@query(
    "m3_ridge",
    f"""
    WITH r AS (SELECT x, y / 1000 AS y FROM ({LINE})), m AS (SELECT avg(x) AS mx, avg(y) AS my FROM r),
    s AS (SELECT sum((x - mx) * (y - my)) / (sum((x - mx) * (x - mx)) + 50000::DOUBLE) AS b FROM r, m)
    SELECT 'intercept' AS term, round(my - b * mx, 4) AS value FROM s, m UNION ALL SELECT 'x', round(b, 4) FROM s
    """,
)
def ridge(spark, sf):
    rows = lineitem(spark, sf).withColumn("y", F.col("y") / 1000)
    return rounded(M.penalized_fit(rows, ["x"], "y", 50000.0), 4, "value")


# Coordinate descent over the centred sums, one soft threshold of alpha / 2 per coordinate.
@query(
    "m3_lasso",
    """
    WITH RECURSIVE r AS (SELECT l_quantity::DOUBLE AS a, l_linenumber::DOUBLE AS b, l_extendedprice / 1000::DOUBLE AS y FROM lineitem),
    m AS (SELECT avg(a) AS ma, avg(b) AS mb, avg(y) AS my FROM r),
    s AS (SELECT sum((a - ma) * (a - ma)) AS saa, sum((b - mb) * (b - mb)) AS sbb, sum((a - ma) * (b - mb)) AS sab,
                 sum((a - ma) * (y - my)) AS say, sum((b - mb) * (y - my)) AS sby FROM r, m),
    d AS (SELECT 0 AS i, 0.0::DOUBLE AS u, 0.0::DOUBLE AS v
          UNION ALL SELECT i + 1, w, sign(sby - sab * w) * greatest(abs(sby - sab * w) - 2500, 0) / sbb
          FROM (SELECT i, sab, sbb, sby, sign(say - sab * v) * greatest(abs(say - sab * v) - 2500, 0) / saa AS w FROM d, s WHERE i < 200) z),
    f AS (SELECT u, v FROM d WHERE i = 200)
    SELECT 'intercept' AS term, round(my - u * ma - v * mb, 3) AS value FROM f, m
    UNION ALL SELECT 'x', round(u, 3) FROM f UNION ALL SELECT 'line', round(v, 3) FROM f
    """,
)
def lasso(spark, sf):
    rows = lineitem(spark, sf).withColumn("y", F.col("y") / 1000).withColumn("line", F.col("l_linenumber").cast("double"))
    return rounded(M.penalized_fit(rows, ["x", "line"], "y", 5000.0, lasso=True), 3, "value")


def labelled(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "n_chars", "lang")
    return table(spark, sf, "labels").join(docs, "doc_id").withColumn("x", F.col("n_chars") / 1000.0)


def newton_sql(rounds):
    """Logistic regression of quality on x by Newton steps, one aggregation each; half the squared weight is added."""
    out = [
        "r AS MATERIALIZED (SELECT doc_id, quality, n_chars / 1000.0::DOUBLE AS x FROM labels JOIN documents USING (doc_id))",
        "n0 AS (SELECT 0.0::DOUBLE AS a, 0.0::DOUBLE AS b)",
    ]
    for k in range(rounds):
        out.append(
            f"z{k} AS (SELECT x, quality, a, b, 1 / (1 + exp(-(a + b * x))) AS p FROM r, n{k}),"
            f"h{k} AS MATERIALIZED (SELECT any_value(a) AS a, any_value(b) AS b, sum(p - quality) AS ga, sum((p - quality) * x) + any_value(b) AS gb, "
            f"sum(p * (1 - p)) AS aa, sum(p * (1 - p) * x) AS ab, sum(p * (1 - p) * x * x) + 1 AS bb FROM z{k}),"
            f"n{k + 1} AS MATERIALIZED (SELECT a - (bb * ga - ab * gb) / (aa * bb - ab * ab) AS a, "
            f"b - (aa * gb - ab * ga) / (aa * bb - ab * ab) AS b FROM h{k})"
        )
    last = f"SELECT doc_id, quality, round(1 / (1 + exp(-(a + b * x))), 6) AS p FROM r, n{rounds}"
    return "WITH " + ",\n".join(out) + "\n" + last


@query("m4_logistic_probability", newton_sql(12))
def logistic(spark, sf):
    out = gram.logistic_probability(labelled(spark, sf), ["x"], "quality")
    return rounded(out.select("doc_id", "quality", "p"), 6, "p")


def first_vectors(spark, sf, k):
    """(class, centre): the vectors with the smallest ids."""
    first = table(spark, sf, "embeddings").orderBy("vec_id").limit(k)
    return first.select("vec_id", A.doubles("embedding").alias("centre")).withColumn(
        "class", F.row_number().over(Window.orderBy("vec_id")) - 1
    ).drop("vec_id")


@query("m5_gaussian_mixture")
def gaussian_mixture(spark, sf):
    """All 64 dimensions; tests compare the fixed point with plain numpy."""
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding")
    start = np.array([r["centre"] for r in first_vectors(spark, sf, 3).orderBy("class").collect()])
    model = classes.fit_mixture(rows, "embedding", start)
    return classes.mixture(rows, "embedding", model).select("vec_id", "component")


def lloyd_sql(k, rounds):
    """Lloyd's rounds over all dimensions from the vectors with the smallest ids."""
    out = [
        "z AS MATERIALIZED (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS dim FROM embeddings)",
        f"f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS centre FROM embeddings ORDER BY vec_id LIMIT {k})",
        "c0 AS MATERIALIZED (SELECT centre, dim, v AS m FROM z JOIN f USING (vec_id))",
    ]
    for i in range(rounds + 1):
        out.append(
            f"a{i} AS MATERIALIZED (SELECT vec_id, arg_min(centre, (d, centre)) AS centre FROM "
            f"(SELECT vec_id, centre, sum((v - m) * (v - m)) AS d FROM z JOIN c{i} USING (dim) GROUP BY ALL) GROUP BY vec_id)"
        )
        out.append(
            f"c{i + 1} AS MATERIALIZED (SELECT centre, dim, coalesce(n.m, c.m) AS m FROM c{i} c LEFT JOIN "
            f"(SELECT centre, dim, avg(v) AS m FROM z JOIN a{i} USING (vec_id) GROUP BY ALL) n USING (centre, dim))"
        )
    return "WITH " + ",\n".join(out) + f"\nSELECT vec_id, CAST(centre AS INTEGER) AS cluster FROM a{rounds}"


@query("m6_kmeans", lloyd_sql(3, 6))
def kmeans(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding")
    out, _ = classes.kmeans(rows, "embedding", first_vectors(spark, sf, 3), rounds=6)
    return out.select("vec_id", "cluster")


@query(
    "m6_nearest_centre",
    """
    WITH z AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS dim FROM embeddings),
    c AS (SELECT label AS centre, dim, avg(v) AS m FROM z GROUP BY ALL),
    d AS (SELECT vec_id, centre, sum((v - m) * (v - m)) AS d FROM z JOIN c USING (dim) GROUP BY ALL)
    SELECT vec_id, arg_min(centre, (d, centre)) AS cluster FROM d GROUP BY vec_id
    """,
)
def nearest_centre(spark, sf):
    rows = table(spark, sf, "embeddings")
    centres = group_means(rows, "label", "embedding").select(F.col("label").alias("class"), F.col("mean").alias("centre"))
    return classes.nearest_centre(rows.select("vec_id", "embedding"), "embedding", centres).select("vec_id", "cluster")


@query(
    "m7_hash_split",
    f"WITH {SPLIT} SELECT l_returnflag, split, count(*) AS n FROM r GROUP BY ALL",
)
def hash_split(spark, sf):
    rows = M.hash_split(lineitem(spark, sf), "key", 0.4, 1)
    return rows.groupBy("l_returnflag", "split").agg(F.count(F.lit(1)).alias("n"))


# A penalty of 1e-6 on sums of tens of thousands does not show at four decimals.
@query("m8_validation_curve", orthogonal_sql([1, 2, 3, 4, 5]))
def validation_curve(spark, sf):
    out = gram.polynomial_risk(scaled(spark, sf), "x", "y", [1, 2, 3, 4, 5], ridge=1e-6)
    return rounded(out, 4, "train_mse", "test_mse")


@query(
    "m9_learning_curve",
    """
    WITH r AS MATERIALIZED (SELECT l_quantity AS x, l_extendedprice / 1000 AS y,
             row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS i FROM lineitem),
    n AS (SELECT count(*) AS n FROM r), f AS (SELECT CAST(f AS BIGINT) AS f FROM range(0, 5) t(f)), st AS (SELECT CAST(k AS BIGINT) AS k FROM range(1, 11) t(k)),
    b AS (SELECT f, f * (n // 5) + least(f, n % 5) AS lo, (f + 1) * (n // 5) + least(f + 1, n % 5) AS hi,
                 n - (n // 5 + CASE WHEN n % 5 > 0 THEN 1 ELSE 0 END) AS most FROM f, n),
    c AS (SELECT f, lo, hi, k, CAST(floor(k / 10.0::DOUBLE * most + 1e-9::DOUBLE) AS BIGINT) AS m FROM b, st),
    t AS MATERIALIZED (SELECT f, k, m, x, y, i >= lo AND i < hi AS is_val, CASE WHEN i >= hi THEN i - (hi - lo) ELSE i END AS j FROM r, c),
    g AS (SELECT f, k, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM t WHERE NOT is_val AND j < m GROUP BY f, k),
    e AS (SELECT f, k, m, avg((y - a - b * x) * (y - a - b * x)) FILTER (NOT is_val AND j < m) AS tr,
                 avg((y - a - b * x) * (y - a - b * x)) FILTER (is_val) AS va FROM t JOIN g USING (f, k) GROUP BY f, k, m)
    SELECT m AS train_size, round(avg(tr), 4) AS train_mean, round(stddev_pop(tr), 4) AS train_std,
           round(avg(va), 4) AS val_mean, round(stddev_pop(va), 4) AS val_std FROM e GROUP BY m
    """,
)
def learning_curve(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("y", F.col("l_extendedprice") / 1000)
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    out = M.learning_curve(rows, "l_quantity", "y", order)
    return rounded(out, 4, "train_mean", "train_std", "val_mean", "val_std")


CLASSES = """
    r AS (SELECT doc_id, quality, n_chars / 1000.0::DOUBLE AS x FROM labels JOIN documents USING (doc_id)),
    g AS (SELECT quality AS c, avg(x) AS m, stddev_pop(x) AS s, count(*)::DOUBLE / (SELECT count(*) FROM r) AS p FROM r GROUP BY quality),
    k AS (SELECT doc_id, quality, c, -0.5::DOUBLE * ((x - m) / s) * ((x - m) / s) - ln(s) - 0.5::DOUBLE * ln(2 * pi()) + ln(p) AS score FROM r, g),
    w AS (SELECT doc_id, any_value(quality) AS quality, arg_max(c, score) AS predicted FROM k GROUP BY doc_id)
"""


@query("m10_class_gaussians", f"WITH {CLASSES} SELECT doc_id, quality, predicted FROM w")
def class_gaussians(spark, sf):
    rows = labelled(spark, sf).select("doc_id", "quality", "x")
    return classes.classify(rows, "x", classes.class_gaussians(rows, "quality", "x")).select("doc_id", "quality", "predicted")


@query(
    "m11_bayes_error",
    f"""
    WITH {CLASSES}, h AS (SELECT min(x) - 1 AS lo, max(x) + 1 AS hi FROM r), i AS (SELECT unnest(range(0, 2001)) AS i),
    o AS (SELECT i, lo + i * ((hi - lo) / 2000) AS x, (hi - lo) / 2000 AS step FROM h, i),
    v AS (SELECT i, step, sum(p * exp(-0.5::DOUBLE * ((x - m) / s) * ((x - m) / s)) / (s * sqrt(2 * pi())))
            - max(p * exp(-0.5::DOUBLE * ((x - m) / s) * ((x - m) / s)) / (s * sqrt(2 * pi()))) AS f FROM o, g GROUP BY i, step),
    t AS (SELECT (f + lead(f) OVER (ORDER BY i)) / 2 * step AS a FROM v)
    SELECT round((SELECT sum(a) FROM t), 6) AS bayes_error, round((SELECT avg(CASE WHEN predicted <> quality THEN 1.0::DOUBLE ELSE 0 END) FROM w), 6) AS error_rate
    """,
)
def bayes_error(spark, sf):
    rows = labelled(spark, sf).select("doc_id", "quality", "x")
    densities = classes.class_gaussians(rows, "quality", "x")
    scored = classes.classify(rows, "x", densities)
    wrong = (F.col("predicted") != F.col("quality")).cast("double")
    seen = scored.agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.avg(wrong).alias("rate")).first()
    error = classes.bayes_error(densities, seen["lo"] - 1, seen["hi"] + 1, 2001)
    out = spark.createDataFrame([(error, seen["rate"])], "bayes_error double, error_rate double")
    return rounded(out, 6, "bayes_error", "error_rate")


@query(
    "m12_moments",
    "SELECT event_type, round(avg(value), 6) AS mean, round(var_pop(value), 5) AS var_n, round(var_samp(value), 5) AS var_n1, count(*) AS n FROM events GROUP BY event_type",
)
def moments(spark, sf):
    return rounded(rounded(M.moments(table(spark, sf, "events"), "value", ["event_type"]), 6, "mean"), 5, "var_n", "var_n1")


@query(
    "m13_estimator_quality",
    f"""
    WITH t AS (SELECT avg(value) AS theta FROM events),
    m AS (SELECT {digest_sql('event_id', '0')} % 50 AS r, avg(value) AS m FROM events GROUP BY r),
    e AS (SELECT 'mean' AS estimator, m AS e FROM m UNION ALL SELECT 'shifted', m + 0.5::DOUBLE FROM m)
    SELECT estimator, round(avg(e) - any_value(theta), 6) AS bias, round(var_pop(e), 6) AS variance,
           round((avg(e) - any_value(theta)) * (avg(e) - any_value(theta)) + var_pop(e), 6) AS mse FROM e, t GROUP BY estimator
    """,
)
def estimator_quality(spark, sf):
    out = M.estimator_quality(table(spark, sf, "events"), "value", "event_id", 50)
    return rounded(out, 6, "bias", "variance", "mse")


@query(
    "m14_bias_variance",
    f"""
    WITH q AS (SELECT key, x, y / 1000 AS y FROM ({LINE})),
    t AS (SELECT avg(y) AS truth, var_pop(y) AS noise FROM q WHERE x = 25),
    d AS (SELECT x, y, r, {digest_sql('key', 'r')} AS u FROM q, range(0, 16) v(r)),
    w AS (SELECT r, x, y, {' + '.join(f'(u >= {c})::INTEGER' for c in M.poisson_cuts())} AS w FROM d),
    f AS (SELECT r, sum(w) AS n, sum(w * x) AS sx, sum(w * y) AS sy, sum(w * x * x) AS sxx, sum(w * x * y) AS sxy FROM w GROUP BY r),
    b AS (SELECT *, (n * sxy - sx * sy) / (n * sxx - sx * sx) AS b FROM f), p AS (SELECT (sy - b * sx) / n + b * 25 AS p FROM b)
    SELECT round((avg(p) - any_value(truth)) * (avg(p) - any_value(truth)), 6) AS bias2, round(var_pop(p), 6) AS variance,
           round(any_value(noise), 6) AS noise, round((avg(p) - any_value(truth)) * (avg(p) - any_value(truth)) + var_pop(p) + any_value(noise), 6) AS mse
    FROM p, t
    """,
)
def bias_variance(spark, sf):
    rows = lineitem(spark, sf).withColumn("y", F.col("y") / 1000)
    return rounded(M.bias_variance(rows, "x", "y", "key", 25.0, 16), 6, "bias2", "variance", "noise", "mse")


FAMILIES = """
    f AS (SELECT event_type, avg(value) AS mean, stddev_pop(value) AS sigma, 1 / avg(value) AS rate,
                 avg(CASE WHEN value > 50 THEN 1.0::DOUBLE ELSE 0 END) AS p, count(*) AS n FROM events GROUP BY event_type)
"""


@query(
    "m15_maximum_likelihood",
    f"WITH {FAMILIES} SELECT event_type, round(mean, 6) AS mean, round(sigma, 6) AS sigma, round(rate, 6) AS rate, round(p, 6) AS p, n FROM f",
)
def maximum_likelihood(spark, sf):
    out = M.fit_families(table(spark, sf, "events"), "value", F.col("value") > 50, ["event_type"])
    return rounded(out, 6, "mean", "sigma", "rate", "p")


@query(
    "m16_gaussian_grid",
    """
    WITH g AS (SELECT mu::DOUBLE AS mu, sigma::DOUBLE AS sigma FROM range(10, 91, 20) a(mu), range(20, 101, 20) b(sigma))
    SELECT event_type, mu, sigma, round(sum(-ln(sigma) - 0.5::DOUBLE * ln(2 * pi()) - (value - mu) * (value - mu) / (2 * sigma * sigma)), 3) AS log_likelihood
    FROM events, g GROUP BY event_type, mu, sigma
    """,
)
def gaussian_grid(spark, sf):
    out = M.gaussian_grid(table(spark, sf, "events"), "value", ["event_type"], range(10, 91, 20), range(20, 101, 20))
    return rounded(out, 3, "log_likelihood")


@query(
    "m16_line_grid",
    f"""
    WITH q AS (SELECT l_returnflag, x, y / 1000 AS y FROM ({LINE})),
    g AS (SELECT b0::DOUBLE AS b0, b1 / 2.0::DOUBLE AS b1 FROM range(-10, 11, 5) a(b0), range(1, 5) b(b1))
    SELECT l_returnflag, b0, b1, round(sum(-ln(10.0::DOUBLE) - 0.5::DOUBLE * ln(2 * pi()) - (y - b0 - b1 * x) * (y - b0 - b1 * x) / 200), 2) AS log_likelihood
    FROM q, g GROUP BY ALL
    """,
)
def line_grid(spark, sf):
    rows = lineitem(spark, sf).withColumn("y", F.col("y") / 1000)
    out = M.line_grid(rows, "x", "y", ["l_returnflag"], range(-10, 11, 5), [0.5, 1.0, 1.5, 2.0], 10.0)
    return rounded(out, 2, "log_likelihood")


PREFIX = "PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


@query(
    "m17_running_mle",
    f"""
    SELECT user_id, event_id, count(*) OVER w AS n, round(sum(value) OVER w, 2) AS total, round(stddev_pop(value) OVER w, 4) AS sigma
    FROM events WINDOW w AS ({PREFIX})
    """,
)
def running_mle(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "ts", "event_id", "value")
    out = M.running_mle(rows, "user_id", ["ts", "event_id"], "value").select("user_id", "event_id", "n", "mu", "sigma")
    # Values have two decimals, so n times the mean is exact at two; a rounded mean could be a tie.
    total = F.round(F.col("mu") * F.col("n"), 2).alias("total")
    return rounded(out.select("user_id", "event_id", "n", total, "sigma"), 4, "sigma")


BETA = f"""
    b AS (SELECT user_id, event_id, count(*) OVER w AS n, CAST(sum((event_type = 'purchase')::INTEGER) OVER w AS BIGINT) AS heads
          FROM events WINDOW w AS ({PREFIX})),
    p AS (SELECT user_id, event_id, n, heads, heads + 2.0::DOUBLE AS alpha, n - heads + 2.0::DOUBLE AS beta FROM b),
    o AS (SELECT *, round(CASE WHEN alpha + beta > 2 THEN (alpha - 1) / (alpha + beta - 2) ELSE 0.5 END, 9) AS map,
                 round(alpha / (alpha + beta), 9) AS posterior_mean, round(heads::DOUBLE / n, 9) AS mle FROM p)
"""


def _sequential(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    out = M.sequential_beta(rows, "user_id", ["ts", "event_id"], F.col("event_type") == "purchase")
    return rounded(out.drop("ts", "event_type"), 9, "map", "posterior_mean", "mle")


@query("m18_sequential_beta", f"WITH {BETA} SELECT * FROM o")
def sequential_beta(spark, sf):
    return _sequential(spark, sf)


@query(
    "m19_estimates_by_size",
    f"WITH {BETA} SELECT user_id, n, mle, map, posterior_mean FROM o WHERE n IN (2, 5, 10, 30)",
)
def estimates_by_size(spark, sf):
    return _sequential(spark, sf).filter(F.col("n").isin(2, 5, 10, 30)).select(
        "user_id", "n", "mle", "map", "posterior_mean"
    )


@query(
    "m20_slope_posterior",
    f"""
    WITH q AS (SELECT l_returnflag, x, y / 1000 AS y FROM ({LINE})),
    s AS (SELECT l_returnflag, 1 / (1 / 0.25::DOUBLE + sum(x * x) / 100) AS post_var, sum(x * y) AS sxy FROM q GROUP BY l_returnflag)
    SELECT l_returnflag, round(post_var * 1000000, 6) AS post_var, round(post_var * sxy / 100, 6) AS post_mean,
           round(sqrt(post_var * 900 + 100), 6) AS predictive_sd FROM s
    """,
)
def slope_posterior(spark, sf):
    rows = lineitem(spark, sf).withColumn("y", F.col("y") / 1000)
    out = M.slope_posterior(rows, "x", "y", ["l_returnflag"], 0.5, 10.0, 30.0)
    return rounded(out.withColumn("post_var", F.col("post_var") * 1000000), 6, "post_var", "post_mean", "predictive_sd")


@query(
    "m21_generalization_gap",
    f"""
    WITH {SPLIT}, q AS (SELECT x, y / 1000 AS y, split FROM r),
    f AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM q WHERE split = 'train'),
    e AS (SELECT split, (y - a - b * x) * (y - a - b * x) AS e FROM q, f),
    m AS (SELECT avg(e) FILTER (split = 'train') AS tr, avg(e) FILTER (split = 'test') AS te FROM e)
    SELECT round(tr, 5) AS train_risk, round(te, 5) AS test_risk, round(te - tr, 5) AS gap FROM m
    """,
)
def generalization_gap(spark, sf):
    rows = M.hash_split(lineitem(spark, sf).withColumn("y", F.col("y") / 1000), "key", 0.4, 1)
    return rounded(M.risk_by_split(rows, "x", "y"), 5, "train_risk", "test_risk", "gap")


@query(
    "m22_density_scores",
    f"""
    WITH {FAMILIES},
    l AS (SELECT event_type, -0.5::DOUBLE * ((value - mean) / sigma) * ((value - mean) / sigma) - ln(sigma) - 0.5::DOUBLE * ln(2 * pi()) AS a,
                 ln(rate) - rate * value AS b, CASE WHEN value > 50 THEN ln(p) ELSE ln(1 - p) END AS c FROM events JOIN f USING (event_type))
    SELECT event_type, round(avg(a), 6) AS normal, round(avg(b), 6) AS exponential, round(avg(c), 6) AS bernoulli,
           CASE WHEN avg(a) >= avg(b) THEN 'normal' ELSE 'exponential' END AS family FROM l GROUP BY event_type
    """,
)
def density_scores(spark, sf):
    rows = table(spark, sf, "events").select("event_type", "value")
    out = M.score_families(rows, "value", F.col("value") > 50, ["event_type"])
    return rounded(out, 6, "normal", "exponential", "bernoulli")


@query(
    "m23_series_gradient",
    """
    WITH e AS (SELECT user_id, event_id, event_id / 100.0::DOUBLE AS x, value AS y FROM events),
    n AS (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM e WINDOW w AS (PARTITION BY user_id ORDER BY x)),
    h AS (SELECT *, x - px AS hs, nx - x AS hd FROM n)
    SELECT user_id, event_id, round(coalesce((hs * hs * ny + (hd * hd - hs * hs) * y - hd * hd * py) / (hs * hd * (hd + hs)), (ny - y) / hd, (y - py) / hs), 4) + 0.0::DOUBLE AS gradient
    FROM h
    """,
)
def series_gradient(spark, sf):
    rows = table(spark, sf, "events").select(
        "user_id", "event_id", (F.col("event_id") / 100.0).alias("x"), F.col("value").alias("y")
    )
    out = M.series_gradient(rows, "user_id", "x", "y").select("user_id", "event_id", "gradient")
    return rounded(out, 4, "gradient")
