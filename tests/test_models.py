"""Class tables, mixtures, linear models, exact search, medians and folds against plain versions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusweave.functions.draws import permuted
from corpusweave.operators import classes, dataset, fit, gram, metrics, ngram, runs, stats, text, vectors

# --- linear models ----------------------------------------------------------------------------


def points(spark, n=400, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.uniform(-1, 1, n)
    y = 1e6 + 3 * x - 5 * x**3 + rng.normal(0, 0.3, n)
    split = np.where(rng.random(n) < 0.3, "test", "train")
    rows = [(float(a), float(b), str(s)) for a, b, s in zip(x, y, split, strict=True)]
    rows += [(None, 1.0, "train"), (0.5, None, "test")]
    return x, y, split, spark.createDataFrame(rows, "x double, y double, split string")


def test_polynomial_risk_equals_least_squares(spark):
    x, y, split, rows = points(spark)
    found = {r["degree"]: r for r in gram.polynomial_risk(rows, "x", "y", [1, 3, 9]).collect()}
    train = split == "train"
    for degree, row in found.items():
        fit_ = np.polynomial.Polynomial.fit(x[train], y[train], degree, domain=[-1, 1])
        e = (y - fit_(x)) ** 2
        assert row["train_mse"] == pytest.approx(e[train].mean(), rel=1e-6)
        assert row["test_mse"] == pytest.approx(e[~train].mean(), rel=1e-6)
    only_train = gram.polynomial_risk(rows.filter("split = 'train'"), "x", "y", [2]).first()
    assert only_train["test_mse"] is None
    with pytest.raises(ValueError, match="train"):
        gram.polynomial_risk(rows.filter("split = 'test'"), "x", "y", [2])


def test_polynomial_ridge_penalises_powers(spark):
    x, y, split, rows = points(spark)
    train = split == "train"
    row = gram.polynomial_risk(rows, "x", "y", [4], ridge=3.0).first()
    wide = np.vander(x[train], 5, increasing=True)
    w = np.linalg.solve(wide.T @ wide + 3.0 * np.diag([0, 1, 1, 1, 1]), wide.T @ y[train])
    assert row["train_mse"] == pytest.approx(((y[train] - wide @ w) ** 2).mean(), rel=1e-6)


def test_one_scan_serves_all_penalties(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(1e4, 1, (300, 3))
    y = x @ [2.0, 0.0, -1.0] + rng.normal(0, 0.1, 300)
    rows = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y, strict=True)], "a double, b double, c double, y double")
    off, target = x - x.mean(0), y - y.mean()
    ridge = gram.penalized_fit(rows, ["a", "b", "c"], "y", [0.0, 10.0, 1e4]).collect()
    for alpha in (0.0, 10.0, 1e4):
        w = np.linalg.solve(off.T @ off + alpha * np.eye(3), off.T @ target)
        found = {r["term"]: r["value"] for r in ridge if r["alpha"] == alpha}
        assert [found[c] for c in "abc"] == pytest.approx(w, rel=1e-6)
        assert found["intercept"] == pytest.approx(y.mean() - w @ x.mean(0), rel=1e-6)
    lasso = gram.penalized_fit(rows, ["a", "b", "c"], "y", [200.0, 1e9], lasso=True).collect()
    for alpha in (200.0, 1e9):
        w = np.array([r["value"] for r in lasso if r["alpha"] == alpha and r["term"] != "intercept"])
        slope = 2 * off.T @ (off @ w - target)
        # At the minimum the slope of the squares is alpha against the sign, or smaller where a weight is 0.
        assert all(abs(s + alpha * np.sign(v)) < 1e-3 if v else abs(s) <= alpha + 1e-3 for s, v in zip(slope, w, strict=True))
    with pytest.raises(ValueError, match="rows"):
        gram.penalized_fit(rows.filter("a < 0"), ["a"], "y", [1.0])


def test_logistic_weights_are_a_minimum(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 2, (500, 2))
    y = (rng.random(500) < 1 / (1 + np.exp(-(x @ [1.0, -2.0] + 0.5)))).astype(int)
    rows = spark.createDataFrame([(*map(float, a), int(b)) for a, b in zip(x, y, strict=True)], "a double, b double, y int")
    at = gram.logistic_weights(rows, ["a", "b"], "y", c=0.5)
    wide = np.column_stack([np.ones(500), x])
    slope = wide.T @ (1 / (1 + np.exp(-wide @ at)) - y) + np.array([0, 2, 2]) * at
    assert np.abs(slope).max() < 1e-6
    # Classes that one line parts: the penalty keeps the weights finite.
    parted = rows.withColumn("y", (F.col("a") > 0).cast("int"))
    assert np.isfinite(gram.logistic_weights(parted, ["a", "b"], "y")).all()
    assert gram.logistic_probability(rows.union(spark.createDataFrame([(None, 1.0, 1)], rows.schema)), ["a", "b"], "y").filter("p IS NULL").count() == 1


# --- classes ----------------------------------------------------------------------------------


def test_classes_with_one_row_and_without_label(spark):
    rows = spark.createDataFrame(
        [(1, 0.0), (1, 2.0), (2, 5.0), (None, 9.0), (3, 100.0), (3, 100.0), (1, None)], "label int, x double"
    )
    table = classes.class_gaussians(rows, "label", "x")
    assert sorted((r["class"], r["sigma"]) for r in table.collect()) == [(1, 1.0), (2, 0.0), (3, 0.0)]
    out = classes.classify(rows, "x", table).collect()
    assert [(r["x"], r["predicted"]) for r in out] == [
        (0.0, 1), (2.0, 1), (5.0, 2), (9.0, 1), (100.0, 3), (100.0, 3), (None, None),
    ]
    assert classes.bayes_error(table, -10, 10, 201) == pytest.approx(0.0, abs=1e-9)


@pytest.mark.parametrize("part", [3, 1 << 20])
def test_any_number_of_classes(spark, part):
    rng = np.random.default_rng(5)
    table = [(k, float(rng.uniform(0, 100)), float(rng.uniform(0.5, 3)), float(rng.uniform(0.1, 1))) for k in range(10)]
    frame = spark.createDataFrame(table, "class int, mean double, sigma double, prior double")
    x = rng.uniform(0, 100, 200)
    rows = spark.createDataFrame([(float(v),) for v in x], "x double")
    out = {r["x"]: r["predicted"] for r in classes.classify(rows, "x", frame, part=part).collect()}
    for v in x:
        scores = [math.log(p) - math.log(s) - (v - m) ** 2 / 2 / s**2 for _, m, s, p in table]
        assert out[v] == int(np.argmax(scores))
    grid = np.linspace(-10, 110, 501)
    density = np.array([[p * math.exp(-((v - m) ** 2) / 2 / s**2) / s / math.sqrt(2 * math.pi) for _, m, s, p in table] for v in grid])
    expected = np.trapezoid(density.sum(1) - density.max(1), grid)
    assert classes.bayes_error(frame, -10, 110, 501, part=part) == pytest.approx(expected, rel=1e-9)


def test_a_hundred_thousand_classes(spark):
    n = 100_000
    frame = spark.range(n).select(
        F.col("id").alias("class"), (F.col("id") * 2.0).alias("mean"), F.lit(0.5).alias("sigma"), F.lit(1.0 / n).alias("prior")
    )
    rows = spark.range(0, n, 977).select((F.col("id") * 2.0 + 0.6).alias("x"), F.col("id"))
    assert classes.classify(rows, "x", frame).filter("predicted <> id").count() == 0


def test_kmeans_ends_at_a_fixed_point(spark):
    rng = np.random.default_rng(6)
    data = np.concatenate([rng.normal(c, 0.3, (40, 5)) for c in (0, 3, 7)])
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(data)], "id long, v array<double>").repartition(4)
    start = spark.createDataFrame([(k, data[k].tolist()) for k in range(3)] + [(9, [1e6] * 5)], "class int, centre array<double>")
    out, centres = classes.kmeans(rows, "v", start)
    found = {r["class"]: np.array(r["centre"]) for r in centres.collect()}
    own = np.array([r["cluster"] for r in out.orderBy("id").collect()])
    for k, centre in found.items():
        members = data[own == k]
        assert np.allclose(centre, members.mean(0) if len(members) else [1e6] * 5)
    away = np.array([[((v - found[k]) ** 2).sum() for k in sorted(found)] for v in data])
    assert (np.array(sorted(found))[away.argmin(1)] == own).all()


def plain_em(data, start, rounds):
    """Expectation and maximisation row by row in the textbook form."""
    n, d = data.shape
    weights, means = np.full(len(start), 1 / len(start)), start.copy()
    floor = classes.COVARIANCE_FLOOR * np.eye(d)
    covariances = [np.cov(data.T, bias=True) + floor for _ in start]
    for _ in range(rounds):
        density = np.array(
            [
                [
                    w * math.exp(-0.5 * (v - m) @ np.linalg.solve(c, v - m)) / math.sqrt(np.linalg.det(2 * math.pi * c))
                    for w, m, c in zip(weights, means, covariances, strict=True)
                ]
                for v in data
            ]
        )
        share = density / density.sum(1, keepdims=True)
        weights = share.mean(0)
        means = (share.T @ data) / share.sum(0)[:, None]
        covariances = [
            ((share[:, [k]] * (data - means[k])).T @ (data - means[k])) / share[:, k].sum() + floor for k in range(len(start))
        ]
    return weights, means, np.array(covariances)


def test_mixture_is_a_fixed_point(spark):
    rng = np.random.default_rng(7)
    data = np.concatenate([rng.normal(c, s, (60, 3)) for c, s in ((0, 1.0), (12, 0.5))]) + 1000.0
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(data)] + [(999, None)], "id long, v array<double>")
    start = data[[0, 119]]
    model = classes.fit_mixture(rows.repartition(3), "v", start, rounds=7, tolerance=0.0)
    weights, means, covariances = plain_em(data, start, 7)
    assert np.allclose(model.weights, weights) and np.allclose(model.means, means)
    assert np.allclose(model.covariances, covariances, rtol=1e-5, atol=1e-7)
    done = classes.fit_mixture(rows, "v", start)
    again = plain_em_step(data, done)
    assert np.allclose(again[0], done.weights, atol=1e-6) and np.allclose(again[1], done.means, atol=1e-5)
    out = {r["id"]: r for r in classes.mixture(rows, "v", done).collect()}
    assert out[999]["component"] is None and out[0]["component"] != out[119]["component"]
    assert sum(out[5]["responsibilities"]) == pytest.approx(1)


def plain_em_step(data, model):
    share, _ = model.responsibilities(data)
    return share.mean(0), (share.T @ data) / share.sum(0)[:, None]


# --- search -----------------------------------------------------------------------------------


@pytest.mark.parametrize("shard", [40, 1 << 15])
def test_exact_search_over_balls(spark, shard):
    rng = np.random.default_rng(8)
    keys = np.concatenate([rng.normal(c, 0.2, (100, 6)) for c in rng.normal(0, 5, (5, 6))])
    keys[7] = keys[3]
    queries = rng.normal(0, 1, (20, 6))
    held = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(keys)] + [(9999, None)], "vec_id long, embedding array<double>")
    asked = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(queries)], "query_id long, query array<double>")
    for k in (1, 4, 700):
        out = vectors.best_matches(held.repartition(3), asked, k, shard=shard).collect()
        found = {}
        for r in sorted(out, key=lambda r: r["place"]):
            found.setdefault(r["query_id"], []).append(r["vec_id"])
        for q, query in enumerate(queries):
            scores = keys @ query
            assert found[q] == sorted(range(len(keys)), key=lambda i: (-round(scores[i], 9), i))[:k]
    effort = vectors.match_effort(held, asked, 4, shard=shard).agg(F.sum("balls"), F.sum("skipped")).first()
    assert effort[1] > effort[0] / 3
    empty = spark.createDataFrame([], asked.schema)
    assert vectors.best_matches(held, empty, 3).count() == 0
    assert vectors.best_matches(held.limit(0), asked, 3).count() == 0


# --- streams of tokens ------------------------------------------------------------------------


def token_rows(spark, seed=9, n=60):
    rng = random.Random(seed)
    parts = [[rng.randrange(1000) for _ in range(rng.choice([0, 1, 2, 5, 40, 300]))] for _ in range(n)]
    keys = rng.sample(range(10_000), n)
    flat = [i for _, p in sorted(zip(keys, parts, strict=True)) for i in p]
    return spark.createDataFrame(list(zip(keys, parts, strict=True)), "doc_id long, ids array<int>").repartition(3), flat


@pytest.mark.parametrize(("size", "overlap"), [(7, 0), (16, 1), (64, 30), (5000, 3)])
def test_blocks_of_the_stream(spark, size, overlap):
    tokens, flat = token_rows(spark)
    out = {r["block"]: r["ids"] for r in dataset.stream_blocks(tokens, size, overlap).collect()}
    assert out == {b: flat[b * size : b * size + size + overlap] for b in range(-(-len(flat) // size))}
    named = tokens.withColumn("doc_id", F.format_string("k%06d", "doc_id"))
    assert {r["block"]: r["ids"] for r in dataset.stream_blocks(named, size, overlap).collect()} == out
    assert dataset.stream_blocks(tokens.limit(0), size, overlap).count() == 0


@pytest.mark.parametrize("size", [1, 9, 700])
def test_as_of_join_of_windows_and_documents(spark, size):
    tokens, flat = token_rows(spark)
    held = {r["doc_id"]: r["ids"] for r in tokens.collect()}
    starts = sorted(random.Random(1).sample(range(len(flat) - size), 40)) + [0, len(flat) - size]
    windows = spark.createDataFrame(list(enumerate(starts)), "w long, since long")
    cuts = dataset.covering_documents(dataset.stream_offsets(tokens), windows, "w", size).collect()
    by_window = {}
    for c in sorted(cuts, key=lambda c: c["at"]):
        by_window.setdefault(c["w"], []).extend(held[c["doc_id"]][c["from"] - 1 : c["from"] - 1 + c["n"]])
    assert by_window == {w: flat[s : s + size] for w, s in enumerate(starts)}


def test_a_shuffle_is_a_permutation_without_a_pattern(spark):
    for n in (0, 1, 2, 3, 10, 1000, 4097):
        out = sorted(r[0] for r in spark.range(n).select(permuted(F.col("id"), n, 5)).collect())
        assert out == list(range(n))
    n = 4000
    at = np.array([r[0] for r in spark.range(n).orderBy("id").select(permuted(F.col("id"), n, 5)).collect()])
    gaps = np.diff(at)
    assert len(set(gaps.tolist())) > n / 3
    assert abs(np.corrcoef(at[:-1], at[1:])[0, 1]) < 0.05 and abs(np.corrcoef(np.arange(n), at)[0, 1]) < 0.05
    other = np.array([r[0] for r in spark.range(n).orderBy("id").select(permuted(F.col("id"), n, 6)).collect()])
    assert (at == other).mean() < 0.01
    rows = spark.range(1000).withColumnRenamed("id", "k")
    batches = dataset.shuffled_batches(rows, "k", 64, seed=2)
    assert sorted(r["count"] for r in batches.groupBy("batch_id").count().collect()) == [40] + [64] * 15
    placed = dataset.shuffled_batches(rows, "k", 64, seed=2, position="k")
    assert sorted(map(tuple, placed.collect())) == sorted(map(tuple, batches.collect()))


def test_draws_of_neighbours_are_independent(spark):
    rows = spark.range(4000).select("id", metrics.seeded_draw(F.col("id"), 3).alias("u")).orderBy("id").collect()
    u = np.array([r["u"] for r in rows])
    assert abs(u.mean() - 0.5) < 0.02 and abs(np.corrcoef(u[:-1], u[1:])[0, 1]) < 0.05
    far = spark.createDataFrame([(5,), (5 + 1_000_003,)], "id long").select(metrics.seeded_draw(F.col("id"), 3)).collect()
    assert far[0] != far[1]
    shares = stats.hash_split(spark.range(4000), "id", 0.4, 1).groupBy("split").count().collect()
    assert abs(dict(map(tuple, shares))["test"] - 1600) < 120


# --- ordered folds, medians, generation, gradients ---------------------------------------------


def test_running_deviations_keep_their_digits(spark):
    rng = np.random.default_rng(10)
    values = {1: 1e9 + rng.normal(0, 1e-2, 300), 2: rng.normal(0, 5, 40), 3: np.array([4.0])}
    rows = [(k, t, float(v)) for k, vs in values.items() for t, v in enumerate(vs)] + [(2, 1000, None)]
    out = stats.running_mle(spark.createDataFrame(rows, "k int, t int, x double").repartition(5), "k", ["t"], "x").collect()
    assert len(out) == len(rows)
    for r in out:
        seen = values[r["k"]][: r["t"] + 1]
        assert r["n"] == len(seen)
        assert r["mu"] == pytest.approx(seen.mean(), rel=1e-12)
        assert r["sigma"] == pytest.approx(seen.std(), rel=1e-4, abs=1e-8)


def test_medians_by_histograms(spark):
    rng = np.random.default_rng(11)
    groups = {
        "even": rng.normal(0, 1, 200), "odd": rng.integers(0, 5, 101).astype(float), "one": np.array([3.5]),
        "two": np.array([1.0, 2.0]), "wide": np.concatenate([10.0 ** rng.uniform(-300, 300, 150), -(10.0 ** rng.uniform(-300, 300, 90))]),
        "same": np.full(50, 7.0), "ends": np.array([-1.7e308, 1.7e308, 0.0]),
    }
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("none", None), (None, 1.0), (None, 5.0)]
    frame = spark.createDataFrame(rows, "g string, v double")
    out = {r["g"]: r["median"] for r in runs.exact_medians(frame.repartition(4), "g", "v").collect()}
    expected = {g: float(np.median(v)) for g, v in groups.items()} | {None: 3.0}
    assert out == pytest.approx(expected, rel=1e-15)


def test_a_context_with_most_rows(spark, monkeypatch):
    monkeypatch.setattr(ngram, "BLOCK_ROWS", 3)
    rng = random.Random(12)
    counts = [("ab", chr(200 + k), rng.randrange(1, 9)) for k in range(40)] + [("b" + chr(200 + k), "a", 1) for k in range(40)]
    frame = spark.createDataFrame(counts, "context string, next string, cnt long").repartition(4)
    prompts = spark.createDataFrame([(k, "xab") for k in range(50)] + [(99, "zz")], "item_id long, text string")
    ranges, low = [], 0
    for _, c, n in sorted(counts[:40], key=lambda r: (-r[2], r[1])):
        ranges.append((low, low + n, c))
        low += n
    from corpusweave.functions.draws import digest_number

    draws = {r["item_id"]: r["d"] % low for r in prompts.select("item_id", digest_number(F.col("item_id"), 0, 4).alias("d")).collect()}
    out = {r["item_id"]: r["generated"] for r in ngram.generate(frame, prompts, 3, 1, seed=4).collect()}
    for k in range(50):
        assert out[k] == "xab" + next(c for a, b, c in ranges if a <= draws[k] < b)
    assert out[99] == "zz"
    greedy = ngram.generate(frame, prompts, 3, 2, greedy=True).collect()
    assert {r["generated"] for r in greedy} == {"xab" + ranges[0][2] + "a", "zz"}


def test_words_meet_the_vocabulary_once_a_document(spark):
    docs = spark.createDataFrame([(1, "a b a c"), (2, ""), (3, None), (4, "b b")], "doc_id long, text string")
    vocab = spark.createDataFrame([(2, "a"), (3, "b")], "id long, word string")
    out = sorted(tuple(r) for r in text.encode_words(docs, vocab).collect())
    assert out == [(1, 0, "a", 2), (1, 1, "b", 3), (1, 2, "a", 2), (1, 3, "c", 1), (4, 0, "b", 3), (4, 1, "b", 3)]


def test_gradients_of_several_settings_in_one_pass(spark):
    rng = np.random.default_rng(13)
    x, y = rng.normal(0, 1, (90, 2)), rng.normal(0, 1, 90)
    rows = spark.createDataFrame(
        [(a.tolist(), float(b)) for a, b in zip(x, y, strict=True)] + [(None, 1.0), ([1.0, None], 1.0), ([1.0, 2.0], None)],
        "x array<double>, y double",
    )
    thetas = [[0.1, -0.4, 2.0], [0.0, 0.0, 0.0]]
    wide = np.column_stack([np.ones(90), x])
    for (gradient, loss), theta in zip(fit.gradient_step(rows, thetas, "squared"), thetas, strict=True):
        e = wide @ theta - y
        assert gradient == pytest.approx(2 * wide.T @ e / 90) and loss == pytest.approx((e**2).mean())
