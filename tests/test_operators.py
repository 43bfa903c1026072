import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusweave.functions import arrays as A
from corpusweave.operators import dataset, fit, metrics, ngram, runs, stats, text, vectors
from corpusweave.sources import runs as run_files, texts


def test_losses_on_known_values(spark):
    rows = spark.createDataFrame([(0, 0.1), (0, 0.2), (1, 0.8), (1, 0.9)], "y int, p double")
    expected = -(math.log(0.9) + math.log(0.8)) / 2
    assert metrics.binary_cross_entropy(rows, "y", "p").first()["bce"] == pytest.approx(expected)
    z = spark.createDataFrame([([1.0, 3.0, 0.5, -2.0],)], "z array<double>")
    assert z.select(metrics.predicted_class(F.col("z"))).first()[0] == 1
    assert sum(z.select(A.softmax(F.col("z"))).first()[0]) == pytest.approx(1)
    with pytest.raises(ValueError):
        metrics.predicted_class(F.col("z"), -1.0)


def test_rotation_keeps_pair_norms(spark):
    rows = spark.createDataFrame([([3.0, 4.0, 1.0, 2.0], 7)], "v array<double>, pos int")
    out = rows.select(vectors.rotate(F.col("v"), F.col("pos"), 4)).first()[0]
    assert math.hypot(*out[:2]) == pytest.approx(5) and math.hypot(*out[2:]) == pytest.approx(math.hypot(1, 2))
    with pytest.raises(ValueError):
        vectors.rotate(F.col("v"), F.col("pos"), 3)


def test_causal_lookup_across_blocks(spark):
    rows = spark.createDataFrame([(1, i, [float(i), 1.0]) for i in range(20)], "s int, p int, v array<double>")
    small = vectors.causal_lookup(rows, "s", "p", "v", 3, block=4).orderBy("p").collect()
    whole = vectors.causal_lookup(rows, "s", "p", "v", 3, block=4096).orderBy("p").collect()
    assert len(small) == 20
    for a, b in zip(small, whole):
        assert a["pooled"] == pytest.approx(b["pooled"])


def test_best_matches_in_query_batches(spark, monkeypatch):
    keys = spark.createDataFrame([(i, [math.cos(i), math.sin(i)]) for i in range(300)], "vec_id long, embedding array<double>")
    queries = keys.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query")).filter("query_id < 5")
    one = vectors.best_matches(keys.repartition(5), queries, 3).collect()
    monkeypatch.setattr(vectors, "QUERY_BATCH", 2)
    many = vectors.best_matches(keys, queries, 3).collect()
    def shown(rows):
        return sorted((r["query_id"], r["place"], r["vec_id"], round(r["score"], 9)) for r in rows)

    assert shown(one) == shown(many) and len(one) == 15


def test_layer_norm(spark):
    rows = spark.createDataFrame([([1.0, 2.0, 3.0, 6.0],)], "v array<double>")
    out = vectors.layer_norm(rows, "v").first()["normed"]
    assert sum(out) == pytest.approx(0, abs=1e-9) and sum(x * x for x in out) / 4 == pytest.approx(1, abs=1e-4)
    with pytest.raises(Exception, match="width must be"):
        vectors.layer_norm(rows, "v", gamma=[1.0]).collect()


def test_short_sequences_give_no_windows(spark):
    rows = spark.createDataFrame([(0, [1, 2]), (1, []), (2, list(range(10)))], "doc_id long, ids array<int>")
    assert dataset.strided_blocks(rows, 4).select("doc_id", "start").collect() == [(2, 0), (2, 4)]
    assert dataset.sliding_windows(rows, 3).count() == 7
    padded = rows.select(dataset.left_pad(F.col("ids"), 3).alias("p")).collect()
    assert [r["p"] for r in padded] == [[0, 1, 2], [0, 0, 0], [7, 8, 9]]


def test_char_windows(spark):
    rows = spark.createDataFrame([("a🙂bc",)], "text string")
    assert rows.select(ngram.char_ngrams(F.col("text"), 2)).first()[0] == ["a🙂", "🙂b"]
    assert rows.select(ngram.char_ngrams(F.col("text"), 2, True)).first()[0] == ["a🙂", "🙂b", "bc"]


def test_char_vocabulary_unknown(spark):
    rows = spark.createDataFrame([("abz",)], "text string")
    ids = rows.select(text.encode_chars(F.col("text"), ["a", "b"])).first()[0]
    assert ids == [0, 1]
    with pytest.raises(Exception, match="not in vocabulary"):
        rows.select(text.encode_chars(F.col("text"), ["a", "b"], "error")).collect()
    back = spark.createDataFrame([([0, 5, 1],)], "ids array<int>")
    assert back.select(text.decode_chars(F.col("ids"), ["a", "b"])).first()[0] == "a?b"


def test_posterior(spark):
    rows = spark.createDataFrame([(1, i, i < 7) for i in range(10)], "k int, t int, hit boolean")
    last = stats.group_beta(rows, ["k"], F.col("hit")).first()
    assert (last["alpha"], last["beta"]) == (9, 5)
    assert last["posterior_mean"] == pytest.approx(9 / 14) and last["map"] == pytest.approx(8 / 12)


def test_run_status(spark):
    nan = float("nan")
    rows = [("up", 0, 1.0), ("up", 1, 2.0), ("down", 0, 2.0), ("down", 1, 1.0), ("bad", 0, nan), ("bad", 1, 1.0)]
    history = spark.createDataFrame([(*r, None) for r in rows], "run string, step int, train_loss double, val_seen double")
    history = history.withColumn("ts", F.timestamp_seconds("step")).withColumn("event_id", F.col("step"))
    status = {r["run"]: r["status"] for r in runs.run_metrics(history).collect()}
    assert status == {"up": "DIVERGE", "down": "ok", "bad": "NaN"}


def test_overrides_and_experiments(spark, tmp_path):
    given = spark.createDataFrame([("a", "num_steps", "7"), ("a", "zzz", "1")], "run string, field string, value string")
    with pytest.raises(ValueError, match="zzz"):
        runs.resolve_configs(given)
    config = runs.resolve_configs(given.filter("field <> 'zzz'")).first()["config"]
    assert config["num_steps"] == "7" and config["batch_size"] == "32"
    path = tmp_path / "runs.json"
    path.write_text('[{"name": "a", "overrides": {"num_steps": 3}}, {"name": "a", "overrides": {}}]')
    with pytest.raises(ValueError, match="duplicate"):
        run_files.read_experiments(spark, str(path))


def test_negative_rate(spark):
    with pytest.raises(ValueError):
        fit.fit(spark.createDataFrame([([1.0], 1.0)], "x array<double>, y double"), fit.Setting("a", "sgd", -1.0), 1)


def test_text_records_and_invalid_bytes(spark, tmp_path):
    path = tmp_path / "t.txt"
    path.write_bytes(b"one\xff\n<|endoftext|>two \xef\xbf\xbd")
    records = [r["text"] for r in texts.read_records(spark, str(path)).collect()]
    assert records == ["one\n", "two �"]


def test_draws_hold_for_any_key_and_range(spark):
    from corpusweave.functions.draws import residue
    from corpusweave.operators import dataset, metrics

    keys = spark.createDataFrame([(2**63 - 1,), (-(2**63),), (4_000_000_000,), (7,)], "key long")
    out = keys.select("key", residue(F.col("key"), 3, 1_000_003).alias("r"), metrics.seeded_draw(F.col("key")).alias("u"))
    for row in out.collect():
        assert row["r"] == (row["key"] * 2654435761 + 3) % 1_000_003
        assert 0 < row["u"] < 1
    starts = spark.range(1000).select(dataset.draw_start(F.col("id"), 7, 10**13).alias("s"))
    low, high, mean = starts.agg(F.min("s"), F.max("s"), F.avg("s")).first()
    assert 0 <= low < 10**11 and 10**13 - 10**11 < high < 10**13 and abs(mean / 10**13 - 0.5) < 0.05


def test_replicates_are_independent_poisson_draws(spark):
    from corpusweave.operators import stats

    rows = spark.range(2000).crossJoin(spark.range(60).withColumnRenamed("id", "r"))
    drawn = rows.select("r", stats.resample_weight(F.col("id"), F.col("r")).alias("w"))
    mean, variance = drawn.agg(F.avg("w"), F.var_pop("w")).first()
    assert abs(mean - 1) < 0.02 and abs(variance - 1) < 0.03
    spread = drawn.groupBy("r").agg(F.sum("w").alias("s")).agg(F.stddev_pop("s")).first()[0]
    assert 34 < spread < 56  # sqrt(2000) is 44.7


def test_lasso_penalises_half_as_much_as_it_weighs(spark):
    from corpusweave.operators import stats

    points = [(float(x), 3.0 * x + (x % 3) - 1) for x in range(-10, 11)]
    rows = spark.createDataFrame(points, "x double, y double")
    mean = sum(y for _, y in points) / len(points)
    sxy, sxx = sum(x * (y - mean) for x, y in points), sum(x * x for x, _ in points)
    for alpha in (40.0, 400.0):
        fit = {r["term"]: r["value"] for r in stats.penalized_fit(rows, ["x"], "y", alpha, lasso=True).collect()}
        assert abs(fit["x"] - (sxy - alpha / 2) / sxx) < 1e-4


def test_all_unknown_fields_are_named(spark):
    import pytest
    from corpusweave.operators import runs

    rows = spark.createDataFrame([("a", f"f{k:03d}", "1") for k in range(300)], "run string, field string, value string")
    with pytest.raises(ValueError, match="f000.*f299"):
        runs.resolve_configs(rows)


def test_random_windows_span_documents(spark):
    from corpusweave.operators import dataset

    parts = [[1, 2], [], list(range(3, 40)), [40], [41, 42, 43]]
    flat = [i for p in parts for i in p]
    tokens = spark.createDataFrame(list(enumerate(parts)), "doc_id long, ids array<int>")
    draws = spark.range(60).withColumnRenamed("id", "draw")
    rows = dataset.random_windows(tokens, draws, "draw", 4, seed=3).collect()
    assert sorted(r["draw"] for r in rows) == list(range(60))
    assert len({r["start"] for r in rows}) > 10
    for r in rows:
        assert r["x"] == flat[r["start"] : r["start"] + 4]
        assert r["y"] == flat[r["start"] + 1 : r["start"] + 5]


def test_small_histories_are_written_by_several_tasks(spark, tmp_path):
    few = spark.range(64).selectExpr("concat('r', id) AS run", "id AS k", "'1.0 nan' AS value")
    run_files.write_history_lines(few, f"{tmp_path}/few", ["k"])
    written = list((tmp_path / "few").glob("run=*/part-*"))
    assert len(written) == 64 and len({file.name.split("-")[1] for file in written}) > 1


def test_histories_keep_run_and_order(spark, tmp_path):
    from corpusweave.sources import runs

    lines = [("a b", k, f"{9 - k}.5 nan") for k in range(5)] + [("c", k, f"{k}.25 1.0") for k in range(3)]
    path = f"{tmp_path}/histories"
    runs.write_history_lines(spark.createDataFrame(lines, "run string, k int, value string"), path, ["k"])
    found = sorted((r["run"], r["step"], r["train_loss"]) for r in runs.read_history(spark, path).collect())
    assert found == [("a b", k, 9.5 - k) for k in range(5)] + [("c", k, k + 0.25) for k in range(3)]
    (tmp_path / "one.txt").write_text("# train_loss val_loss\n3.0 nan\n2.0 1.5\n")
    single = runs.read_history(spark, f"{tmp_path}/one.txt").orderBy("step").collect()
    assert [(r["run"], r["step"], r["train_loss"]) for r in single] == [("one.txt", 0, 3.0), ("one.txt", 1, 2.0)]


def test_a_run_that_begins_at_zero_has_an_infinite_reduction(spark):
    rows = [(1, 1, 0.0), (1, 2, 3.0), (2, 1, 0.0), (2, 2, 0.0), (3, 1, 4.0), (3, 2, 1.0), (4, 1, None)]
    history = spark.createDataFrame(rows, "run int, ts int, train_loss double").withColumn("event_id", F.col("ts"))
    found = {r["run"]: r["reduction_pct"] for r in runs.loss_reduction(history).collect()}
    assert found[1] == -math.inf and math.isnan(found[2]) and found[3] == 75.0 and found[4] is None


ODD_TEXTS = [None, "", " ", "a", "A b", "a b  c\td\n", " Ärger über b c d e f a b c ", "x　y z\x1cw v", "🙂 b 🙂 b 🙂 b 🙂"]


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("include_last", [False, True])
@pytest.mark.parametrize("n", [1, 2, 3])
def test_word_windows_are_strings_from_the_start(spark, n, include_last):
    docs = spark.createDataFrame([(t,) for t in ODD_TEXTS], "text string")
    out = ngram.word_ngram_counts(docs, n, include_last=include_last)
    assert "transform(" not in optimized(out)
    want = Counter()
    for t in ODD_TEXTS:
        w = (t or "").lower().split()
        for i in range(max(len(w) - n + include_last, 0)):
            want[" ".join(w[i : i + n - 1]), w[i + n - 1]] += 1
    assert {(r["context"], r["next"]): r["cnt"] for r in out.collect()} == want


@pytest.mark.parametrize("include_last", [False, True])
@pytest.mark.parametrize("n", [1, 2, 4, 7])
def test_character_windows_are_counted_in_tasks(spark, n, include_last):
    # Seven of 8,000 characters do not fit into one number.
    texts = [*ODD_TEXTS, "abcabcabcabc" * 20, "".join(map(chr, range(0x4E00, 0x4E00 + 8000))) * 2]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    out = ngram.char_ngram_counts(docs, n, include_last=include_last)
    assert "explode(" not in optimized(out)
    want = Counter()
    for t in texts:
        for i in range(max(len(t or "") - n + include_last, 0)):
            want[t[i : i + n - 1], t[i + n - 1]] += 1
    assert {(r["context"], r["next"]): r["cnt"] for r in out.collect()} == want


def test_windows_are_not_sliced_one_by_one(spark):
    rows = spark.createDataFrame([(1, [5, 6, 7, 8, 9]), (2, [1, 2]), (3, None), (None, [4, 4, 4])], "doc_id long, ids array<int>")
    out = dataset.sliding_windows(rows, 2)
    assert "transform(" not in optimized(out)
    found = {(r["doc_id"], r["start"], tuple(r["context"]), r["target"]) for r in out.collect()}
    assert found == {(1, 0, (5, 6), 7), (1, 1, (6, 7), 8), (1, 2, (7, 8), 9), (None, 0, (4, 4), 4)}


def test_resamples_draw_once(spark):
    rows = spark.range(40).selectExpr("id AS key", "double(id % 5) AS x", "double(id) AS y")
    out = rows.select(stats.resample_weight(F.col("key"), F.lit(3)).alias("w"), "key").withColumn("v", F.col("w") * 2)
    cuts = stats.poisson_cuts()
    for r in out.collect():
        drawn = int(hashlib.md5(f"{r['key']}:3".encode()).hexdigest()[:15], 16)
        assert r["w"] == sum(drawn >= c for c in cuts)
    assert stats.bias_variance(rows, "x", "y", "key", 2.0, 8).first()["variance"] > 0
    assert "conv(" not in optimized(out)
