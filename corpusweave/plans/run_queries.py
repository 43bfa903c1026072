"""Registered queries for run tracking."""

from pyspark.sql import functions as F

from corpusweave.operators import fit, runs as R
from corpusweave.plans.fit_queries import ROWS
from corpusweave.plans.registry import query, table

DEFAULT_ROWS = " UNION ALL ".join(f"SELECT '{f}' AS field, '{v}' AS value" for f, v in R.DEFAULTS.items())
OVERRIDES = """
    SELECT user_id AS run, CASE event_type WHEN 'view' THEN 'num_steps' WHEN 'click' THEN 'batch_size'
           WHEN 'signup' THEN 'warmup_steps' WHEN 'error' THEN 'no_such_field' ELSE 'model_dim' END AS field,
           CAST(count(*) AS {text}) AS value
    FROM events GROUP BY user_id, event_type
"""


def _overrides(spark, sf):
    table(spark, sf, "events").createOrReplaceTempView("corpusweave_events")
    return spark.sql(OVERRIDES.format(text="STRING").replace("FROM events", "FROM corpusweave_events"))


@query(
    "r1_resolve_overrides",
    f"""
    WITH o AS ({OVERRIDES.format(text='VARCHAR')}), d AS ({DEFAULT_ROWS}), r AS (SELECT DISTINCT run FROM o)
    SELECT r.run, d.field, coalesce(o.value, CASE d.field WHEN 'vocab_size' THEN '512' ELSE d.value END) AS value
    FROM r CROSS JOIN d LEFT JOIN o ON o.run = r.run AND o.field = d.field
    """,
)
def resolve(spark, sf):
    given = _overrides(spark, sf).filter("field <> 'no_such_field'")
    configs = R.resolve_configs(given, vocab_size=512)
    return configs.select("run", F.explode("config").alias("field", "value"))


@query(
    "r1_unknown_overrides",
    f"""
    WITH o AS ({OVERRIDES.format(text='VARCHAR')})
    SELECT run, field, value FROM o WHERE field NOT IN (SELECT field FROM ({DEFAULT_ROWS}))
    """,
)
def unknown(spark, sf):
    return R.unknown_overrides(_overrides(spark, sf)).select("run", "field", "value")


HISTORY = """
    h AS (SELECT user_id AS run, ts, event_id, value AS train_loss,
            CASE event_type WHEN 'error' THEN 'nan'::DOUBLE WHEN 'view' THEN value END AS val_seen FROM events),
    c AS (SELECT *, last_value(val_seen IGNORE NULLS) OVER (PARTITION BY run ORDER BY ts, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS val_loss,
            row_number() OVER (PARTITION BY run ORDER BY ts, event_id) AS k, count(*) OVER (PARTITION BY run) AS n FROM h)
"""
METRICS = f"""
    {HISTORY},
    m AS (SELECT run, arg_max(train_loss, k) AS final_train, arg_min(train_loss, k) AS first_train,
                 avg(train_loss) FILTER (k > n - greatest(1, n // 5)) AS train_tail,
                 min(val_loss) FILTER (NOT isnan(val_loss)) AS val_min, bool_or(isnan(train_loss)) AS has_nan,
                 max(n) AS num_steps, CAST(floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000) AS BIGINT) AS seconds
          FROM c GROUP BY run),
    f AS (SELECT *, CASE WHEN has_nan THEN 'NaN' WHEN final_train > first_train THEN 'DIVERGE' ELSE 'ok' END AS status FROM m)
"""


@query(
    "r2_carry_validation",
    f"""
    WITH {HISTORY} SELECT run, event_id, train_loss, CASE WHEN val_loss IS NULL OR isnan(val_loss) THEN -1.0 ELSE val_loss END AS val_loss,
    val_loss IS NULL OR isnan(val_loss) AS missing FROM c
    """,
)
def carry(spark, sf):
    out = R.carry_validation(R.event_history(table(spark, sf, "events")))
    return out.select(
        "run", "event_id", "train_loss", F.nanvl("val_loss", F.lit(-1.0)).alias("val_loss"),
        F.isnan("val_loss").alias("missing"),
    )


@query(
    "r3_run_metrics",
    f"""
    WITH {METRICS} SELECT run, round(final_train, 6) AS final_train, round(coalesce(val_min, -1.0), 6) AS val_min,
      round(train_tail, 6) AS train_tail, status, num_steps FROM f
    """,
)
def metrics(spark, sf):
    out = R.run_metrics(R.event_history(table(spark, sf, "events")))
    return out.select(
        "run",
        F.round("final_train", 6).alias("final_train"),
        F.round(F.nanvl("val_min", F.lit(-1.0)), 6).alias("val_min"),
        F.round("train_tail", 6).alias("train_tail"),
        "status",
        "num_steps",
    )


@query(
    "r3_status_with_nan",
    """
    WITH e AS (SELECT user_id AS run, ts, event_id, CASE WHEN value > 300 THEN 'nan'::DOUBLE ELSE value END AS x FROM events)
    SELECT run, CASE WHEN bool_or(isnan(x)) THEN 'NaN' WHEN arg_max(x, (ts, event_id)) > arg_min(x, (ts, event_id)) THEN 'DIVERGE'
           ELSE 'ok' END AS status, count(*) AS num_steps FROM e GROUP BY run
    """,
)
def status_with_nan(spark, sf):
    history = R.event_history(table(spark, sf, "events"))
    spoiled = history.withColumn(
        "train_loss", F.when(F.col("train_loss") > 300, F.lit(R.NAN)).otherwise(F.col("train_loss"))
    )
    return R.run_metrics(spoiled).select("run", "status", "num_steps")


@query(
    "r4_manifest",
    f"""
    WITH {METRICS} SELECT 'run_' || run AS name, status, round(final_train, 4) AS final_train,
      round(coalesce(val_min, -1.0), 4) AS val_min, round(train_tail, 4) AS train_tail, num_steps, seconds,
      '{{"num_steps":' || num_steps || '}}' AS overrides FROM f
    """,
)
def manifest(spark, sf):
    out = R.manifest(R.run_metrics(R.event_history(table(spark, sf, "events"))))
    return out.withColumn("val_min", F.nanvl("val_min", F.lit(-1.0)))


@query(
    "r5_best_run",
    f"""
    WITH {METRICS} SELECT name, round(train_tail, 6) AS train_tail
    FROM (SELECT 'run_' || run AS name, train_tail FROM f WHERE status = 'ok' ORDER BY train_tail, 'run_' || run LIMIT 1)
    """,
)
def best(spark, sf):
    out = R.run_metrics(R.event_history(table(spark, sf, "events")))
    named = out.withColumn("name", F.concat(F.lit("run_"), F.col("run").cast("string")))
    return R.best_run(named).select("name", F.round("train_tail", 6).alias("train_tail"))


TRIALS = """
    SELECT event_type, CAST(event_id % 977 AS INTEGER) AS iterations, value < 60 AND event_type <> 'signup' AS converged,
           value AS final_loss, sqrt(value) AS final_distance, value / 7 AS grad_norm FROM events
"""


@query(
    "r6_trial_summary",
    f"""
    WITH t AS ({TRIALS})
    SELECT event_type, round(100.0 * avg(converged::INTEGER), 6) AS convergence_rate,
      round(coalesce(avg(iterations) FILTER (converged), -1.0), 6) AS mean_iterations,
      round(coalesce(quantile_cont(iterations, 0.5) FILTER (converged), -1.0), 6) AS median_iterations,
      round(avg(final_loss), 6) AS mean_final_loss, round(avg(final_distance), 6) AS mean_final_distance,
      round(avg(grad_norm), 6) AS mean_grad_norm
    FROM t GROUP BY event_type
    """,
)
def trial_summary(spark, sf):
    table(spark, sf, "events").createOrReplaceTempView("corpusweave_events")
    trials = spark.sql(TRIALS.replace("FROM events", "FROM corpusweave_events"))
    out = R.summarize_trials(trials, "event_type")
    numbers = [c for c in out.columns if c != "event_type"]
    return out.select("event_type", *[F.round(F.nanvl(c, F.lit(-1.0)), 6).alias(c) for c in numbers])


@query(
    "r7_loss_reduction",
    """
    WITH e AS (SELECT user_id AS run, arg_min(value, (ts, event_id)) AS a, arg_max(value, (ts, event_id)) AS b FROM events GROUP BY user_id)
    SELECT run, a AS first_loss, b AS last_loss, round(100.0::DOUBLE * (a - b) / a, 6) AS reduction_pct FROM e
    """,
)
def loss_reduction(spark, sf):
    out = R.loss_reduction(R.event_history(table(spark, sf, "events")))
    return out.withColumn("reduction_pct", F.round("reduction_pct", 6))


@query("r7_perplexity", "SELECT event_id, round(exp(least(value / 10, 20.0)), 3) AS perplexity FROM events")
def step_perplexity(spark, sf):
    events = table(spark, sf, "events")
    return events.select("event_id", F.round(R.perplexity(F.col("value") / 10), 3).alias("perplexity"))


BATCHES = "SELECT l_linenumber AS epoch, l_tax + l_discount AS loss, CAST(l_quantity AS BIGINT) AS rows FROM lineitem"


@query(
    "r8_epoch_losses",
    f"SELECT epoch, round(sum(loss * rows) / sum(rows), 6) AS epoch_loss, CAST(sum(rows) AS BIGINT) AS rows FROM ({BATCHES}) GROUP BY epoch",
)
def epoch_losses(spark, sf):
    return R.epoch_losses(_batches(spark, sf)).withColumn("epoch_loss", F.round("epoch_loss", 6))


@query(
    "r8_best_epoch",
    f"""
    SELECT epoch, round(l, 6) AS epoch_loss FROM
      (SELECT epoch, sum(loss * rows) / sum(rows) AS l FROM ({BATCHES}) GROUP BY epoch) ORDER BY l, epoch LIMIT 1
    """,
)
def best_epoch(spark, sf):
    best = R.best_epoch(R.epoch_losses(_batches(spark, sf)))
    return best.select("epoch", F.round("epoch_loss", 6).alias("epoch_loss"))


def _batches(spark, sf):
    rows = table(spark, sf, "lineitem")
    return rows.select(
        F.col("l_linenumber").alias("epoch"),
        (F.col("l_tax") + F.col("l_discount")).alias("loss"),
        F.col("l_quantity").cast("long").alias("rows"),
    )


SWEEP = [(rule, rate) for rule in ("sgd", "momentum", "adam") for rate in (0.05, 0.1)]
SWEEP_STEPS = 8


def sweep_sql():
    """Every setting unrolled: one aggregation and one update per step."""
    score = "w0 + w1 * x1 + w2 * x2"
    out, last = [ROWS], []
    number = lambda v: f"({v!r}::DOUBLE)"
    for k, (rule, rate) in enumerate(SWEEP):
        names = [f"{n}{i}" for i in range(3) for n in "wsv"]
        out.append(f"t{k}_0 AS (SELECT " + ", ".join(f"0.0::DOUBLE AS {n}" for n in names) + ")")
        for t in range(1, SWEEP_STEPS + 1):
            grads = ", ".join(f"avg(2 * ({score} - y){x}) AS g{i}" for i, x in enumerate(("", " * x1", " * x2")))
            out.append(
                f"a{k}_{t} AS MATERIALIZED (SELECT {grads}, avg(({score} - y) * ({score} - y)) AS loss FROM r, t{k}_{t - 1})"
            )
            columns = []
            for i in range(3):
                s, v = f"s{i}", f"v{i}"
                change = f"-{number(rate)} * g{i}"
                if rule == "momentum":
                    v = change = f"(0.9::DOUBLE * v{i} - {number(rate)} * g{i})"
                if rule == "adam":
                    s = f"({number(0.9)} * s{i} + {number(1 - 0.9)} * g{i})"
                    v = f"({number(0.999)} * v{i} + {number(1 - 0.999)} * g{i} * g{i})"
                    mean, root = f"{s} / {number(1 - 0.9**t)}", f"(sqrt({v} / {number(1 - 0.999**t)}) + 1e-8::DOUBLE)"
                    change = f"-{number(rate)} * {mean} / {root}"
                columns += [f"{s} AS s{i}", f"{v} AS v{i}", f"w{i} + ({change}) AS w{i}"]
            out.append(f"t{k}_{t} AS MATERIALIZED (SELECT {', '.join(columns)} FROM t{k}_{t - 1}, a{k}_{t})")
        last.append(
            f"SELECT '{rule}_{rate}' AS name, {SWEEP_STEPS} AS steps, round(a.loss, 6) AS first_loss, round(b.loss, 6) AS last_loss "
            f"FROM a{k}_1 a, a{k}_{SWEEP_STEPS} b"
        )
    return "WITH " + ",\n".join(out) + "\n" + " UNION ALL ".join(last)


@query("r9_sweep", sweep_sql())
def sweep(spark, sf):
    """Every update rule and learning rate on the same rows, in one pass per step."""
    rows = table(spark, sf, "lineitem").select(
        F.array((F.col("l_quantity") - 25.5) / 14.4, F.col("l_discount") * 20 - 1).alias("x"),
        (F.col("l_extendedprice") / 50000 - 1).alias("y"),
    )
    settings = [fit.Setting(f"{rule}_{rate}", rule, rate) for rule, rate in SWEEP]
    fits = fit.fit_many(rows, settings, steps=SWEEP_STEPS, loss="squared")
    return spark.createDataFrame(
        [(s.name, f.steps, round(f.first_loss, 6), round(f.last_loss, 6)) for s, f in zip(settings, fits)],
        "name string, steps int, first_loss double, last_loss double",
    )
