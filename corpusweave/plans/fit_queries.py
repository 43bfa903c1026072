"""Registered queries for gradient fitting."""

import math

from pyspark.sql import functions as F

from corpusweave.operators import fit as G
from corpusweave.plans.registry import query, table

STEPS = 4
ROWS = """
    r AS MATERIALIZED (SELECT (l_quantity - 25.5::DOUBLE) / 14.4::DOUBLE AS x1, l_discount * 20 - 1 AS x2,
                              l_extendedprice / 50000 - 1 AS y,
                              CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0 END AS c FROM lineitem)
"""


def rows(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.array((F.col("l_quantity") - 25.5) / 14.4, F.col("l_discount") * 20 - 1).alias("x"),
        (F.col("l_extendedprice") / 50000 - 1).alias("y"),
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("c"),
    )


def d(value):
    return f"({value!r}::DOUBLE)"


def unrolled(update, loss="squared", clip=None, state=("s", "v")):
    """SQL of a fit: one aggregation and one parameter update per step.

    ``update(i, t)`` gives (new state dict, change of w{i}) as SQL over g{i}, w{i} and the state.
    """
    score = "w0 + w1 * x1 + w2 * x2"
    if loss == "squared":
        e, l = f"2 * ({score} - y)", f"({score} - y) * ({score} - y)"
    else:
        p = f"(1 / (1 + exp(-({score}))))"
        e, l = f"({p} - c)", f"-(c * ln({p}) + (1 - c) * ln(1 - {p}))"
    names = [f"{n}{i}" for i in range(3) for n in ("w", *state)]
    out = [ROWS, "t0 AS (SELECT " + ", ".join(f"0.0::DOUBLE AS {n}" for n in names) + ", 0.0::DOUBLE AS loss)"]
    for t in range(1, STEPS + 1):
        grads = f"avg({e}) AS g0, avg(({e}) * x1) AS g1, avg(({e}) * x2) AS g2, avg({l}) AS loss"
        out.append(f"a{t} AS (SELECT {grads} FROM r, t{t - 1})")
        factor = "1.0::DOUBLE" if clip is None else f"least(1.0::DOUBLE, {d(clip)} / (sqrt(g0*g0 + g1*g1 + g2*g2) + 1e-6::DOUBLE))"
        out.append(
            f"g{t} AS (SELECT q.* EXCLUDE (loss), a.loss, a.g0 * f AS g0, a.g1 * f AS g1, a.g2 * f AS g2 "
            f"FROM t{t - 1} q, (SELECT *, {factor} AS f FROM a{t}) a)"
        )
        cols = []
        for i in range(3):
            changed, change = update(i, t)
            cols += [f"{changed.get(n, f'{n}{i}')} AS {n}{i}" for n in state]
            cols.append(f"w{i} + ({change}) AS w{i}")
        out.append(f"t{t} AS (SELECT {', '.join(cols)}, loss FROM g{t})")
    final = f"SELECT round(w0, 7) AS w0, round(w1, 7) AS w1, round(w2, 7) AS w2, round(loss, 7) AS last_loss FROM t{STEPS}"
    return "WITH " + ",\n".join(out) + "\n" + final


def _moments(i, t, b1=0.9, b2=0.999):
    s, v = f"({d(b1)} * s{i} + {d(1 - b1)} * g{i})", f"({d(b2)} * v{i} + {d(1 - b2)} * g{i} * g{i})"
    return {"s": s, "v": v}, f"{s} / {d(1 - b1**t)}", f"(sqrt({v} / {d(1 - b2**t)}) + 1e-8::DOUBLE)"


def sgd(i, t):
    return {}, f"-0.1::DOUBLE * g{i}"


def sgd_decay(i, t):
    return {}, f"-{d(0.1 / math.sqrt(t))} * g{i}"


def momentum(i, t):
    v = f"(0.9::DOUBLE * v{i} - 0.1::DOUBLE * g{i})"
    return {"v": v}, v


def adagrad(i, t):
    s = f"(s{i} + g{i} * g{i})"
    return {"s": s}, f"-0.1::DOUBLE * g{i} / (sqrt({s}) + 1e-8::DOUBLE)"


def rmsprop(i, t):
    s = f"(0.9::DOUBLE * s{i} + {d(1 - 0.9)} * g{i} * g{i})"
    return {"s": s}, f"-0.1::DOUBLE * g{i} / (sqrt({s}) + 1e-8::DOUBLE)"


def adam(i, t):
    state, mean, root = _moments(i, t)
    return state, f"-0.1::DOUBLE * {mean} / {root}"


def adamw(i, t):
    state, mean, root = _moments(i, t)
    return state, f"-0.1::DOUBLE * ({mean} / {root} + 0.01::DOUBLE * w{i})"


def scheduled(i, t):
    return {}, f"-{d(G.warmup_cosine_value(t - 1, 3, 10, 0.2, 0.01))} * g{i}"


def _register(name, setting, update, loss="squared", target="y", clip=None):
    @query(name, unrolled(update, loss, clip))
    def run(spark, sf):
        data = rows(spark, sf).select("x", F.col(target).alias("y"))
        found = G.fit(data, setting, STEPS, loss)
        values = [round(v, 7) for v in (*found.theta, found.last_loss)]
        return spark.createDataFrame([tuple(values)], "w0 double, w1 double, w2 double, last_loss double")


_register("g1_linear_gradient", G.Setting("a", "sgd", 0.1), sgd)
_register("g1_logistic_gradient", G.Setting("a", "sgd", 0.1), sgd, "logistic", "c")
_register("g2_sgd_decay", G.Setting("a", "sgd", 0.1, options={"decay": True}), sgd_decay)
_register("g3_momentum", G.Setting("a", "momentum", 0.1), momentum)
_register("g4_adagrad", G.Setting("a", "adagrad", 0.1), adagrad)
_register("g5_rmsprop", G.Setting("a", "rmsprop", 0.1), rmsprop)
_register("g6_adam", G.Setting("a", "adam", 0.1), adam)
_register("g7_adamw", G.Setting("a", "adamw", 0.1, options={"weight_decay": 0.01}), adamw)
_register(
    "g8_scheduled_fit",
    G.Setting("a", "sgd", 0.1, schedule=lambda s: G.warmup_cosine_value(s, 3, 10, 0.2, 0.01)),
    scheduled,
)
_register("g9_clipped_fit", G.Setting("a", "sgd", 0.1, clip=0.05), sgd, clip=0.05)


@query(
    "g8_schedule",
    """
    SELECT event_id, round(CASE WHEN event_id + 1 < 500 THEN 0.1::DOUBLE * (event_id + 1) / 500
      WHEN event_id + 1 <= 8000 THEN 0.0001::DOUBLE + 0.5::DOUBLE * 0.0999::DOUBLE * (1 + cos(pi() * (event_id + 1 - 500) / 7500))
      ELSE 0.0001::DOUBLE END, 9) AS rate FROM events
    """,
)
def schedule(spark, sf):
    events = table(spark, sf, "events")
    return events.select(
        "event_id", F.round(G.warmup_cosine(F.col("event_id"), 500, 8000, 0.1, 0.0001), 9).alias("rate")
    )


@query(
    "g9_clip_groups",
    """
    WITH z AS (SELECT label, unnest(embedding)::DOUBLE AS v FROM embeddings), n AS (SELECT label, sqrt(sum(v * v)) AS norm FROM z GROUP BY label)
    SELECT label, round(norm, 6) AS norm, round(least(1.0::DOUBLE, 7.0::DOUBLE / (norm + 1e-6::DOUBLE)), 9) AS factor FROM n
    """,
)
def clip_groups(spark, sf):
    out = G.clip_groups(table(spark, sf, "embeddings"), "label", "embedding", 7.0)
    return out.select("label", F.round("norm", 6).alias("norm"), F.round("factor", 9).alias("factor"))
