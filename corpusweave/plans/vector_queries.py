"""Registered queries for embedding vectors."""

from pyspark.sql import functions as F

from corpusweave.functions import arrays as A
from corpusweave.operators import vectors as V
from corpusweave.plans.registry import query, table

WIDTH = 64
LONG = """
    z AS MATERIALIZED (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS dim FROM embeddings)
"""


def long_form(df, key, vector, name="value", digits=9):
    return df.select(*key, F.posexplode(vector).alias("dim", "_v")).select(
        *key, "dim", (F.round("_v", digits) + F.lit(0.0)).alias(name)
    )


@query(
    "e1_lookup",
    """
    SELECT l_returnflag, l_suppkey % 500 AS vec_id, count(*) AS n, round(sum(embedding[1]::DOUBLE), 6) AS first_sum,
           round(sum(embedding[64]::DOUBLE), 6) AS last_sum
    FROM lineitem JOIN embeddings ON vec_id = l_suppkey % 500 GROUP BY ALL
    """,
)
def lookup(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_returnflag", (F.col("l_suppkey") % 500).alias("vec_id"))
    found = V.lookup(rows, "vec_id", table(spark, sf, "embeddings"))
    return found.groupBy("l_returnflag", "vec_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum(F.get("embedding", F.lit(0)).cast("double")), 6).alias("first_sum"),
        F.round(F.sum(F.get("embedding", F.lit(63)).cast("double")), 6).alias("last_sum"),
    )


TURNS = "SELECT conv_id, turn, (conv_id * 31 + turn) % 500 AS vec_id FROM conversations"


def turns(spark, sf):
    rows = table(spark, sf, "conversations").select(
        "conv_id", "turn", ((F.col("conv_id") * 31 + F.col("turn")) % 500).alias("vec_id")
    )
    return V.lookup(rows, "vec_id", table(spark, sf, "embeddings"))


@query(
    "e2_context_features",
    f"""
    WITH t AS ({TURNS}), v AS (SELECT conv_id, turn, embedding FROM t JOIN embeddings USING (vec_id)),
    j AS (SELECT a.conv_id, a.turn, b.embedding || c.embedding || a.embedding AS f FROM v a
          JOIN v b ON b.conv_id = a.conv_id AND b.turn = a.turn - 2 JOIN v c ON c.conv_id = a.conv_id AND c.turn = a.turn - 1)
    SELECT conv_id, turn, CAST(generate_subscripts(f, 1) - 1 AS INTEGER) AS dim, round(unnest(f)::DOUBLE, 9) + 0.0::DOUBLE AS value FROM j
    """,
)
def context_features(spark, sf):
    rows = V.context_features(turns(spark, sf), "conv_id", "turn", "embedding", 3)
    return long_form(rows.withColumn("features", A.doubles("features")), ["conv_id", "turn"], "features")


PE = "CASE WHEN dim % 2 = 0 THEN sin({pos} * pow(10000.0::DOUBLE, -(dim - dim % 2)::DOUBLE / {w})) ELSE cos({pos} * pow(10000.0::DOUBLE, -(dim - dim % 2)::DOUBLE / {w})) END"


@query(
    "e3_position_table",
    f"""
    WITH p AS (SELECT DISTINCT length(text) // 100 AS pos FROM documents), d AS (SELECT pos, CAST(unnest(range(0, 15)) AS INTEGER) AS dim FROM p)
    SELECT pos, dim, round({PE.format(pos='pos', w=15)}, 6) + 0.0::DOUBLE AS value FROM d
    """,
)
def position_table(spark, sf):
    pos = table(spark, sf, "documents").select(F.expr("cast(length(text) div 100 as long)").alias("pos")).distinct()
    return long_form(pos.withColumn("pe", V.positional(F.col("pos"), 15)), ["pos"], "pe", digits=6)


@query(
    "e4_add_positions",
    f"WITH {LONG} SELECT vec_id, dim, round(v + {PE.format(pos='(vec_id % 128)', w=64)}, 6) + 0.0::DOUBLE AS value FROM z",
)
def add_positions(spark, sf):
    rows = table(spark, sf, "embeddings")
    added = V.add_positions(F.col("embedding"), F.col("vec_id") % 128, WIDTH, 128)
    return long_form(rows.withColumn("x", added), ["vec_id"], "x", digits=6)


@query(
    "e5_rotate",
    f"""
    WITH {LONG}, a AS (SELECT *, (vec_id % 128) * pow(10000.0::DOUBLE, -(dim - dim % 2)::DOUBLE / 64) AS a FROM z)
    SELECT x.vec_id, x.dim, round(x.v * cos(x.a) + CASE WHEN x.dim % 2 = 0 THEN -y.v ELSE y.v END * sin(x.a), 6) + 0.0::DOUBLE AS value
    FROM a x JOIN z y ON y.vec_id = x.vec_id AND y.dim = CASE WHEN x.dim % 2 = 0 THEN x.dim + 1 ELSE x.dim - 1 END
    """,
)
def rotate(spark, sf):
    rows = table(spark, sf, "embeddings").withColumn("v", A.doubles("embedding"))
    turned = V.rotate(F.col("v"), F.col("vec_id") % 128, WIDTH)
    return long_form(rows.withColumn("x", turned), ["vec_id"], "x", digits=6)


@query(
    "e6_layer_norm",
    f"""
    WITH {LONG}
    SELECT vec_id, dim, round((v - avg(v) OVER w) / sqrt(var_pop(v) OVER w + 1e-5::DOUBLE) * (1 + dim / 64.0::DOUBLE) + 0.25::DOUBLE, 6) + 0.0::DOUBLE AS value
    FROM z WINDOW w AS (PARTITION BY vec_id)
    """,
)
def layer_norm(spark, sf):
    gamma, beta = [1 + i / 64 for i in range(WIDTH)], [0.25] * WIDTH
    rows = V.layer_norm(table(spark, sf, "embeddings").select("vec_id", "embedding"), "embedding", gamma, beta)
    return long_form(rows, ["vec_id"], "normed", digits=6)


MEANS = f"{LONG}, m AS (SELECT label, dim, avg(v) AS m FROM z GROUP BY label, dim)"


@query(
    "e7_similarity",
    f"""
    WITH {MEANS} SELECT vec_id, round(sum(v * m), 9) + 0.0::DOUBLE AS score, round(sum(v * m) / 8, 9) + 0.0::DOUBLE AS scaled
    FROM z JOIN m USING (label, dim) GROUP BY vec_id
    """,
)
def similarity(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", "label", A.doubles("embedding").alias("v"))
    both = rows.join(V.group_means(rows, "label", "v"), "label")
    return both.select(
        "vec_id",
        (F.round(V.similarity(F.col("v"), F.col("mean")), 9) + F.lit(0.0)).alias("score"),
        (F.round(V.similarity(F.col("v"), F.col("mean"), True), 9) + F.lit(0.0)).alias("scaled"),
    )


@query(
    "e8_best_matches",
    f"""
    WITH {MEANS}, s AS (SELECT m.label AS query_id, vec_id, sum(v * m) AS score FROM z JOIN m USING (dim) GROUP BY ALL)
    SELECT query_id, vec_id, round(score, 9) AS score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS place
    FROM s QUALIFY place <= 10
    """,
)
def best_matches(spark, sf):
    keys = table(spark, sf, "embeddings")
    queries = V.group_means(keys, "label", "embedding").select(
        F.col("label").cast("long").alias("query_id"), F.col("mean").alias("query")
    )
    out = V.best_matches(keys, queries, 10)
    return out.select(
        F.col("query_id").cast("int").alias("query_id"), "vec_id", F.round("score", 9).alias("score"), "place"
    )


@query(
    "e9_soft_lookup",
    f"""
    WITH {MEANS}, s AS (SELECT vec_id, label, sum(v * m) AS s FROM z JOIN m USING (label, dim) GROUP BY vec_id, label),
    w AS (SELECT vec_id, label, exp(s - max(s) OVER (PARTITION BY label)) AS w FROM s)
    SELECT label, dim, round(sum(w * v) / sum(w), 9) + 0.0::DOUBLE AS value FROM z JOIN w USING (vec_id, label) GROUP BY label, dim
    """,
)
def soft_lookup(spark, sf):
    rows = table(spark, sf, "embeddings").select("label", A.doubles("embedding").alias("v"))
    scored = rows.join(V.group_means(rows, "label", "v"), "label").withColumn(
        "score", V.similarity(F.col("v"), F.col("mean"))
    )
    pooled = V.soft_lookup(scored, "label", "score", "v")
    return pooled.withColumn("value", F.round("value", 9) + F.lit(0.0))


@query(
    "e10_causal_lookup",
    f"""
    WITH t AS ({TURNS}), v AS (SELECT conv_id, turn, CAST(unnest(embedding) AS DOUBLE) AS v, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS dim
         FROM t JOIN embeddings USING (vec_id)),
    s AS (SELECT q.conv_id, q.turn, k.turn AS kt, sum(q.v * k.v) / 8 AS s FROM v q JOIN v k
          ON k.conv_id = q.conv_id AND k.dim = q.dim AND k.turn <= q.turn AND q.turn - k.turn < 4 GROUP BY ALL),
    w AS (SELECT *, exp(s - max(s) OVER (PARTITION BY conv_id, turn)) AS w FROM s)
    SELECT w.conv_id, w.turn, v.dim, round(sum(w * v) / sum(w), 9) + 0.0::DOUBLE AS value
    FROM w JOIN v ON v.conv_id = w.conv_id AND v.turn = w.kt GROUP BY ALL
    """,
)
def causal_lookup(spark, sf):
    out = V.causal_lookup(turns(spark, sf), "conv_id", "turn", "embedding", 4)
    return long_form(out, ["conv_id", "turn"], "pooled")


@query(
    "e11_activation_report",
    f"""
    WITH {LONG} SELECT label, round(avg(CASE WHEN v <= 0 THEN 1.0::DOUBLE ELSE 0 END), 9) AS zero_share,
      round(avg(1 / (1 + exp(-v))), 9) AS mean_sigmoid, round(avg(v / (1 + exp(-v))), 9) AS mean_silu FROM z GROUP BY label
    """,
)
def activation_report(spark, sf):
    out = V.activation_report(table(spark, sf, "embeddings"), "label", "embedding")
    return out.select("label", *[F.round(c, 9).alias(c) for c in ("zero_share", "mean_sigmoid", "mean_silu")])


@query(
    "e12_vector_sums",
    f"WITH {LONG} SELECT label, dim, round(sum(v), 6) + 0.0::DOUBLE AS total, round(avg(v), 9) + 0.0::DOUBLE AS mean, count(*)::DOUBLE AS weight FROM z GROUP BY label, dim",
)
def vector_sums(spark, sf):
    out = V.vector_sums(table(spark, sf, "embeddings"), ["label"], "embedding")
    return out.select(
        "label",
        "dim",
        (F.round("total", 6) + F.lit(0.0)).alias("total"),
        (F.round(F.col("total") / F.col("weight"), 9) + F.lit(0.0)).alias("mean"),
        "weight",
    )
