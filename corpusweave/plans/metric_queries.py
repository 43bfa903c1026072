"""Registered queries for losses and prediction metrics."""

from pyspark.sql import functions as F

from corpusweave.functions import arrays as A
from corpusweave.operators import metrics as L
from corpusweave.functions.draws import digest_sql
from corpusweave.plans.registry import query, table

LONG = """
    z AS MATERIALIZED (SELECT vec_id, label, unnest(embedding)::DOUBLE AS z, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS i FROM embeddings),
    e AS (SELECT *, exp(z - max(z) OVER (PARTITION BY vec_id)) AS e, max(z) OVER (PARTITION BY vec_id) AS top FROM z),
    p AS MATERIALIZED (SELECT *, e / sum(e) OVER (PARTITION BY vec_id) AS p, top + ln(sum(e) OVER (PARTITION BY vec_id)) AS lse FROM e)
"""


def _errors(name, column, sql):
    @query(
        name,
        f"""
        WITH r AS (SELECT l_returnflag, l_extendedprice - 1500 * l_quantity AS e FROM lineitem)
        SELECT l_returnflag, round({sql}, 4) AS {column} FROM r GROUP BY l_returnflag
        """,
    )
    def run(spark, sf):
        rows = table(spark, sf, "lineitem").select(
            "l_returnflag", F.col("l_extendedprice").alias("y"), (1500 * F.col("l_quantity")).alias("p")
        )
        out = L.regression_errors(rows, "y", "p", ["l_returnflag"], delta=10_000.0)
        return out.select("l_returnflag", F.round(column, 4).alias(column))

    return run


_errors("l1_mae", "mae", "avg(abs(e))")
_errors("l2_mse", "mse", "avg(e * e)")
_errors("l3_rmse", "rmse", "sqrt(avg(e * e))")
_errors("l4_huber", "huber", "avg(CASE WHEN abs(e) <= 10000 THEN 0.5::DOUBLE * e * e ELSE 10000::DOUBLE * (abs(e) - 5000) END)")


@query(
    "l5_binary_cross_entropy",
    """
    WITH r AS (SELECT lang, quality, greatest(1e-15::DOUBLE, least(1 - 1e-15::DOUBLE, 1 / (1 + exp(-(n_chars - 2000) / 1000.0::DOUBLE)))) AS p
               FROM labels JOIN documents USING (doc_id))
    SELECT lang, round(avg(-(quality * ln(p) + (1 - quality) * ln(1 - p))), 6) AS bce, count(*) AS n FROM r GROUP BY lang
    """,
)
def bce(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    rows = table(spark, sf, "labels").join(docs, "doc_id")
    scored = rows.withColumn("p", L.sigmoid((F.col("n_chars") - 2000) / 1000.0))
    out = L.binary_cross_entropy(scored, "quality", "p", ["lang"])
    return out.withColumn("bce", F.round("bce", 6))


@query(
    "l6_probability_loss",
    f"WITH {LONG} SELECT label, round(avg(-ln(greatest(p, 1e-12::DOUBLE))), 6) AS loss FROM p WHERE i = label GROUP BY label",
)
def probability_loss(spark, sf):
    rows = L.probabilities(table(spark, sf, "embeddings"), "embedding")
    return rows.groupBy("label").agg(
        F.round(F.avg(L.probability_loss(F.col("probs"), F.col("label"))), 6).alias("loss")
    )


@query(
    "l7_cross_entropy",
    f"WITH {LONG} SELECT label, round(avg(lse - z), 6) AS loss, count(*) AS n FROM p WHERE i = label GROUP BY label",
)
def cross_entropy(spark, sf):
    out = L.cross_entropy(table(spark, sf, "embeddings"), "embedding", "label", ["label"])
    return out.withColumn("loss", F.round("loss", 6))


@query(
    "l8_softmax",
    """
    WITH z AS (SELECT vec_id, unnest(embedding)::DOUBLE / 0.5 AS z, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS class FROM embeddings),
    e AS (SELECT *, exp(z - max(z) OVER (PARTITION BY vec_id)) AS e FROM z)
    SELECT vec_id, class, round(e / sum(e) OVER (PARTITION BY vec_id), 9) AS prob FROM e
    """,
)
def softmax(spark, sf):
    rows = L.probabilities(table(spark, sf, "embeddings"), "embedding", 0.5)
    return rows.select("vec_id", F.posexplode("probs").alias("class", "p")).select(
        "vec_id", "class", F.round("p", 9).alias("prob")
    )


@query(
    "l9_greedy_class",
    f"WITH {LONG} SELECT vec_id, min(i) AS class FROM p WHERE z = top GROUP BY vec_id",
)
def greedy_class(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", A.doubles("embedding").alias("z"))
    return rows.select("vec_id", L.predicted_class(F.col("z")).alias("class"))


@query(
    "l10_sampled_class",
    f"""
    WITH {LONG},
    c AS (SELECT vec_id, i, sum(p) OVER (PARTITION BY vec_id ORDER BY i) AS upto,
                 (({digest_sql('vec_id', '5')} >> 8) + 0.5::DOUBLE) / 4503599627370496 AS u FROM p)
    SELECT vec_id, CAST(least(count(*) FILTER (upto < u), 63) AS INTEGER) AS class FROM c GROUP BY vec_id
    """,
)
def sampled_class(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", A.doubles("embedding").alias("z"))
    drawn = L.predicted_class(F.col("z"), 1.0, L.seeded_draw(F.col("vec_id"), 5))
    return rows.select("vec_id", drawn.alias("class"))


@query(
    "l11_top_classes",
    f"""
    WITH {LONG}, r AS (SELECT vec_id, i, p, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, i) - 1 AS place FROM p)
    SELECT vec_id, CAST(place AS INTEGER) AS place, i AS class, round(p, 9) AS prob FROM r WHERE place < 5
    """,
)
def top_classes(spark, sf):
    out = L.top_classes(table(spark, sf, "embeddings"), "embedding", 5, "vec_id")
    return out.withColumn("prob", F.round("prob", 9))


@query(
    "l12_bias_gradient",
    f"WITH {LONG} SELECT i AS class, round(avg(p - CASE WHEN i = label THEN 1 ELSE 0 END), 9) AS gradient FROM p GROUP BY i",
)
def bias_gradient(spark, sf):
    out = L.bias_gradient(table(spark, sf, "embeddings"), "embedding", "label")
    return out.withColumn("gradient", F.round("gradient", 9))
