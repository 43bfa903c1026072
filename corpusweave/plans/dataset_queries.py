"""Registered queries for training-set construction (D1-D12); tokens are code points."""

from pyspark.sql import functions as F

from corpusweave.functions.draws import digest_sql
from corpusweave.operators import dataset as D
from corpusweave.operators.text import code_points
from corpusweave.plans.registry import query, texts


def tokens(spark, sf, *more):
    docs = texts(spark, sf, "doc_id", *more, "text")
    return docs.select("doc_id", *more, code_points(F.col("text")).alias("ids"))


def joined(column):
    return F.array_join(F.transform(column, lambda i: i.cast("string")), ",")


LIST = "list_transform(string_split(text, ''), lambda c: unicode(c))"
TOKENS = f"k AS MATERIALIZED (SELECT doc_id, lang, {LIST} AS ids FROM documents)"
STREAM = (
    f"{TOKENS}, u AS (SELECT doc_id, unnest(ids) AS token_id, generate_subscripts(ids, 1) - 1 AS ix FROM k), "
    "s AS MATERIALIZED (SELECT row_number() OVER (ORDER BY doc_id, ix) - 1 AS pos, doc_id, ix, token_id FROM u)"
)


@query(
    "d1_token_stream",
    f"""
    WITH {STREAM} SELECT pos // 1000 AS block, count(*) AS n, CAST(sum(token_id * (pos % 97)) AS BIGINT) AS check_sum,
      min(doc_id) AS first_doc, max(doc_id) AS last_doc FROM s GROUP BY block
    """,
)
def token_stream(spark, sf):
    stream = D.token_stream(tokens(spark, sf))
    return stream.groupBy(F.expr("pos div 1000").alias("block")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("token_id") * (F.col("pos") % 97)).alias("check_sum"),
        F.min("doc_id").alias("first_doc"),
        F.max("doc_id").alias("last_doc"),
    )


@query(
    "d2_next_tokens",
    f"""
    WITH {TOKENS} SELECT doc_id, array_to_string(ids[1:len(ids)-1], ',') AS x, array_to_string(ids[2:], ',') AS y
    FROM k WHERE len(ids) > 1
    """,
)
def next_tokens(spark, sf):
    return D.next_tokens(tokens(spark, sf)).select("doc_id", joined("x").alias("x"), joined("y").alias("y"))


@query(
    "d3_strided_blocks",
    f"""
    WITH {TOKENS}, b AS (SELECT doc_id, ids, unnest(range(0, len(ids) - 64 - 1, 64)) AS start FROM k)
    SELECT doc_id, CAST(start AS INTEGER) AS start, array_to_string(ids[start+1:start+64], ',') AS x,
           array_to_string(ids[start+2:start+65], ',') AS y FROM b
    """,
)
def strided_blocks(spark, sf):
    return D.strided_blocks(tokens(spark, sf), 64).select(
        "doc_id", "start", joined("x").alias("x"), joined("y").alias("y")
    )


@query(
    "d3_stream_blocks",
    f"""
    WITH {STREAM}, n AS (SELECT count(*) AS n FROM s),
    a AS (SELECT pos // 256 AS block, string_agg(token_id, ',' ORDER BY pos) AS x FROM s GROUP BY block),
    y AS (SELECT (pos - 1) // 256 AS block, string_agg(token_id, ',' ORDER BY pos) AS y FROM s WHERE pos > 0 GROUP BY block)
    SELECT block * 256 AS start, x, y FROM a JOIN y USING (block), n WHERE block * 256 < n - 256 - 1
    """,
)
def stream_blocks(spark, sf):
    return D.stream_strided_blocks(tokens(spark, sf), 256).select(
        "start", joined("x").alias("x"), joined("y").alias("y")
    )


@query(
    "d4_sliding_windows",
    f"""
    WITH {STREAM}, w AS (SELECT token_id AS a, lead(token_id) OVER d AS b, lead(token_id, 2) OVER d AS c, lead(token_id, 3) OVER d AS e
      FROM s WINDOW d AS (PARTITION BY doc_id ORDER BY ix))
    SELECT a || ',' || b || ',' || c AS context, e::INTEGER AS target, count(*) AS n FROM w WHERE e IS NOT NULL GROUP BY ALL
    """,
)
def sliding_windows(spark, sf):
    windows = D.sliding_windows(tokens(spark, sf), 3)
    return windows.groupBy("context", "target").agg(F.count(F.lit(1)).alias("n")).select(
        joined("context").alias("context"), "target", "n"
    )


@query(
    "d5_random_windows",
    f"""
    WITH {STREAM}, n AS (SELECT count(*) AS n FROM s),
    d AS (SELECT doc_id AS draw, {digest_sql('doc_id', '7')} % (n - 32 - 1) AS start FROM documents, n),
    r AS (SELECT draw, start, unnest(range(0, 33)) AS j FROM d),
    t AS (SELECT draw, start, j, token_id FROM r JOIN s ON s.pos = r.start + r.j)
    SELECT draw, start, string_agg(token_id, ',' ORDER BY j) FILTER (j < 32) AS x,
           string_agg(token_id, ',' ORDER BY j) FILTER (j > 0) AS y FROM t GROUP BY draw, start
    """,
)
def random_windows(spark, sf):
    t = tokens(spark, sf)
    draws = texts(spark, sf, "doc_id").withColumnRenamed("doc_id", "draw")
    return D.random_windows(t, draws, "draw", 32, seed=7).select(
        "draw", "start", joined("x").alias("x"), joined("y").alias("y")
    )


def _split_sql(fraction, overlap):
    return f"""
    WITH {STREAM}, n AS (SELECT CAST(floor({fraction}::DOUBLE * count(*)) AS BIGINT) AS cut FROM s),
    p AS (SELECT 'train' AS part, s.* FROM s, n WHERE pos < cut
          UNION ALL SELECT 'val', s.* FROM s, n WHERE pos >= cut - {overlap})
    SELECT part, doc_id, min(pos) AS start, count(*) AS n, CAST(sum(token_id) AS BIGINT) AS id_sum FROM p GROUP BY part, doc_id
    """


def _split(spark, sf, fraction, overlap):
    parts = D.ordered_split(tokens(spark, sf), fraction, overlap)
    return parts.select(
        "part",
        "doc_id",
        "start",
        F.size("ids").cast("long").alias("n"),
        F.aggregate("ids", F.lit(0).cast("long"), lambda a, i: a + i).alias("id_sum"),
    )


@query("d6_ordered_split", _split_sql(0.95, 0))
def ordered_split(spark, sf):
    return _split(spark, sf, 0.95, 0)


@query("d7_split_with_context", _split_sql(0.9, 6))
def split_with_context(spark, sf):
    return _split(spark, sf, 0.9, 6)


@query(
    "d8_shuffled_batches",
    f"""
    WITH RECURSIVE i AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS x, count(*) OVER () AS n FROM documents),
    c AS (SELECT *, CAST(floor(sqrt(n - 1)) AS BIGINT) + 1 AS a FROM i),
    d AS (SELECT *, (n + a - 1) // a AS b FROM c),
    w AS (
      SELECT doc_id, n, a, b, x // b AS l, x % b AS r, 0 AS k FROM d
      UNION ALL
      SELECT doc_id, n, a, b, CASE WHEN k % 2 = 0 THEN (l + {digest_sql('3', 'k % 4', 'r')}) % a ELSE l END,
        CASE WHEN k % 2 = 0 THEN r ELSE (r + {digest_sql('3', 'k % 4', 'l')}) % b END, k + 1
      FROM w WHERE k % 4 > 0 OR k = 0 OR l * b + r >= n
    )
    SELECT doc_id, (l * b + r) // 128 AS batch_id FROM w WHERE k > 0 AND k % 4 = 0 AND l * b + r < n
    """,
)
def shuffled_batches(spark, sf):
    return D.shuffled_batches(texts(spark, sf, "doc_id"), "doc_id", 128, seed=3)


@query(
    "d9_left_pad",
    f"""
    WITH {TOKENS}, p AS (SELECT doc_id, list_concat(list_transform(range(0, 48), lambda i: 0), ids) AS p FROM k)
    SELECT doc_id, array_to_string(p[len(p)-47:], ',') AS padded FROM p
    """,
)
def left_pad(spark, sf):
    return tokens(spark, sf).select("doc_id", joined(D.left_pad(F.col("ids"), 48)).alias("padded"))


@query(
    "d10_last_tokens",
    f"WITH {TOKENS} SELECT doc_id, array_to_string(ids[greatest(1, len(ids) - 99):], ',') AS kept FROM k",
)
def last_tokens(spark, sf):
    return tokens(spark, sf).select("doc_id", joined(D.last_tokens(F.col("ids"), 100)).alias("kept"))


@query(
    "d11_batches_per_epoch",
    "SELECT lang, CAST(sum(length(text)) AS BIGINT) AS tokens, CAST(sum(length(text)) // (32 * 256) AS BIGINT) AS batches FROM documents GROUP BY lang",
)
def batches_per_epoch(spark, sf):
    return D.batches_per_epoch(tokens(spark, sf, "lang"), 32, 256, ["lang"])


@query(
    "d12_uniform_baseline",
    f"""
    WITH {TOKENS} SELECT lang, count(DISTINCT t) AS vocab_size, round(ln(count(DISTINCT t)), 9) AS loss
    FROM (SELECT lang, unnest(ids) AS t FROM k) GROUP BY lang
    """,
)
def uniform_baseline(spark, sf):
    out = D.uniform_baseline(tokens(spark, sf, "lang"), ["lang"])
    return out.withColumn("loss", F.round("loss", 9))
