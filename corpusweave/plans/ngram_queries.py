"""Registered queries for n-gram language models."""

from pyspark.sql import functions as F

from corpusweave.functions.draws import digest_sql
from corpusweave.operators import ngram as N
from corpusweave.plans import sqltext as Q
from corpusweave.plans.registry import query, table, texts


def lowered(spark, sf, *more):
    return texts(spark, sf, *more, "text").withColumn("text", F.lower("text"))


def char_sql(n, source="documents", last=0):
    chars = " || ".join(["ch", *[f"lead(ch, {i}) OVER d" for i in range(1, n - 1)]])
    return f"""
    SELECT context, next, count(*) AS cnt FROM (
      SELECT {chars} AS context, lead(ch, {n - 1}) OVER d AS next, lead(ch, {n - last}) OVER d AS beyond
      FROM (SELECT id, unnest(c) AS ch, generate_subscripts(c, 1) AS i
            FROM (SELECT rowid AS id, string_split(lower(text), '') AS c FROM (SELECT row_number() OVER () AS rowid, text FROM {source})))
      WINDOW d AS (PARTITION BY id ORDER BY i))
    WHERE beyond IS NOT NULL GROUP BY context, next
    """


@query("n1_char_trigrams", char_sql(3))
def char_trigrams(spark, sf):
    return N.char_ngram_counts(lowered(spark, sf), 3)


@query("n1_char_fivegrams", char_sql(5))
def char_fivegrams(spark, sf):
    return N.char_ngram_counts(lowered(spark, sf), 5)


@query("n1_char_bigrams_all_windows", char_sql(2, last=1))
def char_bigrams(spark, sf):
    return N.char_ngram_counts(lowered(spark, sf), 2, include_last=True)


@query(
    "n2_word_trigrams",
    f"""
    SELECT w[i] || ' ' || w[i+1] AS context, w[i+2] AS next, count(*) AS cnt
    FROM (SELECT w, unnest(range(1, len(w) - 2)) AS i FROM (SELECT {Q.words('lower(text)')} AS w FROM documents)) GROUP BY ALL
    """,
)
def word_trigrams(spark, sf):
    return N.word_ngram_counts(texts(spark, sf, "text"), 3)


@query(
    "n3_probabilities",
    f"""
    WITH g AS ({char_sql(3)})
    SELECT context, next, cnt, CAST(sum(cnt) OVER (PARTITION BY context) AS BIGINT) AS total,
           round(cnt / sum(cnt) OVER (PARTITION BY context), 9) AS p FROM g
    """,
)
def probabilities(spark, sf):
    out = N.with_probability(N.char_ngram_counts(lowered(spark, sf), 3))
    return out.withColumn("p", F.round("p", 9))


@query(
    "n4_top_next",
    f"""
    WITH g AS ({char_sql(4)})
    SELECT context, next, cnt, CAST(row_number() OVER (PARTITION BY context ORDER BY cnt DESC, encode(next)) AS INTEGER) AS place
    FROM g QUALIFY place <= 3
    """,
)
def top_next(spark, sf):
    return N.top_next(N.char_ngram_counts(lowered(spark, sf), 4), 3)


def generate_sql(greedy):
    hit = "low = 0" if greedy else f"{digest_sql('item_id', 'step', '11')} % total BETWEEN low AND high - 1"
    return f"""
    WITH RECURSIVE g AS MATERIALIZED ({char_sql(4)}),
    t AS MATERIALIZED (SELECT context, next, sum(cnt) OVER (PARTITION BY context) AS total,
           sum(cnt) OVER (PARTITION BY context ORDER BY cnt DESC, encode(next) ROWS UNBOUNDED PRECEDING) AS high,
           sum(cnt) OVER (PARTITION BY context ORDER BY cnt DESC, encode(next) ROWS UNBOUNDED PRECEDING) - cnt AS low FROM g),
    r AS (SELECT item_id, lower(text) AS txt, 0 AS step FROM benchmark
          UNION ALL
          SELECT item_id, txt || coalesce(next, ''), step + 1 FROM r LEFT JOIN t ON context = right(txt, 3) AND {hit}
          WHERE step < 8)
    SELECT item_id, txt AS generated FROM r WHERE step = 8
    """


@query("n5_generate_greedy", generate_sql(True))
def generate_greedy(spark, sf):
    counts = N.char_ngram_counts(lowered(spark, sf), 4)
    prompts = table(spark, sf, "benchmark").select("item_id", F.lower("text").alias("text"))
    return N.generate(counts, prompts, 4, 8, greedy=True)


@query("n5_generate_sampled", generate_sql(False))
def generate_sampled(spark, sf):
    counts = N.char_ngram_counts(lowered(spark, sf), 4)
    prompts = table(spark, sf, "benchmark").select("item_id", F.lower("text").alias("text"))
    return N.generate(counts, prompts, 4, 8, seed=11)


def loss_sql(p):
    return f"""
    WITH g AS ({char_sql(4)}), h AS ({char_sql(4, 'benchmark')}),
    m AS (SELECT context, next, cnt AS seen FROM g), tt AS (SELECT context, sum(cnt) AS total FROM g GROUP BY context),
    b AS (SELECT h.cnt, -ln({p}) AS nll FROM h LEFT JOIN m USING (context, next) LEFT JOIN tt USING (context))
    SELECT CAST(sum(cnt) AS BIGINT) AS windows, CAST(sum(CASE WHEN nll IS NULL THEN cnt ELSE 0 END) AS BIGINT) AS unseen,
           round(sum(nll * cnt) / sum(cnt) FILTER (nll IS NOT NULL), 6) AS loss,
           round(exp(least(sum(nll * cnt) / sum(cnt) FILTER (nll IS NOT NULL), 20.0)), 4) AS perplexity FROM b
    """


def _loss(spark, sf, **options):
    counts = N.char_ngram_counts(lowered(spark, sf), 4)
    held_out = table(spark, sf, "benchmark").select(F.lower("text").alias("text"))
    out = N.held_out_loss(counts, N.char_ngram_counts(held_out, 4), **options)
    return out.select(
        "windows", "unseen", F.round("loss", 6).alias("loss"), F.round("perplexity", 4).alias("perplexity")
    )


@query("n6_held_out_loss", loss_sql("seen / total"))
def held_out_loss(spark, sf):
    return _loss(spark, sf)


@query("n6_smoothed_loss", loss_sql("(coalesce(seen, 0) + 0.5::DOUBLE) / (coalesce(total, 0) + 0.5::DOUBLE * 100)"))
def smoothed_loss(spark, sf):
    return _loss(spark, sf, alpha=0.5, vocab_size=100)
