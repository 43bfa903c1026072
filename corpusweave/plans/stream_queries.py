"""Registered queries for the streaming forms (W1-W3): the tables are replayed as streams."""

from pyspark.sql import functions as F

from corpusweave.plans import sqltext as Q
from corpusweave.plans.bpe_queries import ENCODED, IDS, LEARN, learned
from corpusweave.plans.registry import query, table
from corpusweave.plans.stats_queries import BETA
from corpusweave.session import scratch_path, work_partitions
from corpusweave.streaming import corpus_stream as W


def arriving(spark, df, batches=3):
    """A folder of files with the rows of a table, read back as a stream of some batches.

    A batch is as many files as the session has work partitions, so neither writing nor reading it is left
    to a few tasks.
    """
    path, files = scratch_path(spark, "arriving"), work_partitions(spark)
    df.repartition(batches * files).write.parquet(path)
    return W.read_stream(spark, path, df.schema, files)


def dated(spark, sf):
    # Documents have no time of their own: the id spreads them over days.
    return table(spark, sf, "documents").select(
        "doc_id", "text", F.timestamp_seconds(F.col("doc_id") % 5 * 86400).alias("ts")
    )


@query("w1_encode_stream", f"{LEARN}, {ENCODED} SELECT doc_id, {IDS} AS ids, length(sym) AS n_tokens FROM e")
def encode_stream(spark, sf):
    stream = arriving(spark, table(spark, sf, "documents").select("doc_id", "text"))
    sink = scratch_path(spark, "encoded")
    encoded = W.encode_stream(stream, learned(spark, sf)).select("doc_id", "ids", "n_tokens")
    W.run_available(encoded, sink, scratch_path(spark, "progress"))
    ids = F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids")
    return spark.read.parquet(sink).select("doc_id", ids, F.col("n_tokens").cast("long").alias("n_tokens"))


def _counts(spark, stream, name):
    sink = scratch_path(spark, "counts")
    W.run_available_to_table(stream, sink, scratch_path(spark, "progress"), ["window_start", name])
    out = W.latest(spark, sink, ["window_start", name])
    return out.select((F.unix_seconds("window_start") / 86400).cast("long").alias("day"), name, "n")


@query(
    "w2_piece_counts_stream",
    f"SELECT doc_id % 5 AS day, piece, count(*) AS n FROM (SELECT doc_id, unnest({Q.gpt2_pieces('text')}) AS piece FROM documents) GROUP BY ALL",
)
def piece_counts_stream(spark, sf):
    stream = W.piece_counts_stream(arriving(spark, dated(spark, sf)), "ts", delay="10 days")
    return _counts(spark, stream, "piece")


@query(
    "w2_pair_counts_stream",
    f"""
    WITH s AS (SELECT day, {Q.hex_symbols('hex(encode(piece))')} AS sym, n FROM
      (SELECT doc_id % 5 AS day, piece, count(*) AS n FROM (SELECT doc_id, unnest({Q.gpt2_pieces('text')}) AS piece FROM documents) GROUP BY ALL)),
    a AS (SELECT day, n, string_split(sym, '') AS a FROM s WHERE length(sym) > 1)
    SELECT day, l || r AS pair, CAST(sum(n) AS BIGINT) AS n
    FROM (SELECT day, n, unnest(a[1:len(a)-1]) AS l, unnest(a[2:len(a)]) AS r FROM a) GROUP BY ALL
    """,
)
def pair_counts_stream(spark, sf):
    stream = W.pair_counts_stream(arriving(spark, dated(spark, sf)), "ts", delay="10 days")
    return _counts(spark, stream, "pair")


@query(
    "w2_ngram_counts_stream",
    """
    SELECT doc_id % 5 AS day, gram, count(*) AS n FROM (
      SELECT doc_id, ch || lead(ch) OVER d || lead(ch, 2) OVER d AS gram, lead(ch, 3) OVER d AS beyond
      FROM (SELECT doc_id, unnest(c) AS ch, generate_subscripts(c, 1) AS i FROM (SELECT doc_id, string_split(text, '') AS c FROM documents))
      WINDOW d AS (PARTITION BY doc_id ORDER BY i)) WHERE beyond IS NOT NULL GROUP BY ALL
    """,
)
def ngram_counts_stream(spark, sf):
    stream = W.ngram_counts_stream(arriving(spark, dated(spark, sf)), 3, "ts", delay="10 days")
    return _counts(spark, stream, "gram")


@query(
    "w3_beta_stream",
    """
    SELECT user_id, CAST(floor(epoch_us(ts) / 86400000000) AS BIGINT) AS day, count(*) AS n, count(*) FILTER (event_type = 'purchase') AS heads,
           round((count(*) FILTER (event_type = 'purchase') + 2.0::DOUBLE) / (count(*) + 4), 9) AS posterior_mean
    FROM events GROUP BY ALL
    """,
)
def beta_stream(spark, sf):
    stream = arriving(spark, table(spark, sf, "events").select("user_id", "ts", "event_type"))
    timed = stream.withColumn("ts", W.event_time("ts"))
    posterior = W.beta_stream(timed, "user_id", "ts", F.col("event_type") == "purchase", delay="60 days")
    sink = scratch_path(spark, "posterior")
    W.run_available_to_table(posterior, sink, scratch_path(spark, "progress"), ["user_id", "window_start"])
    out = W.latest(spark, sink, ["user_id", "window_start"])
    day = F.unix_seconds("window_start") / 86400
    return out.select(
        "user_id", day.cast("long").alias("day"), "n", "heads", F.round("posterior_mean", 9).alias("posterior_mean")
    )


@query(
    "w3_prefix_posterior_stream",
    f"""
    WITH {BETA}
    SELECT user_id, event_id, n, heads, alpha, beta, map, posterior_mean, mle FROM o
    """,
)
def prefix_posterior_stream(spark, sf):
    """The posterior after every event; a last event far ahead closes the stream and lets all others out."""
    events = table(spark, sf, "events").select(
        "user_id", "event_id", W.event_time("ts").alias("ts"), (F.col("event_type") == "purchase").alias("hit")
    )
    path = scratch_path(spark, "arriving")
    events.repartition(3).write.parquet(path)
    end = events.agg(F.max("ts").alias("ts")).select(
        F.lit(None).cast("long").alias("user_id"), F.lit(0).cast("long").alias("event_id"),
        (F.col("ts") + F.expr("INTERVAL 200 DAYS")).alias("ts"), F.lit(False).alias("hit"),
    )
    end.select(*[F.col(f.name).cast(f.dataType) for f in events.schema.fields]).write.mode("append").parquet(path)
    stream = W.read_stream(spark, path, events.schema, 1)
    sink = scratch_path(spark, "posterior")
    with W.use_rocksdb(spark):
        out = W.prefix_posterior_stream(stream, "user_id", "ts", "event_id", F.col("hit"), delay="100 days")
        W.run_available(out, sink, scratch_path(spark, "progress"))
    done = spark.read.parquet(sink).filter("user_id IS NOT NULL").drop("ts")
    return done.select(*[F.round(c, 9).alias(c) if c in ("map", "posterior_mean", "mle") else c for c in done.columns])
