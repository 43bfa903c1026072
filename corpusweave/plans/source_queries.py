"""Registered queries for sources and sinks."""

from pyspark.sql import functions as F

from corpusweave.operators import bpe, runs as R
from corpusweave.plans import sqltext as Q
from corpusweave.plans.bpe_queries import ENCODED, LEARN, LEARNED, learned
from corpusweave.plans.run_queries import METRICS
from corpusweave.plans.registry import query, table, texts
from corpusweave.session import scratch_path
from corpusweave.sources import byte_ranges, models, runs as run_files, texts as X

TOKEN = "<|endoftext|>"
TOKEN_HEX = TOKEN.encode().hex().upper()
MARKED = "replace(text, '. ', '.<|endoftext|>')"
LINES = r"regexp_extract_all(text, '[^\n]*\n|[^\n]+')"


@query(
    "s1_text_files",
    r"""
    SELECT replace(line, chr(10), '') AS text, count(*) AS n FROM
      (SELECT unnest(regexp_extract_all(text || chr(10), '[^\n]*\n')) AS line FROM documents) GROUP BY ALL
    """,
)
def text_files(spark, sf):
    """Texts written as plain files with a stray byte in front, read back without it."""
    path = scratch_path(spark, "lines")
    broken = F.concat(F.unhex(F.lit("FF")).cast("string"), F.col("text"))
    texts(spark, sf, "text").select(broken.alias("value")).write.text(path)
    return X.read_lines(spark, path).groupBy("text").agg(F.count(F.lit(1)).alias("n"))


@query(
    "s2_first_lines",
    f"""
    SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, line FROM
      (SELECT doc_id, unnest({LINES}) AS line, generate_subscripts({LINES}, 1) - 1 AS line_no FROM documents)
    WHERE line_no < 3
    """,
)
def first_lines(spark, sf):
    return X.first_lines(texts(spark, sf, "doc_id", "text"), 3)


@query(
    "s3_line_batches",
    f"""
    WITH RECURSIVE l AS MATERIALIZED (SELECT doc_id, unnest({LINES}) AS line, generate_subscripts({LINES}, 1) AS i FROM documents),
    r AS (SELECT doc_id, i, line, length(line) AS filled, 0 AS batch_no FROM l WHERE i = 1
          UNION ALL
          SELECT l.doc_id, l.i, l.line, CASE WHEN r.filled >= 400 THEN length(l.line) ELSE r.filled + length(l.line) END,
                 CASE WHEN r.filled >= 400 THEN r.batch_no + 1 ELSE r.batch_no END
          FROM r JOIN l ON l.doc_id = r.doc_id AND l.i = r.i + 1)
    SELECT doc_id, batch_no, string_agg(line, '' ORDER BY i) AS batch FROM r GROUP BY doc_id, batch_no
    """,
)
def line_batches(spark, sf):
    return X.line_batches(texts(spark, sf, "doc_id", "text"), 400)


@query(
    "s4_byte_chunks",
    """
    WITH c AS (SELECT doc_id, unnest(string_split(text, '')) AS ch, generate_subscripts(string_split(text, ''), 1) AS i FROM documents),
    e AS (SELECT *, sum(octet_length(encode(ch))) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM c)
    SELECT doc_id, CAST((upto - 1) // 512 AS INTEGER) AS chunk_no, string_agg(ch, '' ORDER BY i) AS chunk
    FROM e GROUP BY ALL
    """,
)
def byte_chunks(spark, sf):
    return X.byte_chunks(texts(spark, sf, "doc_id", "text"), 512)


@query(
    "s5_split_records",
    f"""
    WITH p AS (SELECT doc_id, string_split({MARKED}, '{TOKEN}') AS p FROM documents),
    u AS (SELECT doc_id, unnest(p) AS part, generate_subscripts(p, 1) - 1 AS i FROM p)
    SELECT doc_id, CAST(i AS INTEGER) AS record_no, CASE WHEN i = 0 THEN part ELSE '{TOKEN}' || part END AS record FROM u
    """,
)
def split_records(spark, sf):
    docs = texts(spark, sf, "doc_id", "text").withColumn("marked", F.expr(MARKED))
    return X.split_records(docs, TOKEN, text="marked")


@query(
    "s5_split_even",
    f"""
    WITH d AS (SELECT doc_id, {MARKED} AS t FROM documents),
    s AS (SELECT doc_id, hex(encode(t)) AS h, octet_length(encode(t)) AS n FROM d),
    k AS (SELECT doc_id, n, string_split(h, '{TOKEN_HEX}') AS parts FROM s),
    o AS (SELECT doc_id, n, list_transform(range(1, len(parts)), lambda j:
            CAST((list_sum(list_transform(parts[1:j], lambda x: length(x))) + (j - 1) * {len(TOKEN_HEX)}) // 2 AS BIGINT)) AS hits FROM k),
    g AS (SELECT *, unnest(range(1, 4)) AS i FROM o),
    f AS (SELECT doc_id, n, hits, i * (n // 4) AS g FROM g),
    b AS (SELECT doc_id, coalesce(list_min(list_filter(hits, lambda x: x >= g)), n) AS b, n FROM f),
    e AS (SELECT DISTINCT doc_id, b FROM (SELECT doc_id, b FROM b UNION ALL SELECT doc_id, n FROM b UNION ALL SELECT doc_id, 0 FROM b))
    SELECT doc_id, CAST(row_number() OVER w - 1 AS INTEGER) AS part_no,
           CAST(lead(b) OVER w - b AS INTEGER) AS n_bytes
    FROM e WINDOW w AS (PARTITION BY doc_id ORDER BY b) QUALIFY lead(b) OVER w IS NOT NULL
    """,
)
def split_even(spark, sf):
    docs = texts(spark, sf, "doc_id", "text").withColumn("marked", F.expr(MARKED))
    parts = X.split_even(docs, 4, TOKEN, text="marked")
    return parts.select("doc_id", "part_no", F.octet_length("part").alias("n_bytes"))


FILE_DOCS = 16
FILES = f"""
    files AS MATERIALIZED (SELECT doc_id // {FILE_DOCS} AS file, string_agg({MARKED} || chr(10), '' ORDER BY doc_id) AS text
      FROM documents GROUP BY file)
"""


def joined_files(spark, sf):
    """Files of several documents each, line after line; far more bytes than the ranges they are read by."""
    path = scratch_path(spark, "files")
    docs = table(spark, sf, "documents").select(
        F.expr(f"doc_id div {FILE_DOCS}").alias("file"), "doc_id", F.expr(MARKED).alias("value")
    )
    dealt = docs.repartition("file").sortWithinPartitions("file", "doc_id")
    dealt.select("file", "value").write.partitionBy("file").text(path)
    return path


def by_file(rows, *columns):
    return rows.select(F.regexp_extract("path", r"file=(\d+)", 1).cast("long").alias("file"), *columns)


RANGE = 12_000


@query(
    "s3_file_line_batches",
    f"""
    WITH RECURSIVE {FILES},
    l AS MATERIALIZED (SELECT file, unnest({LINES}) AS line, generate_subscripts({LINES}, 1) AS i FROM files),
    r AS (SELECT file, i, line, length(line) AS filled, 0 AS batch_no FROM l WHERE i = 1
          UNION ALL
          SELECT l.file, l.i, l.line, CASE WHEN r.filled >= 900 THEN length(l.line) ELSE r.filled + length(l.line) END,
                 CASE WHEN r.filled >= 900 THEN r.batch_no + 1 ELSE r.batch_no END
          FROM r JOIN l ON l.file = r.file AND l.i = r.i + 1)
    SELECT file, batch_no, string_agg(line, '' ORDER BY i) AS batch FROM r GROUP BY file, batch_no
    """,
)
def file_line_batches(spark, sf):
    batches = byte_ranges.line_batches(spark, joined_files(spark, sf), 900, RANGE)
    return by_file(batches, "batch_no", "batch")


@query(
    "s4_file_chunks",
    f"""
    WITH {FILES},
    c AS (SELECT file, unnest(string_split(text, '')) AS ch, generate_subscripts(string_split(text, ''), 1) AS i FROM files),
    e AS (SELECT *, sum(octet_length(encode(ch))) OVER (PARTITION BY file ORDER BY i) AS upto FROM c)
    SELECT file, CAST((upto - 1) // 2048 AS BIGINT) AS chunk_no, string_agg(ch, '' ORDER BY i) AS chunk FROM e GROUP BY ALL
    """,
)
def file_chunks(spark, sf):
    chunks = byte_ranges.read_ranges(spark, joined_files(spark, sf), "chunks", size=2048, range_bytes=RANGE)
    return by_file(chunks, F.col("at").alias("chunk_no"), F.col("text").alias("chunk"))


@query(
    "s5_file_records",
    f"""
    WITH {FILES},
    u AS (SELECT file, unnest(string_split(text, '{TOKEN}')) AS part, generate_subscripts(string_split(text, '{TOKEN}'), 1) AS i FROM files),
    r AS (SELECT file, i, CASE WHEN i = 1 THEN part ELSE '{TOKEN}' || part END AS record FROM u)
    SELECT file, CAST(coalesce(sum(octet_length(encode(record))) OVER (PARTITION BY file ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS at, record
    FROM r WHERE record <> ''
    """,
)
def file_records(spark, sf):
    records = byte_ranges.read_ranges(spark, joined_files(spark, sf), "records", token=TOKEN, range_bytes=RANGE)
    return by_file(records, "at", F.col("text").alias("record"))


@query("s6_schema")
def schema(spark, sf):
    return X.schema_table(table(spark, sf, "lineitem"))


@query("s7_columns", "SELECT doc_id, lang, n_chars FROM documents")
def columns(spark, sf):
    return X.read_columns(spark, f"{sf}/documents.parquet", ["doc_id", "lang", "n_chars"])


@query(
    "s8_row_batches",
    """
    SELECT batch_id, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id, round(sum(value), 4) AS total
    FROM (SELECT *, (row_number() OVER (ORDER BY ts, event_id) - 1) // 1000 AS batch_id FROM events) GROUP BY batch_id
    """,
)
def row_batches(spark, sf):
    rows = table(spark, sf, "events").select("ts", "event_id", "value")
    return X.row_batches(rows, ["ts", "event_id"], 1000).groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("event_id").alias("first_id"),
        F.max("event_id").alias("last_id"),
        F.round(F.sum("value"), 4).alias("total"),
    )


@query(
    "s9_first_values",
    """
    SELECT doc_id, source, (row_number() OVER (ORDER BY doc_id) - 1) // 100 AS batch_id
    FROM (SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 750)
    """,
)
def first_values(spark, sf):
    return X.first_values(table(spark, sf, "documents"), "source", ["doc_id"], 750, 100)


THINNED = "CASE WHEN turn % 4 = 1 THEN '' WHEN turn % 4 = 3 THEN NULL ELSE text END"


@query(
    "s10_joined_batches",
    f"""
    WITH c AS (SELECT conv_id, turn, {THINNED} AS t,
                      (row_number() OVER (ORDER BY conv_id, turn) - 1) // 100 AS batch_id FROM conversations)
    SELECT batch_id, string_agg(t, chr(10) ORDER BY conv_id, turn) AS text, count(*) AS n_values
    FROM c WHERE t <> '' GROUP BY batch_id
    """,
)
def joined_batches(spark, sf):
    rows = table(spark, sf, "conversations").withColumn("t", F.expr(THINNED))
    return X.joined_batches(rows, "t", ["conv_id", "turn"], 100)


@query(
    "s11_first_text",
    f"""
    WITH c AS (SELECT conv_id, turn, {THINNED} AS t FROM conversations ORDER BY conv_id, turn LIMIT 300)
    SELECT string_agg(t, chr(10) ORDER BY conv_id, turn) AS text, count(*) AS n_values FROM c WHERE t <> ''
    """,
)
def first_text(spark, sf):
    rows = table(spark, sf, "conversations").withColumn("t", F.expr(THINNED))
    return X.first_text(rows, "t", ["conv_id", "turn"], 300)


@query(
    "s12_write_tokens",
    f"{LEARN}, {ENCODED} SELECT doc_id, length(sym) AS n_tokens, CAST(list_sum(list_transform(string_split(sym, ''), lambda c: unicode(c))) AS BIGINT) AS id_sum FROM e",
)
def write_tokens(spark, sf):
    path = scratch_path(spark, "tokens")
    models.write_tokens(texts(spark, sf, "doc_id", "text"), learned(spark, sf), path)
    return spark.read.parquet(path).select(
        "doc_id",
        F.col("n_tokens").cast("long").alias("n_tokens"),
        F.aggregate("ids", F.lit(0).cast("long"), lambda a, i: a + i).alias("id_sum"),
    )


@query(
    "s13_save_and_load",
    f"{LEARN}, {ENCODED} SELECT doc_id, length(sym) AS n_tokens FROM e",
)
def save_and_load(spark, sf):
    path = scratch_path(spark, "model")
    models.save_model(spark, learned(spark, sf), path)
    again = models.load_model(spark, path)
    encoded = bpe.encode_documents(texts(spark, sf, "doc_id", "text"), again)
    return encoded.select("doc_id", F.col("n_tokens").cast("long").alias("n_tokens"))


SHOWN = (
    "CASE WHEN length(hex) = 2 AND (hex < '20' OR hex = '7F') THEN '\\u' || lower(lpad(hex, 4, '0')) "
    "ELSE coalesce(TRY(decode(unhex(hex))), chr(65533)) END"
)


@query(
    "s14_vocabulary_listing",
    f"""
    {LEARN},
    t AS (SELECT sym, unicode(sym) AS id, {SHOWN} AS s FROM v{LEARNED}),
    m AS ({Q.merge_list(LEARNED)})
    SELECT CAST(t.id AS INTEGER) AS token_id,
      CASE WHEN m.new_id IS NULL THEN '[' || t.s || '] ' || t.id
           ELSE '[' || a.s || '][' || b.s || '] -> [' || t.s || '] ' || t.id END AS line
    FROM t LEFT JOIN m ON m.new_id = t.id LEFT JOIN t a ON a.id = m."left" LEFT JOIN t b ON b.id = m."right"
    """,
)
def vocabulary_listing(spark, sf):
    return bpe.vocab_listing(spark, learned(spark, sf))


@query(
    "s15_import_model",
    f"{LEARN}, {ENCODED} SELECT doc_id, length(sym) AS n_tokens FROM e",
)
def import_model(spark, sf):
    """The learned model exported in the published two-file form and imported again."""
    import json

    model, alphabet = learned(spark, sf), models.printable_alphabet()

    def shown(raw):
        return "".join(alphabet[b] for b in raw)

    vocab = model.vocab()
    listing = json.dumps({shown(b): i for i, b in vocab.items()})
    lines = [("#version: 0.2",), *[(f"{shown(vocab[a])} {shown(vocab[b])}",) for a, b, _ in model.merges]]
    path = scratch_path(spark, "published")
    spark.createDataFrame([(listing,)], "value string").coalesce(1).write.text(f"{path}/vocab")
    spark.createDataFrame(lines, "value string").coalesce(1).write.text(f"{path}/merges")
    again = models.import_model(spark, f"{path}/vocab", f"{path}/merges", [TOKEN])
    encoded = bpe.encode_documents(texts(spark, sf, "doc_id", "text"), again)
    return encoded.select("doc_id", F.col("n_tokens").cast("long").alias("n_tokens"))


@query(
    "s16_experiment_list",
    """
    SELECT 'run_' || user_id AS name, CAST(count(DISTINCT event_type) AS BIGINT) AS n_overrides FROM events GROUP BY user_id
    """,
)
def experiment_list(spark, sf):
    """One experiment per user, written as JSON and read back with its checks."""
    path = scratch_path(spark, "experiments")
    events = table(spark, sf, "events")
    per_type = events.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    runs = per_type.groupBy("user_id").agg(
        F.map_from_entries(
            F.collect_list(F.struct("event_type", F.col("n").cast("string").alias("n")))
        ).alias("overrides")
    )
    runs.select(F.concat(F.lit("run_"), "user_id").alias("name"), "overrides").write.json(path)
    listed = spark.read.schema(run_files.EXPERIMENT).json(path)
    run_files.check_experiments(listed)
    return listed.select("name", F.size("overrides").cast("long").alias("n_overrides"))


@query(
    "s17_manifest_files",
    f"""
    WITH {METRICS} SELECT 'run_' || run AS name, status, printf('%.4f', final_train) AS final_train,
      CASE WHEN val_min IS NULL THEN 'NaN' ELSE printf('%.4f', val_min) END AS val_min,
      printf('%.4f', train_tail) AS train_tail, CAST(num_steps AS VARCHAR) AS num_steps FROM f
    """,
)
def manifest_files(spark, sf):
    path = scratch_path(spark, "manifest")
    history = R.event_history(table(spark, sf, "events"))
    run_files.write_manifest(R.manifest(R.run_metrics(history)), path)
    written = spark.read.option("header", True).csv(f"{path}/csv")
    return written.select("name", "status", "final_train", "val_min", "train_tail", "num_steps")


@query(
    "s18_history_files",
    """
    SELECT 'run_' || user_id AS run, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS step,
           value AS train_loss, event_type = 'error' AS missing_val
    FROM events
    """,
)
def history_files(spark, sf):
    """One history per user, written as text and read back in order."""
    path = scratch_path(spark, "history")
    events = table(spark, sf, "events")
    val = F.when(F.col("event_type") == "error", F.lit("nan")).otherwise(F.format_string("%.18e", "value"))
    lines = events.select(
        F.concat(F.lit("run_"), "user_id").alias("run"), "ts", "event_id",
        F.concat_ws(" ", F.format_string("%.18e", "value"), val).alias("value"),
    )
    run_files.write_history_lines(lines, path, ["ts", "event_id"])
    return run_files.read_history(spark, path).select(
        "run", "step", "train_loss", F.isnan("val_loss").alias("missing_val")
    )
