"""Registered queries for byte-pair encoding."""

from pyspark.sql import functions as F

from corpusweave.functions import symbols as S
from corpusweave.operators import bpe, pretok, text as X
from corpusweave.plans import sqltext as Q
from corpusweave.plans.registry import query, texts
from corpusweave.session import scratch_path
from corpusweave.sources import models

LEARNED = 8
_models: dict = {}


def learned(spark, sf, merges=LEARNED):
    """The model of the documents; a model is small and may serve several queries of a session."""
    key = (spark.sparkContext.applicationId, sf, merges)
    if key not in _models:
        _models[key] = bpe.train(texts(spark, sf, "text"), bpe.BASE_SIZE + merges)
    return _models[key]


def _ids(column):
    return F.array_join(F.transform(column, lambda i: i.cast("string")), ",")


LEARN = f"WITH {Q.merge_ctes(Q.PIECE_SEQUENCES, LEARNED)}"
FINAL = f"w{LEARNED}"
IDS = "array_to_string(list_transform(string_split(sym, ''), lambda c: unicode(c)), ',')"


@query(
    "b1_pair_counts",
    f"""
    WITH s AS ({Q.PIECE_SEQUENCES}), a AS (SELECT n, string_split(sym, '') AS a FROM s WHERE length(sym) > 1)
    SELECT unicode(l)::INTEGER AS "left", unicode(r)::INTEGER AS "right", CAST(sum(n) AS BIGINT) AS "count"
    FROM (SELECT n, unnest(a[1:len(a)-1]) AS l, unnest(a[2:len(a)]) AS r FROM a) GROUP BY l, r
    """,
)
def pair_counts(spark, sf):
    return bpe.pair_counts(texts(spark, sf, "text"))


@query(
    "b2_merge_pair",
    f"""
    WITH s AS ({Q.PIECE_SEQUENCES})
    SELECT piece, n, {IDS.replace('sym', "replace(sym, 'ee', chr(256))")} AS ids FROM s
    """,
)
def merge_pair(spark, sf):
    pieces = pretok.piece_counts(texts(spark, sf, "text"))
    merged = bpe.merge_symbols(S.text_to_symbols(F.col("piece")), 101, 101, 256)
    return pieces.select("piece", "n", _ids(S.symbols_to_ids(merged)).alias("ids"))


@query(
    "b3_best_pair",
    f"""
    WITH {Q.merge_ctes(Q.PIECE_SEQUENCES, 1)}
    SELECT "left", "right", CAST(cnt AS BIGINT) AS "count" FROM ({Q.merge_list(1)})
    """,
)
def best_pair(spark, sf):
    counts = bpe.pair_counts(texts(spark, sf, "text"))
    return counts.orderBy(F.col("count").desc(), F.col("left").desc(), F.col("right").desc()).limit(1)


def _merge_rows(spark, merges):
    rows = [(r, a, b, c) for r, (a, b, c) in enumerate(merges)]
    return spark.createDataFrame(rows, "rank int, left int, right int, new_id int")


PLAIN = 4


@query(
    "b4_train_plain",
    f"""
    WITH {Q.merge_ctes(Q.DOC_SEQUENCES, PLAIN)}
    SELECT rank, "left", "right", new_id FROM ({Q.merge_list(PLAIN)})
    """,
)
def train_plain(spark, sf):
    docs = texts(spark, sf, "text")
    return bpe.train(docs, bpe.BASE_SIZE + PLAIN, pattern=None).merges_table(spark)


SHOWN = 24


@query(
    "b5_train_merges",
    f"""
    WITH {Q.merge_ctes(Q.PIECE_SEQUENCES, SHOWN)}
    SELECT rank, "left", "right", new_id, lower(lh) AS left_hex, lower(rh) AS right_hex FROM ({Q.merge_list(SHOWN)})
    """,
)
def train_merges(spark, sf):
    model = learned(spark, sf, SHOWN)
    shown = bpe.merge_byte_pairs(spark, model).select(
        "rank",
        F.lower(F.hex("left_bytes")).alias("left_hex"),
        F.lower(F.hex("right_bytes")).alias("right_hex"),
    )
    return model.merges_table(spark).join(shown, "rank")


@query(
    "b6_train_smallest_pair",
    f"""
    WITH {Q.merge_ctes(Q.DOC_SEQUENCES, PLAIN, 'ids')}
    SELECT rank, "left", "right", new_id FROM ({Q.merge_list(PLAIN)})
    """,
)
def train_smallest(spark, sf):
    docs = texts(spark, sf, "text")
    model = bpe.train(docs, bpe.BASE_SIZE + PLAIN, pattern=None, tie="ids", min_frequency=2)
    return model.merges_table(spark)


@query("b7_encode_pieces", f"{LEARN} SELECT piece, n, {IDS} AS ids FROM {FINAL}")
def encode_pieces(spark, sf):
    pieces = pretok.piece_counts(texts(spark, sf, "text"))
    return bpe.encode_pieces(pieces, learned(spark, sf)).select("piece", "n", _ids("ids").alias("ids"))


VOCAB_SQL = f"""
    SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS token_id, lower(hex) AS hex FROM v{LEARNED}
"""


@query("b8_vocabulary", f"{LEARN} SELECT CAST(unicode(sym) AS INTEGER) AS token_id, lower(hex) AS hex FROM v{LEARNED}")
def vocabulary(spark, sf):
    return learned(spark, sf).vocab_table(spark).select("token_id", F.lower(F.hex("bytes")).alias("hex"))


ENCODED = f"""
    pl AS (SELECT doc_id, unnest({Q.gpt2_pieces('text')}) AS piece,
                  generate_subscripts({Q.gpt2_pieces('text')}, 1) AS pos FROM documents),
    e AS (SELECT doc_id, string_agg(sym, '' ORDER BY pos) AS sym FROM pl JOIN {FINAL} USING (piece) GROUP BY doc_id)
"""


@query(
    "b9_encode_documents",
    f"{LEARN}, {ENCODED} SELECT doc_id, {IDS} AS ids, CAST(length(sym) AS INTEGER) AS n_tokens FROM e",
)
def encode_documents(spark, sf):
    out = bpe.encode_documents(texts(spark, sf, "doc_id", "text"), learned(spark, sf))
    return out.select("doc_id", _ids("ids").alias("ids"), "n_tokens")


@query(
    "b9_encode_by_rank",
    f"{LEARN}, {ENCODED} SELECT doc_id, {IDS} AS ids, CAST(length(sym) AS INTEGER) AS n_tokens FROM e",
)
def encode_by_rank(spark, sf):
    docs = texts(spark, sf, "doc_id", "text")
    out = bpe.encode_documents(docs, learned(spark, sf), strategy="rank")
    return out.select("doc_id", _ids("ids").alias("ids"), "n_tokens")


@query(
    "b9_encode_with_specials",
    f"""
    {LEARN},
    d AS (SELECT doc_id, {Q.PLANTED} AS t FROM documents),
    toks AS (SELECT doc_id, unnest(regexp_extract_all(t, '{Q.SPECIAL_RE}')) AS tok FROM d),
    sp AS (SELECT doc_id, count(*) AS n_special FROM toks GROUP BY doc_id)
    SELECT doc_id, coalesce(n_special, 0) AS n_special, TRUE AS restored FROM d LEFT JOIN sp USING (doc_id)
    """,
)
def encode_with_specials(spark, sf):
    model = learned(spark, sf).with_specials(Q.SPECIALS)
    docs = texts(spark, sf, "doc_id", "text").withColumn(
        "planted", F.expr(Q.PLANTED.replace("chr(10)", "char(10)"))
    )
    out = bpe.decode_documents(bpe.encode_documents(docs, model, text="planted"), model)
    return out.select(
        "doc_id",
        F.size(F.filter("ids", lambda i: i >= 1000)).cast("long").alias("n_special"),
        (F.col("decoded") == F.col("planted")).alias("restored"),
    )


# Conversations hold pieces that documents lack, so the merges are applied to their own pieces.
@query(
    "b10_encode_stream_of_texts",
    f"""
    {LEARN},
    cp AS (SELECT conv_id, turn, unnest({Q.gpt2_pieces('text')}) AS piece,
                  generate_subscripts({Q.gpt2_pieces('text')}, 1) AS pos FROM conversations),
    cs AS (SELECT piece, {Q.hex_symbols('hex(encode(piece))')} AS sym FROM (SELECT DISTINCT piece FROM cp)),
    cm AS (SELECT piece, {Q.apply_merges('sym', LEARNED)} AS sym FROM cs),
    ce AS (SELECT conv_id, turn, string_agg(sym, '' ORDER BY pos) AS sym FROM cp JOIN cm USING (piece) GROUP BY conv_id, turn)
    SELECT conv_id, turn, {IDS} AS ids, CAST(length(sym) AS INTEGER) AS n_tokens FROM ce
    """,
)
def encode_batches(spark, sf):
    """Every row is a batch of its own, so pieces never depend on a read boundary."""
    docs = texts(spark, sf, "conv_id", "turn", "text", name="conversations")
    out = bpe.encode_documents(pretok.require_text(docs), learned(spark, sf))
    return out.select("conv_id", "turn", _ids("ids").alias("ids"), "n_tokens")


# Its SQL unrolls no merges, so the round trip has the vocabulary of the README's example, four times the largest that
# the reference trains: most tokens are several bytes.
ROUND_TRIP_VOCAB = 2048


@query("b11_decode_round_trip", "SELECT doc_id, text AS decoded FROM documents")
def decode_round_trip(spark, sf):
    model = learned(spark, sf, ROUND_TRIP_VOCAB - bpe.BASE_SIZE)
    encoded = bpe.encode_documents(texts(spark, sf, "doc_id", "text"), model).select("doc_id", "ids")
    return bpe.decode_documents(encoded, model).select("doc_id", "decoded")


@query(
    "b12_merge_byte_pairs",
    f"{LEARN} SELECT rank, lower(lh) AS left_hex, lower(rh) AS right_hex FROM ({Q.merge_list(LEARNED)})",
)
def merge_byte_pairs(spark, sf):
    return bpe.merge_byte_pairs(spark, learned(spark, sf)).select(
        "rank",
        F.lower(F.hex("left_bytes")).alias("left_hex"),
        F.lower(F.hex("right_bytes")).alias("right_hex"),
    )


@query(
    "b13_vocabulary_specials_first",
    f"""
    {LEARN} SELECT CAST(unicode(sym) + 2 AS INTEGER) AS token_id, lower(hex) AS hex FROM v{LEARNED}
    UNION ALL SELECT 0, lower(hex(encode('<|endoftext|>')))
    UNION ALL SELECT 1, lower(hex(encode('<|endoftext|><|endoftext|>')))
    """,
)
def vocabulary_specials_first(spark, sf):
    model = learned(spark, sf).with_specials(Q.SPECIALS)
    return bpe.vocab_specials_first(spark, model).select(
        "token_id", F.lower(F.hex("bytes")).alias("hex")
    )


@query(
    "b14_recover_merges",
    f'{LEARN} SELECT "left", "right", new_id FROM ({Q.merge_list(LEARNED)})',
)
def recover_merges(spark, sf):
    model = learned(spark, sf)
    ranked = model.vocab_table(spark).withColumnRenamed("token_id", "rank")
    return bpe.recover_merges(ranked, {b: i for i, b in model.vocab().items()})


def _permuted(model):
    """The same model over byte ids that are not the byte values."""

    def move(i):
        return (i * 7 + 3) % 256 if i < 256 else i

    base = {move(b): bytes([b]) for b in range(256)}
    merges = [(move(a), move(b), c) for a, b, c in model.merges]
    return bpe.BpeModel(merges, model.pattern, {}, base)


def moved_sql(code, offset):
    return f"({offset} + CASE WHEN {code} < 256 THEN ({code} * 7 + 3) % 256 ELSE {code} END)"


@query(
    "b15_permuted_bytes",
    f"""
    {LEARN}, {ENCODED}
    SELECT doc_id, {IDS.replace('unicode(c)', moved_sql('unicode(c)', 0))} AS ids, TRUE AS restored FROM e
    """,
)
def permuted_bytes(spark, sf):
    model = _permuted(learned(spark, sf))
    encoded = bpe.encode_documents(texts(spark, sf, "doc_id", "text"), model)
    return bpe.decode_documents(encoded, model).select(
        "doc_id", _ids("ids").alias("ids"), (F.col("decoded") == F.col("text")).alias("restored")
    )


RANKS_FROM = 70_000


@query(
    "b14_model_from_ranks",
    f"""
    {LEARN}, {ENCODED}
    SELECT doc_id, {IDS.replace('unicode(c)', moved_sql('unicode(c)', RANKS_FROM))} AS ids, TRUE AS restored FROM e
    """,
)
def model_from_ranks(spark, sf):
    """A vocabulary file of bytes and ranks, bytes in another order and ids past 65,535, read as a tokenizer."""
    vocab = _permuted(learned(spark, sf)).vocab()
    ranked = spark.createDataFrame([(bytearray(b), RANKS_FROM + i) for i, b in vocab.items()], "bytes binary, rank int")
    path = scratch_path(spark, "ranks")
    models.write_ranks(ranked, path)
    model = models.load_ranked_model(spark, path)
    encoded = bpe.encode_documents(texts(spark, sf, "doc_id", "text"), model)
    return bpe.decode_documents(encoded, model).select(
        "doc_id", _ids("ids").alias("ids"), (F.col("decoded") == F.col("text")).alias("restored")
    )


@query(
    "b16_token_pieces",
    f"""
    {LEARN}, {ENCODED},
    t AS (SELECT doc_id, unnest(string_split(sym, '')) AS sym, generate_subscripts(string_split(sym, ''), 1) - 1 AS pos FROM e)
    SELECT CAST(unicode(sym) AS INTEGER) AS token_id,
           replace(coalesce(TRY(decode(unhex(hex))), chr(65533)), chr(10), '\\u000a') AS token,
           count(*) AS n, CAST(sum(pos) AS BIGINT) AS pos_sum, count(DISTINCT doc_id) AS docs
    FROM t JOIN v{LEARNED} USING (sym) GROUP BY ALL
    """,
)
def token_pieces(spark, sf):
    model = learned(spark, sf)
    encoded = bpe.encode_documents(texts(spark, sf, "doc_id", "text"), model)
    placed = bpe.token_pieces(encoded, model)
    per_doc = placed.groupBy("token_id", "token", "doc_id").agg(
        F.count(F.lit(1)).alias("k"), F.sum("pos").alias("p")
    )
    return per_doc.groupBy("token_id", "token").agg(
        F.sum("k").alias("n"), F.sum("p").alias("pos_sum"), F.count(F.lit(1)).alias("docs")
    )


@query(
    "b17_token_frequency",
    f"""
    {LEARN},
    pl AS (SELECT lang, piece, count(*) AS k FROM (SELECT lang, unnest({Q.gpt2_pieces('text')}) AS piece FROM documents) GROUP BY ALL)
    SELECT lang, CAST(unicode(s) AS INTEGER) AS token_id, CAST(sum(k) AS BIGINT) AS n
    FROM (SELECT lang, k, unnest(string_split(sym, '')) AS s FROM pl JOIN {FINAL} USING (piece)) GROUP BY ALL
    """,
)
def token_frequency(spark, sf):
    pieces = pretok.piece_counts(texts(spark, sf, "lang", "text"), by=["lang"])
    return bpe.token_frequency(pieces, learned(spark, sf), by=["lang"])


@query(
    "b17_tokens_per_language",
    f"""
    {LEARN}, {ENCODED}
    SELECT lang, count(*) AS docs, CAST(sum(length(sym)) AS BIGINT) AS tokens,
           CAST(sum(octet_length(encode(text))) AS BIGINT) AS bytes,
           round(sum(octet_length(encode(text)))::DOUBLE / sum(length(sym)), 6) AS ratio
    FROM e JOIN documents USING (doc_id) GROUP BY lang
    """,
)
def tokens_per_language(spark, sf):
    encoded = bpe.encode_documents(texts(spark, sf, "lang", "text"), learned(spark, sf))
    sums = encoded.groupBy("lang").agg(
        F.count(F.lit(1)).alias("docs"),
        F.sum("n_tokens").alias("tokens"),
        F.sum(F.octet_length("text")).cast("long").alias("bytes"),
    )
    return sums.withColumn("ratio", F.round(X.compression_ratio(F.col("bytes"), F.col("tokens")), 6))
