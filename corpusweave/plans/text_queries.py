"""Registered queries for text and Unicode profiling."""

from pyspark.sql import functions as F

from corpusweave.functions import symbols as S
from corpusweave.operators import bpe, text as X
from corpusweave.plans import sqltext as Q
from corpusweave.plans.registry import query, table, texts


@query(
    "t1_code_point_counts",
    """
    WITH c AS (SELECT lang, unnest(string_split(text, '')) AS ch FROM documents)
    SELECT lang, CAST(unicode(ch) AS INTEGER) AS code_point, count(*) AS n,
           count(*) FILTER (chr(unicode(ch)) = ch) AS round_trip
    FROM c GROUP BY ALL
    """,
)
def code_points(spark, sf):
    counts = X.code_point_counts(texts(spark, sf, "lang", "text"), by=["lang"])
    back = X.from_code_points(F.array("code_point"))
    return counts.select(
        "lang", "code_point", "n", F.when(back == F.col("char"), F.col("n")).otherwise(0).alias("round_trip")
    )


@query(
    "t2_byte_histogram",
    """
    WITH h AS (SELECT lang, hex(encode(text)) AS h FROM documents),
    b AS (SELECT lang, unnest(regexp_extract_all(h, '..')) AS b FROM h)
    SELECT lang, CAST(('0x' || b) AS INTEGER) AS byte, count(*) AS n FROM b GROUP BY ALL
    """,
)
def byte_histogram(spark, sf):
    return X.byte_counts(texts(spark, sf, "lang", "text"), by=["lang"])


@query(
    "t2_byte_round_trip",
    """
    SELECT lang, count(*) AS docs, count(*) FILTER (contains(text, '€')) AS invalid_after_cut,
           count(*) AS equal_docs
    FROM documents GROUP BY lang
    """,
)
def byte_round_trip(spark, sf):
    docs = texts(spark, sf, "lang", "text")
    cut = F.unhex(F.replace(F.hex(F.encode("text", "UTF-8")), F.lit("E282AC"), F.lit("E282")))
    back = S.bytes_to_text(F.encode("text", "UTF-8"))
    return docs.groupBy("lang").agg(
        F.count(F.lit(1)).alias("docs"),
        F.count_if(~F.is_valid_utf8(cut.cast("string"))).alias("invalid_after_cut"),
        F.count_if(back == F.col("text")).alias("equal_docs"),
    )


@query(
    "t3_length_profile",
    """
    SELECT lang, source, count(*) AS docs, CAST(sum(length(text)) AS BIGINT) AS chars,
           CAST(sum(octet_length(encode(text))) AS BIGINT) AS utf8_bytes,
           CAST(sum(2 + 2 * length(text)
                + 2 * length(regexp_replace(text, '[^\\x{10000}-\\x{10FFFF}]', '', 'g'))) AS BIGINT) AS utf16_bytes
    FROM documents GROUP BY lang, source
    """,
)
def length_profile(spark, sf):
    return X.length_profile(texts(spark, sf, "lang", "source", "text"), ["lang", "source"])


@query(
    "t4_nfc_distinct",
    """
    SELECT lang, count(DISTINCT text) AS texts, count(DISTINCT nfc_normalize(text)) AS nfc_texts,
           count(*) FILTER (nfc_normalize(text) = text) AS already_nfc
    FROM documents GROUP BY lang
    """,
)
def nfc_distinct(spark, sf):
    docs = texts(spark, sf, "lang", "text")
    # Hash keys keep whole texts out of the shuffle; equal texts have equal digests.
    keyed = docs.select(
        "lang", F.sha2("text", 256).alias("raw"), F.sha2(X.nfc(F.col("text")), 256).alias("form")
    )
    per_key = keyed.groupBy("lang", "raw", "form").agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy("lang").agg(
        F.count_distinct("raw").alias("texts"),
        F.count_distinct("form").alias("nfc_texts"),
        F.sum(F.when(F.col("raw") == F.col("form"), F.col("n")).otherwise(0)).alias("already_nfc"),
    )


# The letters of the four languages fold to lower case, but for the sharp s.
@query(
    "t4_nfc_casefold_groups",
    """
    WITH f AS (SELECT lang, replace(lower(nfc_normalize(text)), 'ß', 'ss') AS form FROM documents)
    SELECT lang, sha256(form) AS form, count(*) AS copies FROM f GROUP BY ALL
    """,
)
def nfc_casefold(spark, sf):
    docs = texts(spark, sf, "lang", "text")
    keyed = docs.select("lang", F.sha2(X.nfc_fold(F.col("text")), 256).alias("form"))
    return keyed.groupBy("lang", "form").agg(F.count(F.lit(1)).alias("copies"))


@query(
    "t5_char_inventory",
    r"""
    WITH c AS (SELECT unnest(string_split(text, '')) AS ch FROM documents),
    g AS (SELECT ch, count(*) AS n FROM c GROUP BY ch)
    SELECT ch AS "char", CAST(unicode(ch) AS INTEGER) AS code_point, n,
      CASE WHEN regexp_full_match(ch, '\p{Nd}') THEN 'digit' WHEN regexp_full_match(ch, '\p{N}') THEN 'numeric'
           WHEN regexp_full_match(ch, '\p{L}') THEN 'letter' ELSE 'other' END AS kind
    FROM g
    """,
)
def char_inventory(spark, sf):
    return X.char_inventory(texts(spark, sf, "text"))


@query(
    "t6_escaped_characters",
    r"""
    WITH c AS (SELECT unnest(string_split(text, '')) AS ch FROM documents),
    g AS (SELECT ch, count(*) AS n FROM c GROUP BY ch)
    SELECT CASE WHEN regexp_full_match(ch, '(?s)\p{C}') THEN '\u' || lower(lpad(hex(unicode(ch)), 4, '0'))
                ELSE ch END AS shown, n FROM g
    """,
)
def escaped(spark, sf):
    counts = X.code_point_counts(texts(spark, sf, "text"))
    return counts.select(bpe.escape_controls(F.col("char")).alias("shown"), "n")


@query(
    "t7_word_counts",
    f"""
    SELECT lang, word, count(*) AS n
    FROM (SELECT lang, unnest({Q.words('lower(text)')}) AS word FROM documents) GROUP BY ALL
    """,
)
def word_counts(spark, sf):
    docs = texts(spark, sf, "lang", "text")
    return (
        docs.select("lang", F.explode(X.words(F.col("text"))).alias("word"))
        .groupBy("lang", "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


CHAR_VOCAB = """
    v AS (SELECT CAST(row_number() OVER (ORDER BY unicode(ch)) - 1 AS INTEGER) AS id, ch
          FROM (SELECT DISTINCT unnest(string_split(text, '')) AS ch FROM documents))
"""


@query("t8_char_vocabulary", f'WITH {CHAR_VOCAB} SELECT id, ch AS "char" FROM v')
def char_vocabulary(spark, sf):
    return X.char_vocabulary_table(texts(spark, sf, "text"))


@query(
    "t9_encode_characters",
    f"""
    WITH {CHAR_VOCAB.replace('documents', 'benchmark')},
    c AS (SELECT doc_id, unnest(string_split(text, '')) AS ch,
                 generate_subscripts(string_split(text, ''), 1) AS pos FROM documents)
    SELECT doc_id, coalesce(string_agg(CAST(id AS VARCHAR), ',' ORDER BY pos), '') AS ids, count(id) AS n_ids
    FROM documents LEFT JOIN (SELECT doc_id, pos, id FROM c JOIN v USING (ch)) USING (doc_id) GROUP BY doc_id
    """,
)
def encode_characters(spark, sf):
    vocab = X.char_vocabulary(table(spark, sf, "benchmark"))
    docs = texts(spark, sf, "doc_id", "text").withColumn("ids", X.encode_chars(F.col("text"), vocab))
    return docs.select(
        "doc_id",
        F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"),
        F.size("ids").cast("long").alias("n_ids"),
    )


@query(
    "t9_decode_characters",
    f"""
    WITH {CHAR_VOCAB.replace('documents', 'benchmark')},
    c AS (SELECT doc_id, unnest(string_split(text, '')) AS ch,
                 generate_subscripts(string_split(text, ''), 1) AS pos FROM documents)
    SELECT doc_id, string_agg(coalesce(v.ch, '?'), '' ORDER BY pos) AS decoded
    FROM c LEFT JOIN v ON v.id = unicode(c.ch) % 100 GROUP BY doc_id
    """,
)
def decode_characters(spark, sf):
    vocab = X.char_vocabulary(table(spark, sf, "benchmark"))
    docs = texts(spark, sf, "doc_id", "text")
    ids = F.transform(X.code_points(F.col("text")), lambda p: p % 100)
    return docs.select("doc_id", X.decode_chars(ids, vocab).alias("decoded"))


WORD_VOCAB = f"""
    w AS (SELECT unnest({Q.words('text')}) AS word FROM documents),
    g AS (SELECT word, count(*) AS n FROM w GROUP BY word),
    v AS (SELECT row_number() OVER (ORDER BY encode(word)) + 1 AS id, word, n FROM g
          UNION ALL SELECT 0, '<pad>', 0 UNION ALL SELECT 1, '<unk>', 0)
"""


@query("t10_word_vocabulary", f"WITH {WORD_VOCAB} SELECT id, word, n FROM v")
def word_vocabulary(spark, sf):
    return X.word_vocabulary(X.word_counts(texts(spark, sf, "text")))


@query(
    "t10_word_vocabulary_capped",
    f"""
    WITH p AS (SELECT doc_id, unnest({Q.words('text')}) AS word,
                      generate_subscripts({Q.words('text')}, 1) AS pos FROM documents),
    k AS (SELECT word FROM p QUALIFY row_number() OVER (ORDER BY doc_id, pos) <= 300000),
    g AS (SELECT word, count(*) AS n FROM k GROUP BY word)
    SELECT row_number() OVER (ORDER BY encode(word)) + 1 AS id, word, n FROM g
    UNION ALL SELECT 0, '<pad>', 0 UNION ALL SELECT 1, '<unk>', 0
    """,
)
def word_vocabulary_capped(spark, sf):
    first = X.first_words(texts(spark, sf, "doc_id", "text"), 300_000)
    counts = first.select(F.explode("words").alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")
    )
    return X.word_vocabulary(counts)


BENCH_VOCAB = WORD_VOCAB.replace("FROM documents", "FROM benchmark")


@query(
    "t11_encode_words",
    f"""
    WITH {BENCH_VOCAB},
    p AS (SELECT doc_id, unnest({Q.words('text')}) AS word FROM documents)
    SELECT doc_id, count(*) AS n_words, count(*) FILTER (v.id IS NULL) AS unknown,
           CAST(sum(coalesce(v.id, 1)) AS BIGINT) AS id_sum
    FROM p LEFT JOIN v USING (word) GROUP BY doc_id
    """,
)
def encode_words(spark, sf):
    vocab = X.word_vocabulary(X.word_counts(table(spark, sf, "benchmark")))
    ids = X.encode_words(texts(spark, sf, "doc_id", "text"), vocab)
    return ids.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_words"),
        F.count_if(F.col("id") == 1).alias("unknown"),
        F.sum("id").alias("id_sum"),
    )


@query(
    "t11_out_of_vocabulary",
    f"""
    WITH d AS (SELECT DISTINCT unnest({Q.words('text')}) AS word FROM benchmark),
    p AS (SELECT word, count(*) AS n FROM (SELECT unnest({Q.words('text')}) AS word FROM documents) GROUP BY word)
    SELECT word, n, word IN (SELECT word FROM d) AS known FROM p
    """,
)
def out_of_vocabulary(spark, sf):
    vocab = X.word_vocabulary(X.word_counts(table(spark, sf, "benchmark")))
    return X.vocabulary_coverage(X.word_counts(texts(spark, sf, "text")), vocab)


@query(
    "t12_compression_ratio",
    f"""
    WITH p AS (SELECT lang, octet_length(encode(text)) AS b, len({Q.gpt2_pieces('text')}) AS t FROM documents)
    SELECT lang, CAST(sum(b) AS BIGINT) AS bytes, CAST(sum(t) AS BIGINT) AS tokens,
           round(CASE WHEN sum(t) = 0 THEN 1.0 ELSE sum(b)::DOUBLE / sum(t) END, 6) AS ratio
    FROM p GROUP BY lang
    """,
)
def compression(spark, sf):
    from corpusweave.operators.pretok import piece_array

    docs = texts(spark, sf, "lang", "text")
    sums = docs.groupBy("lang").agg(
        F.sum(F.octet_length("text")).alias("bytes"),
        F.sum(F.size(piece_array(F.col("text")))).alias("tokens"),
    )
    return sums.withColumn("ratio", F.round(X.compression_ratio(F.col("bytes"), F.col("tokens")), 6))
