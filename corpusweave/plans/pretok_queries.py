"""Registered queries for pre-tokenisation and special tokens."""

from pyspark.sql import functions as F

from corpusweave.functions.patterns import GPT2_PATTERN, GPT4_PATTERN
from corpusweave.operators import pretok as P
from corpusweave.plans import sqltext as Q
from corpusweave.plans.registry import query, texts


def planted():
    return F.expr(Q.PLANTED.replace("chr(10)", "char(10)"))


def _digest(pieces):
    return F.md5(F.encode(F.array_join(pieces, "|"), "UTF-8"))


def _split_query(name, pattern, sql_pieces):
    @query(
        name,
        f"""
        SELECT doc_id, CAST(len(p) AS BIGINT) AS n_pieces, md5(array_to_string(p, '|')) AS digest
        FROM (SELECT doc_id, {sql_pieces} AS p FROM documents)
        """,
    )
    def run(spark, sf):
        docs = texts(spark, sf, "doc_id", "text")
        pieces = docs.select("doc_id", P.piece_array(F.col("text"), pattern).alias("p"))
        return pieces.select(
            "doc_id", F.size("p").cast("long").alias("n_pieces"), _digest(F.col("p")).alias("digest")
        )

    return run


_split_query("p1_gpt2_split", GPT2_PATTERN, Q.gpt2_pieces("text"))
_split_query("p2_gpt4_split", GPT4_PATTERN, Q.gpt4_pieces("text"))
_split_query("p3_custom_split", "[a-z]+|[^a-z]+", "regexp_extract_all(text, '[a-z]+|[^a-z]+')")
_split_query("p3_no_split", None, "[text]")


@query(
    "p4_longest_special_first",
    f"""
    SELECT lang, tok AS token, count(*) AS n
    FROM (SELECT lang, unnest(regexp_extract_all({Q.PLANTED}, '{Q.SPECIAL_RE}')) AS tok FROM documents) GROUP BY ALL
    """,
)
def longest_special(spark, sf):
    docs = texts(spark, sf, "lang", "text").withColumn("planted", planted())
    found = F.regexp_extract_all("planted", F.lit(P.special_alternation(Q.SPECIALS)), F.lit(0))
    return docs.select("lang", F.explode(found).alias("token")).groupBy("lang", "token").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "p5_training_split",
    f"""
    WITH parts AS (SELECT unnest(string_split_regex({Q.PLANTED}, '{Q.SPECIAL_RE}')) AS part FROM documents)
    SELECT piece, count(*) AS n FROM (SELECT unnest({Q.gpt2_pieces('part')}) AS piece FROM parts) GROUP BY piece
    """,
)
def training_split(spark, sf):
    docs = texts(spark, sf, "text").withColumn("planted", planted())
    return P.piece_counts(docs, "planted", specials=list(Q.SPECIALS))


@query(
    "p6_encoding_split",
    f"""
    WITH d AS (SELECT doc_id, {Q.PLANTED} AS t FROM documents),
    x AS (SELECT doc_id, string_split_regex(t, '{Q.SPECIAL_RE}') AS parts,
                 regexp_extract_all(t, '{Q.SPECIAL_RE}') AS toks FROM d),
    a AS (SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS i FROM x),
    b AS (SELECT doc_id, 2 * i AS i, unnest({Q.gpt2_pieces('part')}) AS piece,
                 generate_subscripts({Q.gpt2_pieces('part')}, 1) AS j, FALSE AS special FROM a),
    c AS (SELECT doc_id, 2 * generate_subscripts(toks, 1) + 1 AS i, unnest(toks) AS piece, 1 AS j, TRUE AS special FROM x),
    u AS (SELECT * FROM b UNION ALL SELECT * FROM c)
    SELECT doc_id, count(*) AS n_pieces, count(*) FILTER (special) AS n_special,
           md5(string_agg(CASE WHEN special THEN '#' || CASE WHEN length(piece) > 13 THEN '1001' ELSE '1000' END
                          ELSE piece END, '|' ORDER BY i, j)) AS digest
    FROM u GROUP BY doc_id
    """,
)
def encoding_split(spark, sf):
    docs = texts(spark, sf, "doc_id", "text").withColumn("planted", planted())
    pieces = docs.select("doc_id", P.encoding_pieces(F.col("planted"), Q.SPECIALS).alias("p"))
    shown = F.transform(
        "p",
        lambda x: F.when(
            x["special_id"].isNotNull(), F.concat(F.lit("#"), x["special_id"].cast("string"))
        ).otherwise(x["piece"]),
    )
    return pieces.select(
        "doc_id",
        F.size("p").cast("long").alias("n_pieces"),
        F.size(F.filter("p", lambda x: x["special_id"].isNotNull())).cast("long").alias("n_special"),
        _digest(shown).alias("digest"),
    )


@query(
    "p7_specials_not_allowed",
    f"""
    WITH d AS (SELECT doc_id, {Q.PLANTED} AS t FROM documents),
    a AS (SELECT doc_id, contains(t, '<|endoftext|>') AS would_raise,
                 unnest(string_split_regex(t, '{Q.SPECIAL_RE}')) AS part FROM d)
    SELECT doc_id, any_value(would_raise) AS would_raise, CAST(sum(len({Q.gpt2_pieces('part')})) AS BIGINT) AS n_pieces
    FROM a GROUP BY doc_id
    """,
)
def specials_not_allowed(spark, sf):
    docs = texts(spark, sf, "doc_id", "text").withColumn("planted", planted())
    pieces = P.encoding_pieces(F.col("planted"), Q.SPECIALS, allowed_special="none")
    return docs.select(
        "doc_id",
        F.col("planted").rlike(P.special_alternation(Q.SPECIALS)).alias("would_raise"),
        F.size(pieces).cast("long").alias("n_pieces"),
    )


@query(
    "p8_piece_counts",
    f"SELECT piece, count(*) AS n FROM (SELECT unnest({Q.gpt2_pieces('text')}) AS piece FROM documents) GROUP BY piece",
)
def piece_counts(spark, sf):
    return P.piece_counts(texts(spark, sf, "text"))


@query(
    "p8_top_pieces",
    f"""
    SELECT piece, count(*) AS n FROM (SELECT unnest({Q.gpt2_pieces('text')}) AS piece FROM documents)
    GROUP BY piece ORDER BY n DESC, encode(piece) LIMIT 20
    """,
)
def top_pieces(spark, sf):
    return P.piece_counts(texts(spark, sf, "text")).orderBy(F.col("n").desc(), "piece").limit(20)
