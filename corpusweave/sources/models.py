"""Tokenised corpora and tokenizers on disk."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusweave.functions.patterns import GPT2_PATTERN
from corpusweave.operators.bpe import BpeModel, encode_documents, model_from_ranks


def write_tokens(docs: DataFrame, model: BpeModel, path: str, key: str = "doc_id") -> None:
    """Encode a corpus into Parquet rows (key, ids, n_tokens)."""
    encode_documents(docs, model).select(key, "ids", "n_tokens").write.mode("overwrite").parquet(path)


def save_model(spark: SparkSession, model: BpeModel, path: str) -> None:
    """Three small tables: settings, special tokens and merges in rank order."""
    settings = [(model.pattern,)]
    spark.createDataFrame(settings, "pattern string").coalesce(1).write.mode("overwrite").parquet(f"{path}/settings")
    spark.createDataFrame(list(model.specials.items()), "token string, token_id int").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{path}/specials")
    base = [(i, bytearray(b)) for i, b in model.base.items()]
    spark.createDataFrame(base, "token_id int, bytes binary").coalesce(1).write.mode("overwrite").parquet(
        f"{path}/base"
    )
    model.merges_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/merges")


def load_model(spark: SparkSession, path: str) -> BpeModel:
    """Read a saved tokenizer; the vocabulary is computed again from the merges."""
    pattern = spark.read.parquet(f"{path}/settings").first()["pattern"]
    specials = {r["token"]: r["token_id"] for r in spark.read.parquet(f"{path}/specials").collect()}
    base = {r["token_id"]: bytes(r["bytes"]) for r in spark.read.parquet(f"{path}/base").collect()}
    rows = spark.read.parquet(f"{path}/merges").orderBy("rank").collect()
    model = BpeModel([(r["left"], r["right"], r["new_id"]) for r in rows], pattern, specials, base)
    model.require_ordered()
    return model


def printable_alphabet() -> dict[int, str]:
    """The byte to printable character alphabet of published vocabularies.

    Visible Latin-1 characters stand for themselves, the other bytes for the characters from
    U+0100 on, in byte order.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {**{b: chr(b) for b in visible}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}


def import_model(
    spark: SparkSession,
    vocab_path: str,
    merges_path: str,
    specials: list[str] | None = None,
    pattern: str = GPT2_PATTERN,
) -> BpeModel:
    """A tokenizer from a vocabulary JSON (token to id) and a merges text (two parts per line).

    Lines that do not split into two parts by a blank are left out, and so is a first line with the
    version of the format. Special tokens missing from the vocabulary are appended to it.
    """
    alphabet = {c: b for b, c in printable_alphabet().items()}
    listed = json.loads(spark.read.text(vocab_path, wholetext=True).first()["value"])

    def raw(token: str) -> bytes:
        return bytes(alphabet[c] for c in token)

    ids = {}
    for token, token_id in listed.items():
        if all(c in alphabet for c in token):
            ids[raw(token)] = token_id
    lines = spark.read.text(merges_path).select(F.rtrim("value").alias("line"), F.monotonically_increasing_id().alias("at"))
    two = lines.filter(F.size(F.split("line", " ")) == 2).orderBy("at").collect()
    if two and two[0]["line"].startswith("#version"):
        two = two[1:]
    merges = []
    for row in two:
        left, right = (raw(p) for p in row["line"].split(" "))
        merges.append((ids[left], ids[right], ids[left + right]))
    special_ids, size = {}, len(listed)
    for token in specials or []:
        found = ids.get(token.encode("utf-8"))
        if found is None:
            found, size = size, size + 1
        special_ids[token] = found
    base = {ids[bytes([b])]: bytes([b]) for b in range(256) if bytes([b]) in ids}
    model = BpeModel(merges, pattern, special_ids, base)
    model.require_ordered()
    return model


def read_ranks(spark: SparkSession, path: str) -> DataFrame:
    """(bytes, rank) of a vocabulary file with one token per line: its bytes in base 64, a blank, its rank."""
    parts = F.split(F.trim("value"), " ")
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return lines.select(F.unbase64(parts[0]).alias("bytes"), parts[1].cast("int").alias("rank"))


def write_ranks(ranked: DataFrame, path: str) -> None:
    """The same file from (bytes, rank), in the order of ranks."""
    # One file of one vocabulary. Long base 64 comes in lines.
    token = F.regexp_replace(F.base64("bytes"), r"\s", "")
    lines = ranked.orderBy("rank").select(F.concat_ws(" ", token, F.col("rank").cast("string")).alias("value"))
    lines.coalesce(1).write.text(path)


def load_ranked_model(
    spark: SparkSession, path: str, specials: dict[str, int] | None = None, pattern: str = GPT2_PATTERN
) -> BpeModel:
    """A tokenizer from a vocabulary file of ranks."""
    return model_from_ranks(read_ranks(spark, path), pattern=pattern, specials=specials)
