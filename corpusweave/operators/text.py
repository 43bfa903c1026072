"""Text and Unicode profiling over tables."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusweave.functions import symbols as S
from corpusweave.functions.ordered import row_index
from corpusweave.session import written

# Whitespace as the word splitter sees it: Unicode spaces and the four separator controls.
WORD_SPACE = r"(?U)[\s\x1c-\x1f]+"
PAD, UNK = "<pad>", "<unk>"
# Words that a task turns into codes at a time.
CODED_WORDS = 1 << 16


def code_points(text: Column) -> Column:
    """Code point of every character."""
    return F.transform(S.chars(text), lambda c: F.ascii(c))


def from_code_points(points: Column) -> Column:
    wide = F.transform(points, lambda p: F.lpad(F.hex(p.cast("long")), 8, "0"))
    return F.decode(F.unhex(F.array_join(wide, "")), "UTF-32")


def code_point_counts(docs: DataFrame, text: str = "text", by: Iterable[str] = ()) -> DataFrame:
    by = list(by)
    return (
        docs.select(*by, F.explode(S.chars(F.col(text))).alias("char"))
        .groupBy(*by, "char")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("code_point", F.ascii("char"))
    )


def byte_array(text: Column) -> Column:
    """UTF-8 byte values of a text."""
    return F.transform(S.chars(S.text_to_symbols(text)), lambda c: F.ascii(c))


def byte_counts(docs: DataFrame, text: str = "text", by: Iterable[str] = ()) -> DataFrame:
    """Byte histogram; characters are counted first, so a byte row is made once per character."""
    by = list(by)
    chars = code_point_counts(docs, text, by)
    return (
        chars.select(*by, "n", F.explode(byte_array(F.col("char"))).alias("byte"))
        .groupBy(*by, "byte")
        .agg(F.sum("n").alias("n"))
    )


def length_profile(docs: DataFrame, by: Iterable[str], text: str = "text") -> DataFrame:
    """Characters, UTF-8 bytes and UTF-16 bytes (with the 2-byte mark) per group."""
    t = F.col(text)
    return docs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("docs"),
        F.sum(F.char_length(t)).alias("chars"),
        F.sum(F.octet_length(t)).cast("long").alias("utf8_bytes"),
        F.sum(F.octet_length(F.encode(t, "UTF-16"))).cast("long").alias("utf16_bytes"),
    )


@F.pandas_udf(T.StringType())
def _nfc(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield texts.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


@F.pandas_udf(T.StringType())
def _fold(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield texts.map(lambda t: unicodedata.normalize("NFC", t).casefold(), na_action="ignore")


def _non_ascii(text: Column) -> Column:
    # Pure ASCII never leaves the JVM: it is equal to its NFC form.
    return F.when(F.octet_length(text) != F.char_length(text), text)


def nfc(text: Column) -> Column:
    return F.coalesce(_nfc(_non_ascii(text)), text)


def nfc_fold(text: Column) -> Column:
    """NFC plus case folding, a key for comparing texts."""
    return F.coalesce(_fold(_non_ascii(text)), F.lower(text))


def char_inventory(docs: DataFrame, text: str = "text") -> DataFrame:
    """Characters with count and class."""
    kind = (
        F.when(F.col("char").rlike(r"^\p{Nd}$"), "digit")
        .when(F.col("char").rlike(r"^\p{N}$"), "numeric")
        .when(F.col("char").rlike(r"^\p{L}$"), "letter")
        .otherwise("other")
    )
    return code_point_counts(docs, text).withColumn("kind", kind)


def text_slices(texts: pa.Array, size: int) -> Iterator[pa.Array]:
    """Parts of a text column of about ``size`` bytes, one row at least."""
    ends, lo = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)), 0
    while lo < len(texts):
        upto = (ends[lo - 1] if lo else 0) + size
        hi = max(int(np.searchsorted(ends, upto, side="right")), lo + 1)
        yield texts[lo:hi]
        lo = hi


def words(text: Column, lower: bool = True) -> Column:
    source = F.lower(text) if lower else text
    return F.filter(F.split(source, WORD_SPACE), lambda w: w != "")


def char_vocabulary(docs: DataFrame, text: str = "text") -> list[str]:
    """Sorted distinct characters; the id is the position. Bounded by Unicode itself."""
    rows = docs.select(F.explode(S.chars(F.col(text))).alias("char")).distinct().collect()
    return sorted(r["char"] for r in rows)


def char_vocabulary_table(docs: DataFrame, text: str = "text") -> DataFrame:
    vocab = char_vocabulary(docs, text)
    return docs.sparkSession.createDataFrame(list(enumerate(vocab)), "id int, char string")


def encode_chars(text: Column, vocab: list[str], unknown: str = "drop") -> Column:
    """Ids of the characters; unknown ones are dropped or are an error. Map-only."""
    known = "".join(vocab)
    klass = "[^" + "".join(f"\\x{{{ord(c):x}}}" for c in vocab) + "]"
    if unknown == "drop":
        kept = F.regexp_replace(text, klass, "")
    elif unknown == "error":
        kept = F.when(text.rlike(klass), F.raise_error(F.lit("character not in vocabulary"))).otherwise(text)
    else:
        raise ValueError(f"unknown={unknown} not understood")
    # Ids start at code point 1: translate reads a NUL target as deletion.
    target = "".join(S.symbol(i + 1) for i in range(len(vocab)))
    return F.transform(S.symbols_to_ids(F.translate(kept, known, target)), lambda i: i - 1)


def decode_chars(ids: Column, vocab: list[str]) -> Column:
    """Characters of the ids; an unknown id becomes ``?``."""
    table = S.literal_array(vocab)
    return F.array_join(
        F.transform(ids, lambda i: F.coalesce(F.when(i >= 0, F.get(table, i)), F.lit("?"))), ""
    )


def word_counts(docs: DataFrame, text: str = "text", lower: bool = False) -> DataFrame:
    return (
        docs.select(F.explode(words(F.col(text), lower)).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def word_vocabulary(counts: DataFrame) -> DataFrame:
    """``<pad>`` 0, ``<unk>`` 1, then the words in code point order.

    The vocabulary grows with the corpus, so ids come from a distributed position.
    """
    placed = row_index(counts.select("word", "n"), ["word"], "_at")
    ordinary = placed.select((F.col("_at") + 2).alias("id"), "word", "n")
    fixed = counts.sparkSession.createDataFrame(
        [(0, PAD, 0), (1, UNK, 0)], "id long, word string, n long"
    )
    return fixed.unionByName(ordinary)


def first_words(docs: DataFrame, limit: int, order: str = "doc_id", text: str = "text") -> DataFrame:
    """The corpus cut to its first ``limit`` words, counted over documents in order."""
    from corpusweave.functions.ordered import with_ordered

    listed = docs.select(order, words(F.col(text), False).alias("words"))
    sized = listed.withColumn("_n", F.size("words"))
    upto = with_ordered(sized.select(order, "_n"), [], [order], sums={"_end": F.col("_n")})
    kept = upto.select(order, (F.col("_end") - F.col("_n")).alias("_start")).filter(
        F.col("_start") < limit
    )
    return sized.join(kept, order).select(
        order,
        F.slice("words", F.lit(1), F.least(F.col("_n"), limit - F.col("_start")).cast("int")).alias("words"),
    )


def encode_words(
    docs: DataFrame, vocab: DataFrame, key: str = "doc_id", text: str = "text", lower: bool = False
) -> DataFrame:
    """Word ids per document as (key, pos, word, id); words outside the vocabulary get ``<unk>``.

    A document becomes its distinct words and a code for every position. Only distinct words meet the
    vocabulary and come back as a list of ids per document. Keys are distinct.
    """
    kind = docs.schema[key].dataType.simpleString()

    def coded(batches):
        for batch in batches:
            ends, lo = np.cumsum(pc.list_value_length(batch.column("w")).fill_null(0).to_numpy(zero_copy_only=False)), 0
            while lo < batch.num_rows:
                # A part of the rows at a time: words as Python strings take many times their bytes.
                upto = (ends[lo - 1] if lo else 0) + CODED_WORDS
                hi = max(int(np.searchsorted(ends, upto, side="right")), lo + 1)
                part, lo = batch.slice(lo, hi - lo), hi
                listed = [pa.array(w or [], pa.string()).dictionary_encode() for w in part.column("w").to_pylist()]
                words_ = [d.dictionary.to_pylist() for d in listed]
                codes = [d.indices.to_pylist() for d in listed]
                yield pa.RecordBatch.from_arrays(
                    [part.column(key), pa.array(words_, pa.list_(pa.string())), pa.array(codes, pa.list_(pa.int32()))],
                    names=[key, "words", "codes"],
                )

    made = docs.select(key, words(F.col(text), lower).alias("w")).mapInArrow(
        coded, f"`{key}` {kind}, words array<string>, codes array<int>"
    )
    held = written(made, "word-codes")
    ids = (
        held.select(key, F.posexplode("words").alias("i", "word"))
        .join(vocab.select("word", "id"), "word", "left")
        .groupBy(key)
        .agg(F.array_sort(F.collect_list(F.struct("i", F.coalesce("id", F.lit(1)).alias("id")))).alias("_found"))
    )
    placed = held.join(ids, key).select(key, "words", "_found", F.posexplode("codes").alias("pos", "_c"))
    return placed.select(key, "pos", F.get("words", F.col("_c")).alias("word"), F.get("_found", F.col("_c"))["id"].alias("id"))


def vocabulary_coverage(counts: DataFrame, vocab: DataFrame) -> DataFrame:
    """Words of a corpus with their count and whether the vocabulary has them."""
    known = vocab.select("word", F.lit(True).alias("_known"))
    return counts.join(known, "word", "left").select(
        "word", "n", F.coalesce("_known", F.lit(False)).alias("known")
    )


def compression_ratio(text_bytes: Column, tokens: Column) -> Column:
    """UTF-8 bytes per token; 1.0 when there are no tokens."""
    return F.when(tokens == 0, F.lit(1.0)).otherwise(text_bytes / tokens)
