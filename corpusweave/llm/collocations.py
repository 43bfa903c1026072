"""Phrase collocations counted in counting quotient filters.

1. Texts are lower-cased and cut into words and pieces once. A block of texts becomes a row: its distinct
   (language, word) pairs with their counts, and the stream of their numbers within the block.
2. Words that are frequent enough to be part of a candidate get numbers; others cannot be, and become breaks.
3. Blocks get the numbers of their words, from a shared list where that is small and by a join where it is
   not, and every task counts the phrases of two, three and four words in filters, which travel by shard
   and are merged there. Only frequent phrases leave a shard.
4. Joins over the frequent phrases give the weakest cut of each, and whether a longer one stands for it.

Word numbers are unique over all languages, so a phrase names its language.

A null text is empty, a null language counts as ``und``; an empty table gives an empty result. Rows count
as often as they occur.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusweave.functions.ordered import row_index
from corpusweave.llm.batches import BROADCAST_BYTES, slices, write_and_read
from corpusweave.llm.quotient_filter import Filter, Keys, merged, shards
from corpusweave.llm.spans import byte_set, rows_of, text_array, text_bytes, word_spans

LONGEST = 4
LEAST = 30
# A longer phrase with this share of the occurrences, in percent, stands for the ones inside it.
COVERED = 80
FIRST = 2000
SCALE = 2_000_000
NO_LANGUAGE = "und"

BREAKS = b".,;:!?\n\x0b\x0c\r"
SEPARATORS = byte_set(b" \t" + BREAKS)
BREAKING = byte_set(BREAKS)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

# Text bytes of a block, words of a longer text that one block holds, keys of the filters that a task
# writes at a time, keys of a shard.
BLOCK_BYTES = 2 << 20
BLOCK_WORDS = 1 << 19
FILTER_KEYS = 1 << 21
SHARD_KEYS = 1 << 19
# Blocks of a row group: Spark's reader decodes the words and codes of up to 4,096 rows of a group at once.
FILE_BLOCKS = 4
LIMIT_BITS = 32

WORDS = "array<struct<lang:string,word:string,n:bigint>>"


def _blocks(part: pa.RecordBatch):
    """Rows (words, codes) of a part of the table: code 0 is a break, k + 1 the word k of the list."""
    data, borders = text_bytes(part.column("text"))
    data = LOWER[data]
    begins, ends = word_spans(data, borders, SEPARATORS)
    if not len(begins):
        return
    doc = rows_of(begins, borders)
    broken = np.concatenate([[0], np.cumsum(BREAKING[data])])
    langs = part.column("lang").dictionary_encode()
    lang = langs.indices.to_numpy().astype(np.int64)[doc]
    for lo in range(0, len(begins), BLOCK_WORDS):
        hi = min(lo + BLOCK_WORDS, len(begins))
        # Phrases that begin in this block may end in the next one: its first words come along, uncounted.
        end = min(hi + LONGEST - 1, len(begins))
        sizes = ends[lo:end] - begins[lo:end]
        packed = np.concatenate([[0], np.cumsum(sizes)])
        inside = np.repeat(begins[lo:end] - packed[:-1], sizes) + np.arange(packed[-1])
        words = text_array(data[inside], packed).dictionary_encode()
        pair = lang[lo:end] * len(words.dictionary) + words.indices.to_numpy()
        found, codes = np.unique(pair, return_inverse=True)
        counts = np.bincount(codes[: hi - lo], minlength=len(found))
        new = np.zeros(end - lo, bool)
        new[1:] = (doc[lo + 1 : end] != doc[lo : end - 1]) | (
            broken[begins[lo + 1 : end]] != broken[ends[lo : end - 1]]
        )
        at = np.arange(end - lo) + np.cumsum(new)
        stream = np.zeros(at[-1] + 1, np.uint16 if len(found) < 1 << 16 else np.uint32)
        stream[at] = codes + 1
        listed = pa.StructArray.from_arrays(
            [
                langs.dictionary.take(pa.array(found // len(words.dictionary))).cast(pa.string()),
                words.dictionary.take(pa.array(found % len(words.dictionary))).cast(pa.string()),
                pa.array(counts, pa.int64()),
            ],
            ["lang", "word", "n"],
        )
        # Places of the stream from here on begin no phrase of this block.
        own = int(at[hi - lo - 1]) + 1
        yield listed, stream, own


def blocks(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """(block, words, codes, width, own), written to the shared folder: texts are read once."""
    source = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", BLOCK_BYTES):
                for listed, stream, own in _blocks(part):
                    offsets = pa.array([0, len(listed)], pa.int32())
                    yield pa.record_batch(
                        {
                            "words": pa.ListArray.from_arrays(offsets, listed),
                            "codes": pa.array([stream.tobytes()], pa.binary()),
                            "width": pa.array([stream.itemsize], pa.int32()),
                            "own": pa.array([own], pa.int64()),
                        }
                    )

    made = source.mapInArrow(run, f"words {WORDS}, codes binary, width int, own long")
    made = made.withColumn("block", F.monotonically_increasing_id())
    return write_and_read(made, "phrase-blocks", rows=FILE_BLOCKS)


def word_counts(made: DataFrame) -> DataFrame:
    return made.select(F.explode("words").alias("w")).groupBy("w.lang", "w.word").agg(F.sum("w.n").alias("f"))


def joined_numbers(made: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(block, code, id, codes, width, own): each block's row, with code -1, and then its frequent words.

    Words of blocks meet the vocabulary in a join. What belongs to a block comes in one task in a row, by a sort
    that may spill, and no list of it is held in the JVM.
    """
    numbered = (
        made.select("block", F.posexplode("words").alias("code", "w"))
        .select("block", "code", "w.lang", "w.word")
        .join(vocabulary.select("lang", "word", "id"), ["lang", "word"])
        .select("block", "code", "id")
    )
    own = made.select("block", F.lit(-1).alias("code"), "codes", "width", "own")
    return (
        own.unionByName(numbered, allowMissingColumns=True)
        .select("block", "code", "id", "codes", "width", "own")
        .repartition("block")
        .sortWithinPartitions("block", "code")
    )


def shared_numbers(made: DataFrame, vocabulary: DataFrame, limit: int):
    """A function from a row of ``made`` to codes and numbers, or nothing for a vocabulary over ``limit`` bytes."""
    size = vocabulary.agg(F.sum(F.octet_length("lang") + F.octet_length("word") + 16)).first()[0] or 0
    if size > limit:
        return None
    # A word holds no line end, so the last one parts language and word.
    listed = vocabulary.select(F.concat_ws("\n", "lang", "word").alias("word"), "id").toArrow()
    shared = made.sparkSession.sparkContext.broadcast(
        (listed.column("word").combine_chunks(), listed.column("id").to_numpy().astype(np.uint64))
    )

    def find(row: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        words, ids = shared.value
        lists = row.column("words").flatten()
        at = pc.index_in(pc.binary_join_element_wise(lists.field("lang"), lists.field("word"), "\n"), words)
        return np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False)), ids[at.drop_null().to_numpy()]

    return find


def _stream(row: pa.RecordBatch) -> tuple[np.ndarray, int]:
    """The stream of a block's only row, and the places in it that are its own."""
    width = np.uint16 if row.column("width")[0].as_py() == 2 else np.uint32
    return np.frombuffer(row.column("codes")[0].as_buffer(), width), row.column("own")[0].as_py()


def shared_blocks(find):
    """A function from batches of blocks to (stream, own, codes, numbers) of each block."""

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                yield *_stream(row), *find(row)

    return run


def joined_blocks(batches):
    """(stream, own, codes, numbers) of each block, from the rows of ``joined_numbers``."""
    block, codes, numbers = None, [], []

    def settle():
        empty = np.zeros(0, np.int64)
        return *block, np.concatenate([empty, *codes]), np.concatenate([empty, *numbers]).astype(np.uint64)

    for batch in batches:
        code = batch.column("code").to_numpy()
        starts = np.flatnonzero(code < 0)
        for lo, hi in zip([0, *starts], [*starts, batch.num_rows], strict=True):
            if lo < hi and code[lo] < 0:
                if block is not None:
                    yield settle()
                # The bytes are copied, so that the batch can go.
                stream, own = _stream(batch.slice(lo, 1))
                block, codes, numbers = (stream.copy(), own), [], []
                lo += 1
            if lo < hi:
                codes.append(code[lo:hi].copy())
                numbers.append(batch.column("id").slice(lo, hi - lo).to_numpy().copy())
    if block is not None:
        yield settle()


def _phrases(ids: np.ndarray, own: int):
    """Columns of the numbers of all phrases of 2 to LONGEST words that begin before ``own``."""
    padded = np.concatenate([ids, np.zeros(LONGEST, np.uint64)])
    columns = [padded[k : k + own] for k in range(LONGEST)]
    whole = columns[0] > 0
    for length in range(2, LONGEST + 1):
        whole = whole & (columns[length - 1] > 0)
        at = np.flatnonzero(whole)
        yield [columns[k][at] for k in range(length)]


STORED = ("runs", "remainders", "repeated", "counters")


def filters(made: DataFrame, numbered, bits: int, shard_bits: int) -> DataFrame:
    """(words, shard, entries, ...): filters of what every task counts, flushed at a fixed number of keys.

    ``numbered`` gives the stream of each block with the codes of its frequent words and their numbers.
    """

    def flush(held):
        for words, parts in held.items():
            keys = Keys(words, bits)
            left, right = (np.concatenate(x) for x in zip(*parts, strict=True))
            for shard, made in shards(keys, shard_bits, *keys.counted(left, right)):
                yield pa.record_batch(
                    {
                        "words": pa.array([words], pa.int32()),
                        "shard": pa.array([shard], pa.int64()),
                        "entries": pa.array([made.entries], pa.int64()),
                        "quotient_bits": pa.array([made.quotient_bits], pa.int32()),
                        **{k: pa.array([getattr(made, k)], pa.binary()) for k in STORED},
                    }
                )

    def run(batches):
        held, size = {}, 0
        for stream, own, code, number in numbered(batches):
            # Codes of words that have no number lead to 0, as breaks do.
            table = np.zeros(int(stream.max(initial=0)) + 1, np.uint64)
            table[code + 1] = number
            for columns in _phrases(table[stream], own):
                if len(columns[0]):
                    held.setdefault(len(columns), []).append(Keys(len(columns), bits).permute(columns))
                    size += len(columns[0])
            if size >= FILTER_KEYS:
                yield from flush(held)
                held, size = {}, 0
        yield from flush(held)

    stored = ", ".join(f"{k} binary" for k in STORED)
    return made.mapInArrow(run, f"words int, shard long, entries long, quotient_bits int, {stored}")


def frequent_phrases(made: DataFrame, bits: int, shard_bits: int, least: int) -> DataFrame:
    """(w1..w4, f) of all phrases of two or more words and at least ``least`` occurrences; absent words are 0."""

    def run(batches):
        held, at, entries = [], None, 0

        def settle():
            keys = Keys(at[0], bits)
            left, right, counts = merged(keys, at[1], held)
            often = counts >= least
            columns = keys.restore(left[often], right[often])
            columns += [np.zeros(int(often.sum()), np.uint64)] * (LONGEST - len(columns))
            arrays = [pa.array(c.astype(np.int64)) for c in columns] + [pa.array(counts[often].astype(np.int64))]
            return pa.RecordBatch.from_arrays(arrays, names=["w1", "w2", "w3", "w4", "f"])

        for batch in batches:
            for row in range(batch.num_rows):
                one = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                place = one.pop("words"), one.pop("shard")
                if held and place != at:
                    yield settle()
                    held, entries = [], 0
                at = place
                held.append(Filter(shard_bits=shard_bits, **one))
                entries += one["entries"]
                if entries >= 4 * SHARD_KEYS:
                    # Merge what there is, so that many small filters don't wait next to each other.
                    keys = Keys(at[0], bits)
                    held = [Filter.build(keys, shard_bits, *merged(keys, at[1], held))]
                    entries = 0
        if held:
            yield settle()

    sent = made.repartition("words", "shard").sortWithinPartitions("words", "shard")
    return sent.mapInArrow(run, "w1 long, w2 long, w3 long, w4 long, f long")


def _key(words: list[Column], width: int, name: str) -> list[Column]:
    return [(words[k] if k < len(words) else F.lit(0).cast("long")).alias(f"{name}{k + 1}") for k in range(width)]


def weakest_cuts(phrases: DataFrame, vocabulary: DataFrame, scale: int = SCALE) -> DataFrame:
    """Add l, r and score of the lowest-scoring cut of every phrase; ties take the shortest first part."""
    words = [F.col(f"w{k}") for k in range(1, LONGEST + 1)]
    length = F.size(F.filter(F.array(*words), lambda w: w > 0))
    zero = F.lit(0).cast("long")
    parts = phrases.filter("w4 = 0").select("w1", "w2", "w3", "f").unionByName(
        vocabulary.select(F.col("id").alias("w1"), zero.alias("w2"), zero.alias("w3"), "f")
    )
    cuts = F.array(
        *[
            F.struct(
                F.lit(k).alias("k"), *_key(words[:k], LONGEST - 1, "left"), *_key(words[k:], LONGEST - 1, "right")
            )
            for k in range(1, LONGEST)
        ]
    )
    cut = phrases.select(*words, F.col("f").alias("a"), F.explode(F.filter(cuts, lambda c: c["k"] < length)).alias("c"))
    cut = cut.select(*words, "a", "c.*")
    for side in ("left", "right"):
        names = [f"{side}{k}" for k in (1, 2, 3)]
        cut = cut.join(parts.toDF(*names, side[0]), names).drop(*names)
    # Decimals: the product may pass 64 bits, the quotient does not.
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    cut = cut.withColumn("product", wide("a") * F.lit(scale).cast("decimal(10,0)")).withColumn(
        "whole", wide("l") + wide("r")
    )
    cut = cut.withColumn("score", F.expr("product div whole"))
    best = F.min(F.struct("score", "k", "l", "r")).alias("best")
    return cut.groupBy(*words, "a").agg(best).select(*words, "a", "best.l", "best.r", "best.score")


def covered(phrases: DataFrame, share: int = COVERED) -> DataFrame:
    """Phrases inside a longer one that has ``share`` percent of their occurrences: (w1, w2, w3, most)."""
    words = [F.col(f"w{k}") for k in range(1, LONGEST + 1)]
    inner = [
        F.struct(*_key(words[s : s + n], LONGEST - 1, "w"), words[s + n - 1].alias("last"))
        for n in range(2, LONGEST)
        for s in range(LONGEST - n + 1)
    ]
    # A part that reaches past a phrase of three words, or is all of it, is no shorter phrase.
    whole = F.when(words[3] == 0, 3).otherwise(4)
    proper = lambda p: (p["last"] > 0) & (F.when(p["w3"] > 0, 3).otherwise(2) < whole)
    inside = phrases.filter("w3 > 0").select("f", F.explode(F.filter(F.array(*inner), proper)).alias("p"))
    return inside.groupBy("p.w1", "p.w2", "p.w3").agg(F.max("f").alias("most"))


def mine(
    docs: DataFrame,
    *,
    lang: str = "lang",
    text: str = "text",
    least: int = LEAST,
    share: int = COVERED,
    first: int = FIRST,
    shard_keys: int = SHARD_KEYS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The ``first`` phrases of every language by score: lang, rank, phrase, a, l, r, n, score."""
    made = blocks(docs, lang, text)
    counts = write_and_read(word_counts(made), "phrase-words")
    totals = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = row_index(counts.filter(F.col("f") >= least), ["lang", "word"], "id")
    vocabulary = write_and_read(frequent.withColumn("id", F.col("id") + 1), "phrase-vocabulary")
    n_words = counts.agg(F.sum("f")).first()[0] or 0
    bits = max(vocabulary.count(), 1).bit_length()
    if bits > LIMIT_BITS:
        raise ValueError(f"{bits} bits a word don't fit into a key of four")
    # Shards grow with the corpus, their size does not.
    shard_bits = min(max(n_words // shard_keys, 1).bit_length() - 1, bits)
    # A small vocabulary goes to every task, a larger one joins the distinct words of the blocks.
    find = shared_numbers(made, vocabulary, broadcast_bytes)
    source = made.drop("block") if find else joined_numbers(made, vocabulary)
    sent = filters(source, shared_blocks(find) if find else joined_blocks, bits, shard_bits)
    phrases = write_and_read(frequent_phrases(sent, bits, shard_bits, least), "phrases")

    scored = weakest_cuts(phrases, vocabulary)
    inside = covered(phrases, share)
    kept = (
        scored.join(inside.withColumn("w4", F.lit(0).cast("long")), ["w1", "w2", "w3", "w4"], "left")
        .filter(F.col("most").isNull() | (F.lit(100) * F.col("most") < F.lit(share) * F.col("a")))
        .drop("most")
    )
    names = vocabulary.select("id", "lang", "word")
    kept = kept.join(names.toDF("w1", "lang", "word1"), "w1")
    # Ties at the border stay until the phrases are spelt out.
    by_score = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc())
    kept = kept.withColumn("place", F.rank().over(by_score)).filter(F.col("place") <= first)
    for k in range(2, LONGEST + 1):
        kept = kept.join(names.select(F.col("id").alias(f"w{k}"), F.col("word").alias(f"word{k}")), f"w{k}", "left")
    spelt = kept.withColumn("phrase", F.concat_ws(" ", *[f"word{k}" for k in range(1, LONGEST + 1)]))
    by_phrase = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = spelt.withColumn("rank", F.row_number().over(by_phrase).cast("long")).filter(F.col("rank") <= first)
    return ranked.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")
    )
