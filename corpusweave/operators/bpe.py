"""Byte-pair encoding on tables: learning merges, encoding and decoding documents.

Learning works on the distinct-piece table, never on the corpus; ``merge_learning`` says how. Encoding
and decoding are map-only.
"""

import heapq
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusweave.functions import symbols as S
from corpusweave.functions.patterns import GPT2_PATTERN
from corpusweave.operators.merge_learning import BASE_SIZE, learn_merges
from corpusweave.operators.pretok import encoding_pieces, piece_array, piece_counts
from corpusweave.operators.text import text_slices

# Frequent pairs that correct the guesses of a round of learning.
TOP_PAIRS = 512
# Pieces remembered by one encoding task, and the symbols of those that are.
PIECE_CACHE = 200_000
SHORT_PIECE = 64
# Text bytes that an encoding task holds as Python strings.
SLICE_BYTES = 1 << 20
# Ids that a decoding task turns into bytes at a time.
DECODED_IDS = 1 << 20


@dataclass
class BpeModel:
    """Ordered merges and special tokens; its size is bounded by the vocabulary."""

    merges: list[tuple[int, int, int]]
    pattern: str | None = GPT2_PATTERN
    specials: dict[str, int] = field(default_factory=dict)
    base: dict[int, bytes] = field(default_factory=lambda: {i: bytes([i]) for i in range(BASE_SIZE)})

    def vocab(self) -> dict[int, bytes]:
        out = dict(self.base)
        for left, right, new in self.merges:
            out[new] = out[left] + out[right]
        for token, token_id in self.specials.items():
            out[token_id] = token.encode("utf-8")
        return out

    def merges_table(self, spark: SparkSession) -> DataFrame:
        rows = [(r, a, b, c) for r, (a, b, c) in enumerate(self.merges)]
        return spark.createDataFrame(rows, "rank int, left int, right int, new_id int")

    def vocab_table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, bytearray(b)) for i, b in sorted(self.vocab().items())]
        return spark.createDataFrame(rows, "token_id int, bytes binary")

    def with_specials(self, specials: Mapping[str, int]) -> "BpeModel":
        return BpeModel(self.merges, self.pattern, dict(specials), self.base)

    def require_ordered(self) -> None:
        """A single pass in rank order needs every part to be made before it is used."""
        made = set(self.base)
        for left, right, new in self.merges:
            if left not in made or right not in made:
                raise ValueError(f"merge ({left}, {right}) comes before one of its parts")
            made.add(new)


# --- learning ---------------------------------------------------------------------------------


def _pair_strings(symbols: Column) -> Column:
    """All adjacent pairs as two-symbol strings, overlapping, in one linear pass."""
    return F.regexp_extract_all(symbols, F.lit("(?s)(?=(..))."), F.lit(1))


def symbol_pairs(table: DataFrame, symbols: str = "symbols", weight: str = "n") -> DataFrame:
    """Adjacent pair counts; overlapping pairs count and pairs never cross a row."""
    pairs = table.select(F.col(weight).alias("_w"), F.explode(_pair_strings(F.col(symbols))).alias("pair"))
    counts = pairs.groupBy("pair").agg(F.sum("_w").alias("count"))
    return counts.select(F.left("pair", F.lit(1)).alias("left"), F.right("pair", F.lit(1)).alias("right"), "count")


def merge_symbols(symbols: Column, left: int, right: int, new_id: int) -> Column:
    """Merge one pair left to right, without overlap."""
    return F.replace(
        symbols, F.lit(S.symbol(left) + S.symbol(right)), F.lit(S.symbol(new_id))
    )


def train(
    docs: DataFrame,
    vocab_size: int,
    *,
    text: str = "text",
    pattern: str | None = GPT2_PATTERN,
    specials: Iterable[str] | Mapping[str, int] = (),
    tie: str = "bytes",
    min_frequency: int = 1,
) -> BpeModel:
    """Learn a tokenizer from a table of texts.

    ``vocab_size`` counts the 256 bytes and the special tokens. ``pattern=None`` trains on whole
    texts. Special tokens given without ids are numbered after the merges.
    """
    if vocab_size < BASE_SIZE:
        raise ValueError("vocab_size must be at least 256, the number of byte tokens")
    names = list(specials)
    pieces = piece_counts(docs, text, pattern, names)
    table = pieces.select(S.text_to_symbols(F.col("piece")).alias("symbols"), "n")
    merges = learn_merges(
        table,
        vocab_size - BASE_SIZE - len(names),
        tie=tie,
        min_frequency=min_frequency,
        known_pairs=TOP_PAIRS,
    )
    if isinstance(specials, Mapping):
        ids = dict(specials)
    else:
        ids = {s: BASE_SIZE + len(merges) + i for i, s in enumerate(names)}
    return BpeModel(merges, pattern, ids)


def pair_counts(docs: DataFrame, text: str = "text", pattern: str | None = GPT2_PATTERN) -> DataFrame:
    """Pair frequency of a corpus as (left, right, count) with byte ids."""
    pieces = piece_counts(docs, text, pattern).select(
        S.text_to_symbols(F.col("piece")).alias("symbols"), "n"
    )
    return symbol_pairs(pieces).select(
        F.ascii("left").alias("left"), F.ascii("right").alias("right"), "count"
    )


# --- encoding ---------------------------------------------------------------------------------


def _merge_constants(model: BpeModel) -> Column:
    pairs = [S.symbol(a) + S.symbol(b) for a, b, _ in model.merges]
    made = [S.symbol(c) for _, _, c in model.merges]
    return F.arrays_zip(S.literal_array(pairs).alias("pair"), S.literal_array(made).alias("made"))


def fold_merges(symbols: Column, model: BpeModel) -> Column:
    """Apply all merges in rank order; equals merging the lowest-ranked pair first.

    That needs every part to be made before it is used, which is checked here.
    """
    model.require_ordered()
    if not model.merges:
        return symbols
    return F.aggregate(
        _merge_constants(model), symbols, lambda s, m: F.replace(s, m["pair"], m["made"])
    )


def _base_symbols(piece: Column, model: BpeModel) -> Column:
    """Byte symbols of a piece; vocabularies with permuted byte ids are translated."""
    plain = S.text_to_symbols(piece)
    ids = {b[0]: i for i, b in model.base.items()}
    if all(ids[b] == b for b in range(BASE_SIZE)):
        return plain
    source = "".join(chr(b) for b in range(BASE_SIZE))
    # To ``translate`` a target of U+0000 means to drop the character, so another one stands in for it.
    target = "".join(S.symbol(ids[b]) for b in range(BASE_SIZE)).replace("\0", S.SEPARATOR)
    return F.replace(F.translate(plain, source, target), F.lit(S.SEPARATOR), F.lit("\0"))


def _doc_symbols(text: Column, model: BpeModel, allowed_special: str) -> Column:
    """Whole document as symbols with a separator between pieces."""
    pieces = encoding_pieces(text, model.specials, model.pattern, allowed_special)
    if not model.specials:
        return F.array_join(
            F.transform(pieces, lambda p: _base_symbols(p["piece"], model)), S.SEPARATOR
        )
    marks = F.create_map(
        *[x for i in model.specials.values() for x in (F.lit(i), F.lit(S.symbol(i)))]
    )
    return F.array_join(
        F.transform(
            pieces,
            lambda p: F.when(p["special_id"].isNotNull(), marks[p["special_id"]]).otherwise(
                _base_symbols(p["piece"], model)
            ),
        ),
        S.SEPARATOR,
    )


def encode_column(text: Column, model: BpeModel, allowed_special: str = "all") -> Column:
    """Token ids of a text as one native expression: no shuffle, no Python, streamable."""
    joined = fold_merges(_doc_symbols(text, model, allowed_special), model)
    return S.symbols_to_ids(F.replace(joined, F.lit(S.SEPARATOR), F.lit("")))


def _merge_lowest_rank(seq: str, ranks: Mapping[str, tuple[int, str, str]]) -> str:
    """Merge the known pair of lowest rank until none is left, by scanning a short piece again."""
    while len(seq) > 1:
        best = min(
            (ranks[p] for p in {seq[i : i + 2] for i in range(len(seq) - 1)} if p in ranks),
            default=None,
        )
        if best is None:
            break
        seq = seq.replace(best[2], best[1])
    return seq


def _merge_queued(seq: str, ranks: Mapping[str, tuple[int, str, str]]) -> str:
    """The same merges in n log n steps, for pieces of any length.

    Symbols form a linked list. Every known pair waits under its rank with the places where it stands, and
    a heap gives the lowest rank. A merge only looks at its two neighbours; a place whose pair has gone
    meanwhile is passed over.
    """
    n = len(seq)
    symbols, after, before = list(seq), list(range(1, n + 1)), list(range(-1, n - 1))
    waiting: dict[int, tuple[str, str, list[int]]] = {}
    heap: list[int] = []

    def wait(found, place):
        rank, made, pair = found
        if rank not in waiting:
            waiting[rank] = pair, made, []
            heapq.heappush(heap, rank)
        waiting[rank][2].append(place)

    for i in range(n - 1):
        found = ranks.get(seq[i : i + 2])
        if found:
            wait(found, i)
    while heap:
        pair, made, places = waiting.pop(heapq.heappop(heap))
        for i in sorted(places):
            j = after[i]
            if j >= n or symbols[i] + symbols[j] != pair:
                continue
            symbols[i], symbols[j] = made, ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                found = ranks.get(made + symbols[k])
                if found:
                    wait(found, i)
            h = before[i]
            if h >= 0:
                found = ranks.get(symbols[h] + made)
                if found:
                    wait(found, h)
    return "".join(symbols)


def merge_piece(seq: str, ranks: Mapping[str, tuple[int, str, str]]) -> str:
    return (_merge_lowest_rank if len(seq) <= SHORT_PIECE else _merge_queued)(seq, ranks)


class _PieceCache(dict):
    """Ids of the short pieces seen by one task; emptied when it reaches its limit."""

    def __init__(self, ranks, base):
        super().__init__()
        self.ranks, self.base = ranks, base

    def __missing__(self, piece):
        symbols = piece.decode("latin-1")
        merged = merge_piece(symbols.translate(self.base) if self.base else symbols, self.ranks)
        ids = np.frombuffer(merged.encode("utf-32-le"), "<i4")
        if len(piece) <= SHORT_PIECE:
            if len(self) >= PIECE_CACHE:
                self.clear()
            self[piece] = ids
        return ids


def _text_slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Parts of about SLICE_BYTES, one row at least; only one at a time is Python strings, of up to 4 bytes a symbol."""
    return text_slices(texts, SLICE_BYTES)


def _piece_slices(lists: pa.Array) -> Iterator[pa.Array]:
    """Rows of lists of pieces in parts of about SLICE_BYTES, one row at least; only one at a time is Python objects."""
    pieces = lists.values.field("piece") if pa.types.is_struct(lists.type.value_type) else lists.values
    upto = np.concatenate([[0], np.cumsum(pc.binary_length(pieces).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)])
    borders = upto[lists.offsets.to_numpy()]
    lo = 0
    while lo < len(lists):
        hi = max(int(np.searchsorted(borders, borders[lo] + SLICE_BYTES, side="right")) - 1, lo + 1)
        yield lists[lo:hi]
        lo = hi


def _ranked_encoder(spark: SparkSession, model: BpeModel):
    """Ids of lists of pieces, or of structs (piece, special_id), in Arrow batches.

    Each distinct piece of a part is merged or looked up once, and its ids are gathered for all places. The
    broadcast holds one entry per merge, so it is bounded by the vocabulary.
    """
    ranks = {}
    for rank, (a, b, c) in enumerate(model.merges):
        pair = S.symbol(a) + S.symbol(b)
        ranks.setdefault(pair, (rank, S.symbol(c), pair))
    moved = {b[0]: S.symbol(i) for i, b in model.base.items() if b[0] != i}
    shared = spark.sparkContext.broadcast((ranks, moved))

    def encoded(part: pa.ListArray, ids_of: _PieceCache) -> pa.ListArray:
        flat = part.flatten()
        special = None
        if pa.types.is_struct(flat.type):
            flat, special = flat.field("piece"), flat.field("special_id")
        listed = flat.cast(pa.binary()).dictionary_encode()
        found = [ids_of[p] for p in listed.dictionary.to_pylist()]
        if special is not None and special.null_count < len(special):
            # Special tokens are numbered behind the pieces.
            marks, at = np.unique(special.drop_null().to_numpy(), return_inverse=True)
            codes = listed.indices.to_numpy().copy()
            codes[special.is_valid().to_numpy(zero_copy_only=False)] = len(found) + at
            found += [np.array([m + (S.SURROGATE_COUNT if m >= S.SURROGATE_START else 0)], np.int32) for m in marks.tolist()]
        else:
            codes = listed.indices.to_numpy()
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        starts = np.cumsum(sizes) - sizes
        points = np.concatenate([np.zeros(0, np.int32), *found])
        # Ids from the start of the surrogates on are moved past them.
        ids = np.where(points >= S.SURROGATE_START, points - S.SURROGATE_COUNT, points).astype(np.int32)
        n = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(n)])
        places = np.arange(ends[-1]) + np.repeat(starts[codes] - ends[:-1], n)
        rows = np.concatenate([[0], np.cumsum(pc.list_value_length(part).fill_null(0).to_numpy())])
        return pa.ListArray.from_arrays(
            pa.array(ends[rows].astype(np.int32)), pa.array(ids[places]), mask=part.is_null()
        )

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        merges, base = shared.value
        ids_of = _PieceCache(merges, base)
        for lists in batches:
            made = [pa.array([], pa.list_(pa.int32()))]
            made += [encoded(part, ids_of) for part in _piece_slices(lists)]
            yield pa.concat_arrays(made)

    return encode


def encode_pieces(pieces: DataFrame, model: BpeModel, piece: str = "piece") -> DataFrame:
    """Token ids of every row of a piece table (distinct pieces, each encoded once)."""
    one = F.when(F.col(piece).isNotNull(), F.array(F.col(piece)))
    return pieces.withColumn("ids", _ranked_encoder(pieces.sparkSession, model)(one))


def encode_documents(
    docs: DataFrame,
    model: BpeModel,
    *,
    text: str = "text",
    allowed_special: str = "all",
    strategy: str = "rank",
) -> DataFrame:
    """Add ``ids ARRAY<INT>`` and ``n_tokens``, keeping the order of pieces and special tokens.

    ``rank``  Arrow batches with a per-task piece cache, for merges of any number and order; map-only
    ``fold``  native replacements per document, for merges in the order they were made; map-only.
              The caller's choice for short lists; merges in another order are an error
    """
    if strategy == "fold":
        ids = encode_column(F.col(text), model, allowed_special)
        out = docs.withColumn("ids", ids)
    elif strategy == "rank":
        pieces = encoding_pieces(F.col(text), model.specials, model.pattern, allowed_special)
        if not model.specials:
            pieces = piece_array(F.col(text), model.pattern)
        out = docs.withColumn("ids", _ranked_encoder(docs.sparkSession, model)(pieces))
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return out.withColumn("n_tokens", F.size("ids"))


def encode_by_dictionary(docs: DataFrame, model: BpeModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode each distinct piece once and join the result back.

    Worth its shuffles only when the same corpus is encoded while its piece table already exists;
    a frequent piece is a skewed join key, which AQE splits.
    """
    placed = docs.select(
        key, F.posexplode(encoding_pieces(F.col(text), {}, model.pattern)).alias("pos", "p")
    ).select(key, "pos", F.col("p.piece").alias("piece"))
    table = encode_pieces(piece_counts(docs, text, model.pattern).select("piece"), model)
    return (
        placed.join(table, "piece")
        .groupBy(key)
        .agg(F.array_sort(F.collect_list(F.struct("pos", "ids"))).alias("_parts"))
        .select(key, F.flatten(F.col("_parts.ids")).alias("ids"))
        .withColumn("n_tokens", F.size("ids"))
    )


# --- decoding and vocabularies ----------------------------------------------------------------


def decode_column(ids: Column, model: BpeModel) -> Column:
    """Text of an id array. An unknown id is an error; invalid UTF-8 becomes U+FFFD.

    The vocabulary is one run of bytes that ids are gathered from, so decoding is map-only.
    """
    vocab = model.vocab()
    known = np.array(sorted(vocab), np.int64)
    sizes = np.array([len(vocab[i]) for i in known.tolist()], np.int64)
    starts = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(vocab[i] for i in known.tolist()), np.uint8)

    def decoded(part: pa.ListArray) -> pa.Array:
        flat = part.flatten()
        found = flat.fill_null(-1).to_numpy(zero_copy_only=False)
        at = np.minimum(np.searchsorted(known, found), len(known) - 1)
        wrong = np.flatnonzero((known[at] != found) | flat.is_null().to_numpy(zero_copy_only=False))
        if len(wrong):
            raise ValueError(f"token id not in the vocabulary: {flat[wrong[0]].as_py()}")
        n = sizes[at]
        ends = np.concatenate([[0], np.cumsum(n)])
        places = np.arange(ends[-1]) + np.repeat(starts[at] - ends[:-1], n)
        rows = np.concatenate([[0], np.cumsum(pc.list_value_length(part).fill_null(0).to_numpy())])
        borders = pa.py_buffer(ends[rows].astype(np.int32))
        mask = None if not part.null_count else part.is_valid().cast(pa.uint8()).to_numpy()
        valid = None if mask is None else pa.py_buffer(np.packbits(mask, bitorder="little"))
        return pa.Array.from_buffers(pa.binary(), len(part), [valid, borders, pa.py_buffer(data[places])])

    @F.arrow_udf(T.BinaryType())
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            made, lo = [pa.array([], pa.binary())], 0
            ends = lists.offsets.to_numpy()[1:]
            while lo < len(lists):
                hi = max(int(np.searchsorted(ends, (ends[lo - 1] if lo else lists.offsets[0].as_py()) + DECODED_IDS, side="right")), lo + 1)
                made.append(decoded(lists[lo:hi]))
                lo = hi
            yield pa.concat_arrays(made)

    return S.bytes_to_text(decode(ids))


def decode_documents(encoded: DataFrame, model: BpeModel, ids: str = "ids") -> DataFrame:
    return encoded.withColumn("decoded", decode_column(F.col(ids), model))


def merge_byte_pairs(spark: SparkSession, model: BpeModel) -> DataFrame:
    """Merges as byte pairs in rank order."""
    merges, vocab = model.merges_table(spark), model.vocab_table(spark)
    left = vocab.select(F.col("token_id").alias("left"), F.col("bytes").alias("left_bytes"))
    right = vocab.select(F.col("token_id").alias("right"), F.col("bytes").alias("right_bytes"))
    return (
        merges.join(F.broadcast(left), "left")
        .join(F.broadcast(right), "right")
        .select("rank", "left_bytes", "right_bytes")
    )


def vocab_specials_first(spark: SparkSession, model: BpeModel) -> DataFrame:
    """Vocabulary with the special tokens numbered from 0 and all other ids shifted up."""
    names = list(model.specials)
    ordinary = {i: b for i, b in BpeModel(model.merges, model.pattern, {}, model.base).vocab().items()}
    rows = [(i, bytearray(s.encode("utf-8"))) for i, s in enumerate(names)]
    rows += [(i + len(names), bytearray(b)) for i, b in ordinary.items()]
    return spark.createDataFrame(rows, "token_id int, bytes binary")


def escape_controls(text: Column) -> Column:
    """Characters of a Unicode control class (C*) written as \\uXXXX."""
    return F.array_join(
        F.transform(
            S.chars(text),
            lambda c: F.when(
                c.rlike(r"^\p{C}$"), F.format_string("\\u%04x", F.ascii(c))
            ).otherwise(c),
        ),
        "",
    )


def render_token(binary: Column) -> Column:
    return escape_controls(S.bytes_to_text(binary))


def vocab_listing(spark: SparkSession, model: BpeModel) -> DataFrame:
    """Readable vocabulary: ``[token] id`` or ``[left][right] -> [token] id``."""
    vocab = model.vocab_table(spark)
    shown = vocab.select("token_id", render_token(F.col("bytes")).alias("token"))
    merges = model.merges_table(spark)
    left = shown.select(F.col("token_id").alias("left"), F.col("token").alias("left_token"))
    right = shown.select(F.col("token_id").alias("right"), F.col("token").alias("right_token"))
    parts = (
        merges.join(F.broadcast(left), "left")
        .join(F.broadcast(right), "right")
        .select(F.col("new_id").alias("token_id"), "left_token", "right_token")
    )
    return shown.join(F.broadcast(parts), "token_id", "left").select(
        "token_id",
        F.when(
            F.col("left_token").isNotNull(),
            F.format_string("[%s][%s] -> [%s] %d", "left_token", "right_token", "token", "token_id"),
        )
        .otherwise(F.format_string("[%s] %d", "token", "token_id"))
        .alias("line"),
    )


def token_pieces(encoded: DataFrame, model: BpeModel, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """One row per token of a document: position, id and readable text."""
    shown = model.vocab_table(encoded.sparkSession).select(
        "token_id", render_token(F.col("bytes")).alias("token")
    )
    placed = encoded.select(key, F.posexplode(ids).alias("pos", "token_id"))
    return placed.join(F.broadcast(shown), "token_id").select(key, "pos", "token_id", "token")


def token_frequency(pieces: DataFrame, model: BpeModel, by: Iterable[str] = ()) -> DataFrame:
    """Token counts from a piece table: every distinct piece is encoded once, then weighted."""
    by = list(by)
    return (
        encode_pieces(pieces, model)
        .select(*by, "n", F.explode("ids").alias("token_id"))
        .groupBy(*by, "token_id")
        .agg(F.sum("n").alias("n"))
    )


# --- merges from a vocabulary of ranks --------------------------------------------------------


def _parts_below(token: bytes, rank: int, known: Mapping[bytes, int]) -> list[int]:
    """Cuts of a token after all merges ranked below it."""
    cuts = list(range(len(token) + 1))
    while len(cuts) > 3:
        lowest, at = min(
            (known.get(token[cuts[i - 1] : cuts[i + 1]], rank), i) for i in range(1, len(cuts) - 1)
        )
        if lowest >= rank:
            break
        del cuts[at]
    return cuts


def recover_merges(ranked: DataFrame, ranks: Mapping[bytes, int]) -> DataFrame:
    """Merge pairs of a vocabulary that lists only token bytes and ranks.

    Every multi-byte token is rebuilt on its own with the merges ranked below it; exactly two
    parts must remain. ``ranks`` is the vocabulary itself and is broadcast to the tasks.
    """
    shared = ranked.sparkSession.sparkContext.broadcast(dict(ranks))

    def rebuild(batches):
        known = shared.value
        for batch in batches:
            rows = []
            for token, rank in zip(batch["bytes"], batch["rank"]):
                token = bytes(token)
                cuts = _parts_below(token, rank, known)
                if len(cuts) == 2:
                    continue
                if len(cuts) != 3:
                    raise ValueError(f"token {token!r} does not split into two parts")
                left, right = token[: cuts[1]], token[cuts[1] :]
                rows.append((known[left], known[right], int(rank)))
            yield pd.DataFrame(rows, columns=["left", "right", "new_id"]).astype("int32")

    return ranked.mapInPandas(rebuild, "left int, right int, new_id int")


def model_from_ranks(
    ranked: DataFrame, *, pattern: str | None = GPT2_PATTERN, specials: Mapping[str, int] | None = None
) -> BpeModel:
    """A whole tokenizer from a table (bytes, rank) without merges.

    Byte tokens may have any ranks; they become the base alphabet, so encoding translates bytes to their
    ids and decoding back. All 256 bytes must be there, ranks must be distinct, and special tokens may not
    reuse one. The merges come back in the order of their ranks, which is the order in which they were made.
    """
    listed = ranked.select("bytes", F.col("rank").cast("int").alias("rank"))
    # The vocabulary itself, as large as a tokenizer is.
    rows = listed.collect()
    ranks = {bytes(r["bytes"]): r["rank"] for r in rows}
    taken = set(ranks.values())
    missing = [b for b in range(BASE_SIZE) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"the vocabulary lacks the bytes {missing[:8]}")
    if len(ranks) < len(rows) or len(taken) < len(ranks):
        raise ValueError("the vocabulary repeats a token or a rank")
    specials = dict(specials or {})
    reused = [t for t, i in specials.items() if i in taken]
    if reused or len(set(specials.values())) < len(specials):
        raise ValueError(f"special tokens need ids of their own: {reused or sorted(specials)}")
    merges = recover_merges(listed, ranks).orderBy("new_id").collect()
    base = {ranks[bytes([b])]: bytes([b]) for b in range(BASE_SIZE)}
    model = BpeModel([(r["left"], r["right"], r["new_id"]) for r in merges], pattern, specials, base)
    model.require_ordered()
    return model
