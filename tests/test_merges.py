"""Merge learning by signed changes, queued merging and tokenizers from ranks."""

import base64
import random
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

import public_tokenizers
from corpusweave.functions import symbols as S
from corpusweave.functions.patterns import GPT2_PATTERN, GPT4_PATTERN
from corpusweave.operators import bpe, merge_learning
from corpusweave.plans.registry import load_all
from corpusweave.sources import models
from test_bpe import frame, one_by_one


def weighted(spark, sequences):
    rows = [("".join(map(chr, s)), n) for s, n in sequences.items()]
    return spark.createDataFrame(rows, "symbols string, n long")


@pytest.mark.parametrize("pattern", [GPT2_PATTERN, GPT4_PATTERN])
def test_243_merges_equal_one_by_one(spark, documents, pattern):
    docs = documents.limit(60).persist()
    counts = Counter()
    for row in docs.select("text").collect():
        counts.update(p.encode() for p in regex.findall(pattern, row["text"]))
    assert bpe.train(docs, 256 + 243, pattern=pattern).merges == one_by_one(counts, 243, "bytes")


@pytest.mark.parametrize("tie", ["bytes", "ids"])
def test_whole_texts_learn_like_one_by_one(spark, documents, tie):
    """Without a split pattern sequences are long; the draft still looks ahead."""
    docs = documents.limit(25).persist()
    counts = Counter(row["text"].encode() for row in docs.select("text").collect())
    assert bpe.train(docs, 256 + 60, pattern=None, tie=tie).merges == one_by_one(counts, 60, tie)


@pytest.mark.parametrize("tie", ["bytes", "ids"])
def test_ties_and_runs_of_one_symbol(spark, tie):
    rng = random.Random(3)
    sequences = Counter()
    for _ in range(300):
        sequences[bytes(rng.choices(b"aab", k=rng.randrange(1, 12)))] += rng.randrange(1, 4)
    expected = one_by_one(sequences, 40, tie)
    assert merge_learning.learn_merges(weighted(spark, sequences), 40, tie=tie) == expected
    assert merge_learning.learn_merges(weighted(spark, sequences), 40, tie=tie, draft_steps=3, known_pairs=1) == expected


def test_learning_over_refreshes(spark, monkeypatch):
    monkeypatch.setattr(merge_learning, "REFRESH_ROUNDS", 2)
    rng = random.Random(5)
    sequences = Counter({bytes(rng.choices(b"abcdef", k=rng.randrange(2, 30))): rng.randrange(1, 9) for _ in range(200)})
    found = merge_learning.learn_merges(weighted(spark, sequences), 50, draft_steps=2)
    assert found == one_by_one(sequences, 50, "bytes")


def test_changes_add_up_to_full_counts():
    rng = np.random.default_rng(2)
    ids = rng.integers(0, 3, 400).astype(np.uint32)
    ids[rng.choice(399, 60, replace=False)] = merge_learning.SEPARATOR
    ids[-1] = merge_learning.SEPARATOR
    weights = rng.integers(1, 9, int((ids == merge_learning.SEPARATOR).sum()))
    block = merge_learning.Block(ids, weights)
    kept = dict(zip(*map(np.ndarray.tolist, merge_learning.summed(*block.all_pairs())), strict=True))
    for new, (left, right) in enumerate([(0, 0), (1, 2), (3, 0), (3, 3), (2, 2)], 3):
        for pair, n in zip(*map(np.ndarray.tolist, merge_learning.summed(*block.changes(left, right, new))), strict=True):
            kept[pair] = kept.get(pair, 0) + n
        full = dict(zip(*map(np.ndarray.tolist, merge_learning.summed(*block.all_pairs())), strict=True))
        assert {p: n for p, n in kept.items() if n} == full


def test_linked_blocks_merge_like_plain_ones():
    """Known and unknown pairs, runs of one symbol, symbols made twice, and merges whose changes nobody asks for."""
    for trial in range(200):
        rng, names = np.random.default_rng(trial), random.Random(trial)
        ids = rng.integers(0, 3, int(rng.integers(5, 300))).astype(np.uint32)
        ids[rng.random(len(ids)) < 0.15] = merge_learning.SEPARATOR
        ids[-1] = merge_learning.SEPARATOR
        weights = rng.integers(1, 9, int((ids == merge_learning.SEPARATOR).sum()))
        symbols, merges = [0, 1, 2], []
        for new in range(3, 3 + names.randrange(1, 12)):
            new = merges[-1][2] if merges and names.random() < 0.1 else new
            merges.append((names.choice(symbols), names.choice(symbols), new))
            symbols.append(new)
        plain = merge_learning.Block(ids.copy(), weights)
        live = merge_learning.LiveBlock(merge_learning.Block(ids.copy(), weights), merges[: names.randrange(len(merges) + 1)])
        for merge in merges:
            if names.random() < 0.7:
                keys, n = merge_learning.summed(*plain.changes(*merge))
                found = merge_learning.summed(*live.merge(*merge, told=True))
                assert keys.tolist() == found[0].tolist() and n.tolist() == found[1].tolist()
            else:
                plain.merge(*merge)
                live.merge(*merge)
            assert live.block().ids.tolist() == plain.ids.tolist()


def test_the_round_trip_has_a_whole_vocabulary(spark, tmp_path, monkeypatch):
    """B11 decodes tokens of several bytes, not bytes and eight pairs of them."""
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefghijk", k=rng.randrange(3, 10))) for _ in range(1500)]
    rows = [(k // 2, " ".join(rng.choices([*words, "¡ñandú", "🙂"], k=50))) for k in range(300)]
    rows += [(900, ""), (901, None), (None, "low lower"), (None, "low lower")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    seen, decode = [], bpe.decode_documents

    def watched(encoded, model):
        seen.append((encoded, model))
        return decode(encoded, model)

    monkeypatch.setattr(bpe, "decode_documents", watched)
    out = load_all()["b11_decode_round_trip"].run(spark, str(tmp_path))
    assert Counter(map(tuple, out.select("doc_id", "decoded").collect())) == Counter(rows)
    ((encoded, model),) = seen
    assert len(model.vocab()) == 2048
    tokens = sum(len(r["ids"] or []) for r in encoded.collect())
    assert tokens < sum(len((text or "").encode()) for _, text in rows) / 3


def random_ranks(rng, symbols, n):
    """Merges in any order, parts not always made before they are used."""
    ranks, made = {}, list(symbols)
    for rank in range(n):
        a, b = rng.choice(made), rng.choice(made)
        new = chr(1000 + rank)
        ranks.setdefault(a + b, (rank, new, a + b))
        made.append(new)
    keys = list(ranks.values())
    order = rng.sample(range(len(keys)), len(keys))
    return {pair: (order[k], new, pair) for k, (_, new, pair) in enumerate(keys)}


def test_queued_merging_equals_scanning():
    rng = random.Random(7)
    for _ in range(400):
        ranks = random_ranks(rng, "abc", rng.randrange(1, 25))
        seq = "".join(rng.choices("aaabc", k=rng.randrange(0, 60)))
        assert bpe._merge_queued(seq, ranks) == bpe._merge_lowest_rank(seq, ranks)


def test_a_piece_of_a_megabyte_takes_seconds(spark, documents):
    model = bpe.train(documents.limit(40), 256 + 100)
    ranks = {S.symbol(a) + S.symbol(b): (r, S.symbol(c), S.symbol(a) + S.symbol(b)) for r, (a, b, c) in enumerate(model.merges)}
    text = "\n".join(r["text"] for r in documents.select("text").collect()).encode().decode("latin-1")
    text = (text * (1 + (1 << 20) // len(text)))[: 1 << 20]
    start = time.perf_counter()
    merged = bpe.merge_piece(text, ranks)
    assert time.perf_counter() - start < 20
    cut = text[: 1 << 12]
    assert bpe.merge_piece(cut, ranks) == bpe._merge_lowest_rank(cut, ranks)
    assert len(merged) < len(text) * 0.8
    # In the order in which merges were made, rank by rank replacement gives the same.
    folded = text
    for a, b, c in model.merges:
        folded = folded.replace(S.symbol(a) + S.symbol(b), S.symbol(c))
    assert merged == folded


def test_256_merges_without_a_pattern_give_the_same_ids(spark, documents):
    docs = documents.select("doc_id", "text").limit(30).persist()
    model = bpe.train(docs, 512, pattern=None)
    for row in bpe.encode_documents(docs, model).collect():
        ids = row["text"].encode().decode("latin-1")
        for a, b, c in model.merges:
            ids = ids.replace(S.symbol(a) + S.symbol(b), S.symbol(c))
        assert row["ids"] == [S.symbol_id(c) for c in ids]


# --- tokenizers from ranks --------------------------------------------------------------------

SPECIALS = {"<|endoftext|>": 100_257, "<|fim_prefix|>": 100_258}


def published():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def test_published_ranks_give_the_ids_of_their_library(spark, documents, tmp_path):
    ranks = published()
    model = models.load_ranked_model(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    assert [m[2] for m in model.merges] == sorted(r for t, r in ranks.items() if len(t) > 1)
    library = tiktoken.Encoding("t", pat_str=GPT2_PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = documents.select("doc_id", "text").unionByName(frame(spark, ["", "🙂 ñ \x00", "don't  stop\n\n 12345"]))
    encoded = bpe.encode_documents(docs, model)
    for row in bpe.decode_documents(encoded, model).collect():
        assert row["ids"] == library.encode_ordinary(row["text"])
        assert row["decoded"] == row["text"]


def test_permuted_bytes_high_ids_and_special_tokens(spark, documents, tmp_path):
    """Ranks moved past 65,535, bytes in another order: ids move along, and special tokens are whole."""
    move = {r: 70_000 + (r * 7 + 3) % 256 if r < 256 else r + 70_000 for r in published().values()}
    ranks = {t: move[r] for t, r in published().items() if r < 20_000}
    listed = spark.createDataFrame([(bytearray(t), r) for t, r in ranks.items()], "bytes binary, rank int")
    models.write_ranks(listed, str(tmp_path / "ranks"))
    model = models.load_ranked_model(spark, str(tmp_path / "ranks"), SPECIALS)
    library = tiktoken.Encoding("t", pat_str=GPT2_PATTERN, mergeable_ranks=ranks, special_tokens=SPECIALS)
    docs = documents.select("doc_id", F.concat(F.lit("<|endoftext|>"), "text", F.lit("<|fim_prefix|>x")).alias("text")).limit(80)
    for row in bpe.decode_documents(bpe.encode_documents(docs, model), model).collect():
        assert row["ids"] == library.encode(row["text"], allowed_special="all")
        assert row["decoded"] == row["text"]


def test_vocabularies_that_are_no_tokenizer(spark):
    def ranked(rows):
        return spark.createDataFrame([(bytearray(b), r) for b, r in rows], "bytes binary, rank int")

    whole = [(bytes([b]), b) for b in range(256)]
    assert bpe.model_from_ranks(ranked([*whole, (b"ab", 256)])).merges == [(97, 98, 256)]
    for rows, specials in (
        (whole[1:], {}), ([*whole, (b"ab", 7)], {}), ([*whole, (b"a", 300)], {}), (whole, {"<s>": 9}), (whole, {"<s>": 300, "</s>": 300}),
    ):
        with pytest.raises(ValueError):
            bpe.model_from_ranks(ranked(rows), specials=specials)
    with pytest.raises(Exception, match="does not split"):
        bpe.model_from_ranks(ranked([*whole, (b"abc", 256)]))


def test_blocks_stay_small_whatever_a_batch_holds(spark):
    texts = spark.range(600).select(F.repeat(F.lit("ab"), F.lit(2000)).alias("symbols"), F.lit(1).cast("long").alias("n"))
    sizes = [len(r["ids"]) // 4 for r in merge_learning.pack(texts.coalesce(1)).select("ids").collect()]
    assert sum(sizes) == 600 * 4001
    assert max(sizes) <= 2 * merge_learning.BLOCK_SYMBOLS


def test_an_encoding_task_holds_a_slice_of_a_batch(spark):
    texts = pa.array(["x" * 300_000, None, "", "y" * (3 << 20), *["z" * 1000] * 5000])
    parts = list(bpe._text_slices(texts))
    assert pa.concat_arrays(parts).equals(texts)
    assert all(len(p) == 1 or len("".join(t or "" for t in p.to_pylist())) <= bpe.SLICE_BYTES for p in parts)
