from collections import Counter

import pytest
import regex
from pyspark.sql import functions as F

from corpusweave.functions.patterns import GPT2_PATTERN
from corpusweave.operators import bpe, pretok
from corpusweave.sources import models

END = "<|endoftext|>"
SAMPLES = ["", "s", "🙃", "Hello, how are you?", "Héllò hôw are ü? 🙃", "a  b\n\n c  d"]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def one_by_one(sequences, n_merges, tie):
    """Plain learning: count everything again before every merge."""
    vocab = {i: bytes([i]) for i in range(256)}
    table, merges = Counter({tuple(s): n for s, n in sequences.items()}), []
    for new in range(256, 256 + n_merges):
        counts = Counter()
        for seq, n in table.items():
            for pair in zip(seq, seq[1:]):
                counts[pair] += n
        if not counts:
            break
        if tie == "bytes":
            best = max(counts, key=lambda p: (counts[p], vocab[p[0]], vocab[p[1]]))
        else:
            best = min(counts, key=lambda p: (-counts[p], p))
        vocab[new] = vocab[best[0]] + vocab[best[1]]
        merges.append((*best, new))
        fresh = Counter()
        for seq, n in table.items():
            out, i = [], 0
            while i < len(seq):
                if seq[i : i + 2] == best:
                    out.append(new)
                    i += 2
                else:
                    out.append(seq[i])
                    i += 1
            fresh[tuple(out)] += n
        table = fresh
    return merges


def test_worked_example(spark):
    docs = frame(spark, ["aaabdaaabac"])
    model = bpe.train(docs, 259, pattern=None)
    assert [m[:2] for m in model.merges] == [(97, 97), (256, 97), (257, 98)]
    ids = bpe.encode_documents(docs, model).first()["ids"]
    assert ids == [258, 100, 258, 97, 99]


@pytest.mark.parametrize("tie", ["bytes", "ids"])
def test_learning_equals_one_merge_per_pass(spark, documents, tie):
    counts = Counter()
    for row in documents.select("text").collect():
        counts.update(p.encode("utf-8") for p in regex.findall(GPT2_PATTERN, row["text"]))
    expected = one_by_one(counts, 40, tie)
    assert bpe.train(documents, 296, tie=tie).merges == expected


def test_partitions_do_not_matter(spark, documents):
    one = bpe.train(documents.coalesce(1), 276).merges
    assert bpe.train(documents.repartition(8), 276).merges == one


def test_ties_at_the_cut_of_the_top(spark, monkeypatch):
    docs = frame(spark, ["ab cd ef gh ij"])
    full = bpe.train(docs, 262).merges
    monkeypatch.setattr(bpe, "TOP_PAIRS", 2)
    assert bpe.train(docs, 262).merges == full


def test_stops_when_pairs_run_out(spark):
    assert len(bpe.train(frame(spark, ["ab"]), 300).merges) == 1
    assert bpe.train(frame(spark, ["abcd"]), 300, min_frequency=2).merges == []


def test_bad_training_input(spark):
    with pytest.raises(ValueError):
        bpe.train(frame(spark, ["ab"]), 255)
    with pytest.raises(ValueError):
        bpe.train(frame(spark, [""]), 300)


def test_round_trip_and_equal_strategies(spark, documents):
    model = bpe.train(documents, 300)
    docs = documents.select("doc_id", "text").unionByName(
        frame(spark, SAMPLES).withColumn("doc_id", F.col("doc_id") + 10_000)
    )
    found = []
    for strategy in ("fold", "rank"):
        encoded = bpe.encode_documents(docs, model, strategy=strategy)
        assert bpe.decode_documents(encoded, model).filter("decoded <> text").count() == 0
        found.append({r["doc_id"]: r["ids"] for r in encoded.collect()})
    assert found[0] == found[1]
    joined = bpe.encode_by_dictionary(docs, model).collect()
    assert all(found[0][r["doc_id"]] == r["ids"] for r in joined)


def test_special_tokens(spark):
    docs = frame(spark, [f"one {END} two{END}{END}three", "plain"])
    model = bpe.train(docs, 262, specials=[END])
    assert all(b"<|" not in v for i, v in model.vocab().items() if i not in model.specials.values())
    model = model.with_specials({END: 900, END + END: 901})
    for strategy in ("fold", "rank"):
        encoded = bpe.encode_documents(docs, model, strategy=strategy).orderBy("doc_id")
        ids = encoded.first()["ids"]
        assert ids.count(900) == 1 and ids.count(901) == 1
        assert bpe.decode_documents(encoded, model).filter("decoded <> text").count() == 0
    none = bpe.encode_documents(docs, model, allowed_special="none").orderBy("doc_id").first()["ids"]
    assert not {900, 901} & set(none)
    with pytest.raises(Exception, match="special token found"):
        bpe.encode_documents(docs, model, allowed_special="none_raise").collect()
    with pytest.raises(ValueError):
        bpe.encode_documents(docs, model, allowed_special="some")


def test_unknown_id_and_invalid_bytes(spark):
    model = bpe.BpeModel([])
    broken = spark.createDataFrame([([0xC3],)], "ids array<int>")
    assert bpe.decode_documents(broken, model).first()["decoded"] == "�"
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode_documents(spark.createDataFrame([([999],)], "ids array<int>"), model).collect()


def test_split_patterns_equal_regex_module(spark, documents):
    from corpusweave.functions.patterns import GPT4_PATTERN

    docs = documents.select("text").unionByName(frame(spark, SAMPLES).select("text"))
    for pattern in (GPT2_PATTERN, GPT4_PATTERN):
        rows = docs.select("text", pretok.piece_array(F.col("text"), pattern).alias("p")).collect()
        for r in rows:
            assert r["p"] == regex.findall(pattern, r["text"])


def test_save_load_import(spark, documents, tmp_path):
    model = bpe.train(documents, 270, specials=[END])
    models.save_model(spark, model, str(tmp_path / "m"))
    again = models.load_model(spark, str(tmp_path / "m"))
    assert (again.merges, again.specials, again.pattern) == (model.merges, model.specials, model.pattern)
    with pytest.raises(ValueError):
        bpe.BpeModel([(256, 97, 257), (97, 97, 256)]).require_ordered()


def test_recovered_merges(spark, documents):
    model = bpe.train(documents, 276)
    ranked = model.vocab_table(spark).withColumnRenamed("token_id", "rank")
    rows = bpe.recover_merges(ranked, {b: i for i, b in model.vocab().items()}).collect()
    assert sorted(tuple(r) for r in rows) == sorted(model.merges)


def test_merge_order_never_changes_the_ids(spark):
    """Rank decides at every number of merges, and the fold refuses merges it would get wrong."""
    docs = spark.createDataFrame([(1, "aaaaa")], "doc_id long, text string")
    shuffled = [(256, 97, 257), (97, 97, 256)]
    for extra in (0, 29, 30, 31, 298):
        merges = shuffled + [(98, 98, 258), *[(257 + k, 98, 258 + k) for k in range(1, extra)]][:extra]
        model = bpe.BpeModel(merges, None)
        assert bpe.encode_documents(docs, model).first()["ids"] == [256, 257]
        with pytest.raises(ValueError, match="before one of its parts"):
            bpe.encode_documents(docs, model, strategy="fold")


def test_a_token_of_two_high_bytes_decodes(spark):
    model = bpe.BpeModel([(255, 255, 300)], None)
    row = spark.createDataFrame([(1, [300, 97])], "doc_id long, ids array<int>")
    assert bpe.decode_documents(row, model).first()["decoded"] == "��a"


def test_ids_are_looked_up_by_piece_and_not_by_symbol(spark):
    """Nulls, special tokens, moved byte ids and ids past the surrogates, equal to the native fold."""
    docs = frame(spark, [*SAMPLES, None, f"low{END}lower {END}{END} newest\x00", "low low low", END]).coalesce(1)
    base = {(b * 7 + 3) % 256: bytes([b]) for b in range(256)}
    ids = {t[0]: i for i, t in base.items()}
    merges = [(ids[ord("l")], ids[ord("o")], 0xD7FF), (0xD7FF, ids[ord("w")], 0xD800), (ids[ord(" ")], 0xD800, 70_000)]
    model = bpe.BpeModel(merges, GPT2_PATTERN, {}, base)
    for one in (model, model.with_specials({END: 0xDABC, END + END: 80_001})):
        found = bpe.encode_documents(docs, one)
        assert "transform(" not in bpe.encode_documents(docs, model)._jdf.queryExecution().optimizedPlan().toString()
        fold = bpe.encode_documents(docs, one, strategy="fold")
        assert found.collect() == fold.collect()
        back = bpe.decode_documents(found, one)
        assert "transform(" not in back.select(bpe.decode_column(F.lit([1]), one))._jdf.queryExecution().optimizedPlan().toString()
        assert back.filter("NOT (decoded <=> text)").count() == 0
