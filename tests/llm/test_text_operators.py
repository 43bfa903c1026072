"""Token counts, SentencePiece, chat formatting, quality rules, toxicity and mixing against plain versions."""

import base64
import hashlib
import math
import random
import re
import string

import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from corpusweave.llm import chat_format, edit_counts, mixing, quality, sentencepieces, toxicity
from pyspark.sql import functions as F

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
EMPTY = "doc_id long, text string, source string"


def encoding():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


# 1. Token counts


def test_every_edit_counts_like_a_full_recount():
    counter, plain = edit_counts.Counter(RANKS, public_tokenizers.PATTERN), encoding()
    rng = random.Random(3)
    alphabet = ["a", "b", " ", "  ", "\n", "'ll", "'l", "7", "!", "é", "\U0001f600", "word", " x"]
    for _ in range(300):
        document = edit_counts.Document("".join(rng.choices(alphabet, k=rng.randrange(0, 900))), counter)
        for _ in range(6):
            start, length = rng.randrange(0, len(document.text) + 2), rng.randrange(0, 12)
            before = document.text
            document.edit(start, length, "".join(rng.choices(alphabet, k=rng.randrange(0, 5))))
            assert document.tree.tokens == len(plain.encode_ordinary(document.text)), before
            assert document.tree.chars == len(document.text)


def test_an_edit_reads_only_its_surroundings():
    counter = edit_counts.Counter(RANKS, public_tokenizers.PATTERN)
    document = edit_counts.Document("some plain words " * 5000, counter)
    document.edit(40_000, 3, "other")
    assert document.recounted < 100


def test_edits_of_a_table(spark, odd_documents):
    edits = [{"start": 4, "length": 5, "text": "slow"}, {"start": 6, "length": 2, "text": "never"}, None]
    rows = [(r["doc_id"], r["text"], edits if r["doc_id"] != 6 else None) for r in odd_documents.collect()]
    docs = spark.createDataFrame(rows, f"doc_id long, n_text string, edits array<{edit_counts.EDIT}>")
    out = edit_counts.count(docs, RANKS, public_tokenizers.PATTERN, text="n_text", with_text=True).collect()
    plain = encoding()
    assert len(out) == len(rows)
    for row in out:
        text = row["n_text"] or ""
        after = text if row["doc_id"] == 6 else text[:4] + "slow" + text[9:]
        assert row["edited"] == after
        assert row["tokens_after"] == len(plain.encode_ordinary(after))
        assert row["tokens_before"] == len(plain.encode_ordinary(text))
    listed = spark.createDataFrame([(1, 5, 0, "b"), (1, 2, 1, "a")], "doc_id long, start long, length long, text string")
    assert [e["start"] for e in edit_counts.edit_lists(listed).first()["edits"]] == [2, 5]


# 2. SentencePiece


def test_ids_and_spans_equal_the_library():
    pieces = sentencepieces.Pieces(MODEL)
    texts = ["", " ", "  a\tb\n", "ﬁ ½ é é \U0001f600 ͸", "</s>[INST] <s>", "a\x00b", " ▁x", "long words " * 20_000]
    for text, (ids, begins, ends) in zip(texts, pieces.encode(texts), strict=True):
        assert ids.tolist() == pieces.decoder.encode(text)
        expected = [(p.begin, p.end) for p in pieces.decoder.encode(text, return_type="proto").pieces]
        assert list(zip(begins.tolist(), ends.tolist(), strict=True)) == expected


def double_array(entries: dict[bytes, bytes]) -> bytes:
    """A compiled character map made the plain way: every trie node gets a block of its own."""
    pool, values = b"", {}
    for key, value in entries.items():
        values[key] = len(pool)
        pool += value + b"\0"
    prefixes = sorted({k[:n] for k in entries for n in range(len(k) + 1)}, key=len)
    base = {p: 256 * (n + 1) for n, p in enumerate(prefixes)}
    units = [0] * (256 * (len(prefixes) + 1))
    for prefix in prefixes:
        at = base[prefix[:-1]] ^ prefix[-1] if prefix else 0
        leaf = prefix in values
        units[at] = (at ^ base[prefix]) << 10 | leaf << 8 | (prefix[-1] if prefix else 0)
        if leaf:
            units[base[prefix]] = 1 << 31 | values[prefix]
    blob = b"".join(u.to_bytes(4, "little") for u in units)
    return len(blob).to_bytes(4, "little") + blob + pool


def test_longest_prefix_normalisation_remembers_the_source():
    entries = {"ﬁ": "fi", "a": "A", "ab": "X", "½": "1/2", "　": " ", "zz": ""}
    charmap = sentencepieces.CharacterMap(double_array({k.encode(): v.encode() for k, v in entries.items()}))
    text, align = sentencepieces.Normalizer(charmap, dummy_prefix=False, escape=False)("cabaﬁ zz½　é")
    assert text == "cXAfi 1/2 é"
    source = "cabaﬁ zz½　é".encode()
    at = {c: align[text.encode().index(c.encode())] for c in "cXAf1é"}
    assert at == {"c": 0, "X": 1, "A": 3, "f": 4, "1": source.index("½".encode()), "é": source.index("é".encode())}
    assert align[-1] == len(source)
    squeezed, align = sentencepieces.Normalizer(charmap, squeeze=True)("  b 　 c  ")
    assert squeezed == "▁b▁c" and align[-1] == len("  b 　 c".encode())


def test_sentencepiece_table(spark, odd_documents):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    out = sentencepieces.decode(sentencepieces.encode(odd_documents, MODEL), MODEL).collect()
    short = sentencepieces.digests(odd_documents, MODEL).collect()
    assert len(out) == len(short) == odd_documents.count()
    for row, digest in zip(
        sorted(out, key=lambda r: str(r["text"])),
        sorted(odd_documents.collect(), key=lambda r: str(r["text"])),
        strict=True,
    ):
        ids = library.encode(digest["text"] or "", add_bos=True, add_eos=True)
        assert row["ids"] == ids and row["decoded"] == library.decode(ids)
    wanted = {
        (r["doc_id"], hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in r["ids"])).hexdigest()) for r in out
    }
    assert {(r["doc_id"], r["ids_sha256"]) for r in short} == wanted
    assert all(r["spans_cover"] for r in short)
    assert sentencepieces.digests(spark.createDataFrame([], EMPTY), MODEL).count() == 0


# 3. Chat formatting


@pytest.mark.parametrize("text", ["", "</s>[INST] ok [/INST]", "<\\/s>", "<\\\\/s> [\\INST]", "<<s>", "\\", "[[INST]]", "<|im_end|>"])
def test_escapes_are_reversible_and_hide_marks(text):
    hidden = chat_format.escape(text)
    assert not any(c in hidden for c in chat_format.CONTROLS)
    assert chat_format.unescape(hidden) == text


def test_layouts_are_found_by_their_paths():
    layouts = chat_format.Layouts()
    assert layouts.turns('{"prompt": "a", "completion": null}') == [("user", "a"), ("assistant", "")]
    assert layouts.turns('{"instruction": "a", "input": "b", "output": "c"}') == [
        ("system", "a"), ("user", "b"), ("assistant", "c")
    ]
    assert layouts.turns('{"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}') == [
        ("user", "a"), ("assistant", "b")
    ]
    assert layouts.turns(None) == []
    with pytest.raises(ValueError, match="no mapping"):
        layouts.turns('{"words": 1}')


def test_formatted_conversations_read_back(spark):
    marks = "</s>[INST] ok [/INST]"
    rows = [
        (1, 0, "user", "hello"), (1, 1, "assistant", "a" * 50), (1, 2, "assistant", marks), (1, 2, "assistant", marks),
        (2, 0, "user", None), (2, 1, None, "x"), (None, 0, "assistant", "y"), (3, None, "system", "z"), (-1, 0, "user", marks),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    expected = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (-1 if r[1] is None else r[1], r[2] or ""))
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        expected[conv] = (
            len(own), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()
        )
    records = chat_format.canonical_turns(chat_format.mixed_layouts(table))
    for turns in (records, chat_format.turn_rows(table)):
        for size in (chat_format.PART_CHARS, 10):
            out = chat_format.read_back(chat_format.render(turns, part_chars=size)).collect()
            assert {r["conv_id"]: tuple(r)[1:5] for r in out} == expected
    assert chat_format.fingerprints(chat_format.mixed_layouts(table)).count() >= 2
    assert chat_format.read_back(chat_format.render(chat_format.turn_rows(table.limit(0)))).count() == 0


def test_nested_and_optional_fields():
    layouts = chat_format.Layouts()
    assert layouts.turns('{"data": {"prompt": "a", "answer": "b"}}') == [("user", "a"), ("assistant", "b")]
    assert layouts.turns('{"messages": [{"role": "user", "content": "a", "name": "x"}, {"role": "gpt", "content": null}]}') == [
        ("user", "a"), ("assistant", "")
    ]
    assert layouts.turns('{"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}]}') == [
        ("user", "ab")
    ]
    assert layouts.turns('{"messages": []}') == layouts.turns('{"messages": null}') == []
    assert layouts.turns('{"messages": [{"role": "user", "content": 1.5}, {"role": "user", "content": true}]}') == [
        ("user", "1.5"), ("user", "true")
    ]
    deep = chat_format.Mapping(("a.b[].c.who", "a.b[].c.what"), items=("a.b", "c.who", "c.what"), optional=("a.id",))
    own = chat_format.Layouts([deep])
    assert own.turns('{"a": {"id": 3, "b": [{"c": {"who": "user", "what": "x"}}]}}') == [("user", "x")]
    assert own.turns('{"a": {"b": []}}') == []


def test_odd_records_are_rows_with_a_reason(spark):
    odd = [
        "not json", "[1, 2]", '"text"', "{}", '{"messages": [{"role": "user", "content": "a", "other": 1}]}',
        '{"prompt": {"deep": "a"}}', '{"prompt": ["a"], "completion": "b"}', "[" * 100_000,
    ]
    good = ['{"prompt": "a"}', None, '{"messages": []}']
    rows = [(k, 0, r, "x") for k, r in enumerate(odd + good)]
    records = spark.createDataFrame(rows, "conv_id long, position long, record string, text string")
    rejects = {r["conv_id"]: r for r in chat_format.rejected(records).collect()}
    assert sorted(rejects) == list(range(len(odd)))
    assert all(r["reason"] and r["record"] == odd[k] for k, r in rejects.items())
    assert [tuple(r) for r in chat_format.canonical_turns(records).collect()] == [(len(odd), 0, 0, "user", "a")]
    assert chat_format.fingerprints(records).count() >= 5
    assert chat_format.canonical_turns(records.limit(0)).count() == 0


def test_the_query_meets_every_layout(spark):
    """All layouts, several turns in a record, and one conversation over many tasks."""
    rows = [(c, t, role, f"{c} {t}") for c in range(120) for t, role in enumerate(["system", "user", "assistant", "user", "assistant", "tool"])]
    rows += [(c, t, role, f"{c} {t}") for c in range(200, 320) for t, role in enumerate(["user", "assistant"] * 3)]
    rows += [(500, t, ["user", "assistant"][t % 2], "long " * 9) for t in range(4000)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    records = chat_format.mixed_layouts(table)
    seen = {r["fingerprint"] for r in chat_format.fingerprints(records).collect()}
    assert all(seen & m.fingerprints() for m in chat_format.LAYOUTS)
    assert chat_format.rejected(records).count() == 0
    formatted = chat_format.render(chat_format.canonical_turns(records, roles={}))
    assert formatted.filter("conv_id = 500").count() > 1
    out = {r["conv_id"]: r for r in chat_format.read_back(formatted).collect()}
    assert len(out) == 241
    for conv in (0, 250, 500):
        own = sorted(r[1:] for r in rows if r[0] == conv)
        assert out[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest()
        assert out[conv]["loss_chars"] == sum(len(x) for _, r, x in own if r == "assistant")


# 8. Mixing


def plain_targets(sizes: dict, weights=(5, 2, 1), most=3) -> dict:
    names = sorted((n for n in sizes if n is not None), key=lambda n: [ord(c) for c in n]) + [None] * (None in sizes)
    weight = {n: weights[k % len(weights)] for k, n in enumerate(names)}
    total, stopped = sum(sizes.values()), set()
    while True:
        rest = [n for n in names if n not in stopped]
        left = total - sum(most * sizes[n] for n in stopped)
        target = {n: most * sizes[n] for n in stopped}
        target |= {n: weight[n] * left / sum(weight[m] for m in rest) for n in rest}
        over = {n for n in rest if target[n] > most * sizes[n]}
        if not over:
            return target
        stopped |= over


def test_mixing_meets_its_targets(spark):
    rng = random.Random(5)
    rows = [
        (k, " ".join(["w"] * rng.randrange(0, 30)), rng.choices(["b", "a", "é", "Z", None, "\U0001f600", "empty"], [50, 20, 9, 1, 2, 3, 0])[0])
        for k in range(6000)
    ] + [(9999, None, "empty")]
    docs = spark.createDataFrame(rows, EMPTY)
    plan = mixing.plan(docs).collect()
    sizes = {}
    for r in plan:
        sizes[r["source"]] = sizes.get(r["source"], 0) + len((r["text"] or "").split())
    want = plain_targets(sizes)
    for name, target in want.items():
        own = [r for r in plan if r["source"] == name]
        assert own[0]["target"] == pytest.approx(target) and own[0]["source_size"] == sizes[name]
        taken = sum(r["size"] * r["copies"] for r in own)
        assert abs(taken - target) <= 0.1 * target + 60
        assert all(0 <= r["copies"] <= 3 for r in own)
    assert mixing.mix(docs).count() == sum(r["copies"] for r in plan)
    assert sorted(map(tuple, mixing.plan(docs).collect()), key=str) == sorted(map(tuple, plan), key=str)


def test_mixing_odd_rows(spark, odd_documents):
    clash = odd_documents.withColumnRenamed("score", "size")
    assert mixing.plan(clash).count() == clash.count()
    assert mixing.mix(clash).columns == clash.columns
    assert mixing.mix(spark.createDataFrame([], EMPTY)).count() == 0


# 9. Toxicity


def test_unseen_misspellings_score_like_their_words():
    rng = random.Random(7)
    clean = ["".join(rng.choices("abcdefgh", k=rng.randrange(3, 8))) for _ in range(300)]
    bad = ["horribleperson", "nastycreature"]
    texts, labels = [], []
    for k in range(3000):
        words = rng.choices(clean, k=60)
        if k % 3 == 0:
            words[rng.randrange(60)] = rng.choice(bad)
        texts.append(" ".join(words))
        labels.append(int(k % 3 == 0))
    model = toxicity.train(texts[:2800], labels[:2800])
    scores = model.scores(texts[2800:])
    right = sum((s >= toxicity.THRESHOLD) == bool(y) for s, y in zip(scores, labels[2800:], strict=True))
    assert right >= 180
    plain = " ".join(rng.choices(clean, k=30))
    assert model.scores([plain + " horribleperzon"])[0] > model.scores([plain + " gardenfurniture"])[0]


def test_toxicity_odd_rows(spark, odd_documents):
    labels = spark.createDataFrame([(1, 1), (6, 0), (None, 1), (3, None), (77, 1)], "doc_id long, toxic int")
    model = toxicity.fit(odd_documents, labels)
    out = toxicity.score(odd_documents, model).collect()
    assert len(out) == 8 and all(0 <= r["score"] <= 1 for r in out)
    assert toxicity.score(spark.createDataFrame([], EMPTY), model).count() == 0
    nothing = toxicity.fit(spark.createDataFrame([], EMPTY), labels)
    assert 0 <= nothing.scores([""])[0] <= 1


@pytest.mark.parametrize("long_label", [0, 1])
@pytest.mark.parametrize("long_chars", [150_000, 60_000])
def test_long_texts_leave_the_other_rows_in_the_sample(spark, monkeypatch, long_label, long_chars):
    rng = random.Random(11)
    clean = ["".join(rng.choices("abcdefgh", k=rng.randrange(3, 8))) for _ in range(200)]
    seen = {}
    collected = toxicity._collected

    def watched(rows, order):
        sampled = rows.collect()
        seen.update(texts=[r["text"] for r in sampled], labels=[r["label"] for r in sampled])
        return collected(rows, order)

    monkeypatch.setattr(toxicity, "_collected", watched)
    ids = spark.range(600).filter(~toxicity.held_out(F.col("id"))).orderBy(F.xxhash64("id"), "id")
    keys = [r["id"] for r in ids.limit(250).collect()]
    rows, labels = [], []
    for k, key in enumerate(keys):
        label = long_label if k < 3 else k % 2
        words = rng.choices(clean, k=40)
        if k < 3:
            words = words * (long_chars // len(" ".join(words)) + 1)
        if label:
            words[0] = "nastycreature"
        rows.append((key, " ".join(words)))
        labels.append((key, label))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), sample_chars=100_000)
    assert sum(map(len, seen["texts"])) <= 100_000
    assert sum(len(t) < 1000 for t in seen["texts"]) == 247 and sorted(set(seen["labels"])) == [0, 1]
    bad, good = model.scores([" ".join([*clean[:39], "nastycreature"]), " ".join(clean[:40])])
    assert bad >= toxicity.THRESHOLD > good


def plain_buckets(word, buckets):
    """Own bucket and those of the n-grams, digit by digit."""
    odd, most = 0x9E3779B97F4A7C15, (1 << 64) - 1
    mixed = [(ord(c) + 1) * odd & most for c in f"<{word}>"]
    own = 0
    for k, x in enumerate(mixed):
        x = x * (2 * k + 1) & most
        own += x ^ (x >> 31)
    keys = [own * odd & most]
    for n in toxicity.GRAMS:
        for s in range(len(mixed) - n + 1):
            key = n
            for x in mixed[s : s + n]:
                key = (key ^ x) * odd & most
                key ^= key >> 29
            keys.append(key * odd & most)
    return [(k >> 40) % buckets for k in keys]


def plain_share(count):
    return [1.0] if count == 1 else [toxicity.OWN_SHARE] + [(1 - toxicity.OWN_SHARE) / (count - 1)] * (count - 1)


def test_scores_add_up_from_ngrams_one_by_one():
    rng, np = random.Random(5), pytest.importorskip("numpy")
    values = np.random.default_rng(5).normal(0, 3, 512).astype(np.float32)
    model = toxicity.Model(values, -0.7)
    texts = ["", None, "A a", "Nasty, nasty creature_word 12", "é" * 30, " ".join("".join(rng.choices("abé", k=5)) for _ in range(90))]
    for text, score in zip(texts, model.scores(texts), strict=True):
        words = sorted({w.lower() for w in re.findall(r"[^\W_]+", text or "")})
        total = 0.0
        for word in words:
            found = plain_buckets(word, 512)
            total += sum(float(values[b]) * s for b, s in zip(found, plain_share(len(found)), strict=True))
        margin = total / (len(words) + toxicity.PAD_WORDS) - 0.7
        assert score == pytest.approx(1 / (1 + math.exp(-margin)), rel=1e-5)


def test_training_steps_equal_dense_ones(monkeypatch):
    """The same steps with one dense matrix of words by n-grams."""
    np = pytest.importorskip("numpy")
    monkeypatch.setattr(toxicity, "BLOCK_GRAMS", 30)
    monkeypatch.setattr(toxicity, "BATCH_DOCS", 4)
    monkeypatch.setattr(toxicity, "LEAST_STEPS", 6)
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choices("abcd", k=rng.randrange(1, 9))) for _ in range(rng.randrange(0, 9))) for _ in range(10)]
    labels = [k % 2 for k in range(10)]
    buckets, width = 64, 3
    model = toxicity.train(texts, labels, epochs=2, width=width, buckets=buckets)

    docs = [toxicity.tokens(t) for t in texts]
    vocabulary = sorted({w for d in docs for w in d})
    every = {w: plain_buckets(w, buckets) for w in vocabulary}
    used = sorted({b for found in every.values() for b in found})
    dense = np.zeros((len(vocabulary), len(used)))
    for row, word in enumerate(vocabulary):
        for b, s in zip(every[word], plain_share(len(every[word])), strict=True):
            dense[row, used.index(b)] += s
    bags = np.array([[toxicity.GAIN * (w in d) / (len(d) + toxicity.PAD_WORDS) for w in vocabulary] for d in docs])
    draw = np.random.default_rng(toxicity.SEED)
    vectors = draw.standard_normal((len(used), width), dtype=np.float32).astype(float) * toxicity.START
    squares = np.full(len(used), toxicity.DAMPING)
    weights, prior = draw.normal(0, 0.5, (width, 2)), toxicity.log_odds(labels)
    bias, w_squares, b_squares = np.array([0.0, prior]), np.full((width, 2), 1e-2), np.full(2, 1e-2)
    for epoch in range(2):
        order = draw.permutation(10)
        for start in range(0, 10, 4):
            chosen = [k for k in order[start : start + 4] if docs[k]]
            x = bags[chosen] @ dense @ vectors
            z = x @ weights + bias
            p = np.exp(z) / np.exp(z).sum(1, keepdims=True) - np.eye(2)[[labels[k] for k in chosen]]
            d_vectors = dense.T @ bags[chosen].T @ p @ weights.T
            touched = (dense.T @ bags[chosen].T).any(1)
            dw, db = x.T @ p / len(chosen), p.mean(0)
            w_squares += dw**2
            b_squares += db**2
            squares[touched] += (d_vectors[touched] ** 2).mean(1)
            rate = toxicity.VECTOR_RATE * (1 - epoch / 2)
            vectors[touched] -= rate * d_vectors[touched] / np.sqrt(squares[touched])[:, None]
            weights = weights - toxicity.RATE * dw / np.sqrt(w_squares)
            bias = bias - toxicity.RATE * db / np.sqrt(b_squares)
    side = weights[:, 1] - weights[:, 0]
    expected = np.zeros(buckets)
    expected[used] = toxicity.GAIN * (vectors @ side)
    assert np.allclose(model.values, expected, rtol=1e-3, atol=1e-4)
    assert model.bias == pytest.approx(bias[1] - bias[0], rel=1e-4)


# 10. Quality rules


def plain_counts(text: str) -> tuple:
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    covered = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    lines = text.split("\n")
    dups = sum(1 for k, line in enumerate(lines) if line.strip(" \t\n\x0b\x0c\r") and line in lines[:k])
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dups, len(covered), failed


def test_counts_equal_a_plain_version(spark):
    rng = random.Random(1)
    texts = ["", "a b c a b c a b c", "x\nx\n\n\ny\r\nx", "  é  #*"]
    for _ in range(60):
        texts.append("".join(rng.choices(["ab", "c", " ", "\n", "#", " de ", "\t"], k=rng.randrange(0, 400))))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in quality.score(docs).collect():
        assert tuple(row[c] for c in (
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
        )) == plain_counts(texts[row["doc_id"]])


def test_bands_reject_repetition_and_noise(spark):
    rng = random.Random(2)
    syllables = ["ba", "do", "ri", "men", "ta", "lo", "shu", "ke"]
    prose = " ".join("".join(rng.choices(syllables, k=rng.randrange(1, 4))) for _ in range(3000))
    noise = " ".join(base64.b85encode(rng.randbytes(12)).decode() for _ in range(3000))
    # Words differ from line to line, so only compression sees the repetition.
    dull = " ".join(f"{k:04d}{'a' * 60}" for k in range(3000))
    docs = spark.createDataFrame([(1, prose), (2, noise), (3, dull)], "doc_id long, text string")
    assert {r["doc_id"]: r["kept"] for r in quality.score(docs).collect()} == {1: True, 2: False, 3: False}


LENGTHS = (600, 1200, 2500, 4000, 5000, 9000, 20_000)


def random_words(rng: random.Random, alphabet: str, size: int) -> str:
    words = []
    while sum(map(len, words)) + len(words) < size:
        words.append("".join(rng.choices(alphabet, k=rng.randrange(2, 9))))
    return " ".join(words)[:size]


def test_noise_and_repetition_at_each_length(spark):
    rng = random.Random(3)
    letters = "eeeeeetttttaaaaooooiiiinnnsssrrrhhlldducmfpgwybvkxjqz"
    lexicon = ["".join(rng.choices(letters, k=rng.randrange(2, 10))) for _ in range(900)]
    prose = lambda n: " ".join(rng.choices(lexicon, [1 / (k + 5) for k in range(900)], k=n))[:n]
    base64ish = string.ascii_letters + string.digits + "+/"
    cases = []
    for n in LENGTHS:
        cases.append((f"prose {n}", prose(n), True))
        cases.append((f"base64 {n}", random_words(rng, base64ish, n), False))
        cases.append((f"printable {n}", random_words(rng, string.digits + string.ascii_letters + string.punctuation, n), False))
        cases.append((f"items {n}", " ".join(f"item{k:05d}" for k in range(n))[:n], False))
        if n >= 1200:
            cases.append((f"alphanumeric {n}", random_words(rng, string.ascii_lowercase + string.digits, n), False))
    # Prose around noise or repetition, in the first chunk, a middle one and the rest.
    for name, bad in [("noise", random_words(rng, base64ish, 4096)), ("items", " ".join(f"item{k:05d}" for k in range(500))[:4096])]:
        for before, after in [(0, 4096), (4096, 4096), (8192, 0)]:
            cases.append((f"{name} behind {before}", prose(before) + bad + prose(after), False))
        cases.append((f"{name} in the rest", prose(4096) + bad[:2000], False))
        cases.append((f"{name} in a short rest", prose(8192 - 300) + " " + bad[:799], False))
    cases.append(("prose with a short rest", prose(8192 + 20), True))
    docs = spark.createDataFrame([(name, text) for name, text, _ in cases], "doc_id string, text string")
    found = {r["doc_id"]: r for r in quality.score(docs).collect()}
    assert not [name for name, r in found.items() if r["base_failed"]]
    assert {name: r["kept"] for name, r in found.items()} == {name: good for name, _, good in cases}
    assert found["prose 4000"]["n_chunks"] == 1 and found["prose 5000"]["n_chunks"] == 2


def test_quality_odd_rows(spark, odd_documents):
    clash = odd_documents.withColumnRenamed("score", "kept")
    assert quality.score(clash).count() == 8
    assert quality.accepted(clash).columns == clash.columns
    assert {r["doc_id"] for r in quality.accepted(clash).collect()} == {1} & {
        r["doc_id"] for r in quality.score(clash).filter("kept").collect()
    }
    assert quality.accepted(spark.createDataFrame([], EMPTY)).count() == 0
