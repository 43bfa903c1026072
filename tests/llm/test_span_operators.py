"""Substring removal, fill-in-the-middle and collocations against plain versions."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from corpusweave.llm import collocations, fill_middle, quotient_filter, spans, substring_dedup
from pyspark.sql import functions as F

EMPTY = "doc_id long, text string, lang string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def hashed(text):
    return hashlib.sha256(text.encode()).hexdigest()


# 11. Substring dedup


def plain_removal(rows, window):
    """{(key, text): (words, removed, kept text)} by a dictionary of all windows."""
    docs = sorted({(k is None, k or 0, _copy(t), k, t or "") for k, t in rows}, key=lambda d: d[:3])
    seen, out = set(), {}
    for _, _, _, key, text in docs:
        words = WORD.findall(text)
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            found = tuple(words[s : s + window])
            if found in seen:
                gone[s : s + window] = [True] * window
            seen.add(found)
        out[key, text] = (len(words), sum(gone), " ".join(w for w, g in zip(words, gone, strict=True) if not g))
    return out


_COPIES = {}


def _copy(text):
    return _COPIES.get(text or "", 0)


def check_removal(spark, rows, **options):
    docs = spark.createDataFrame([(k, t, "kept") for k, t in rows], "doc_id long, text string, n_words string")
    _COPIES.update({r[0]: r[1] for r in docs.select(F.coalesce("text", F.lit("")), F.xxhash64(F.coalesce("text", F.lit("")))).collect()})
    out = substring_dedup.deduplicate(docs.repartition(3), **options).collect()
    expected = plain_removal(rows, options["window"])
    assert sorted(((r["doc_id"], r["text"]) for r in out), key=repr) == sorted(rows, key=repr)
    for r in out:
        assert (r["n_words"], r["n_removed"], r["kept_text"]) == expected[r["doc_id"], r["text"] or ""]


def random_rows(rng, n):
    passage = [rng.choice("abcdefgh") for _ in range(12)]
    rows = []
    for k in range(n):
        words = [rng.choice(["a", "b", "c", "é", "\U0001f600", "word"]) for _ in range(rng.randrange(0, 25))]
        if k % 3 == 0:
            words[len(words) // 2 : len(words) // 2] = passage[rng.randrange(0, 3) :]
        rows.append((k, rng.choice([" ", "\n", " \t "]).join(words)))
    return rows


@pytest.mark.parametrize("frequent", [1, 3, 4096])
@pytest.mark.parametrize(("window", "minimiser"), [(4, 2), (5, 1), (3, 3)])
def test_repeated_windows_go_as_in_a_plain_scan(spark, window, minimiser, frequent):
    rows = random_rows(random.Random(window), 60)
    check_removal(spark, rows, window=window, minimiser=minimiser, frequent=frequent)


def test_removal_from_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \t "), (None, "a b c d e f"), (None, "x a b c d e"), (4, "a b c d e f"),
        (4, "a b c d e f"), (4, "z a b c d e f"), (5, "w " * 40_000), (6, "v" * 200_000 + " a b c d"), (7, "a\x00 b c d e"),
    ]
    check_removal(spark, rows, window=4, minimiser=2, frequent=2)
    check_removal(spark, rows, window=20, minimiser=5, frequent=4096)
    empty = substring_dedup.deduplicate(spark.createDataFrame([], EMPTY))
    assert empty.columns == ["doc_id", "text", "lang", "n_words", "n_removed", "kept_text"]
    assert empty.count() == 0


def test_windows_of_one_hash_are_compared_by_words():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 3, 400)
    at = np.arange(390)
    for bits in (1, 4, 64):
        order, first = substring_dedup.equal_windows(ids, at, 5, at, bits)
        seen, expected = set(), []
        for k in at:
            found = tuple(ids[k : k + 5])
            if found not in seen:
                expected.append(int(k))
            seen.add(found)
        assert sorted(order.tolist()) == at.tolist()
        assert sorted(order[first].tolist()) == expected


def test_super_kmers_hold_every_window_once():
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abc") for _ in range(n)) for n in (0, 5, 19, 20, 21, 900)] + ["same " * 2000]
    words = substring_dedup.Words(pa.array(texts))
    covered = [
        k for heads, n, _, _, _ in substring_dedup.runs_of_windows(words, 20, 5) for k in spans.ranges(heads, n).tolist()
    ]
    expected = [int(words.first[d]) + s for d, n in enumerate(words.counts) for s in range(n - 19)]
    assert covered == expected


def test_sliding_least():
    values = np.random.default_rng(2).integers(0, 99, 50)
    for width in (1, 2, 3, 7, 16, 50):
        assert substring_dedup.sliding_least(values, width).tolist() == [
            values[k : k + width].min() for k in range(51 - width)
        ]


# 12. Fill-in-the-middle


def plain_form(key, text, rate=100, spm=50):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(lines) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(lines), "plain", None, None, text
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h[3] % 100 < spm:
        return len(lines), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(lines), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("rate", [100, 40, 0])
def test_forms_equal_plain_cuts_and_read_back(spark, odd_documents, rate):
    rng = random.Random(9)
    rows = [tuple(r) for r in odd_documents.collect()]
    rows += [
        (100 + k, "".join(rng.choice(["\n", "é", "a b", "\U0001f600", "\r", "<P", "S>"]) for _ in range(rng.randrange(0, 40))), "s", "x")
        for k in range(200)
    ]
    rows += [(900, "a<P>b\nc", "s", "x"), (901, "line\n" * 300_000, "s", "x"), (902, "\n", "s", "x"), (903, "<", "s", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, output string, N string")
    out = fill_middle.restore(fill_middle.transform(docs, rate=rate)).collect()
    assert len(out) == len(rows)
    for r in out:
        found = (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"])
        assert found == plain_form(r["doc_id"], r["text"], rate)
        assert r["restored"] == (r["text"] or "")
    assert {r["form"] for r in out} == ({"plain"} if rate == 0 else {"plain", "psm", "spm"})


def test_forms_of_an_empty_table_and_other_marks(spark):
    formed = fill_middle.transform(spark.createDataFrame([], EMPTY))
    assert fill_middle.restore(formed).count() == 0
    marks = fill_middle.Marks("<|p|>", "<|suffix|>", "<|m|>")
    docs = spark.createDataFrame([(1, "one\ntwo <P>\nthree", None)], EMPTY)
    row = fill_middle.restore(fill_middle.transform(docs, marks=marks, spm_share=100), marks=marks).first()
    assert row["output"].startswith("<|suffix|>") and row["restored"] == row["text"] and row["form"] == "spm"
    for wrong in (("a", "a", "b"), ("", "b", "c"), ("ab", "bc", "d"), ("aba", "x", "y"), ("abc", "b", "z")):
        with pytest.raises(ValueError, match="overlap"):
            fill_middle.Marks(*wrong)


def test_shifts_carry_over_blocks(monkeypatch):
    texts = ["one\ntwo\nthree", "", "x\ny\n\nz" * 7, "\n\n"]
    data, borders = spans.text_bytes(pa.array(texts))
    draws = np.array([[1, 2], [3, 4], [9, 4], [1, 1]])
    outs = []
    for block in (1, 3, 1 << 20):
        monkeypatch.setattr(fill_middle, "BLOCK", block)
        _, cuts = fill_middle.line_cuts(data, borders, draws)
        plan = fill_middle.layout(borders, cuts, np.array([1, 0, 2, 1]), fill_middle.Marks())
        out = fill_middle.scatter(data, plan)
        assert (fill_middle.gather(out, plan, len(data)) == data).all()
        outs.append((out.tobytes(), fill_middle.code_points(data, plan.source[:, 1], plan.size[:, 1]).tolist()))
    assert outs[0] == outs[1] == outs[2]


def test_an_output_without_its_marks_is_an_error(spark):
    broken = spark.createDataFrame([("no marks", "psm")], "output string, form string")
    with pytest.raises(Exception, match="lacks its marks"):
        fill_middle.restore(broken).collect()


# 13. Collocations


@pytest.mark.parametrize("words", [2, 3, 4])
@pytest.mark.parametrize("bits", [1, 5, 16, 17, 32])
def test_filters_give_back_keys_and_counts(bits, words):
    keys, rng = quotient_filter.Keys(words, bits), np.random.default_rng(bits)
    columns = [rng.integers(0, 1 << bits, 3000, dtype=np.uint64) for _ in range(words)]
    columns = [np.append(c, c[:900]) for c in columns]
    left, right = keys.permute(columns)
    assert all((a == b).all() for a, b in zip(keys.restore(left, right), columns, strict=True))
    expected = Counter(zip(*[c.tolist() for c in columns], strict=True))
    shard_bits = min(3, bits)
    halves = [keys.counted(left[::2], right[::2]), keys.counted(left[1::2], right[1::2])]
    by_shard = {}
    for half in halves:
        for shard, made in quotient_filter.shards(keys, shard_bits, *half):
            by_shard.setdefault(shard, []).append(made)
    found = Counter()
    for shard, filters in by_shard.items():
        a, b, counts = quotient_filter.merged(keys, shard, filters)
        for *gram, n in zip(*[c.tolist() for c in keys.restore(a, b)], counts.tolist(), strict=True):
            found[tuple(gram)] += n
    assert found == expected


def plain_phrases(rows, least, share, first):
    totals, counts = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, 5):
                for s in range(len(words) - n + 1):
                    counts[lang, tuple(words[s : s + n])] += 1
    often = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    longest = Counter()
    for (lang, words), a in often.items():
        for n in range(2, len(words)):
            for s in range(len(words) - n + 1):
                key = lang, words[s : s + n]
                longest[key] = max(longest[key], a)
    found = {}
    for (lang, words), a in often.items():
        if 100 * longest[lang, words] >= share * a and longest[lang, words]:
            continue
        cuts = [
            (2_000_000 * a // (counts[lang, words[:k]] + counts[lang, words[k:]]), k) for k in range(1, len(words))
        ]
        score, k = min(cuts)
        row = (" ".join(words), a, counts[lang, words[:k]], counts[lang, words[k:]], totals[lang], score)
        found.setdefault(lang, []).append(row)
    out = []
    for lang, listed in found.items():
        listed.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out += [(lang, rank, *row) for rank, row in enumerate(listed[:first], 1)]
    return sorted(out)


@pytest.mark.parametrize("broadcast_bytes", [0, 8 << 20])
@pytest.mark.parametrize(("least", "first", "shard_keys"), [(2, 1000, 50), (3, 7, 1 << 21), (30, 5, 300)])
def test_collocations_equal_plain_counts(spark, least, first, shard_keys, broadcast_bytes):
    rng = random.Random(least)
    vocabulary = ["new", "York", "CITY", "é", "Éa", "of", "the", "\U0001f600", "a\x00b", "x"]
    rows = [
        (rng.choice(["en", "de", None, "und", "e\nn"]), "".join(rng.choice(vocabulary) + rng.choice([" ", " ", "\t", ", ", "\n", "."]) for _ in range(rng.randrange(0, 60))))
        for _ in range(150)
    ]
    rows += [("en", None), (None, ""), ("fr", " \t.,"), ("en", "new york city " * 3000), ("en", rows[0][1])] + rows[:20]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    out = collocations.mine(docs, least=least, first=first, shard_keys=shard_keys, broadcast_bytes=broadcast_bytes)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in out.collect()) == plain_phrases(rows, least, 80, first)


def test_blocks_of_a_file_are_read_a_few_at_a_time(spark):
    """A reader decodes a row group at once, so a group holds few of the rows of megabytes."""
    docs = spark.createDataFrame([("en", "a b " * 1_500_000)], "lang string, text string")
    made = collocations.blocks(docs)
    files = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in made.inputFiles()]
    sizes = [f.row_group(k).num_rows for f in files for k in range(f.num_row_groups)]
    assert sum(sizes) == 6 and max(sizes) <= collocations.FILE_BLOCKS


def test_words_of_a_block_are_no_list_in_the_jvm(spark):
    docs = spark.createDataFrame([("en", "a b c"), ("de", "b. b d")], "lang string, text string").repartition(2)
    made = collocations.blocks(docs)
    listed = spark.createDataFrame([("en", "b", 1), ("de", "b", 2), ("de", "d", 3)], "lang string, word string, id long")
    joined = collocations.joined_numbers(made, listed)
    assert "collect_list" not in joined._jdf.queryExecution().toString()
    found = collocations.joined_blocks(pa.Table.from_pandas(joined.coalesce(1).toPandas()).to_batches(max_chunksize=2))
    # A null id makes a column of floats in pandas, so numbers are compared as such.
    assert sorted(sorted(int(n) for n in numbers) for _, _, _, numbers in found) == [[1], [2, 3]]


def test_collocations_of_no_rows_and_no_words(spark):
    for rows in ([], [(1, None, None), (2, ".,", "en")], [(1, "once only", "en")]):
        assert collocations.mine(spark.createDataFrame(rows, EMPTY)).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    big = 4_000_000_000_000_000_003
    phrases = spark.createDataFrame([(1, 2, 0, 0, big)], "w1 long, w2 long, w3 long, w4 long, f long")
    vocabulary = spark.createDataFrame([(1, big + 10**12, "a"), (2, big + 7, "b")], "id long, f long, word string")
    row = collocations.weakest_cuts(phrases, vocabulary).first()
    assert (row["a"], row["l"], row["r"]) == (big, big + 10**12, big + 7)
    assert row["score"] == 2_000_000 * big // (2 * big + 10**12 + 7)


def test_phrases_run_over_block_borders(monkeypatch):
    part = pa.record_batch({"lang": ["en", "en", "de"], "text": ["a b c d e f g. h i", "", "j k l m n"]})
    whole = None
    for limit in (1, 2, 3, 100):
        monkeypatch.setattr(collocations, "BLOCK_WORDS", limit)
        found, words = Counter(), Counter()
        for listed, stream, own in collocations._blocks(part):
            names = [w["word"] for w in listed.to_pylist()]
            words.update({w["word"]: w["n"] for w in listed.to_pylist()})
            for columns in collocations._phrases(stream.astype(np.uint64), own):
                found.update(tuple(names[k - 1] for k in gram if k) for gram in zip(*[c.tolist() for c in columns], strict=True))
        whole = whole or (found, words)
        assert (found, words) == whole
    assert found["a", "b", "c", "d"] == 1 and ("g", "h") not in found and ("i", "j") not in found
    assert sum(words.values()) == 14
