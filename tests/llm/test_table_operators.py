"""Top-k, near-duplicates, token files, web archives and the pipeline against plain versions."""

import gzip
import hashlib
import io
import math
import random
import zipfile
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from corpusweave.llm import token_files, top_k, web_archives, weighted_minhash
from corpusweave.llm.batches import WORD
from corpusweave.session import scratch_path
from tokenizers import Tokenizer

import corpus_pipeline

import public_tokenizers

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
EMPTY = "doc_id long, text string, source string"
SMALL = "/root/testdata/sf0.001"


# 4. Top-k


def plain_top(vectors: dict, k: int) -> set:
    good = {
        i: [math.floor(256 * x) for x in v]
        for i, v in vectors
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    out = set()
    for q in good:
        if q % 50 == 0:
            scored = sorted(
                (-sum(a * b for a, b in zip(good[q], good[c], strict=False)), c) for c in good if c != q
            )
            out |= {(q, r + 1, c, -s) for r, (s, c) in enumerate(scored[:k])}
    return out


def test_top_k_equals_brute_force(spark):
    rng = random.Random(4)
    rows = [(k, [rng.gauss(0, 1) for _ in range(8)]) for k in range(400)]
    rows += [(400 + k, rows[k % 3][1]) for k in range(30)]
    rows += [(1000, None), (1050, [float("nan")] * 8), (1100, [None] * 8), (None, [1.0] * 8), (1150, [1.0, 2.0]), (1200, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    vectors = top_k.quantised(table)
    found = top_k.top_k(vectors, vectors.filter("vec_id % 50 = 0"), 5)
    assert {tuple(r) for r in found.collect()} == plain_top(rows, 5)
    assert top_k.top_k(vectors.limit(0), vectors.limit(0)).count() == 0


def test_packs_travel_once_a_row_of_shards(spark, monkeypatch):
    """More packs and shards than a cell holds: each pair meets once, and no pack is copied for every lane."""
    monkeypatch.setattr(top_k, "SHARD", 16)
    monkeypatch.setattr(top_k, "QUERY_SHARD", 2)
    monkeypatch.setattr(top_k, "PACKS", 2)
    monkeypatch.setattr(top_k, "SHARDS", 3)
    rng = random.Random(5)
    rows = [(k, [rng.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(6)]) for k in range(900)]
    vectors = top_k.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4))
    found = top_k.top_k(vectors, vectors.filter("vec_id % 50 = 0"), 5)
    assert "BroadcastNestedLoopJoin" not in found._jdf.queryExecution().toString()
    assert "Join" not in found._jdf.queryExecution().toString()
    assert {tuple(r) for r in found.collect()} == plain_top(rows, 5)


def test_large_components_stay_exact():
    ids = np.arange(3)
    big = np.array([[3_000_000_019, 7], [3_000_000_019, 8], [5, 1]])
    row, names, scores, _ = top_k.search(ids[:1], big[:1] // 10**9, ids, big, 2)
    assert list(zip(names.tolist(), scores.tolist(), strict=True)) == [(1, 3 * 3_000_000_019), (2, 15)]


def test_blocks_are_pruned():
    rng = np.random.default_rng(1)
    centres = rng.integers(-200, 200, (20, 16))
    vectors = np.repeat(centres, 200, axis=0) + rng.integers(-5, 5, (4000, 16))
    vectors = vectors[top_k.likeness_order(vectors)]
    _, _, _, scored = top_k.search(np.array([-1]), centres[:1], np.arange(4000), vectors, 5)
    assert scored < 30


# 5. Near-duplicates


def weighted_jaccard_classes(rows: list, threshold: float = 0.8) -> dict:
    texts = sorted({t for k, t in rows if k is not None and t is not None and WORD.search(t)})
    bags = []
    for text in texts:
        words = WORD.findall(text)
        bags.append(Counter(tuple(words[k : k + 5]) for k in range(max(len(words) - 4, 1))))
    df = Counter(s for bag in bags for s in bag)
    weight = {s: 1 + math.log(min(len(texts) / n, weighted_minhash.SATURATION)) for s, n in df.items()}
    up = list(range(len(texts)))

    def root(a):
        while up[a] != a:
            a = up[a]
        return a

    for i in range(len(texts)):
        for j in range(i):
            both = set(bags[i]) | set(bags[j])
            low = sum(min(bags[i][s], bags[j][s]) * weight[s] for s in both)
            high = sum(max(bags[i][s], bags[j][s]) * weight[s] for s in both)
            if low >= threshold * high - 1e-9:
                up[root(i)] = root(j)
    members = {}
    for k, text in rows:
        if text in texts and k is not None:
            members.setdefault(root(texts.index(text)), []).append(k)
    return {(k, text): min(members[root(texts.index(text))]) for k, text in rows if k is not None and text in texts}


def near_copies(rng: random.Random) -> list:
    words = [f"w{k}" for k in range(4000)]
    passage = " ".join(rng.choices(words, k=40))
    rows = []
    for _ in range(40):
        base = rng.choices(words, k=rng.randrange(60, 200))
        text = " ".join(base) + (f" {passage}" if rng.random() < 0.5 else "")
        for _ in range(rng.randrange(1, 5)):
            changed = text.split(" ")
            for _ in range(rng.choice([0, 0, 1, 1, 2, 6])):
                changed[rng.randrange(len(changed))] = rng.choice(words)
            rows.append((len(rows), " ".join(changed)))
    return rows


def test_classes_equal_brute_force(spark):
    rows = near_copies(random.Random(8))
    rows += [(len(rows) + k, t) for k, t in enumerate(["one two", "one two", "one", " one", ""])]
    rows += [(5, rows[5][1]), (5, rows[5][1]), (None, rows[3][1]), (9000, None), (9001, " \n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = weighted_jaccard_classes(rows)
    found = docs.join(weighted_minhash.assign(docs), "doc_id").collect()
    for row in found:
        assert row["class_id"] == want.get((row["doc_id"], row["text"]), row["doc_id"])
    assert weighted_minhash.assign(docs).count() == len(rows)
    kept = weighted_minhash.deduplicated(docs.withColumn("node", docs["doc_id"])).collect()
    alone = {None: 1, 9000: 1, 9001: 1, **{k: 1 for k, t in rows if t == ""}}
    assert Counter(r["doc_id"] for r in kept) == Counter({k: 1 for k in want.values()}) + Counter(alone)
    assert kept[0].asDict().keys() == {"doc_id", "text", "node"}


def test_large_groups_are_dealt_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(weighted_minhash, "BLOCK", 4)
    monkeypatch.setattr(weighted_minhash, "GROUP_BLOCK", 3)
    rng = random.Random(6)
    base = [f"x{k}" for k in range(120)]
    rows = []
    for k in range(40):
        changed = list(base)
        for _ in range(k % 5):
            changed[rng.randrange(120)] = f"y{k}"
        rows.append((k, " ".join(changed)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = weighted_jaccard_classes(rows)
    assert {r["doc_id"]: r["class_id"] for r in weighted_minhash.assign(docs).collect()} == {k: c for (k, _), c in want.items()}


def test_every_shingle_is_counted(spark, monkeypatch):
    monkeypatch.setattr(weighted_minhash, "SLICE_TEXT", 3000)
    monkeypatch.setattr(weighted_minhash, "BUCKET_TEXT", 5000)
    rows = near_copies(random.Random(4))
    docs = spark.createDataFrame([*rows, (len(rows), rows[0][1])], "doc_id long, text string")
    texts = weighted_minhash.in_slices(weighted_minhash._readable(docs, "doc_id", "text")).cache()
    shared = weighted_minhash.shared_shingles(weighted_minhash.requests(texts, 7))
    found = weighted_minhash.signatures(texts, shared, texts.count()).join(texts, "node").collect()
    bags = {}
    for _, text in rows:
        words = WORD.findall(text)
        bags[text] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
    df = Counter(s for bag in bags.values() for s in bag)
    assert {r["text"] for r in found} == set(bags)
    for row in found:
        assert sorted(row["frequencies"]) == sorted(df[s] for s in bags[row["text"]])


def test_answers_are_a_table_before_texts_move(spark, monkeypatch):
    # While texts move to their answers, the requests' shuffle must be gone, so the answers are read from files.
    monkeypatch.setattr(weighted_minhash, "SLICE_TEXT", 3000)
    monkeypatch.setattr(weighted_minhash, "BUCKET_TEXT", 5000)
    monkeypatch.setattr(weighted_minhash, "ANSWER_ROWS", 3)
    files = []
    signatures = weighted_minhash.signatures

    def noted(texts, shared, n_texts):
        files.extend(shared.inputFiles())
        return signatures(texts, shared, n_texts)

    monkeypatch.setattr(weighted_minhash, "signatures", noted)
    rows = near_copies(random.Random(4))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = weighted_jaccard_classes(rows)
    assert {r["doc_id"]: r["class_id"] for r in weighted_minhash.assign(docs).collect()} == {k: c for (k, _), c in want.items()}
    assert files and all("minhash-shared" in f for f in files)
    for file in files:
        meta = pq.read_metadata(file.removeprefix("file:").replace("///", "/"))
        assert all(meta.row_group(k).num_rows <= 3 for k in range(meta.num_row_groups))


def test_rare_shingles_outweigh_shared_ones(spark):
    # Of 400 texts 20 share 50 of their 55 shingles: 0.83 by term frequency, less than 0.8 by TF-IDF.
    passage = " ".join(f"p{k}" for k in range(54))
    rows = [(d, f"{passage} " + " ".join(f"u{d}x{k}" for k in range(5))) for d in range(20)]
    rows += [(d, " ".join(f"o{d}x{k}" for k in range(10))) for d in range(20, 400)]
    want = weighted_jaccard_classes(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["class_id"] for r in weighted_minhash.assign(docs).collect()}
    assert found == {k: c for (k, _), c in want.items()} == {k: k for k, _ in rows}


def test_samples_estimate_the_similarity():
    rng = random.Random(2)
    weights = weighted_minhash.Weights(100, {})
    sampler = weighted_minhash.Sampler(weights.rare)
    base = [f"a{k}" for k in range(1000)]
    other = [*base[:850], *[f"b{k}" for k in range(150)]]
    texts = [" ".join(base).encode(), " ".join(other).encode(), " ".join(rng.sample(base, 1000)).encode()]
    key, at, times = weighted_minhash.counted(texts)
    made = sampler(key, at, weights(key, times), 3)
    # Windows across the change belong to neither: 846 of 1146 are shared.
    assert abs((made[0] == made[1]).mean() - 846 / 1146) < 0.15
    assert (made[0] == made[2]).mean() < 0.05


def test_tables_of_weights_change_no_sample(monkeypatch):
    # Weights come from tables where many shingles have them, else from the formula; the samples are the same.
    rng = np.random.default_rng(7)
    key = rng.integers(1 << 63, size=20_000, dtype=np.uint64)
    at = np.sort(rng.integers(0, 50, 20_000))
    weight = rng.integers(1, 9, 20_000) * 1.7
    made = weighted_minhash.Sampler(1.7)(key, at, weight, 50)
    monkeypatch.setattr(weighted_minhash, "LEVELS", 1)
    assert np.array_equal(made, weighted_minhash.Sampler(1.7)(key, at, weight, 50))
    # The first sample of the first text, by its definition.
    sampler = weighted_minhash.Sampler(1.7)
    best = []
    for k, w in zip(key[at == 0].tolist(), weight[at == 0], strict=True):
        x = k * int(sampler.odd[0]) % 2**64
        x = (x ^ x >> 29) * int(weighted_minhash.MIX) % 2**64
        r, b = sampler.r[x >> 32 & 0xFFFF], sampler.b[x >> 32 & 0xFFFF]
        t = np.floor(np.float32(np.log(w)) / r + b)
        mark = x ^ int(t) * int(weighted_minhash.MIX) % 2**64
        value = sampler.log_c[x >> 48] - r * (t - b + np.float32(1)) + np.float32(200)
        best.append((value, (mark ^ mark >> 32) & 0xFFFFFFFF))
    assert min(best)[1] == made[0, 0]


def test_empty_documents_table(spark):
    docs = spark.createDataFrame([], EMPTY)
    assert weighted_minhash.assign(docs).count() == 0
    assert weighted_minhash.deduplicated(docs).columns == docs.columns


# 6. Token files


def test_unit_ids_equal_whole_texts():
    library = Tokenizer.from_file(TOKENIZER)
    library.encode_special_tokens = True
    encoder = token_files.UnitEncoder(TOKENIZER)
    rng = random.Random(9)
    texts = ["".join(rng.choices(["a", "bc", " ", "  ", "\n", "\t", "'ll", "1", "!", "\x1c", "\u3000", "\x85"], k=30)) for _ in range(3000)]
    texts += ["", " ", "it's  a\n\ntest <|endoftext|>", "é \U0001f600\x00 ½", "don'T we'll   x", "long text " * 20_000]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids.tolist() == [*library.encode(text, add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("sequence,batch", [(16, 2), (7, 3), (1024, 64)])
def test_files_give_back_the_stream(spark, odd_documents, sequence, batch):
    library = Tokenizer.from_file(TOKENIZER)
    folder = token_files.folder_uri(spark, scratch_path(spark, "test-tokens"))
    files = token_files.write(odd_documents, folder, TOKENIZER, sequence=sequence, batch_sequences=batch, parts=3)
    found = token_files.read_back(files, sequence=sequence, batch_sequences=batch).collect()
    rows = sorted(odd_documents.collect(), key=lambda r: -1 if r["doc_id"] is None else r["doc_id"])
    start, want = 0, []
    for row in rows:
        ids = [*library.encode(row["text"] or "", add_special_tokens=False).ids, 2]
        data = b"".join(i.to_bytes(4, "little") for i in ids)
        want.append((row["doc_id"], start, len(ids), zlib.crc32(data)))
        start += len(ids)
    assert sorted(map(tuple, found), key=lambda r: r[1]) == want
    assert token_files.write(odd_documents.limit(0), folder + "-none", TOKENIZER).count() == 0


def test_texts_with_special_tokens_have_the_ids_of_the_library(spark):
    library = Tokenizer.from_file(TOKENIZER)
    texts = ["plain words here", "a <|endoftext|> b", "<|endoftext|>", "a b<|endoftext|>c d", "ends in <|endoftext|> ", "< |endoftext|> x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    folder = token_files.folder_uri(spark, scratch_path(spark, "test-special"))
    found = token_files.read_back(token_files.write(docs, folder, TOKENIZER, parts=2)).collect()
    start, want = 0, []
    for k, text in enumerate(texts):
        ids = [*library.encode(text, add_special_tokens=False).ids, 2]
        want.append((k, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    assert sorted(map(tuple, found)) == want


def test_sequences_are_read_in_place(tmp_path):
    path = str(tmp_path / "a.arrow")
    with pa.OSFile(path, "wb") as sink:
        writer = token_files.StreamWriter(sink, 8, 4, False)
        for k in range(10):
            writer.add(np.arange(k * 10, k * 10 + 10))
        head, stride = writer.close()
    with pa.memory_map(path) as file:
        before = pa.total_allocated_bytes()
        reader = token_files.StreamFile(file, head, stride, 8, 4, False)
        ids, mask = reader.sequence_at(5)
        assert ids.tolist() == list(range(40, 48)) and mask.all()
        ids, mask = reader.sequence_at(12)
        assert ids.tolist() == [96, 97, 98, 99, 0, 0, 0, 0] and mask.tolist() == [True] * 4 + [False] * 4
        assert pa.total_allocated_bytes() - before < 4096
    with pa.memory_map(path) as file:
        assert pa.ipc.open_stream(file).read_all().num_rows == 13


# 7. Web archives


def pages(spark):
    big, rows = "<p>é</p>" * 200, []
    for k in range(20):
        rows.append((k, f"http://h{k % 3}.org/a b?q={k}", big if k % 2 else big + str(k % 4)))
    rows += [(20, None, None), (21, "u", ""), (22, "line\r\nbreak", "small"), (23, "u", "small"), (None, "u", big), (19, "u", big)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


@pytest.mark.parametrize("hot,package", [(10_000, 1 << 28), (1, 3000)])
def test_archives_read_back(spark, monkeypatch, hot, package):
    monkeypatch.setattr(web_archives, "HOT_COPIES", hot)
    table = pages(spark)
    folder = token_files.folder_uri(spark, scratch_path(spark, "test-warc"))
    files = web_archives.write(web_archives.planned(table), folder, package)
    out = web_archives.read_records(web_archives.ranges(files, bytes_of_index=100)).collect()
    largest = {}
    for row in table.collect():
        if row["page_id"] is not None:
            largest[row["html"]] = max(row["page_id"], largest.get(row["html"], -1))
    want = Counter()
    for row in table.collect():
        data = (row["html"] or "").encode()
        target = largest.get(row["html"]) if len(data) >= 1000 else None
        kind = "response" if target in (None, row["page_id"]) else "revisit"
        want[
            (
                str(row["page_id"]) if row["page_id"] is not None else "null", len(data), hashlib.sha1(data).hexdigest(),
                kind, str(target) if kind == "revisit" else None, len(data) if kind == "response" else 0,
            )
        ] += 1
    assert Counter(map(tuple, out)) == want
    assert web_archives.read_records(web_archives.ranges(files.limit(0))).count() == 0


def test_directories_with_and_without_zip64(monkeypatch):
    for force, limit, count in ((False, None, 3), (True, None, 3), (True, 2, 5), (False, None, 70_000)):
        data = io.BytesIO()
        with monkeypatch.context() as patch:
            if limit is not None:
                patch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", limit)
                patch.setattr(zipfile, "ZIP64_LIMIT", 10)
            with zipfile.ZipFile(data, "w", zipfile.ZIP_STORED) as package:
                for k in range(count):
                    with package.open(zipfile.ZipInfo(f"é{k}"), "w", force_zip64=force) as member:
                        member.write(b"x" * (k % 50) + str(k).encode())
                package.comment = b"PK\x05\x06 is only a comment"
        raw = data.getvalue()
        read = lambda at, n, raw=raw: raw[at : at + n]
        members = web_archives.directory(read, len(raw))
        assert [m.name for m in members] == [f"é{k}" for k in range(count)]
        for k, member in list(enumerate(members))[-3:]:
            start = web_archives.data_start(read, member)
            assert raw[start : start + member.size] == b"x" * (k % 50) + str(k).encode()
    with pytest.raises(ValueError, match="not a ZIP"):
        web_archives.directory(lambda at, n: b"nothing"[at : at + n], 7)


def test_records_are_gzip_members():
    record = web_archives.record_bytes(3, "http://a.org", b"body", "d", "response", None, 4)
    fields, http, payload = web_archives.parse_record(gzip.decompress(gzip.compress(record)))
    assert (fields["WARC-Type"], http["Content-Length"], payload) == ("response", "4", b"body")


# Pipeline


def test_stages_hand_on_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names, seen = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, seen, SMALL)
        if name != "sentencepiece":
            assert out.columns == names
        if name == "near_dedup":
            kept = {r["doc_id"] for r in out.collect()}
            want = weighted_jaccard_classes([(r["doc_id"], r["text"]) for r in seen.collect()])
            assert kept == set(want.values())
        seen = out.cache()
    total = seen.count()
    assert total == corpus_pipeline.run(spark, SMALL).count() > 0
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).count() == 0
