"""Files read by byte ranges against the forms for texts in a row."""

import random

import pytest

from corpusweave.sources import byte_ranges, texts

TOKEN = "<|endoftext|>"


@pytest.fixture
def files(tmp_path):
    """Texts that are valid UTF-8, of one file each."""
    rng = random.Random(2)
    parts = ["a", "é", "\U0001f600", " word", "\n", "\r\n", TOKEN, "<|end", "line of text\n", "\n\n"]
    made = {
        "mixed.txt": "".join(rng.choices(parts, k=60)),
        "one_line.txt": "no line end at all " * 9,
        "empty.txt": "",
        "ends.txt": "\n" * 12,
        "token_first.txt": TOKEN + "x" + TOKEN,
    }
    folder = tmp_path / "texts"
    folder.mkdir()
    for name, text in made.items():
        (folder / name).write_bytes(text.encode())
    (folder / "_hidden").write_text("not read")
    return str(folder), made


def by_file(rows, *columns):
    out = {}
    for r in rows:
        out.setdefault(r["path"].rsplit("/", 1)[-1], []).append(tuple(r[c] for c in columns))
    return {k: sorted(v) for k, v in out.items()}


def column_form(spark, made, frame, *columns):
    docs = spark.createDataFrame(list(made.items()), "path string, text string")
    return by_file(frame(docs).collect(), *columns)


RANGES = [3, 40, 1 << 20]


@pytest.mark.parametrize("range_bytes", RANGES)
def test_lines(spark, files, range_bytes):
    path, made = files
    found = by_file(byte_ranges.read_ranges(spark, path, "lines", range_bytes=range_bytes).collect(), "at", "text")
    listed = column_form(spark, made, lambda d: texts.first_lines(d, 10**6, key="path"), "line_no", "line")
    assert {k: [t for _, t in v] for k, v in found.items()} == {k: [t for _, t in v] for k, v in listed.items()}


@pytest.mark.parametrize("range_bytes", RANGES)
def test_records(spark, files, range_bytes):
    path, made = files
    found = by_file(byte_ranges.read_ranges(spark, path, "records", range_bytes=range_bytes, token=TOKEN).collect(), "at", "text")
    listed = column_form(spark, made, lambda d: texts.split_records(d, TOKEN, key="path"), "record_no", "record")
    assert {k: [t for _, t in v] for k, v in found.items()} == {k: [t for _, t in v] for k, v in listed.items()}


@pytest.mark.parametrize("size", [2, 5, 64, 10_000])
@pytest.mark.parametrize("range_bytes", [40])
def test_chunks(spark, files, size, range_bytes):
    path, made = files
    found = by_file(byte_ranges.read_ranges(spark, path, "chunks", size=size, range_bytes=range_bytes).collect(), "at", "text")
    listed = column_form(spark, made, lambda d: texts.byte_chunks(d, size, key="path"), "chunk_no", "chunk")
    assert found == listed


@pytest.mark.parametrize("chunks", [1, 2, 4, 9])
def test_parts(spark, files, chunks):
    path, made = files
    found = by_file(byte_ranges.read_ranges(spark, path, "parts", chunks=chunks, token=TOKEN).collect(), "at", "text")
    listed = column_form(spark, made, lambda d: texts.split_even(d, chunks, TOKEN, key="path"), "part_no", "part")
    listed = {k: [t for _, t in v] for k, v in listed.items()}
    found = {k: [t for _, t in v] for k, v in found.items()}
    # A text of fewer bytes than parts has no even borders; it is one part per byte at most either way.
    assert {k: "".join(v) for k, v in found.items()} == {k: t for k, t in made.items() if t}
    assert {k: v for k, v in found.items() if len(made[k]) >= 9} == {k: v for k, v in listed.items() if len(made[k]) >= 9}


@pytest.mark.parametrize("batch_size", [7, 50])
@pytest.mark.parametrize("range_bytes", RANGES)
def test_line_batches(spark, files, batch_size, range_bytes):
    path, made = files
    found = by_file(byte_ranges.line_batches(spark, path, batch_size, range_bytes).collect(), "batch_no", "batch")
    listed = column_form(spark, made, lambda d: texts.line_batches(d, batch_size, key="path"), "batch_no", "batch")
    assert found == listed


def test_invalid_bytes_are_dropped_wherever_a_range_ends(spark, tmp_path):
    data = b"one\xff\ntw\xc3o\n\xe2\x82three\xf0\x9f\x98"
    path = tmp_path / "bad.txt"
    path.write_bytes(data)
    for range_bytes in (1, 2, 5, 100):
        lines = byte_ranges.read_ranges(spark, str(path), "lines", range_bytes=range_bytes).orderBy("at").collect()
        assert "".join(r["text"] for r in lines) == data.decode("utf-8", "ignore")
        chunks = byte_ranges.read_ranges(spark, f"file:{path}", "chunks", size=range_bytes).orderBy("at").collect()
        assert "".join(r["text"] for r in chunks) == data.decode("utf-8", "ignore")


def test_a_file_is_read_by_several_tasks(spark, files):
    path, _ = files
    assert byte_ranges.read_ranges(spark, f"{path}/one_line.txt", "lines", range_bytes=50).rdd.getNumPartitions() == 4
    with pytest.raises(Exception, match="no text files"):
        byte_ranges.read_ranges(spark, path + "/missing").collect()
    with pytest.raises(Exception, match="unknown unit"):
        byte_ranges.read_ranges(spark, path, "words").collect()


def test_whole_texts(spark, files):
    path, made = files
    rows = texts.read_whole_texts(spark, path).collect()
    assert {r["path"].rsplit("/", 1)[-1]: r["text"] for r in rows} == {k: t for k, t in made.items() if t}


def test_many_small_files_share_the_tasks(spark, tmp_path):
    for k in range(60):
        (tmp_path / f"{k:02}.txt").write_text(f"line {k}\n" * 5)
    rows = byte_ranges.read_ranges(spark, str(tmp_path), "lines", range_bytes=16, tasks=5)
    assert 1 < rows.rdd.getNumPartitions() <= 5
    found = by_file(rows.collect(), "text")
    assert found == {f"{k:02}.txt": [(f"line {k}\n",)] * 5 for k in range(60)}
    batches = byte_ranges.line_batches(spark, str(tmp_path), 15, 16)
    assert batches.rdd.getNumPartitions() < 60
    assert sorted("".join(t for _, t in v) for v in by_file(batches.collect(), "batch_no", "batch").values()) == sorted(
        f"line {k}\n" * 5 for k in range(60)
    )
