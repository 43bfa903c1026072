"""Toxicity: bags of subword embeddings averaged into a linear softmax.

A word is the mean of the vectors of its character n-grams and its own one, a document is the mean of
its distinct words, and a softmax over two classes reads the document. Vectors and softmax are learned
together in numpy on a bounded sample of labelled rows. Everything behind the vectors is linear, so
scoring needs one number for each n-gram bucket: the difference of the two class scores.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusweave.llm.batches import fresh, map_slices, write_and_read
from corpusweave.llm.spans import ranges

TOKEN = re.compile(r"[^\W_]+")
BUCKETS = 1 << 20
GRAMS = (4, 5, 6)
# Share of a word's own vector in the word; its n-grams have the rest.
OWN_SHARE = 0.2
WIDTH = 8
# The most labelled rows of class 1 and of class 0, and of characters in all, that training sees.
CLASS_ROWS = (1500, 4500)
SAMPLE_CHARS = 16 << 20
EPOCHS = 3
# A small sample is gone through more often, up to this many steps.
LEAST_STEPS = 200
BATCH_DOCS = 64
RATE = 0.05
VECTOR_RATE = 0.3
START = 0.001
# Sum of squared gradients that every vector starts with: rare n-grams then move little.
DAMPING = 0.1
# The mean over words is scaled so that one word among hundreds can move the softmax.
GAIN = 100.0
# Words with a zero vector that join every document, so that a short text isn't all noise.
PAD_WORDS = 50
# One of so many sample rows sets the slope, if there are enough of them.
HELD_BACK = 5
LEAST_HELD_BACK = 40
THRESHOLD = 0.3
# n-grams of a batch that are held at a time, and words of one step that lists them.
BLOCK_GRAMS = 1 << 17
STEP_WORDS = 1 << 14
# Distinct words whose score a task keeps.
CACHE_WORDS = 200_000
SEED = 20


def tokens(text: str | None) -> list[str]:
    """Distinct words in the order of the text, so that a word repeated at length weighs as one."""
    return list(dict.fromkeys(TOKEN.findall(text.lower()))) if text else []


def subwords(words: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(word index, bucket) of the n-grams of every word between borders, and of the word itself."""
    joined = "".join([f"<{w}>" for w in words])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), lengths)
    at, bucket = [np.arange(len(words))], []
    odd = np.uint64(0x9E3779B97F4A7C15)
    mixed = (points + np.uint64(1)) * odd
    place = np.arange(len(points), dtype=np.uint64) - np.repeat(np.cumsum(lengths) - lengths, lengths).astype(np.uint64)
    whole = mixed * (place * np.uint64(2) + np.uint64(1))
    whole ^= whole >> np.uint64(31)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(whole, dtype=np.uint64)])
    ends = np.cumsum(lengths)
    bucket.append((sums[ends] - sums[ends - lengths]) * odd)
    for n in GRAMS:
        count = len(points) - n + 1
        if count <= 0:
            continue
        key = np.full(count, np.uint64(n))
        for k in range(n):
            key = (key ^ mixed[k : k + count]) * odd
            key ^= key >> np.uint64(29)
        inside = np.flatnonzero(owner[:count] == owner[n - 1 :])
        at.append(owner[inside])
        bucket.append(key[inside] * odd)
    keys = np.concatenate(bucket)
    return np.concatenate(at), ((keys >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def shares(at: np.ndarray, n_words: int) -> np.ndarray:
    """Weight of every entry of ``subwords`` in its word; the first ``n_words`` are the words' own."""
    grams = np.bincount(at, minlength=n_words) - 1
    share = (1 - OWN_SHARE) / np.maximum(grams, 1)[at]
    share[:n_words] = np.where(grams > 0, OWN_SHARE, 1.0)
    return share


@dataclass(frozen=True)
class Model:
    """``values``: difference of the class scores for each bucket, gain included."""

    values: np.ndarray
    bias: float

    def word_values(self, words: list[str]) -> np.ndarray:
        at, bucket = subwords(words, len(self.values))
        share = shares(at, len(words))
        return np.bincount(at, weights=self.values[bucket] * share, minlength=len(words))

    def scores(self, texts: list[str | None], cache: dict[str, float] | None = None) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margins(texts, cache), -60, 60)))

    def margins(self, texts: list[str | None], cache: dict[str, float] | None = None) -> np.ndarray:
        cache = {} if cache is None else cache
        docs = [tokens(t) for t in texts]
        new = list({w for d in docs for w in d if w not in cache})
        if len(cache) + len(new) > CACHE_WORDS:
            cache.clear()
            new = list({w for d in docs for w in d})
        if new:
            cache.update(zip(new, self.word_values(new).tolist(), strict=True))
        means = np.array([sum(map(cache.__getitem__, d)) / (len(d) + PAD_WORDS) for d in docs])
        return means + self.bias


@dataclass(frozen=True)
class Sample:
    """Rows as numbers of their distinct words, and the n-grams of every word one after the other."""

    docs: list[np.ndarray]
    n_grams: np.ndarray
    buckets: np.ndarray
    shares: np.ndarray

    @staticmethod
    def of_texts(texts: list[str | None], buckets: int) -> Sample:
        vocabulary: dict[str, int] = {}
        docs = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in tokens(t)], np.int32) for t in texts]
        return Sample(docs, *grams_of(list(vocabulary), buckets))

    def word_values(self, values: np.ndarray) -> np.ndarray:
        """Value of every word; a word has one n-gram at least, itself."""
        ends = np.cumsum(self.n_grams)
        out = np.zeros(len(ends))
        for lo, hi in gram_blocks(ends):
            cut = slice(ends[lo] - self.n_grams[lo], ends[hi - 1])
            parts = values[self.buckets[cut]] * self.shares[cut]
            out[lo:hi] = np.add.reduceat(parts, ends[lo:hi] - self.n_grams[lo:hi] - cut.start)
        return out

    def margins(self, model: Model, rows: list[int]) -> np.ndarray:
        words = self.word_values(model.values)
        return np.array([words[self.docs[k]].sum() / (len(self.docs[k]) + PAD_WORDS) for k in rows]) + model.bias


def grams_of(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n-grams of each word, their buckets, their shares), word by word."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.float32)
    at, bucket = subwords(words, buckets)
    by_word = np.argsort(at, kind="stable")
    share = shares(at, len(words))[by_word].astype(np.float32)
    return np.bincount(at, minlength=len(words)), bucket[by_word].astype(np.int32), share


def gram_blocks(ends: np.ndarray):
    """Ranges of words with about BLOCK_GRAMS n-grams each, from the running numbers of n-grams."""
    lo = 0
    while lo < len(ends):
        done = ends[lo - 1] if lo else 0
        hi = max(int(np.searchsorted(ends, done + BLOCK_GRAMS, side="right")), lo + 1)
        yield lo, hi
        lo = hi


def train(
    texts: list[str | None], labels: list[int], *, share: float | None = None, epochs: int = EPOCHS, width: int = WIDTH, buckets: int = BUCKETS
) -> Model:
    """``train_sample`` for texts at hand."""
    return train_sample(Sample.of_texts(texts, buckets), labels, share=share, epochs=epochs, width=width, buckets=buckets)


def train_sample(
    sample: Sample, labels: list[int], *, share: float | None = None, epochs: int = EPOCHS, width: int = WIDTH, buckets: int = BUCKETS
) -> Model:
    """Fit vectors and softmax on four fifths of the rows, then the slope of their margin on the rest.

    ``share`` is that of class 1 outside of the sample. With one class only there is nothing to learn:
    the model then gives the share of that class.
    """
    prior = log_odds(labels)
    outside = 0.0 if share is None else float(np.log(share / (1 - share))) - prior
    every = list(range(len(labels)))
    rest = [k for k in every if k % HELD_BACK == HELD_BACK - 1]
    if len(set(labels)) == 2 and len(rest) >= LEAST_HELD_BACK:
        kept = [k for k in every if k % HELD_BACK != HELD_BACK - 1]
        model = _learn(sample, kept, labels, epochs, width, buckets)
        slope, offset = _slope(sample.margins(model, rest), np.array([labels[k] for k in rest]))
    else:
        model, slope, offset = _learn(sample, every, labels, epochs, width, buckets), 1.0, 0.0
    return Model(model.values * np.float32(slope), model.bias * slope + offset + outside)


def log_odds(labels: list[int]) -> float:
    share = (sum(labels) + 1) / (len(labels) + 2)
    return float(np.log(share / (1 - share)))


def _slope(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic slope and offset of the margins by Newton steps, with a light pull towards slope 1."""
    x, at = np.stack([margins, np.ones(len(margins))], 1), np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        pull = np.array([0.1, 0.0])
        curve = x.T @ (x * (p * (1 - p))[:, None]) + np.diag(pull + 1e-3)
        at = at - np.linalg.solve(curve, x.T @ (p - y) + pull * (at - [1.0, 0.0]))
    return (float(at[0]), float(at[1])) if np.isfinite(at).all() and at[0] > 0 else (1.0, 0.0)


def _learn(sample: Sample, rows: list[int], labels: list[int], epochs: int, width: int, buckets: int) -> Model:
    """Vectors and softmax together, by mini-batches with adaptive steps.

    Only n-grams of the sample have vectors, and those of a batch are gone through in blocks, so memory
    depends on the sample's words and not on the buckets or on how long the texts of a batch are.
    """
    docs = [sample.docs[k] for k in rows]
    y = np.asarray([labels[k] for k in rows])
    prior = log_odds(y.tolist())
    values = np.zeros(buckets, np.float32)
    if len(set(y.tolist())) < 2 or not len(sample.n_grams):
        return Model(values, prior)
    rng = np.random.default_rng(SEED)
    used, place = np.unique(sample.buckets, return_inverse=True)
    place = place.astype(np.int32)
    first = np.concatenate([[0], np.cumsum(sample.n_grams)])

    vectors = rng.standard_normal((len(used), width), dtype=np.float32) * np.float32(START)
    squares = np.full((len(used), 1), DAMPING, np.float32)
    weights = rng.normal(0, 0.5, (width, 2))
    bias = np.array([0.0, prior])
    w_squares, b_squares = np.full_like(weights, 1e-2), np.full(2, 1e-2)

    epochs = max(epochs, LEAST_STEPS // -(-len(docs) // BATCH_DOCS))
    for epoch in range(epochs):
        rate = VECTOR_RATE * (1 - epoch / epochs)
        order = rng.permutation(len(docs))
        for start in range(0, len(order), BATCH_DOCS):
            chosen = [k for k in order[start : start + BATCH_DOCS] if len(docs[k])]
            if not chosen:
                continue
            lengths = np.array([len(docs[k]) for k in chosen])
            owner = np.repeat(np.arange(len(chosen)), lengths)
            amounts = np.repeat(GAIN / (lengths + PAD_WORDS), lengths)
            words, inverse = np.unique(np.concatenate([docs[k] for k in chosen]), return_inverse=True)
            sizes = sample.n_grams[words]
            ends = np.cumsum(sizes)
            blocks = [
                (lo, hi, ranges(first[words[lo:hi]], sizes[lo:hi])) for lo, hi in gram_blocks(ends)
            ]
            word_vectors = np.empty((len(words), width), np.float32)
            for lo, hi, grams in blocks:
                parts = vectors[place[grams]] * sample.shares[grams][:, None]
                word_vectors[lo:hi] = np.add.reduceat(parts, ends[lo:hi] - sizes[lo:hi] - (ends[lo] - sizes[lo]))
            x = np.stack(
                [np.bincount(owner, weights=amounts * word_vectors[inverse, k], minlength=len(chosen)) for k in range(width)], 1
            )
            z = x @ weights + bias
            z -= z.max(1, keepdims=True)
            p = np.exp(z)
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(chosen)), y[chosen]] -= 1
            dx = p @ weights.T
            d_words = np.stack(
                [np.bincount(inverse, weights=amounts * dx[owner, k], minlength=len(words)) for k in range(width)], 1
            ).astype(np.float32)
            touched = np.unique(np.concatenate([np.unique(place[grams]) for _, _, grams in blocks]))
            d_vectors = np.zeros((len(touched), width))
            for lo, hi, grams in blocks:
                local = np.searchsorted(touched, place[grams])
                spread = np.repeat(d_words[lo:hi], sizes[lo:hi], axis=0) * sample.shares[grams][:, None]
                for k in range(width):
                    d_vectors[:, k] += np.bincount(local, weights=spread[:, k], minlength=len(touched))
            dw, db = x.T @ p / len(chosen), p.mean(0)
            w_squares += dw**2
            b_squares += db**2
            squares[touched] += (d_vectors**2).mean(1, keepdims=True)
            vectors[touched] -= rate * d_vectors / np.sqrt(squares[touched])
            weights -= RATE * dw / np.sqrt(w_squares)
            bias -= RATE * db / np.sqrt(b_squares)
    values[used] = GAIN * (vectors @ (weights[:, 1] - weights[:, 0]).astype(np.float32))
    return Model(values, float(bias[1] - bias[0]))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels training never sees."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    class_rows: tuple[int, int] = CLASS_ROWS,
    sample_chars: int = SAMPLE_CHARS,
) -> Model:
    """Train on a bounded sample of labelled rows that are not held out.

    The candidates are at most ``class_rows`` rows of class 1 and of class 0 in the order of a hash of the key.
    Whole texts of at most ``sample_chars`` characters together are sampled: a class has a share in
    proportion to its rows and what the other leaves of its own, and takes its shortest texts first, so
    that a long text costs itself alone. A text longer than the share is a candidate only where others
    leave a place, one longer than ``sample_chars`` never. Rows without a key, or with a label other
    than 0 and 1, are not sampled; a key with both labels counts as 1.
    """
    known = (
        labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("int").alias("label"))
        .filter("key is not null and label in (0, 1)")
        .filter(~held_out(F.col("key")))
        .groupBy("key")
        .agg(F.max("label").alias("label"))
    )
    # A key of docs may repeat; one of its texts stands for it.
    pool = docs.select(F.col(f"`{key}`").alias("key"), F.length(f"`{text}`").alias("chars")).join(known, "key")
    pool = pool.groupBy("key", "label").agg(F.coalesce(F.max("chars"), F.lit(0)).alias("chars"))
    pool = pool.filter(F.col("chars") <= sample_chars)
    order = [F.xxhash64("key"), F.col("key")]
    share = {k: sample_chars * n // max(sum(class_rows), 1) for k, n in zip((1, 0), class_rows, strict=True)}
    candidates = [
        pool.filter(F.col("label") == k).orderBy(F.col("chars") > share[k], *order).limit(n)
        for k, n in zip((1, 0), class_rows, strict=True)
    ]
    # At most sum(class_rows) rows reach the windows.
    sample = candidates[0].unionAll(candidates[1]).withColumn("one", F.lit(1))
    upto = Window.partitionBy("label").orderBy("chars", *order).rowsBetween(Window.unboundedPreceding, 0)
    taken = lambda k, most: F.coalesce(
        F.max(F.when((F.col("label") == k) & (F.col("upto") <= most), F.col("upto"))).over(Window.partitionBy("one")),
        F.lit(0),
    )
    # Class 1 has what class 0 leaves within its share, class 0 all that class 1 then leaves.
    sample = (
        sample.withColumn("upto", F.sum("chars").over(upto))
        .withColumn("left", F.lit(sample_chars) - taken(0, F.lit(share[0])))
        .withColumn("rest", F.lit(sample_chars) - taken(1, F.col("left")))
        .filter(F.col("upto") <= F.when(F.col("label") == 1, F.col("left")).otherwise(F.col("rest")))
        .select("key", "label")
    )
    rows = (
        docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
        .join(F.broadcast(sample), "key")
        .groupBy("key", "label")
        .agg(F.max("text").alias("text"))
    )
    ones, n = known.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count("label")).first()
    return train_sample(*_collected(rows, order), share=(ones + 1) / (n + 2))


def _collected(rows: DataFrame, order: list[Column]) -> tuple[Sample, list[int]]:
    """The sample as numbers: texts are cut on the executors, the driver sees digests of words and buckets."""

    def cut(part: pa.RecordBatch) -> pa.RecordBatch:
        words = [tokens(t) for t in part.column("text").to_pylist()]
        return pa.record_batch(
            {"key": part.column("key"), "label": part.column("label"), "words": pa.array(words, pa.list_(pa.string()))}
        )

    def grams(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, STEP_WORDS):
                part = batch.slice(lo, STEP_WORDS)
                counts, buckets, _ = grams_of(part.column("word").to_pylist(), BUCKETS)
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                yield pa.record_batch({"id": part.column("id"), "buckets": pa.ListArray.from_arrays(offsets, buckets)})

    fields = f"key {rows.schema['key'].dataType.simpleString()}, label int, words array<string>"
    held = write_and_read(map_slices(rows, "text", fields, lambda: cut), "toxicity-sample")
    words = held.select(F.explode("words").alias("word")).distinct().select("word", F.xxhash64("word").alias("id"))
    # Bounded by SAMPLE_CHARS, like all that the driver gets.
    table = words.mapInArrow(grams, "id long, buckets array<int>").toArrow()
    listed = table.column("buckets").combine_chunks()
    ids = table.column("id").to_numpy()
    # One order of words whatever the tasks were.
    by_id = np.argsort(ids, kind="stable")
    listed = listed.take(pa.array(by_id))
    counts = pc.list_value_length(listed).to_numpy().astype(np.int64)
    share = np.where(counts > 1, (1 - OWN_SHARE) / np.maximum(counts - 1, 1), 1.0)
    weights = np.repeat(share, counts).astype(np.float32)
    own = np.cumsum(counts) - counts
    weights[own] = np.where(counts > 1, OWN_SHARE, 1.0)
    table = held.orderBy(*order).select("label", F.transform("words", lambda w: F.xxhash64(w)).alias("ids")).toArrow()
    found = table.column("ids").combine_chunks()
    numbers = np.searchsorted(ids[by_id], found.flatten().to_numpy()).astype(np.int32)
    docs = np.split(numbers, np.cumsum(pc.list_value_length(found).to_numpy())[:-1]) if len(found) else []
    sample = Sample(docs, counts, listed.flatten().to_numpy(), weights)
    return sample, table.column("label").to_pylist()


def score(docs: DataFrame, model: Model, text: str = "text", *, threshold: float = THRESHOLD) -> DataFrame:
    """Add ``score`` and ``predicted``; a null or empty text gets the score of the bias alone.

    Columns of these names are replaced. The score depends on the text only, so repeated rows agree.
    """
    kept = docs.drop("score", "predicted") if text not in ("score", "predicted") else docs
    names, body = kept.columns, fresh(kept, "body")["body"]
    source = kept.withColumn(body, F.col(f"`{text}`").cast("string"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields]
    # The model is one number a bucket, however large the corpus is.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        cache: dict[str, float] = {}

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            value = shared.value.scores(part.column(body).to_pylist(), cache)
            arrays = [part.column(c) for c in names] + [pa.array(value)]
            arrays.append(pa.array((value >= threshold).astype(np.int32)))
            return pa.RecordBatch.from_arrays(arrays, names=[*names, "score", "predicted"])

        return work

    return map_slices(source, body, ", ".join([*fields, "score double", "predicted int"]), make)
