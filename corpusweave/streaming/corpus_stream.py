"""The corpus operators on live tables.

The row expressions are those of the batch operators, so a finished stream gives the batch result.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from corpusweave.functions import symbols as S
from corpusweave.functions.patterns import GPT2_PATTERN
from corpusweave.operators.bpe import BpeModel, encode_documents
from corpusweave.operators.ngram import char_ngrams
from corpusweave.operators.pretok import training_pieces
from corpusweave.operators.stats import group_beta


def read_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files of a folder as they arrive."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def event_time(ts: str) -> Column:
    """A zone-free timestamp as the event time a watermark accepts, read as UTC."""
    micros = F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', {ts})")
    return F.timestamp_micros(micros)


def encode_stream(docs: DataFrame, model: BpeModel, text: str = "text") -> DataFrame:
    """Token ids of arriving documents; stateless, append mode."""
    return encode_documents(docs, model, text=text)


def _windowed(docs: DataFrame, items: Column, name: str, ts: str, window: str, delay: str) -> DataFrame:
    items_in = docs.withWatermark(ts, delay).select(F.window(ts, window).alias("_w"), F.explode(items).alias(name))
    counts = items_in.groupBy("_w", name).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("_w.start").alias("window_start"), name, "n")


def piece_counts_stream(
    docs: DataFrame, ts: str, window: str = "1 day", delay: str = "1 hour", text: str = "text",
    pattern: str | None = GPT2_PATTERN,
) -> DataFrame:
    """Piece counts per event-time window. The watermark drops closed windows, so state stays bounded."""
    return _windowed(docs, training_pieces(F.col(text), pattern), "piece", ts, window, delay)


def pair_counts_stream(
    docs: DataFrame, ts: str, window: str = "1 day", delay: str = "1 hour", text: str = "text",
    pattern: str | None = GPT2_PATTERN,
) -> DataFrame:
    """Adjacent byte-pair counts per window, pairs as two-symbol strings."""
    pairs = F.flatten(
        F.transform(
            training_pieces(F.col(text), pattern),
            lambda p: F.regexp_extract_all(S.text_to_symbols(p), F.lit("(?s)(?=(..))."), F.lit(1)),
        )
    )
    return _windowed(docs, pairs, "pair", ts, window, delay)


def ngram_counts_stream(
    docs: DataFrame, n: int, ts: str, window: str = "1 day", delay: str = "1 hour", text: str = "text"
) -> DataFrame:
    return _windowed(docs, char_ngrams(F.col(text), n), "gram", ts, window, delay)


def beta_stream(
    events: DataFrame, key: str, ts: str, success: Column, window: str = "1 day", delay: str = "1 hour",
    alpha: float = 2.0, beta: float = 2.0,
) -> DataFrame:
    """Beta-Binomial posterior per key and window; only sums are kept, so order does not matter."""
    ready = events.withWatermark(ts, delay).select(
        key, success.alias("_success"), F.window(ts, window).alias("_w")
    )
    out = group_beta(ready, [key, "_w"], F.col("_success"), alpha, beta)
    return out.select(F.col("_w.start").alias("window_start"), *[c for c in out.columns if c != "_w"])


PENDING = "ts long, event long, success boolean"


class PrefixPosterior(StatefulProcessor):
    """Posterior of a key after each of its events, in the order of event time.

    Events wait in the state until the watermark has passed them, for an earlier one may still arrive.
    Then a timer takes all that are due in order, adds them to the sums and lets them go, so the state holds
    two numbers and what is younger than the watermark.
    """

    def __init__(self, alpha: float, beta: float):
        self.alpha, self.beta = alpha, beta

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", PENDING)
        self.totals = handle.getValueState("totals", "n long, heads long")
        self.timer = handle.getValueState("timer", "millis long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        arrived = []
        for frame in rows:
            # A trigger for timers alone brings an empty frame without columns.
            if not len(frame):
                continue
            # Computed columns come under other names, so they are taken by place.
            columns = (frame.iloc[:, k].tolist() for k in (-3, -2, -1))
            arrived += [(int(t), int(e), bool(s)) for t, e, s in zip(*columns, strict=True)]
        if arrived:
            self.pending.appendList(arrived)
            self._wake(min(t for t, _, _ in arrived))
        yield from ()

    def _wake(self, ts: int) -> None:
        """Keep one timer, for the earliest event that waits."""
        millis = -(-ts // 1000)
        if self.timer.exists():
            set_for = self.timer.get()[0]
            if set_for <= millis:
                return
            self.handle.deleteTimer(set_for)
        self.handle.registerTimer(millis)
        self.timer.update((millis,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # What the watermark has passed is complete: rows up to it are late on arrival.
        due_until = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = [tuple(r) for r in self.pending.get()] if self.pending.exists() else []
        due = sorted(r for r in waiting if r[0] <= due_until)
        rest = [r for r in waiting if r[0] > due_until]
        self.timer.clear()
        if rest:
            self.pending.put(rest)
            self._wake(min(t for t, _, _ in rest))
        else:
            self.pending.clear()
        if not due:
            return
        n, heads = tuple(self.totals.get()) if self.totals.exists() else (0, 0)
        rows = []
        for ts, event, success in due:
            n, heads = n + 1, heads + int(success)
            a, b = heads + self.alpha, n - heads + self.beta
            rows.append((key[0], event, ts, n, heads, a, b, (a - 1) / (a + b - 2) if a + b > 2 else 0.5, a / (a + b), heads / n))
        self.totals.update((n, heads))
        yield pd.DataFrame(rows, columns=POSTERIOR)

    def close(self) -> None:
        pass


POSTERIOR = ["key", "event", "ts", "n", "heads", "alpha", "beta", "map", "posterior_mean", "mle"]


def prefix_posterior_stream(
    events: DataFrame, key: str, ts: str, event: str, success: Column, delay: str = "1 hour",
    alpha: float = 2.0, beta: float = 2.0,
) -> DataFrame:
    """Beta-Binomial posterior after every event of a key: the rows of the batch form, as time passes them.

    Events of a key are ordered by (event time, event number). A row comes out once the watermark, the
    latest event time less ``delay``, has passed its event. An event behind the watermark on its arrival is
    late: it is dropped and counted in the ``numRowsDroppedByWatermark`` metric, and later rows do not
    contain it. Needs the RocksDB state store, see ``use_rocksdb``.
    """
    kind = events.schema[key].dataType.simpleString()
    ready = events.withWatermark(ts, delay).select(
        F.col(key), F.col(ts), F.unix_micros(ts).alias("_ts"), F.col(event).cast("long").alias("_event"),
        F.coalesce(success, F.lit(False)).alias("_success"),
    )
    schema = (
        f"key {kind}, event long, ts long, n long, heads long, alpha double, beta double, map double, "
        "posterior_mean double, mle double"
    )
    out = ready.groupBy(key).transformWithStateInPandas(
        PrefixPosterior(alpha, beta), outputStructType=schema, outputMode="append", timeMode="eventTime"
    )
    return out.select(
        F.col("key").alias(key), F.col("event").alias(event), F.timestamp_micros("ts").alias(ts),
        *POSTERIOR[3:],
    )


@contextmanager
def use_rocksdb(spark: SparkSession):
    """The state store that keyed state of any shape needs, for the queries started inside."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def run_available(stream: DataFrame, sink: str, checkpoint: str, mode: str = "append") -> None:
    """Process everything that is there into a Parquet folder and stop."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_available_to_table(stream: DataFrame, sink: str, checkpoint: str, keys: list[str]) -> None:
    """Process everything that is there in update mode; a batch adds its changed rows to the sink.

    Read the latest row of a key with ``latest``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # One folder per batch: a retried batch overwrites its own rows only.
        batch.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def latest(spark: SparkSession, sink: str, keys: list[str]) -> DataFrame:
    """The last update of every key."""
    rows = spark.read.parquet(sink)
    values = [c for c in rows.columns if c not in (*keys, "batch_id")]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_v"))
    return best.select(*keys, "_v.*")
