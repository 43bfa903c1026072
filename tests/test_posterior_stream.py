"""The posterior after every event, from a stream, against a plain loop."""

import datetime

import pytest
from pyspark.sql import functions as F

from corpusweave.streaming import corpus_stream as W

DAY = datetime.datetime(2024, 1, 1)


@pytest.fixture
def two_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def arriving(spark, path, files):
    """One file per list of (key, minute, event, hit), in the order of their numbers."""
    schema = "key long, ts timestamp, event long, hit boolean"
    for rows in files:
        made = [(k, DAY + datetime.timedelta(minutes=m), e, h) for k, m, e, h in rows]
        spark.createDataFrame(made, schema).coalesce(1).write.mode("append").parquet(path)
    return W.read_stream(spark, path, spark.read.parquet(path).schema, 1)


def test_prefixes_in_event_time_and_late_rows(spark, tmp_path, two_partitions):
    files = [
        [(1, 10, 1, True), (1, 5, 2, False), (2, 7, 3, True)],
        # An earlier event of a time the watermark has not passed still comes in its place.
        [(1, 3, 4, True), (1, 40, 5, False), (1, 40, 6, None)],
        [(3, 41, 50, True)],
        # The batch before had the watermark at minute 40 - 15: minute 20 is late, minute 30 is not.
        [(1, 20, 7, True), (1, 30, 8, True), (2, 200, 9, False)],
        [(9, 5000, 0, False)],
        [(9, 9000, 0, False)],
    ]
    stream = arriving(spark, str(tmp_path / "in"), files)
    with W.use_rocksdb(spark):
        out = W.prefix_posterior_stream(stream, "key", "ts", "event", F.col("hit"), delay="15 minutes")
        W.run_available(out, str(tmp_path / "out"), str(tmp_path / "progress"))
    found = {}
    for r in spark.read.parquet(str(tmp_path / "out")).orderBy("key", "n").collect():
        found.setdefault(r["key"], []).append((r["event"], r["n"], r["heads"], round(r["posterior_mean"], 6)))
    order = {1: [(4, True), (2, False), (1, True), (8, True), (5, False), (6, False)], 2: [(3, True), (9, False)]}
    for key, events in order.items():
        heads, expected = 0, []
        for n, (event, hit) in enumerate(events, 1):
            heads += hit
            expected.append((event, n, heads, round((heads + 2) / (n + 4), 6)))
        assert found[key] == expected


def test_a_table_arrives_in_batches_of_many_files(spark):
    from corpusweave.plans.stream_queries import arriving
    from corpusweave.session import scratch_path, work_partitions

    stream = arriving(spark, spark.range(3000))
    stream = stream.withColumn("file", F.input_file_name())
    sink = scratch_path(spark, "seen")
    query = stream.writeStream.format("parquet").option("path", sink).option(
        "checkpointLocation", scratch_path(spark, "progress")
    ).trigger(availableNow=True).start()
    query.awaitTermination()
    seen = spark.read.parquet(sink)
    assert seen.select("id").distinct().count() == 3000
    assert seen.select("file").distinct().count() == 3 * work_partitions(spark)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
