"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from corpusweave.operators import bpe, ngram, pretok, vectors  # noqa: E402
from corpusweave.plans.registry import table, texts  # noqa: E402
from corpusweave.session import get_spark  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
MERGES = 256


def consume(df) -> None:
    """Compute every row and column without moving them to the driver."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = get_spark("bench", os.environ.get("BENCH_CPUS"))
    times: dict[str, float] = {}

    def timed(name, job):
        start = time.perf_counter()
        out = job()
        times[name] = round(time.perf_counter() - start, 3)
        return out

    # Start the session's threads and Python workers before the clock runs.
    spark.range(1000).selectExpr("sum(id)").collect()
    documents = texts(spark, SF_DIR, "doc_id", "text")
    timed("p8_piece_counts", lambda: consume(pretok.piece_counts(documents)))
    model = timed("b5_learn_256_merges", lambda: bpe.train(documents, bpe.BASE_SIZE + MERGES))
    timed("b9_encode_documents", lambda: consume(bpe.encode_documents(documents, model)))
    lower = documents.select(F.lower("text").alias("text"))
    timed("n1_fivegram_counts", lambda: consume(ngram.char_ngram_counts(lower, 5)))

    def best():
        keys = table(spark, SF_DIR, "embeddings")
        queries = vectors.group_means(keys, "label", "embedding").select(
            F.col("label").cast("long").alias("query_id"), F.col("mean").alias("query")
        )
        consume(vectors.best_matches(keys, queries, 10))

    timed("e8_top_10_matches", best)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": SF_DIR.rsplit("sf", 1)[-1].strip("/"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
