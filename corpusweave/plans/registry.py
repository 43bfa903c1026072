"""Query registry: each query runs over whole tables and names its equivalent SQL, if there is one."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from corpusweave.session import spread

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, run, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, *columns: str, name: str = "documents") -> DataFrame:
    """Text columns of a table, spread over the cores when the scan has too few tasks."""
    return spread(table(spark, sf_dir, name).select(*columns))


def load_all() -> dict[str, Query]:
    from corpusweave.plans import (  # noqa: F401
        bpe_queries,
        dataset_queries,
        fit_queries,
        metric_queries,
        ngram_queries,
        pretok_queries,
        run_queries,
        source_queries,
        stats_queries,
        stream_queries,
        text_queries,
        vector_queries,
    )

    return QUERIES
