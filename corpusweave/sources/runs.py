"""Experiment lists, histories and manifests on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusweave.functions.ordered import with_ordered
from corpusweave.session import work_partitions

EXPERIMENT = "name string, overrides map<string,string>"
HISTORY = "train_loss double, val_loss double"


def read_experiments(spark: SparkSession, path: str) -> DataFrame:
    """Experiments of a JSON list, checked: not empty, complete, names unique."""
    runs = spark.read.schema(EXPERIMENT).option("multiLine", True).json(path)
    check_experiments(runs)
    return runs


def check_experiments(runs: DataFrame) -> None:
    if runs.isEmpty():
        raise ValueError("the table of experiments has no row")
    missing = runs.filter(F.col("name").isNull() | F.col("overrides").isNull()).limit(1).collect()
    if missing:
        raise ValueError(f"a row has a null in the columns name or overrides: {missing[0].asDict()}")
    twice = runs.groupBy("name").count().filter("count > 1").orderBy("name").limit(1).collect()
    if twice:
        raise ValueError(f"the column name has duplicates: {twice[0]['name']!r} in {twice[0]['count']} rows")


def write_history_lines(lines: DataFrame, path: str, order: list[str]) -> None:
    """Text lines ``value`` of every ``run`` in order, one file below ``run=<name>`` each.

    Files take the time, not bytes, so the number of tasks is given: Spark would join small partitions.
    """
    placed = lines.repartition(work_partitions(lines.sparkSession), "run").sortWithinPartitions("run", *order)
    placed.select("run", "value").write.partitionBy("run").text(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Two-column loss histories as (run, step, train_loss, val_loss).

    The run is the name of the folder ``run=<name>``, or of the file, and the step is the place of the
    line in it. Header comments are left out and NaN stays NaN.
    """
    rows = (
        spark.read.schema(HISTORY)
        .option("sep", " ")
        .option("comment", "#")
        .option("nanValue", "nan")
        .option("recursiveFileLookup", True)
        .csv(path)
        .select(
            "train_loss", "val_loss", F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_line"),
        )
    )
    folder = F.url_decode(F.regexp_extract("_file", "/run=([^/]+)/", 1))
    name = F.regexp_extract("_file", "([^/]+)$", 1)
    named = rows.withColumn("run", F.when(folder != "", folder).otherwise(name))
    return with_ordered(named, ["run"], ["_file", "_start", "_line"], index="step").select(
        "run", F.col("step").cast("long").alias("step"), "train_loss", "val_loss"
    )


def write_manifest(manifest: DataFrame, path: str) -> None:
    """Run table as CSV with four-decimal metrics and as JSON with full ones."""
    shown = manifest.select(
        *[
            F.format_string("%.4f", c).alias(c) if c in ("final_train", "val_min", "train_tail") else F.col(c)
            for c in manifest.columns
        ]
    )
    shown.write.mode("overwrite").option("header", True).csv(f"{path}/csv")
    manifest.write.mode("overwrite").json(f"{path}/json")
