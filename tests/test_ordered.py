import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusweave.functions.ordered import row_index, with_ordered


def hot_rows(spark):
    """One key owns most rows, so it crosses several blocks."""
    rng = random.Random(1)
    rows = [(0 if rng.random() < 0.8 else rng.randrange(1, 9), i, rng.randrange(100)) for i in range(4000)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k int, t int, v int").withColumn(
        "w", F.when(F.col("v") % 7 == 0, F.col("v"))
    ).repartition(8)


def test_columns_equal_plain_windows(spark):
    rows = hot_rows(spark)
    got = with_ordered(
        rows, ["k"], ["t"], index="i", sums={"s": F.col("v")}, totals={"n": F.lit(1)},
        last={"f": F.col("w")}, lag={"p": F.col("w")}, lead={"q": F.col("v")},
    )
    w = Window.partitionBy("k").orderBy("t")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    want = rows.select(
        "*", (F.row_number().over(w) - 1).alias("i"), F.sum("v").over(upto).alias("s"),
        F.count(F.lit(1)).over(Window.partitionBy("k")).alias("n"),
        F.last("w", ignorenulls=True).over(upto).alias("f"), F.lag("w").over(w).alias("p"), F.lead("v").over(w).alias("q"),
    )
    got = got.select(*want.columns)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_row_index_counts_every_row_once(spark):
    placed = row_index(hot_rows(spark), ["t"]).orderBy("t").collect()
    assert [r["row_index"] for r in placed] == list(range(4000))
