"""The two-level (key, chunk) scans must equal plain per-key windows,
including for a hot key spread over many chunks and keys with empty chunks."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from stratum.operators.ordered import fill_forward, neighbour, running_sum


def _frame(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 else rnd.choice([None, f"k{rnd.randint(0, 40)}"])
        rows.append((key, i, rnd.randint(0, 500), rnd.choice([None, None, rnd.randint(0, 9)])))
    return spark.createDataFrame(rows, "key string, ts long, v long, x long")


def _chunk():
    return F.floor(F.col("ts") / 97)


def test_neighbour_prev_next(spark):
    df = _frame(spark)
    w = Window.partitionBy("key").orderBy("ts")
    want = df.select("key", "ts", F.lag("v").over(w).alias("prev_v"), F.lead("v").over(w).alias("next_v"))
    p = neighbour(df, ["key"], ["ts"], _chunk(), ["v"], "prev")
    n = neighbour(p, ["key"], ["ts"], _chunk(), ["v"], "next")
    assert sorted(n.select("key", "ts", "prev_v", "next_v").collect(), key=repr) == sorted(want.collect(), key=repr)


def test_running_sum(spark):
    df = _frame(spark)
    w = Window.partitionBy("key").orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("key", "ts", F.sum("v").over(w).alias("rs"))
    got = running_sum(df, ["key"], ["ts"], _chunk(), "v", "rs").select("key", "ts", "rs")
    assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr)


def test_fill_forward(spark):
    df = _frame(spark)
    w = Window.partitionBy("key").orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("key", "ts", F.last("x", ignorenulls=True).over(w).alias("x"))
    got = fill_forward(df, ["key"], ["ts"], _chunk(), ["x"]).select("key", "ts", "x")
    assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr)
