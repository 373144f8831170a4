"""Sketches against exact quantiles and counts; parts merge into the whole."""

import random

from pyspark.sql import functions as F

from stratum.operators.sketches import (distinct_error, distinct_estimate, distinct_sketches, merge_distinct,
                                        merge_quantiles, quantile, quantile_sketches, rank_error)


def test_quantiles_have_their_rank_and_merge(spark):
    rnd = random.Random(1)
    rows = [(i % 7, rnd.lognormvariate(8, 2) if rnd.random() < 0.6 else 100.0) for i in range(40_000)]
    rows += [(8, None), (9, 5.0), (9, None)]
    df = spark.createDataFrame(rows, "k int, x double").repartition(6)
    parts = quantile_sketches(df, ["k"], "x", 200)
    assert {r.k: r.n for r in parts.collect() if r.k > 6} == {9: 1}
    whole = merge_quantiles(parts, [F.lit("all").alias("level")], 200)
    values = sorted(x for _, x in rows if x is not None)
    assert whole.first()["n"] == len(values)
    for p in (0.1, 0.5, 0.9, 0.99):
        q = whole.select(quantile(p)).first()[0]
        below, upto = sum(x < q for x in values), sum(x <= q for x in values)
        slack = 2 * rank_error(200) * len(values)
        assert below <= p * len(values) + slack and upto >= p * len(values) - slack
    one = parts.where("k = 9").select(quantile(0.5)).first()[0]
    assert one == 5.0
    assert quantile_sketches(df.limit(0), ["k"], "x").collect() == []


def test_distinct_counts_merge(spark):
    df = spark.range(30_000).selectExpr("id % 11 AS day", "id % 9000 AS v").unionByName(
        spark.createDataFrame([(11, None)], "day long, v long"))
    days = distinct_sketches(df, ["day"], "v")
    exact = {r.day: r.n for r in df.groupBy("day").agg(F.count_distinct("v").alias("n")).collect()}
    for r in days.select("day", distinct_estimate().alias("e")).collect():
        assert abs(r.e - exact[r.day]) <= 4 * distinct_error() * exact[r.day] + 1
    whole = merge_distinct(days, [F.lit(1).alias("x")]).select(distinct_estimate()).first()[0]
    assert abs(whole - 9000) <= 4 * distinct_error() * 9000
