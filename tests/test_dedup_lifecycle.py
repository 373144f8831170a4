import datetime as dt

from pyspark.sql import functions as F

from stratum.operators.dedup import dedup_first
from stratum.operators.lifecycle import add_lifecycle, status_history


def test_dedup_keeps_smallest_order_deterministically(spark):
    rows = [("k", "b", 2), ("k", "a", 9), ("k", None, 5), ("j", "z", 1)]
    df = spark.createDataFrame(rows, "key string, t string, v int")
    got = {r["key"]: (r["t"], r["v"]) for r in dedup_first(df, ["key"], ["t", "v"]).collect()}
    assert got == {"k": (None, 5), "j": ("z", 1)}          # NULLs first
    shuffled = df.orderBy(F.rand(7)).repartition(5)
    again = {r["key"]: (r["t"], r["v"]) for r in dedup_first(shuffled, ["key"], ["t", "v"]).collect()}
    assert again == got


def test_dedup_hot_key(spark):
    hot = spark.range(200_000).select(F.lit("hot").alias("key"), (F.col("id") % 1000).alias("v"))
    cold = spark.range(1000).select(F.col("id").cast("string").alias("key"), F.col("id").alias("v"))
    out = dedup_first(hot.unionByName(cold), ["key"], ["v"])
    assert out.count() == 1001
    assert out.where("key = 'hot'").first()["v"] == 0


def test_lifecycle_null_fraud_takes_non_fraud_branch_and_history(spark):
    df = spark.createDataFrame([("c1", dt.date(2020, 1, 1), None), ("c2", None, True)],
                               "claim_id string, incident_date date, fraud boolean")
    life = {r["claim_id"]: r for r in add_lifecycle(df).collect()}
    assert life["c1"]["claim_status"] in ("closed", "settled", "under_review")
    assert life["c2"]["claim_status"] in ("denied", "under_review")
    assert life["c2"]["fnol_date"] is None and life["c2"]["settlement_date"] is None
    hist = status_history(add_lifecycle(df), extra=()).groupBy("claim_id").count().collect()
    n = {r["claim_id"]: r["count"] for r in hist}
    term = life["c1"]["settlement_date"] is not None
    assert n["c1"] == (3 if term else 2) and n["c2"] == 2
