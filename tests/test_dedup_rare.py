"""Deduplication that shuffles only the rows that share a key."""

from pyspark.sql import functions as F

from stratum.operators import dedup
from stratum.operators.dedup import dedup_first, dedup_rare
from stratum.plans import claims
from conftest import SF_SMALL


def _rows(spark):
    one = spark.range(500).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("v"))
    more = spark.createDataFrame([("k7", -1), ("k7", None), ("k9", 9), (None, 4), (None, 3)], "key string, v long")
    return one.unionByName(more).repartition(3)


def test_same_rows_as_the_full_dedup(spark, monkeypatch):
    df = _rows(spark)
    want = sorted(map(str, dedup_first(df, ["key"], ["v"]).collect()))
    assert sorted(map(str, dedup_rare(df, ["key"], ["v"]).collect())) == want and len(want) == 501
    monkeypatch.setattr(dedup, "REPEATED_BYTES", 0)         # many repeated keys: all rows are shuffled
    assert sorted(map(str, dedup_rare(df, ["key"], ["v"]).collect())) == want


def test_claims_that_are_alone_are_not_shuffled(spark):
    plan = claims.deduped(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan
    alone = plan[plan.index("Union"):plan.index("SortAggregate")] if "SortAggregate" in plan else plan
    assert "Exchange hashpartitioning" not in alone
