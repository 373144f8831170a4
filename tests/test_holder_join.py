"""Claims get their holder and the holder's attributes by one join."""

from pyspark.sql import functions as F

from stratum.plans import claims


def test_holder_and_segment_by_one_shuffle_of_the_claims(spark, tmp_path):
    orders = [(1, 10), (2, 11), (2, 12), (3, None), (4, 99)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(10, "x"), (11, "y"), (11, "z"), (None, "n")], "c_custkey long, c_mktsegment string") \
        .write.parquet(f"{tmp_path}/customer.parquet")
    rows = [("orders", "10"), ("orders", "99"), ("orders", None), ("lineitem", "1"), ("lineitem", "2"),
            ("lineitem", "3"), ("lineitem", "7"), ("lineitem", None)]
    c = spark.createDataFrame(rows, "source_system string, policy_number string").withColumn(
        "claim_id", F.sha2(F.concat_ws("|", "source_system", "policy_number"), 256))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = claims.with_holder(c, spark, str(tmp_path), ("c_mktsegment",))
        got = sorted((r.source_system, r.policy_number or "", r.policy_id or -1, r.c_mktsegment or "") for r in out.collect())
        ids = {r.claim_id for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == sorted([("orders", "10", 10, "x"), ("orders", "99", 99, ""), ("orders", "", -1, ""),
                          ("lineitem", "1", 10, "x"), ("lineitem", "2", 11, "y"), ("lineitem", "2", 11, "z"),
                          ("lineitem", "2", 12, ""), ("lineitem", "3", -1, ""), ("lineitem", "7", -1, ""),
                          ("lineitem", "", -1, "")])
    assert ids == {r.claim_id for r in c.collect()}
