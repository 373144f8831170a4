import json
import tempfile

from pyspark.sql import functions as F

from stratum.operators.governance import (column_tags, mask_tagged, mask_value, resolve_columns,
                                          tag_columns, tenant_filter)
from stratum.sinks import append_evolving, materialize, run_summary, write_table


def test_tags_survive_parquet_and_drive_masks(spark):
    df = spark.createDataFrame([(1, "Ann Lee", 1234.5)], "id int, Name string, bal double")
    found, missing = resolve_columns(df, ["name", "BAL", "vin"])
    assert found == {"name": "Name", "BAL": "bal"} and missing == ["vin"]
    tagged = tag_columns(df, {"name": {"pii": "name"}, "bal": {"pii": "balance"}, "vin": {"pii": "id"}})
    path = tempfile.mkdtemp(prefix="stratum-tags-") + "/t"
    tagged.write.parquet(path)
    back = spark.read.parquet(path)
    tags = {(r["column"], r["value"]) for r in column_tags(spark, back, "t").collect()}
    assert tags == {("Name", "name"), ("bal", "balance")}
    m = mask_tagged(back, {"name": "hash", "balance": "band:1000"}, salt="s").first()
    assert m["Name"] != "Ann Lee" and len(m["Name"]) == 64 and m["bal"] == 1000 and m["id"] == 1


def test_mask_strategies(spark):
    df = spark.createDataFrame([("Ab-12",)], "s string")
    r = df.select(mask_value(F.col("s"), "redact").alias("r"), mask_value(F.col("s"), "partial").alias("p"),
                  mask_value(F.col("s"), "null").alias("n")).first()
    assert (r["r"], r["p"], r["n"]) == ("Xx-nn", "*b-12", None)


def test_tenant_filter_never_duplicates(spark):
    rows = spark.createDataFrame([(1, "DE"), (2, "FR"), (3, "DE")], "id int, country string")
    ent = spark.createDataFrame([("eu", "DE"), ("eu", "DE"), ("eu", "FR"), ("us", "US")],
                                "principal string, country string")
    got = sorted(r["id"] for r in tenant_filter(rows, ent, ["country"], "eu").collect())
    assert got == [1, 2, 3]
    assert tenant_filter(rows, ent, ["country"], "us").count() == 0


def test_sinks(spark):
    root = tempfile.mkdtemp(prefix="stratum-sinks-")
    a = spark.createDataFrame([(1, 0, "x"), (2, 1, "y")], "id int, b int, v string")
    write_table(a, f"{root}/t", partition_by=["b"])
    upd = spark.createDataFrame([(3, 1, "z")], "id int, b int, v string")
    write_table(upd, f"{root}/t", partition_by=["b"], dynamic=True)     # only partition b=1 rewritten
    assert sorted(r["id"] for r in spark.read.parquet(f"{root}/t").collect()) == [1, 3]
    ev = append_evolving(a, spark.createDataFrame([(4, "w", 9.5)], "id int, v string, extra double"))
    assert set(ev.columns) == {"id", "b", "v", "extra"} and ev.count() == 3
    m = materialize(a, "unit")
    assert m.count() == 2
    summary = json.loads(run_summary(spark, spark.createDataFrame([("t", "OK")], "table string, status string")))
    assert summary == [{"table": "t", "status": "OK"}]
