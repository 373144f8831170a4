import pyarrow.parquet as pq
from pyspark.sql import functions as F

import __spark_entry__ as entry
from stratum.operators import features as model_features
from stratum.plans import features
from stratum.sinks import materialize_keyed

from conftest import SF_CHECK, SF_SMALL


def test_no_feature_determines_the_label(spark):
    f = features.feature_fraud(spark, SF_CHECK).cache()
    base = f.agg(F.avg("label")).first()[0]
    majority = max(base, 1 - base)
    for c in f.columns:
        if c in ("claim_id", "label"):
            continue
        g = f.groupBy(c).agg(F.count("*").alias("n"), F.sum("label").alias("y"))
        best = g.agg(F.sum(F.greatest("y", F.col("n") - F.col("y"))) / F.sum("n")).first()[0]
        assert best < majority + 0.1, (c, best, majority)


def test_every_claim_is_scored_and_the_auc_is_honest(spark):
    scores = entry.queries()["fraud_scores"](spark, SF_SMALL)
    assert scores.count() == entry.queries()["claim_valid"](spark, SF_SMALL).count()
    auc = {r.split: r.auc for r in entry.queries()["fraud_auc"](spark, SF_CHECK).collect()}
    assert 0.5 < auc["test"] < 0.95


def test_severity_model_is_calibrated(spark):
    # In the proxy data the amount (order price) is independent of the coded
    # features, so the best possible model is the mean; the GLM must be no
    # worse than that baseline (by more than 5%) on the held-out split.
    m = entry.queries()["severity_error"](spark, SF_SMALL).first()
    assert m.rmse <= 1.05 * m.baseline_rmse


def test_model_rows_are_written_in_columns_with_binary_ids(spark, monkeypatch):
    written = []

    def spy(rows, name, key):
        out = materialize_keyed(rows, name, key)
        written.extend(f.removeprefix("file://") for f in out.inputFiles())
        return out

    monkeypatch.setattr(model_features, "materialize_keyed", spy)
    rows = spark.range(200).select(
        F.sha2(F.col("id").cast("string"), 256).alias("claim_id"), (F.col("id") % 3).cast("int").alias("type_code"),
        F.col("id").cast("int").alias("age"), (F.col("id") % 2).cast("int").alias("label"),
        (F.col("id") + 1).cast("double").alias("amount"))
    ids = {r.claim_id for r in rows.collect()}
    scored = [model_features.train_classifier(rows, ["type_code"], ["age"], hex_id=True),
              model_features.train_severity(rows, ["type_code"], "amount", hex_id=True)]
    for out in scored:
        got = [r.claim_id for r in out.collect()]
        assert len(got) == 200 and set(got) == ids
    assert written and all(str(pq.read_schema(f).field("claim_id").type) == "binary" for f in written)
