"""Features and models (ML1-ML3): leakage-free claim features with
SQL-checkable category codes, and spark.ml models trained on a
deterministic hash split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.functions.keys import portable_seed
from stratum.operators.joins import left_join_nonnull
from stratum.sinks import materialize, materialize_keyed

# Columns derived from the label (the synthetic lifecycle is decided from
# the fraud flag), so they must never be features.
LEAKAGE_COLUMNS = ("claim_status", "settlement_date", "cycle_time_days")


def encode_categories(df: DataFrame, cols: Sequence[str], suffix: str = "_code") -> DataFrame:
    """Integer codes per category: 0 = NULL, else 1 + alphabetical index of
    the value.  The distinct (column, value) pairs are ranked by range
    partition: each partition numbers its own values and starts after those of
    the partitions before it, so neither the driver nor one task holds a
    vocabulary.  ``df`` is read twice: give it materialised."""
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("value")) for c in cols])).alias("p"))
    values = pairs.select("p.*").where("value IS NOT NULL").distinct()
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = materialize(values.repartitionByRange(parts, "col", "value")
                         .withColumn("part", F.spark_partition_id()), "vocabulary")
    inside = Window.partitionBy("col", "part").orderBy("value")
    sizes = values.groupBy("col", "part").agg(F.count("*").alias("n"))       # partitions x columns
    before = Window.partitionBy("col").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("col", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    codes = (values.withColumn("rank", F.row_number().over(inside)).join(sizes, ["col", "part"])
             .select("col", "value", (F.col("first") + F.col("rank")).cast("int").alias("code")))
    out = df
    for c in cols:
        own = codes.where(F.col("col") == c).select(F.col("value").alias(c), F.col("code").alias(f"{c}{suffix}"))
        out = left_join_nonnull(out, own, [c]).withColumn(
            f"{c}{suffix}", F.coalesce(f"{c}{suffix}", F.lit(0)))
    return out


def hash_split(id_col: str, train_share: int = 8, buckets: int = 10):
    """Deterministic train/test assignment by the md5 seed of the id."""
    return F.when(F.pmod(portable_seed(id_col), F.lit(buckets)) < train_share,
                  F.lit("train")).otherwise(F.lit("test"))


def _written(rows: DataFrame, name: str, id_col: str, hex_id: bool) -> DataFrame:
    return materialize_keyed(rows, name, id_col) if hex_id else materialize(rows, name)


def train_classifier(features: DataFrame, code_cols: Sequence[str], num_cols: Sequence[str],
                     label: str = "label", id_col: str = "claim_id", max_iter: int = 30,
                     hex_id: bool = False) -> DataFrame:
    """Logistic regression on one-hot codes + numeric columns; returns
    (id, split, label, score) for every row.  Training is an action.
    ``hex_id``: ids are hexadecimal in lower case and written in binary."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import OneHotEncoder, StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    df = features.withColumn("split", hash_split(id_col)).withColumn(label, F.col(label).cast("double"))
    # Estimators make several passes (encoder fit, scaler fit, optimiser,
    # scoring): write the features once, in columns, so the upstream pipeline
    # is not recomputed per pass.
    df = _written(df, "classifier_rows", id_col, hex_id)
    ohe = OneHotEncoder(inputCols=list(code_cols), outputCols=[f"{c}_oh" for c in code_cols],
                        handleInvalid="keep")
    num = VectorAssembler(inputCols=list(num_cols), outputCol="__num", handleInvalid="keep")
    scale = StandardScaler(inputCol="__num", outputCol="__num_s", withMean=True, withStd=True)
    vec = VectorAssembler(inputCols=[f"{c}_oh" for c in code_cols] + ["__num_s"], outputCol="features")
    lr = LogisticRegression(featuresCol="features", labelCol=label, maxIter=max_iter)
    model = Pipeline(stages=[ohe, num, scale, vec, lr]).fit(df.where(F.col("split") == "train"))
    scored = model.transform(df)
    return scored.select(id_col, "split", F.col(label).cast("int").alias(label),
                         F.round(vector_to_array("probability")[1], 6).alias("score"))


def train_severity(features: DataFrame, code_cols: Sequence[str], target: str,
                   id_col: str = "claim_id", hex_id: bool = False) -> DataFrame:
    """Gamma GLM (log link) for claim severity; rows with a positive target
    train, every row is scored.  ``hex_id`` as in ``train_classifier``."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, VectorAssembler
    from pyspark.ml.regression import GeneralizedLinearRegression

    df = features.withColumn("split", hash_split(id_col)).withColumn(target, F.col(target).cast("double"))
    df = _written(df, "severity_rows", id_col, hex_id)
    ohe = OneHotEncoder(inputCols=list(code_cols), outputCols=[f"{c}_oh" for c in code_cols],
                        handleInvalid="keep")
    vec = VectorAssembler(inputCols=[f"{c}_oh" for c in code_cols], outputCol="features")
    glm = GeneralizedLinearRegression(family="gamma", link="log", labelCol=target,
                                      featuresCol="features", maxIter=25)
    train = df.where((F.col("split") == "train") & (F.col(target) > 0))
    model = Pipeline(stages=[ohe, vec, glm]).fit(train)
    return model.transform(df).select(id_col, "split", target,
                                      F.round("prediction", 4).alias("predicted"))


def evaluate_scores(scores: DataFrame, label: str = "label", score: str = "score",
                    split: str = "test") -> float:
    """Area under ROC of the scores on one split (an action)."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    df = scores.where(F.col("split") == split).select(F.col(label).cast("double").alias("label"),
                                                      F.col(score).cast("double").alias("raw"))
    return BinaryClassificationEvaluator(rawPredictionCol="raw", labelCol="label",
                                         metricName="areaUnderROC").evaluate(df)


def evaluate_regression(pred: DataFrame, target: str, predicted: str = "predicted",
                        split: str = "test") -> dict[str, float]:
    """RMSE and MAE of the predictions on one split, with the RMSE of the
    constant-mean predictor as the baseline (one aggregate)."""
    d = pred.where((F.col("split") == split) & F.col(target).isNotNull())
    err = F.col(predicted) - F.col(target)
    r = d.agg(F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae"),
              F.stddev_pop(target).alias("baseline_rmse")).first()
    return {k: float(r[k]) for k in ("rmse", "mae", "baseline_rmse")}
