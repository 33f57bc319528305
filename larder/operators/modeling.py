"""Stockout classifier and reorder-point regressor on the gold table (MLlib).

The split is a hash of the product key, so it does not depend on
partitioning and survives recomputation; both forests have explicit seeds.
Metrics are available both from the MLlib evaluators and as plain
aggregations (exact AUC, MAE, R2) that can be checked against SQL.
"""

from __future__ import annotations

import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.ranking import exclusive_prefix_sums
from larder.sources import files
from larder.sources.writers import replace_folder

# Candidate features (in order), targets, forest size, split.
FEATURES = (
    "initial_stock_quantity", "stock_on_hand", "total_sales", "active_days",
    "daily_sales_velocity", "actual_lead_time", "avg_lead_time_days", "procurement_lead_time",
)
CLASS_LABEL = "stockout_risk"
REGRESSION_LABEL = "reorder_point"
NUM_TREES = 100
TRAIN_FRACTION = 0.8
SEED = 42


def select_features(df: DataFrame, candidates=FEATURES) -> list[str]:
    """The candidate features that exist in ``df``, in candidate order."""
    return [f for f in candidates if f in df.columns]


def fill_null_features(df: DataFrame) -> DataFrame:
    """NULL → 0 in numeric columns; other types untouched."""
    return df.fillna(0)


def assemble(df: DataFrame, features: list[str], output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol=output).transform(df)


def split_bucket(key: Column, seed: int = SEED) -> Column:
    """Stable 0..99 bucket from md5(seed:key)."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast(T.LongType()) % 100


def train_test_split(df: DataFrame, key: str = "product_id", train_fraction: float = TRAIN_FRACTION,
                     seed: int = SEED) -> DataFrame:
    """Adds ``split`` = train / test, reproducible regardless of partitioning."""
    cut = int(round(train_fraction * 100))
    return df.withColumn(
        "split", F.when(split_bucket(F.col(key), seed) < cut, F.lit("train")).otherwise(F.lit("test"))
    )


def model_frame(gold: DataFrame) -> tuple[DataFrame, list[str]]:
    """Null-filled gold rows with split and feature vector."""
    feats = select_features(gold)
    prepared = train_test_split(fill_null_features(gold))
    return assemble(prepared, feats), feats


def fit_classifier(train: DataFrame, label: str = CLASS_LABEL, seed: int = SEED,
                   num_trees: int = NUM_TREES) -> PipelineModel:
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=num_trees, seed=seed)
    model = Pipeline(stages=[rf]).fit(train)
    # The training summary holds the session, which executors cannot take once it has observed a write.
    model.stages[-1]._java_obj.setSummary(train.sparkSession.sparkContext._jvm.scala.Option.empty())
    return model


def fit_regressor(train: DataFrame, label: str = REGRESSION_LABEL, seed: int = SEED,
                  num_trees: int = NUM_TREES) -> PipelineModel:
    from pyspark.ml.regression import RandomForestRegressor

    rf = RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=num_trees, seed=seed)
    return Pipeline(stages=[rf]).fit(train)


def classifier_predictions(model: PipelineModel, df: DataFrame) -> DataFrame:
    out = model.transform(df)
    return out.withColumn("p_risk", vector_to_array("probability")[1])


def auc_by_aggregation(df: DataFrame, label: str, score: str, n_buckets: int | None = None) -> DataFrame:
    """Exact ROC AUC (ties count one half) as a one-row frame.

    Scores are reduced to ``(score, n_pos, n_neg)``; the negatives below each
    score come from a distributed prefix sum. NULL when a class is absent.
    """
    y = F.col(label).cast("int")
    per_score = (
        df.where(F.col(score).isNotNull() & y.isNotNull())
        .groupBy(F.col(score).alias("_score"))
        .agg(F.sum(F.when(y == 1, 1).otherwise(0)).cast("long").alias("n_pos"),
             F.sum(F.when(y == 1, 0).otherwise(1)).cast("long").alias("n_neg"))
    )
    cum = exclusive_prefix_sums(per_score, "_score", ["n_neg"], n_buckets=n_buckets)
    agg = cum.agg(
        F.sum(F.col("n_pos") * (F.col("before_n_neg") + F.col("n_neg") * 0.5)).alias("_wins"),
        F.coalesce(F.sum("n_pos"), F.lit(0)).cast("long").alias("n_pos"),
        F.coalesce(F.sum("n_neg"), F.lit(0)).cast("long").alias("n_neg"),
    )
    denom = F.col("n_pos").cast("double") * F.col("n_neg").cast("double")
    return agg.select(F.when(denom > 0, F.col("_wins") / denom).alias("auc"), "n_pos", "n_neg")


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """MAE and R2 = 1 − SSE/SST in one aggregate over one pass."""
    rows = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull()).select(label, prediction)
    err = F.col(prediction) - F.col(label)
    agg = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(err)).alias("mae"),
        F.sum(err * err).alias("_sse"),
        (F.var_pop(label) * F.count(F.lit(1))).alias("_sst"),
    )
    return agg.select(
        "n", "mae",
        F.when(F.col("_sst") > 0, 1 - F.col("_sse") / F.col("_sst")).alias("r2"),
    )


def evaluator_auc(pred: DataFrame, label: str = CLASS_LABEL) -> float | None:
    n_classes = pred.select(label).distinct().count()
    if n_classes < 2:
        return None
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction",
                                       metricName="areaUnderROC", numBins=0)
    return float(ev.evaluate(pred))


def evaluator_regression(pred: DataFrame, label: str = REGRESSION_LABEL) -> dict[str, float]:
    return {m: float(RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName=m).evaluate(pred))
            for m in ("mae", "r2")}


def feature_importance(model: PipelineModel, features: list[str], spark) -> DataFrame:
    """``(feature, importance)`` rounded to 4 decimals, in feature order."""
    imp = model.stages[-1].featureImportances
    rows = [(i, f, round(float(imp[i]), 4)) for i, f in enumerate(features)]
    return spark.createDataFrame(rows, "position int, feature string, importance double")


def score_products(gold: DataFrame, clf: PipelineModel, reg: PipelineModel) -> DataFrame:
    """All products with ``predicted_stockout`` and ``predicted_rop`` beside the features."""
    frame, _ = model_frame(gold)
    c = clf.transform(frame).withColumnRenamed("prediction", "predicted_stockout").drop(
        "rawPrediction", "probability")
    r = reg.transform(c).withColumnRenamed("prediction", "predicted_rop")
    return r.drop("features")


# ------------------------------------------------------------ saved models

def save_models(spark, clf: PipelineModel, reg: PipelineModel, features: list[str], path: str) -> None:
    """Both forests and the names of their features, replaced together under ``path``."""
    def fill(folder: str) -> None:
        clf.write().save(f"{folder}/classifier")
        reg.write().save(f"{folder}/regressor")
        files.create_text(spark, f"{folder}/features.json", json.dumps(features))

    path = path.rstrip("/")
    if files.exists(spark, path):
        replace_folder(spark, path, fill)
    else:
        fill(path)


def load_models(spark, path: str, gold: DataFrame | None = None) -> tuple[PipelineModel, PipelineModel]:
    """The saved (classifier, regressor); with ``gold``, its features must be those the models were fitted on."""
    path = path.rstrip("/")
    wanted = json.loads(files.read_text(spark, f"{path}/features.json"))
    if gold is not None and model_frame(gold)[1] != wanted:
        raise ValueError(f"the models were fitted on {wanted}, the table has {model_frame(gold)[1]}")
    return PipelineModel.load(f"{path}/classifier"), PipelineModel.load(f"{path}/regressor")
