"""Named modelling queries (train on the written gold table, score, evaluate)."""

from __future__ import annotations

import threading

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators import modeling as M
from larder.functions.lineage import stage
from larder.plans.layers import gold_table, input_state

_MODELS: dict[tuple, object] = {}
_FIT_LOCK = threading.Lock()


def _frame(spark: SparkSession, sf: str):
    return M.model_frame(gold_table(spark, sf))


def fitted(spark: SparkSession, sf: str, kind: str):
    """The forest of the gold table's training rows (``clf`` or ``reg``), fitted once a session."""
    key = (spark.sparkContext.applicationId, input_state(spark, sf), sf, kind)
    with _FIT_LOCK:
        if key not in _MODELS:
            frame, _ = _frame(spark, sf)
            train = frame.where(F.col("split") == "train")
            _MODELS[key] = M.fit_classifier(train) if kind == "clf" else M.fit_regressor(train)
        return _MODELS[key]


def _test(spark, sf) -> DataFrame:
    frame, _ = _frame(spark, sf)
    return frame.where(F.col("split") == "test")


def select_features(spark, sf):
    g = gold_table(spark, sf)
    return g.select("product_id", *M.select_features(g))


def fill_null_features(spark, sf):
    g = gold_table(spark, sf)
    return M.fill_null_features(g).select("product_id", *M.select_features(g), M.CLASS_LABEL, M.REGRESSION_LABEL)


def assemble_features(spark, sf):
    frame, _ = _frame(spark, sf)
    return frame.select("product_id", vector_to_array("features").alias("features"))


def assembled_values(spark, sf):
    """The assembled vectors as (product_id, position, value)."""
    return assemble_features(spark, sf).select("product_id", F.posexplode("features").alias("position", "value"))


def train_test_split(spark, sf):
    return M.train_test_split(gold_table(spark, sf)).select("product_id", "split")


def rf_stockout(spark, sf):
    pred = M.classifier_predictions(fitted(spark, sf, "clf"), _test(spark, sf))
    return pred.select("product_id", M.CLASS_LABEL, "prediction", "p_risk")


def rf_stockout_rows(spark, sf):
    """What must hold of every classified test product: keys, labels, a probability and a class."""
    return rf_stockout(spark, sf).select(
        "product_id", M.CLASS_LABEL, F.col("p_risk").between(0, 1).alias("p_in_range"),
        F.col("prediction").isin(0.0, 1.0).alias("is_class"))


def _label_range(spark, sf):
    """Between the least and the largest label of the training rows, where every mean of labels lies."""
    frame, _ = _frame(spark, sf)
    y = frame.where("split = 'train'").select(M.REGRESSION_LABEL)
    low, high = y.select(F.min(M.REGRESSION_LABEL)).scalar(), y.select(F.max(M.REGRESSION_LABEL)).scalar()
    return lambda c: F.col(c).between(low - 1e-6, high + 1e-6)


def rf_reorder_point_rows(spark, sf):
    return rf_reorder_point(spark, sf).select(
        "product_id", M.REGRESSION_LABEL, _label_range(spark, sf)("prediction").alias("in_label_range"))


def score_products_rows(spark, sf):
    return score_products(spark, sf).select(
        "product_id", "stock_on_hand", F.col("predicted_stockout").isin(0.0, 1.0).alias("is_class"),
        _label_range(spark, sf)("predicted_rop").alias("in_label_range"))


def feature_importance_rows(spark, sf):
    imp = feature_importance(spark, sf)
    total = imp.select(F.sum("importance")).scalar()
    return imp.select("position", "feature", F.col("importance").between(0, 1).alias("in_range"),
                      (F.abs(total - 1) < 0.001).alias("sums_to_one"))


def auc_model_agreement(spark, sf):
    """The evaluator's AUC against the exact aggregation (both absent if the test rows hold one class)."""
    same = F.col("auc").eqNullSafe(F.col("evaluator_auc")) | (F.abs(F.col("auc") - F.col("evaluator_auc")) < 1e-9)
    return auc_model(spark, sf).select("n_pos", "n_neg", F.coalesce(same, F.lit(False)).alias("metrics_agree"))


def _test_unfilled(spark, sf) -> DataFrame:
    return M.train_test_split(gold_table(spark, sf)).where(F.col("split") == "test")


def auc_exact(spark, sf):
    test = _test_unfilled(spark, sf).select(M.CLASS_LABEL, (F.lit(0.0) - F.col("stock_on_hand")).alias("score"))
    return M.auc_by_aggregation(test, M.CLASS_LABEL, "score")


def auc_model(spark, sf):
    pred = stage(M.classifier_predictions(fitted(spark, sf, "clf"), _test(spark, sf)).select(
        M.CLASS_LABEL, "rawPrediction", "p_risk"), "class-predictions")
    exact = M.auc_by_aggregation(pred, M.CLASS_LABEL, "p_risk")
    return exact.withColumn("evaluator_auc", F.lit(M.evaluator_auc(pred)).cast("double"))


def rf_reorder_point(spark, sf):
    pred = fitted(spark, sf, "reg").transform(_test(spark, sf))
    return pred.select("product_id", M.REGRESSION_LABEL, "prediction")


def regression_metrics(spark, sf):
    m = M.regression_metrics(_test_unfilled(spark, sf), M.REGRESSION_LABEL, "safety_stock")
    return m.select("n", F.round("mae", 6).alias("mae"), F.round("r2", 6).alias("r2"))


def regression_metrics_model(spark, sf):
    pred = stage(rf_reorder_point(spark, sf), "reorder-predictions")
    m = M.regression_metrics(pred, M.REGRESSION_LABEL, "prediction")
    ev = M.evaluator_regression(pred)
    return m.select("n", "mae", "r2", F.lit(ev["mae"]).alias("evaluator_mae"), F.lit(ev["r2"]).alias("evaluator_r2"))


def score_products(spark, sf):
    scored = M.score_products(gold_table(spark, sf), fitted(spark, sf, "clf"), fitted(spark, sf, "reg"))
    return scored.select("product_id", "stock_on_hand", "predicted_stockout", "predicted_rop")


def recommendations_from_model_output(spark, sf):
    """Model scores → ``model_output`` CSV → recommendations (the stage-4 to
    stage-5 hand-over, through a written table)."""
    from larder.operators import recommend as R
    from larder.session import scratch_path
    from larder.sources import readers, writers

    path = scratch_path(spark, "model-output")
    writers.write_csv(score_products(spark, sf), path)
    schema = "product_id long, stock_on_hand double, predicted_stockout double, predicted_rop double"
    return R.recommendations(readers.read_csv(spark, path, schema=schema))


def feature_importance(spark, sf):
    _, feats = _frame(spark, sf)
    return M.feature_importance(fitted(spark, sf, "clf"), feats, spark)


def model_queries():
    return {
        "select_features": select_features,
        "fill_null_features": fill_null_features,
        "assemble_features": assemble_features,
        "assembled_values": assembled_values,
        "rf_stockout_rows": rf_stockout_rows,
        "rf_reorder_point_rows": rf_reorder_point_rows,
        "score_products_rows": score_products_rows,
        "feature_importance_rows": feature_importance_rows,
        "auc_model_agreement": auc_model_agreement,
        "train_test_split": train_test_split,
        "rf_stockout": rf_stockout,
        "auc_exact": auc_exact,
        "auc_model": auc_model,
        "rf_reorder_point": rf_reorder_point,
        "regression_metrics": regression_metrics,
        "regression_metrics_model": regression_metrics_model,
        "score_products": score_products,
        "feature_importance": feature_importance,
        "recommendations_from_model_output": recommendations_from_model_output,
    }
