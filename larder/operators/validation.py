"""Checks and summaries of the gold table: target balance, feature statistics, a sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The columns whose statistics are reported, in order.
STAT_FEATURES = ("daily_sales_velocity", "stock_on_hand", "procurement_lead_time",
                 "order_buffer_index", "safety_stock", "reorder_point")


def target_balance(gold: DataFrame) -> DataFrame:
    """One row: products, those at risk and safe, and both as percentages (0 for an empty table)."""
    risk = F.count(F.when(F.col("stockout_risk") == 1, 1))
    safe = F.count(F.when(F.col("stockout_risk") == 0, 1))
    agg = gold.agg(F.count(F.lit(1)).alias("total_products"), risk.alias("at_risk"), safe.alias("safe"))
    denom = F.greatest(F.col("total_products"), F.lit(1))
    return agg.select(
        "total_products", "at_risk", "safe",
        F.round(100.0 * F.col("at_risk") / denom, 1).alias("pct_at_risk"),
        F.round(100.0 * F.col("safe") / denom, 1).alias("pct_safe"),
    )


def feature_stats(gold: DataFrame) -> DataFrame:
    """``feature, n, mean, stddev, min, max`` of each reported column, from one pass."""
    aggs = []
    for f in STAT_FEATURES:
        aggs += [F.count(f).alias(f"{f}__n"), F.avg(f).alias(f"{f}__mean"), F.stddev_samp(f).alias(f"{f}__sd"),
                 F.min(f).alias(f"{f}__min"), F.max(f).alias(f"{f}__max")]
    rows = F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f"{f}__n").alias("n"), F.col(f"{f}__mean").alias("mean"),
                 F.col(f"{f}__sd").alias("stddev"), F.col(f"{f}__min").alias("min"), F.col(f"{f}__max").alias("max"))
        for f in STAT_FEATURES
    ])
    out = gold.agg(*aggs).select(F.inline(rows))
    return out.select("feature", "n", F.round("mean", 6).alias("mean"), F.round("stddev", 6).alias("stddev"),
                      "min", "max")


def gold_sample(gold: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` products by id."""
    return gold.orderBy("product_id").limit(n)
