"""Restock recommendations from a scored product table.

Input columns: ``product_id, stock_on_hand, predicted_stockout, predicted_rop``.
NaN is treated as missing before any rule runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.columns import null_if_nan

# Priority labels and the narrative text attached to each.
HIGH, MEDIUM, LOW = "HIGH", "MEDIUM", "LOW"
INSIGHTS = {
    HIGH: ("Produk ini berisiko tinggi mengalami stockout. "
           "Disarankan segera melakukan restock untuk menghindari kehilangan penjualan."),
    MEDIUM: ("Produk menunjukkan potensi stockout dalam waktu dekat. "
             "Monitoring dan restock dalam waktu dekat sangat disarankan."),
    LOW: ("Stok produk masih dalam kondisi aman. "
          "Belum diperlukan tindakan restock dalam waktu dekat."),
}
PRIORITY_ORDER = (HIGH, MEDIUM, LOW)
SCORE_COLUMNS = ("predicted_stockout", "predicted_rop", "stock_on_hand")


def _num(name: str) -> Column:
    return null_if_nan(F.col(name).cast(T.DoubleType()))


def priority() -> Column:
    """HIGH: predicted stockout and ROP above stock; MEDIUM: stockout otherwise; else LOW."""
    return (
        F.when(_num("predicted_stockout") == 1,
               F.when(_num("predicted_rop") > _num("stock_on_hand"), F.lit(HIGH)).otherwise(F.lit(MEDIUM)))
        .otherwise(F.lit(LOW))
    )


def recommended_order() -> Column:
    """max(ROP − stock, 0); missing inputs stay missing."""
    gap = _num("predicted_rop") - _num("stock_on_hand")
    return F.when(gap.isNotNull(), F.greatest(gap, F.lit(0.0)))


def insight(priority_col: Column) -> Column:
    return (
        F.when(priority_col == HIGH, F.lit(INSIGHTS[HIGH]))
        .when(priority_col == MEDIUM, F.lit(INSIGHTS[MEDIUM]))
        .otherwise(F.lit(INSIGHTS[LOW]))
    )


def recommendations(scored: DataFrame) -> DataFrame:
    """Every input column, then priority, recommended_order and insight (which replace columns of these names).

    Only ``predicted_stockout``, ``predicted_rop`` and ``stock_on_hand`` are needed.
    """
    kept = [f"`{c}`" for c in scored.columns if c not in ("priority", "recommended_order", "insight")]
    base = scored.select(*kept, priority().alias("priority"), recommended_order().alias("recommended_order"))
    return base.withColumn("insight", insight(F.col("priority")))


def priority_summary(recs: DataFrame) -> DataFrame:
    """Count per priority, zero-filled (all three classes always present)."""
    counts = recs.agg(*[F.count(F.when(F.col("priority") == p, 1)).alias(p) for p in PRIORITY_ORDER])
    stack = ", ".join(f"'{p}', `{p}`" for p in PRIORITY_ORDER)
    return counts.selectExpr(f"stack({len(PRIORITY_ORDER)}, {stack}) AS (priority, n_products)")


def priority_rank(col: Column) -> Column:
    return F.when(col == HIGH, 0).when(col == MEDIUM, 1).otherwise(2)


def recommendation_sample(recs: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` by priority, then largest order, then product id."""
    return (
        recs.select("product_id", "stock_on_hand", "predicted_rop", "priority", "recommended_order", "insight")
        .orderBy(priority_rank(F.col("priority")), F.col("recommended_order").desc_nulls_last(),
                 F.col("product_id").asc())
        .limit(n)
    )


def scored_from_gold(gold: DataFrame) -> DataFrame:
    """Exact scores (the gold targets themselves) for an oracle-checkable run."""
    return gold.select("product_id", "stock_on_hand",
                       F.col("stockout_risk").alias("predicted_stockout"),
                       F.col("reorder_point").alias("predicted_rop"))
