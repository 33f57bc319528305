"""Stock-performance, supplier and anomaly reports over silver and gold.

These reports are described only in words (no thresholds or formulas), so
the definitions, thresholds and ratios below are ours and are arguments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.lineage import stage
from larder.functions.skew import hot_keys, replicate_for_salts, salt_rows
from larder.operators.cleaning import dedup_by_key
from larder.functions.ranking import with_dense_ranks
from larder.operators.features import canonical_inventory, one_row_per_product, with_key_as
from larder.functions.roles import resolve_inventory_roles, resolve_transaction_roles
from larder.functions.columns import same_key, to_double

# Status labels.
LOW_STOCK = "Low Stock"
HEALTHY = "Healthy"
OVERSTOCK = "Overstock"


def enriched_movements(trx: DataFrame, inv: DataFrame, sup: DataFrame,
                       supplier_key: str = "supplier_ref", supplier_id: str = "supplier_id",
                       product_attrs: tuple[str, ...] = ("product_name", "category"),
                       supplier_attrs: tuple[str, ...] = ("supplier_name",)) -> DataFrame:
    """Movements with product and supplier attributes (left joins on both keys).

    Two joins to dimensions of one row per key: one scan of the movements, no
    join multiplies rows, and the movements are shuffled once per dimension
    that AQE cannot broadcast. Distinct (product, supplier) pairs would not be
    a smaller table to enrich: almost every movement has its own pair. Hot
    keys are split by AQE's skew join.
    """
    r = resolve_transaction_roles(trx.columns)
    ir = resolve_inventory_roles(inv.columns)
    products = inv.select(inv[ir.product].alias("_p"), *[inv[a] for a in product_attrs])
    suppliers = sup.select(sup[supplier_id].alias("_s"), *[sup[a] for a in supplier_attrs])
    products = dedup_by_key(with_key_as(products, "_p", trx.schema[r.product].dataType), "_p")
    suppliers = dedup_by_key(with_key_as(suppliers, "_s", trx.schema[supplier_key].dataType), "_s")
    return (
        trx.join(products, same_key(trx, r.product, products, "_p"), "left")
        .join(suppliers, same_key(trx, supplier_key, suppliers, "_s"), "left")
        .drop("_p", "_s")
    )


def _in_out(trx: DataFrame, key_type: T.DataType) -> DataFrame:
    r = resolve_transaction_roles(trx.columns)
    q = to_double(trx[r.quantity])
    return (
        with_key_as(trx.select(trx[r.product].alias("_moved"), q.alias("q")), "_moved", key_type)
        .groupBy("_moved")
        .agg(F.sum(F.when(F.col("q") > 0, F.col("q"))).alias("total_in"),
             (-F.sum(F.when(F.col("q") < 0, F.col("q")))).alias("total_out"))
    )


def inventory_performance_report(trx: DataFrame, inv: DataFrame) -> DataFrame:
    """Per product: initial stock, total in, total out, final (unfloored) balance."""
    stock = one_row_per_product(canonical_inventory(inv))
    moves = _in_out(trx, stock.schema["product_id"].dataType)
    j = stock.join(moves, same_key(stock, "product_id", moves, "_moved"), "left")
    t_in = F.coalesce(F.col("total_in"), F.lit(0.0))
    t_out = F.coalesce(F.col("total_out"), F.lit(0.0))
    return j.select(
        "product_id",
        F.col("initial_stock").alias("initial_stock_quantity"),
        t_in.alias("total_in"),
        t_out.alias("total_out"),
        (F.col("initial_stock") + t_in - t_out).alias("final_balance"),
    )


def _supplier_products(trx: DataFrame, supplier_key: str) -> DataFrame:
    """(supplier, product) pairs with their inbound quantity (map-side combined)."""
    r = resolve_transaction_roles(trx.columns)
    q = to_double(trx[r.quantity])
    return (
        trx.select(trx[supplier_key].alias("supplier_id"), trx[r.product].alias("product_id"),
                   F.when(q > 0, q).alias("inbound"))
        .groupBy("supplier_id", "product_id")
        .agg(F.sum("inbound").alias("inbound"))
    )


def supplier_efficiency_metrics(trx: DataFrame, supplier_key: str = "supplier_ref") -> DataFrame:
    """Per supplier: products supplied (inbound > 0), inbound quantity, share of all inbound.

    Two-level aggregation (pair, then supplier) instead of a distinct count:
    both levels combine map-side, so a dominant supplier is not one hot task.
    """
    pairs = _supplier_products(trx, supplier_key)
    per = pairs.groupBy("supplier_id").agg(
        F.count(F.when(F.col("inbound") > 0, 1)).alias("n_products"),
        F.coalesce(F.sum("inbound"), F.lit(0.0)).alias("inbound_quantity"),
    )
    # The total comes from the suppliers, whose pair exchange is reused, so the movements are read once.
    # One reference to it: NULL (not an error) when nothing came in.
    total_inbound = per.select(F.sum("inbound_quantity")).scalar()
    return per.withColumn("inbound_share", F.col("inbound_quantity") / F.nullif(total_inbound, F.lit(0.0)))


def inventory_status(gold: DataFrame, overstock_factor: float = 3.0) -> Column:
    """Low Stock: stock ≤ reorder point; Overstock: stock > k × reorder point."""
    soh, rop = F.col("stock_on_hand"), F.col("reorder_point")
    return (
        F.when(soh <= rop, F.lit(LOW_STOCK))
        .when(soh > rop * overstock_factor, F.lit(OVERSTOCK))
        .otherwise(F.lit(HEALTHY))
    )


def with_inventory_status(gold: DataFrame, overstock_factor: float = 3.0) -> DataFrame:
    return gold.select("product_id", "stock_on_hand", "reorder_point",
                       inventory_status(gold, overstock_factor).alias("inventory_status"))


def restock_list(gold: DataFrame, overstock_factor: float = 3.0) -> DataFrame:
    """Low Stock products, largest shortfall first (all of them, no cap)."""
    s = with_inventory_status(gold, overstock_factor)
    return (
        s.where(F.col("inventory_status") == LOW_STOCK)
        .select("product_id", "stock_on_hand", "reorder_point",
                (F.col("reorder_point") - F.col("stock_on_hand")).alias("shortfall"))
        .orderBy(F.col("shortfall").desc(), F.col("product_id").asc())
    )


def supplier_review(trx: DataFrame, gold: DataFrame, supplier_key: str = "supplier_ref",
                    n_buckets: int | None = None) -> DataFrame:
    """Supplier activity and availability, ranked.

    ``stable_share`` is the share of a supplier's supplied products (inbound > 0)
    that are not at stockout risk. Ranks are global dense ranks computed by
    value range, in one pass for both, not by a single-partition window.
    """
    pairs = _supplier_products(trx, supplier_key).where(F.col("inbound") > 0)
    risk = gold.select(gold["product_id"].alias("_rated"), "stockout_risk")
    per = (
        pairs.join(risk, same_key(pairs, "product_id", risk, "_rated"), "left")
        .groupBy("supplier_id")
        .agg(
            F.count(F.lit(1)).alias("n_products"),
            F.sum("inbound").alias("inbound_quantity"),
            F.count(F.when(F.col("stockout_risk") == 0, 1)).alias("n_stable"),
            F.count("stockout_risk").alias("n_rated"),
        )
        .withColumn("stable_share", F.when(F.col("n_rated") > 0, F.col("n_stable") / F.col("n_rated")))
    )
    # Supplier-grain: written once; both rankings come from one range shuffle of their distinct values.
    per = stage(per, "supplier-review")
    out = with_dense_ranks(per, {"activity_rank": "n_products", "stability_rank": "stable_share"}, n_buckets=n_buckets)
    return out.select("supplier_id", "n_products", "inbound_quantity", "n_stable", "n_rated",
                      "stable_share", "activity_rank", "stability_rank")


def outflow_anomalies(sales: DataFrame, product_col: str, quantity_col: str, k: float = 3.0) -> DataFrame:
    """Outgoing rows whose |quantity| exceeds mean + k·stddev of their product.

    Per-product statistics are a partial aggregate (staged once); the rows are
    joined back to them by product — no window, so a hot product is never one
    task. Products of many rows are salted by their number (see
    ``functions.skew``), so the join spreads them even without AQE.
    """
    out = sales.withColumn("_outflow", F.abs(to_double(sales[quantity_col])))
    stats = stage(
        out.groupBy(F.col(product_col).alias("_p")).agg(
            F.avg("_outflow").alias("mean_outflow"), F.stddev_samp("_outflow").alias("stddev_outflow"),
            F.count(F.lit(1)).alias("_n")),
        "outflow-stats")
    hot = hot_keys(stats, "_p", "_n")
    rows = salt_rows(out, out[product_col], hot)
    stats_salted = replicate_for_salts(stats.drop("_n"), stats["_p"], hot).withColumnRenamed("_salt", "_s")
    j = rows.join(stats_salted, (rows[product_col] == stats_salted["_p"]) & (rows["_salt"] == stats_salted["_s"]),
                  "inner")
    flagged = j.where(F.col("_outflow") > F.col("mean_outflow") + F.lit(k) * F.col("stddev_outflow"))
    return flagged.drop("_p", "_s", "_salt").withColumnRenamed("_outflow", "outflow")


def top_k_velocity(gold: DataFrame, k: int = 20) -> DataFrame:
    """Fastest-selling products (top-k; ties broken by product id)."""
    return (
        gold.select("product_id", "daily_sales_velocity", "total_sales", "active_days")
        .orderBy(F.col("daily_sales_velocity").desc_nulls_last(), F.col("product_id").asc())
        .limit(k)
    )
