"""Named queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the test tables (through the fixture projections and the
written silver / gold layers) over their full size; nothing is sampled or
capped except where a limit is the feature (top-k, samples).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.roles import resolve_transaction_roles
from larder.plans.model_catalog import model_queries
from larder.plans.table_catalog import queries as table_queries
from larder.operators import cleaning as C
from larder.operators import features as G
from larder.operators import recommend as R
from larder.operators import reports as D
from larder.operators import validation as V
from larder.plans import fixtures as fx
from larder.plans.layers import (
    gold_table,
    silver_inventory,
    silver_suppliers,
    silver_tables,
    silver_transactions,
)
from larder.session import scratch_path
from larder.sources import readers as io_in
from larder.sources import writers as io_out
from larder.plans.jobs import SILVER, run_silver
from larder.sources.landing import land_bronze, land_raw_documents
from larder.streaming.landing import land_movements_incrementally

Query = Callable[[SparkSession, str], DataFrame]

STOCK_MOVE_SCHEMA = T.StructType([
    T.StructField("order_ref", T.LongType()), T.StructField("line_no", T.IntegerType()),
    T.StructField("supplier_ref", T.LongType()), T.StructField("product_id", T.LongType()),
    T.StructField("transaction_type", T.StringType()), T.StructField("quantity_change", T.DoubleType()),
    T.StructField("transaction_date", T.TimestampNTZType()),
])
INVENTORY_SCHEMA = T.StructType([
    T.StructField("product_id", T.LongType()), T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()), T.StructField("stock_quantity", T.DoubleType()),
    T.StructField("reorder_level", T.DoubleType()), T.StructField("unit_price", T.DoubleType()),
    T.StructField("last_order_date", T.DateType()), T.StructField("date_received", T.DateType()),
])
SUPPLIER_A_SCHEMA = T.StructType([
    T.StructField("product_id", T.LongType()), T.StructField("supplier_id", T.LongType()),
    T.StructField("avg_lead_time_days", T.DoubleType()),
])
RECOMMENDATION_SCHEMA = T.StructType([
    T.StructField("product_id", T.LongType()), T.StructField("stock_on_hand", T.DoubleType()),
    T.StructField("predicted_stockout", T.IntegerType()), T.StructField("predicted_rop", T.DoubleType()),
    T.StructField("priority", T.StringType()), T.StructField("recommended_order", T.DoubleType()),
    T.StructField("insight", T.StringType()),
])

OUTFLOW_K = 1.5      # stddev multiplier for the anomaly report
TOP_K = 20           # size of the fastest-sellers report
OVERSTOCK_FACTOR = 3.0


# ------------------------------------------------------------------ sources / sinks

def scan_parquet(spark, sf):
    return fx.stock_move(spark, sf)


def scan_csv(spark, sf):
    path = scratch_path(spark, "inventory-csv")
    io_out.write_csv(fx.inventory(spark, sf), path)
    return io_in.read_csv(spark, path, schema=INVENTORY_SCHEMA)


def scan_json_multiline(spark, sf):
    path = scratch_path(spark, "suppliers-json")
    io_out.write_json_documents(fx.suppliers_per_product(spark, sf), path)
    return io_in.read_json_documents(spark, path, schema=SUPPLIER_A_SCHEMA)


def sink_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "recommendations-csv")
    io_out.write_csv(R.recommendations(R.scored_from_gold(gold_table(spark, sf))), path)
    return io_in.read_csv(spark, path, schema=RECOMMENDATION_SCHEMA)


def sink_parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "gold-parquet")
    io_out.write_parquet(G.gold_features(*silver_tables(spark, sf)), path)
    return spark.read.parquet(path)


def sink_parquet_single_file(spark, sf):
    """Compact output: one file at this scale, size-bounded files beyond it
    (never one task for the whole table)."""
    path = scratch_path(spark, "gold-compact")
    io_out.write_parquet(G.gold_features(*silver_tables(spark, sf)), path, compact=True)
    return spark.read.parquet(path)


def land_raw_files(spark, sf):
    """Land supplier documents as raw bytes, then read the records back out of
    the landed bytes: any altered byte would show up as a value mismatch."""
    docs = scratch_path(spark, "supplier-docs")
    io_out.write_json_documents(fx.suppliers_per_product(spark, sf), docs)
    landed = land_raw_documents(spark, docs, scratch_path(spark, "raw-docs"), glob="part-*")
    return io_in.parse_json_documents(landed, SUPPLIER_A_SCHEMA)


def _landed(spark, sf):
    inv_csv = scratch_path(spark, "inventory-src")
    io_out.write_csv(fx.inventory(spark, sf), inv_csv)
    docs = scratch_path(spark, "supplier-src")
    io_out.write_json_documents(fx.suppliers_per_product(spark, sf), docs)
    return land_bronze(spark, fx.stock_move(spark, sf), inv_csv, docs,
                       scratch_path(spark, "raw"), inventory_schema=INVENTORY_SCHEMA, documents_glob="part-*")


def bronze_landing(spark, sf):
    landed = _landed(spark, sf)
    suppliers = io_in.parse_json_documents(landed["suppliers"], SUPPLIER_A_SCHEMA)
    return C.layer_counts({
        "stock_transactions": landed["stock_transactions"],
        "grocery_inventory": landed["grocery_inventory"],
        "suppliers": suppliers,
    })


def bronze_movements(spark, sf):
    return _landed(spark, sf)["stock_transactions"]


def bronze_inventory(spark, sf):
    return _landed(spark, sf)["grocery_inventory"]


def bronze_suppliers(spark, sf):
    return io_in.parse_json_documents(_landed(spark, sf)["suppliers"], SUPPLIER_A_SCHEMA)


def bronze_landing_incremental(spark, sf):
    src = scratch_path(spark, "movement-files")
    io_out.write_parquet(fx.stock_move(spark, sf), src)
    return land_movements_incrementally(spark, src, STOCK_MOVE_SCHEMA, scratch_path(spark, "raw-moves"),
                                        scratch_path(spark, "stream-ckpt"))


def gold_from_landed_files(spark, sf):
    """Bronze files → silver → gold, reading text formats with schema
    inference as the source systems deliver them (CSV with header, JSON
    documents). Keys are cast to bigint at the end for a stable schema."""
    moves, inv, docs = (scratch_path(spark, n) for n in ("e2e-moves", "e2e-inventory", "e2e-suppliers"))
    io_out.write_csv(fx.stock_move(spark, sf), moves)
    io_out.write_csv(fx.inventory(spark, sf), inv)
    io_out.write_json_documents(fx.suppliers_per_product(spark, sf), docs)
    trx = C.clean_transactions(io_in.read_csv(spark, moves, infer_schema=True))
    inventory = C.clean_inventory(io_in.read_csv(spark, inv, infer_schema=True))
    suppliers = C.clean_suppliers(io_in.read_json_documents(spark, docs))
    gold = G.gold_features(trx, inventory, suppliers)
    return gold.withColumn("product_id", F.col("product_id").cast("bigint")).withColumn(
        "supplier_product_ref", F.col("supplier_product_ref").cast("bigint"))


# ------------------------------------------------------------------ cleaning

def normalize_columns(spark, sf):
    return C.normalize_columns(fx.raw_named_inventory(spark, sf))


def normalize_columns_collapsed(spark, sf):
    return C.normalize_columns(fx.raw_named_inventory(spark, sf), collapse=True)


def trim_strings(spark, sf):
    return C.trim_strings(fx.stock_move(spark, sf))


def parse_datetimes(spark, sf):
    return C.parse_datetimes(fx.stock_move_dirty(spark, sf))


def cast_quantity_default(spark, sf):
    return C.cast_with_default(fx.stock_move_dirty(spark, sf), "quantity", 0.0)


def cast_price(spark, sf):
    inv = fx.inventory(spark, sf)
    as_text = inv.select("product_id", inv["unit_price"].cast("string").alias("unit_price"))
    return C.cast_price(as_text)


def approx_median(spark, sf):
    return C.approx_median(fx.inventory(spark, sf), "unit_price")


def impute_median(spark, sf):
    return C.impute_median(fx.inventory(spark, sf).select("product_id", "unit_price"), "unit_price")


def generate_transaction_id(spark, sf):
    return C.with_transaction_id(fx.stock_move(spark, sf))


def dedup_by_key(spark, sf):
    return C.dedup_by_key(fx.stock_move_with_id(spark, sf), "id")


def dedup_rows(spark, sf):
    mv = fx.stock_move(spark, sf)
    return C.dedup_rows(mv.unionByName(mv.where(F.col("transaction_type") == "adjustment")))


def rename_supplier_id(spark, sf):
    return C.rename_supplier_id(C.normalize_columns(fx.raw_suppliers(spark, sf)))


def layer_counts(spark, sf):
    trx, inv, sup = silver_tables(spark, sf)
    return C.layer_counts({"transactions": trx, "inventory": inv, "suppliers": sup})


def clean_transactions(spark, sf):
    return C.clean_transactions(fx.stock_move(spark, sf))


def clean_inventory(spark, sf):
    return C.clean_inventory(fx.inventory(spark, sf))


def clean_suppliers(spark, sf):
    return C.clean_suppliers(fx.raw_suppliers(spark, sf))


def resolve_roles(spark, sf):
    return G.canonical_movements(fx.stock_move(spark, sf))


# ------------------------------------------------------------------ gold

def _wide(spark, sf, suppliers="per_product", inventory=None):
    trx, inv, sup = silver_tables(spark, sf, suppliers)
    if inventory is not None:
        inv = inventory(inv)
    return G.gold_wide(G.prepare_inputs(trx, inv, sup))


def _summary(spark, sf, sale_label=" sale "):
    return G.movement_summary(G.canonical_movements(silver_transactions(spark, sf, sale_label)))


def _wide_cols(*cols, suppliers="per_product"):
    """Select from the wide gold frame; a ``(source, alias)`` pair renames."""
    def run(spark, sf):
        picked = [F.col(c[0]).alias(c[1]) if isinstance(c, tuple) else F.col(c) for c in cols]
        return _wide(spark, sf, suppliers).select("product_id", *picked)
    return run


def canonical_casts(spark, sf):
    return G.canonical_inventory(silver_inventory(spark, sf))


def filter_sales(spark, sf):
    return G.filter_sales(G.canonical_movements(silver_transactions(spark, sf)))


def filter_sales_fallback(spark, sf):
    return G.filter_sales_with_fallback(G.canonical_movements(silver_transactions(spark, sf, " movement ")))


def total_sales(spark, sf):
    return G.sales_features(_summary(spark, sf)).select("product_id", "total_sales")


def active_days(spark, sf):
    return G.sales_features(_summary(spark, sf)).select("product_id", "active_days")


def sales_velocity(spark, sf):
    return G.sales_features(_summary(spark, sf))


def sales_velocity_fallback(spark, sf):
    return G.sales_features(_summary(spark, sf, " movement "))


def net_movement(spark, sf):
    return _summary(spark, sf).select("product_id", "net_quantity")


def gold_features(spark, sf):
    return G.gold_features(*silver_tables(spark, sf))


def gold_features_keyed_dedup(spark, sf):
    """Gold over movements deduplicated by their ``id`` at silver."""
    from larder.plans.layers import silver_transactions_with_id

    return G.gold_features(silver_transactions_with_id(spark, sf), silver_inventory(spark, sf),
                           silver_suppliers(spark, sf))


def gold_features_fan_out(spark, sf):
    return G.gold_features(*silver_tables(spark, sf, "fan_out"))


def gold_features_global_lead(spark, sf):
    return G.gold_features(*silver_tables(spark, sf, "global"))


def gold_features_default_lead(spark, sf):
    return G.gold_features(*silver_tables(spark, sf, "none"))


def reorder_point_formula_only(spark, sf):
    return _wide(spark, sf, inventory=lambda inv: inv.drop("reorder_level")).select("product_id", "reorder_point")


def gold_validation(spark, sf):
    return V.target_balance(gold_table(spark, sf))


def feature_stats(spark, sf):
    return V.feature_stats(gold_table(spark, sf))


def gold_sample(spark, sf):
    return V.gold_sample(gold_table(spark, sf))


def _text_keyed(df, key, by):
    """``key`` as text, spelled in three ways."""
    n, text = F.col(by) % 3, F.col(key).cast("string")
    return df.withColumn(key, F.when(n == 0, F.concat(F.lit(" 0"), text)).when(
        n == 1, F.concat(text, F.lit(".0"))).otherwise(text))


def gold_features_text_keys(spark, sf):
    """Movements and suppliers with text keys, some of no product, against inventory with numeric ones."""
    trx, inv, sup = silver_tables(spark, sf)
    odd = trx.where("line_no = 1").withColumn("product_id", F.concat(F.lit("A"), F.col("order_ref")))
    trx = _text_keyed(trx, "product_id", "order_ref").unionByName(odd)
    gold = G.gold_features(trx, inv, _text_keyed(sup, "product_id", "product_id"))
    return gold.withColumn("supplier_product_ref", F.col("supplier_product_ref").cast("bigint"))


def gold_from_bronze(spark, sf):
    """Bronze landing → silver → gold, each reading only what the one before wrote."""
    raw, silver = scratch_path(spark, "chain-raw"), scratch_path(spark, "chain-silver")
    inv_csv, docs = scratch_path(spark, "chain-inventory"), scratch_path(spark, "chain-suppliers")
    io_out.write_csv(fx.inventory(spark, sf), inv_csv)
    io_out.write_json_documents(fx.suppliers_per_product(spark, sf), docs)
    land_bronze(spark, fx.stock_move(spark, sf), inv_csv, docs, raw, documents_glob="part-*")
    run_silver(spark, raw, silver, landed=True)
    gold = G.gold_features(*(spark.read.parquet(f"{silver}/{n}") for n in SILVER))
    return gold.withColumn("product_id", F.col("product_id").cast("bigint")).withColumn(
        "supplier_product_ref", F.col("supplier_product_ref").cast("bigint"))


# ------------------------------------------------------------------ recommendations

def _recs(spark, sf):
    return R.recommendations(R.scored_from_gold(gold_table(spark, sf)))


# ------------------------------------------------------------------ reports

def enriched_movements(spark, sf):
    trx = silver_transactions(spark, sf)
    out = D.enriched_movements(trx, silver_inventory(spark, sf), silver_suppliers(spark, sf, "global"))
    return out.select("order_ref", "line_no", "product_id", "supplier_ref", "transaction_type",
                      "quantity_change", "transaction_date", "product_name", "category", "supplier_name")


def inventory_performance_report(spark, sf):
    return D.inventory_performance_report(silver_transactions(spark, sf), silver_inventory(spark, sf))


def supplier_efficiency_metrics(spark, sf):
    return D.supplier_efficiency_metrics(silver_transactions(spark, sf))


def inventory_status(spark, sf):
    return D.with_inventory_status(gold_table(spark, sf), OVERSTOCK_FACTOR)


def restock_list(spark, sf):
    return D.restock_list(gold_table(spark, sf), OVERSTOCK_FACTOR)


def supplier_review(spark, sf):
    return D.supplier_review(silver_transactions(spark, sf), gold_table(spark, sf))


def outflow_anomalies(spark, sf):
    trx = silver_transactions(spark, sf)
    r = resolve_transaction_roles(trx.columns)
    sales = G.filter_sales_with_fallback(trx, r.type, r.quantity)
    out = D.outflow_anomalies(sales, r.product, r.quantity, k=OUTFLOW_K)
    return out.select("product_id", "order_ref", "line_no", "outflow",
                      F.round("mean_outflow", 6).alias("mean_outflow"),
                      F.round("stddev_outflow", 6).alias("stddev_outflow"))


def top_k_velocity(spark, sf):
    return D.top_k_velocity(gold_table(spark, sf), TOP_K)


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        # sources and sinks
        "scan_parquet": scan_parquet,
        "scan_csv": scan_csv,
        "scan_json_multiline": scan_json_multiline,
        "sink_csv_roundtrip": sink_csv_roundtrip,
        "sink_parquet_roundtrip": sink_parquet_roundtrip,
        "sink_parquet_single_file": sink_parquet_single_file,
        "land_raw_files": land_raw_files,
        "bronze_landing": bronze_landing,
        "bronze_movements": bronze_movements,
        "bronze_inventory": bronze_inventory,
        "bronze_suppliers": bronze_suppliers,
        "bronze_landing_incremental": bronze_landing_incremental,
        "gold_from_landed_files": gold_from_landed_files,
        # cleaning
        "normalize_columns": normalize_columns,
        "normalize_columns_collapsed": normalize_columns_collapsed,
        "trim_strings": trim_strings,
        "parse_datetimes": parse_datetimes,
        "cast_quantity_default": cast_quantity_default,
        "cast_price": cast_price,
        "approx_median": approx_median,
        "impute_median": impute_median,
        "generate_transaction_id": generate_transaction_id,
        "dedup_by_key": dedup_by_key,
        "dedup_rows": dedup_rows,
        "rename_supplier_id": rename_supplier_id,
        "layer_counts": layer_counts,
        "clean_transactions": clean_transactions,
        "clean_inventory": clean_inventory,
        "clean_suppliers": clean_suppliers,
        "resolve_roles": resolve_roles,
        # gold
        "canonical_casts": canonical_casts,
        "filter_sales": filter_sales,
        "filter_sales_fallback": filter_sales_fallback,
        "total_sales": total_sales,
        "active_days": active_days,
        "sales_velocity": sales_velocity,
        "sales_velocity_fallback": sales_velocity_fallback,
        "net_movement": net_movement,
        "stock_balance": _wide_cols("initial_stock", "net_quantity", "stock_balance"),
        "stock_on_hand": _wide_cols("stock_on_hand"),
        "actual_lead_time": _wide_cols("actual_lead_time"),
        "supplier_lead_time": _wide_cols(("sup_product_id", "supplier_product_ref"),
                                         "avg_lead_time_days"),
        "supplier_lead_time_global": _wide_cols("avg_lead_time_days", suppliers="global"),
        "supplier_lead_time_default": _wide_cols("avg_lead_time_days", suppliers="none"),
        "procurement_lead_time": _wide_cols("actual_lead_time", "avg_lead_time_days", "procurement_lead_time"),
        "join_sales_features": _wide_cols("total_sales", "active_days", "daily_sales_velocity"),
        "order_buffer_index": _wide_cols("stock_on_hand", "daily_sales_velocity", "order_buffer_index"),
        "safety_stock": _wide_cols("safety_stock"),
        "stockout_risk": _wide_cols("stockout_risk"),
        "reorder_point": _wide_cols("reorder_point"),
        "reorder_point_formula_only": reorder_point_formula_only,
        "gold_features": gold_features,
        "gold_features_fan_out": gold_features_fan_out,
        "gold_features_keyed_dedup": gold_features_keyed_dedup,
        "gold_features_global_lead": gold_features_global_lead,
        "gold_features_default_lead": gold_features_default_lead,
        "gold_features_text_keys": gold_features_text_keys,
        "gold_from_bronze": gold_from_bronze,
        "gold_validation": gold_validation,
        "feature_stats": feature_stats,
        "gold_sample": gold_sample,
        # recommendations
        "priority": lambda s, d: _recs(s, d).select("product_id", "priority"),
        "recommended_order": lambda s, d: _recs(s, d).select("product_id", "recommended_order"),
        "insight_text": lambda s, d: _recs(s, d).select("product_id", "priority", "insight"),
        "priority_summary": lambda s, d: R.priority_summary(_recs(s, d)),
        "recommendation_sample": lambda s, d: R.recommendation_sample(_recs(s, d)),
        "recommendations": _recs,
        # reports
        "enriched_movements": enriched_movements,
        "inventory_performance_report": inventory_performance_report,
        "supplier_efficiency_metrics": supplier_efficiency_metrics,
        "inventory_status": inventory_status,
        "restock_list": restock_list,
        "supplier_review": supplier_review,
        "outflow_anomalies": outflow_anomalies,
        "top_k_velocity": top_k_velocity,
    }
    q.update(model_queries())
    q.update(table_queries())
    return q
