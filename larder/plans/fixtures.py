"""Project the driver's test tables into the three input datasets.

No source data comes with the specification; the inputs are known only by
the column-name patterns the roles look for. These projections (see FIXTURES.md) give every role a
column and reach the NULL / unmatched branches. The modulo conditions below
only *set values* (NULLs, malformed text, unmatched keys) inside full-size
tables; no row is filtered out and no query runs on a subset of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _type_and_quantity(returnflag, linestatus, qty, sale_label: str):
    ttype = (
        F.when(returnflag == "A", F.lit(sale_label))
        .when(returnflag == "R", F.lit("adjustment"))
        .when(returnflag == "N", F.lit("purchase"))
    )
    signed = (
        F.when(returnflag == "A", -qty)
        .when(returnflag == "N", qty)
        .when((returnflag == "R") & (linestatus == "F"), qty)
        .when((returnflag == "R") & (linestatus == "O"), -qty)
    )
    return ttype, signed


def stock_move(spark: SparkSession, sf_dir: str, sale_label: str = " sale ") -> DataFrame:
    """Stock movements from ``lineitem`` (signed quantities).

    ``sale_label=" movement "`` gives the variant without any sale-typed row.
    """
    li = table(spark, sf_dir, "lineitem")
    ttype, signed = _type_and_quantity(li["l_returnflag"], li["l_linestatus"], li["l_quantity"], sale_label)
    return li.select(
        li["l_orderkey"].alias("order_ref"),
        li["l_linenumber"].alias("line_no"),
        li["l_suppkey"].alias("supplier_ref"),
        li["l_partkey"].alias("product_id"),
        ttype.alias("transaction_type"),
        signed.alias("quantity_change"),
        li["l_shipdate"].alias("transaction_date"),
    )


def stock_move_with_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movements plus a non-unique ``id`` (a ready-made duplicate-key case)."""
    mv = stock_move(spark, sf_dir)
    return mv.select((mv["order_ref"] * 8 + mv["line_no"]).alias("id"), *mv.columns)


def stock_move_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movements with text dates and a text ``quantity``; some values malformed."""
    mv = stock_move(spark, sf_dir)
    seq = mv["order_ref"] * 8 + mv["line_no"]
    as_text = F.date_format(mv["transaction_date"], "yyyy-MM-dd HH:mm:ss")
    date_text = F.when(seq % 97 == 0, F.lit("bad")).when(seq % 89 == 0, F.lit("")).otherwise(as_text)
    qty_text = (
        F.when(seq % 97 == 0, F.lit("bad")).when(seq % 89 == 0, F.lit(None).cast("string"))
        .otherwise(mv["quantity_change"].cast("string"))
    )
    return mv.select(
        "order_ref", "line_no", "product_id", "transaction_type",
        qty_text.alias("quantity"), date_text.alias("transaction_date"),
    )


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory from ``part``: stock, reorder level, price and order dates."""
    p = table(spark, sf_dir, "part")
    key = p["p_partkey"]
    last_order = F.date_add(F.lit("2001-01-01").cast("date"), (key % 365).cast("int"))
    return p.select(
        key.alias("product_id"),
        p["p_name"].alias("product_name"),
        p["p_type"].alias("category"),
        (p["p_size"] * 10).cast(T.DoubleType()).alias("stock_quantity"),
        F.when(key % 13 == 0, F.lit(None)).otherwise(p["p_size"].cast(T.DoubleType())).alias("reorder_level"),
        F.when(key % 7 == 0, F.lit(None)).otherwise(p["p_retailprice"]).alias("unit_price"),
        last_order.alias("last_order_date"),
        F.when(key % 11 == 0, F.lit(None).cast("date"))
        .otherwise(F.date_add(last_order, (key % 15).cast("int"))).alias("date_received"),
    )


def suppliers_per_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Case A: one supplier row per product; every ninth record carries no
    product reference (NULL), so those products stay unmatched."""
    li = table(spark, sf_dir, "lineitem")
    agg = li.groupBy("l_partkey").agg(F.min("l_suppkey").alias("supplier_id"))
    return agg.select(
        F.when(agg["l_partkey"] % 9 == 0, F.lit(None).cast("bigint")).otherwise(agg["l_partkey"]).alias("product_id"),
        "supplier_id",
        F.when(agg["l_partkey"] % 17 == 0, F.lit(None).cast(T.DoubleType()))
        .otherwise((agg["supplier_id"] % 14 + 1).cast(T.DoubleType())).alias("avg_lead_time_days"),
    )


def suppliers_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Case A′: one row per distinct (product, supplier) — several per product."""
    li = table(spark, sf_dir, "lineitem")
    pairs = li.select(li["l_partkey"].alias("product_id"), li["l_suppkey"].alias("supplier_id")).distinct()
    return pairs.select(
        "product_id", "supplier_id",
        F.when(pairs["product_id"] % 17 == 0, F.lit(None).cast(T.DoubleType()))
        .otherwise((pairs["supplier_id"] % 14 + 1).cast(T.DoubleType())).alias("avg_lead_time_days"),
    )


def suppliers_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Case B: supplier rows without a product column."""
    s = table(spark, sf_dir, "supplier")
    return s.select(
        s["s_suppkey"].alias("supplier_id"),
        s["s_name"].alias("supplier_name"),
        (s["s_suppkey"] % 14 + 1).cast(T.DoubleType()).alias("avg_lead_time_days"),
    )


def suppliers_no_lead(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Case C: supplier rows without a lead-time column."""
    s = table(spark, sf_dir, "supplier")
    return s.select(s["s_suppkey"].alias("supplier_id"), s["s_name"].alias("supplier_name"))


def raw_named_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory under free-form source names (for the name normalisers)."""
    inv = inventory(spark, sf_dir)
    return inv.select(
        inv["product_id"].alias(" Product ID "),
        inv["product_name"].alias("Product-Name"),
        inv["unit_price"].alias("Unit - Price"),
        inv["date_received"].alias("Date/Received"),
        inv["stock_quantity"].alias("Stock Quantity"),
    )


def raw_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier rows as landed: ``id``, padded names, free-form headers."""
    s = table(spark, sf_dir, "supplier")
    return s.select(
        s["s_suppkey"].alias("id"),
        F.concat(F.lit("  "), s["s_name"], F.lit(" ")).alias(" Supplier Name"),
        (s["s_suppkey"] % 14 + 1).cast(T.DoubleType()).alias("Avg Lead-Time Days"),
    )
