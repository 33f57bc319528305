"""Gold-layer features and targets, one product per row.

Plan shape (the fact table is scanned once):

    movements ─► agg (product, 64-day word) ─► agg ──────┐
    inventory ─► canonical ─► keyed dedup ──────────────┤ left joins on
    suppliers ─► canonical ─► keyed dedup (case A) ─────┘ product_id

All three sides end up hash-partitioned on ``product_id``, so the two left
joins share one partitioning. Aggregates combine map-side before any shuffle,
which also absorbs a hot product. The "no sale rows anywhere" fallback flag is
an EXISTS subquery (a limit-1 probe), so no count() action runs while the plan
is built and the common case reads almost nothing extra.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.columns import key_as, same_key, to_day, to_double
from larder.functions.roles import (
    InventoryRoles,
    SupplierRoles,
    TransactionRoles,
    resolve_inventory_roles,
    resolve_supplier_roles,
    resolve_transaction_roles,
)
from larder.operators.cleaning import dedup_by_key, normalize_columns

# The transaction types that count as a sale (compared after
# upper-casing), the default supplier lead time in days, and the output column
# order of the gold table.
SALE_TYPES = ("SALE", "SALES", "OUT", "KELUAR")
DEFAULT_LEAD_TIME_DAYS = 7.0
GOLD_COLUMNS = (
    "product_id", "supplier_product_ref", "initial_stock_quantity", "stock_on_hand",
    "total_sales", "active_days", "daily_sales_velocity", "actual_lead_time",
    "avg_lead_time_days", "procurement_lead_time", "order_buffer_index", "safety_stock",
    "historical_reorder_level", "stockout_risk", "reorder_point",
)

def _null_double() -> Column:
    return F.lit(None).cast(T.DoubleType())


# ------------------------------------------------------------ canonical forms

def canonical_movements(df: DataFrame, roles: TransactionRoles | None = None) -> DataFrame:
    """``product_id, txn_type, quantity (double), txn_day (date)`` by role."""
    r = roles or resolve_transaction_roles(df.columns)
    dtype = df.schema[r.date].dataType
    return df.select(
        df[r.product].alias("product_id"),
        df[r.type].alias("txn_type"),
        to_double(df[r.quantity]).alias("quantity"),
        to_day(df[r.date], dtype).alias("txn_day"),
    )


def canonical_inventory(df: DataFrame, roles: InventoryRoles | None = None) -> DataFrame:
    """``product_id, initial_stock, received_day, last_order_day[, reorder_level]``."""
    r = roles or resolve_inventory_roles(df.columns)
    schema = df.schema
    cols = [df[r.product].alias("product_id"), to_double(df[r.stock]).alias("initial_stock")]
    for role, name in ((r.date_received, "received_day"), (r.last_order, "last_order_day")):
        cols.append(to_day(df[role], schema[role].dataType).alias(name) if role else F.lit(None).cast("date").alias(name))
    if r.reorder_level:
        cols.append(to_double(df[r.reorder_level]).alias("reorder_level"))
    return df.select(*cols)


def with_key_as(df: DataFrame, key: str, wanted: T.DataType) -> DataFrame:
    """``key`` in the type of the products it joins (before grouping, so ``"7"`` and ``"07"`` are one product 7)."""
    return df.withColumn(key, key_as(df[key], df.schema[key].dataType, wanted))


def one_row_per_product(inv: DataFrame) -> DataFrame:
    """Keyed dedup of canonical inventory (deterministic row choice)."""
    return dedup_by_key(inv, "product_id")


def is_sale(type_col: Column) -> Column:
    return F.coalesce(F.upper(type_col).isin(*SALE_TYPES), F.lit(False))


# ------------------------------------------------------------ sales

def filter_sales(mv: DataFrame) -> DataFrame:
    """Rows whose upper-cased type is a sale type; NULL type excluded."""
    return mv.where(is_sale(mv["txn_type"]))


def filter_sales_with_fallback(mv: DataFrame, type_col: str = "txn_type", quantity_col: str = "quantity") -> DataFrame:
    """Sales rows; if the whole table has none, rows with quantity < 0."""
    sale = is_sale(mv[type_col])
    return mv.where(F.when(any_sale_row(mv, type_col), sale).otherwise(to_double(mv[quantity_col]) < 0))


def any_sale_row(mv: DataFrame, type_col: str = "txn_type") -> Column:
    """EXISTS subquery: does any row of the table have a sale type?

    Planned as a limit-1 probe, so it stops at the first sale row; only when
    the table has none does it read the whole (single) type column.
    """
    return mv.where(is_sale(mv[type_col])).exists()


#: Days of one calendar word: a long of the days (since 1970) that share ``day >> 6``.
DAY_WORD_BITS = 6


def _sums_and_days(mv: DataFrame, kinds: dict[str, Column]) -> DataFrame:
    """Per product and calendar word: the net quantity and, for each kind of row, its number, sum and day bits.

    Days are bits of mergeable words (``bit_or``) instead of a set of values:
    every aggregate is a primitive, so the plan is hash aggregation with code
    generation, combined map-side; a hot product spreads over its words. Rows
    without a day form a word of their own with no bits.
    """
    q = F.col("quantity")
    aggs = [F.sum(q).alias("net")]
    for name, flag in kinds.items():
        bit = F.expr("shiftleft(1L, cast(unix_date(txn_day) & 63 as int))")
        aggs += [F.count(F.when(flag, 1)).alias(f"{name}_rows"), F.sum(F.when(flag, q)).alias(f"{name}_sum"),
                 F.bit_or(F.when(flag & F.col("txn_day").isNotNull(), bit).otherwise(F.lit(0).cast("long")))
                 .alias(f"{name}_days")]
    word = F.shiftright(F.unix_date("txn_day"), DAY_WORD_BITS)
    return mv.groupBy("product_id", word.alias("day_word")).agg(*aggs)


def _summed(words: DataFrame, rows: Column, total: Column, days: Column) -> DataFrame:
    """Product-grain summary of the words; the columns name the kind of row that counts as sold."""
    product = words.groupBy("product_id").agg(
        F.sum("net").alias("net_quantity"), F.sum(rows).alias("sold_rows"), F.sum(total).alias("_sum"),
        F.sum(F.bit_count(days)).cast("long").alias("_days"))
    any_sold = F.col("sold_rows") > 0
    summary = product.select(
        "product_id",
        "net_quantity",
        "sold_rows",
        F.when(any_sold, F.abs(F.col("_sum"))).alias("total_sales"),
        F.when(any_sold, F.col("_days")).alias("active_days"),
    )
    return summary.withColumn("daily_sales_velocity", sales_velocity(F.col("total_sales"), F.col("active_days")))


def movement_summary(mv: DataFrame) -> DataFrame:
    """Product-grain movement facts from a single pass over the movements.

    Columns: ``product_id, net_quantity, sold_rows, total_sales, active_days,
    daily_sales_velocity``. ``total_sales``/``active_days``/velocity are NULL
    for products without sales rows. Sales rows are the sale-typed rows, or,
    when no row of the whole table is sale-typed, the rows with quantity < 0.
    """
    flag = F.when(any_sale_row(mv), is_sale(mv["txn_type"])).otherwise(mv["quantity"] < 0)
    words = _sums_and_days(mv.withColumn("_sold", flag), {"sold": F.col("_sold")})
    return _summed(words, F.col("sold_rows"), F.col("sold_sum"), F.col("sold_days"))


# ------------------------------------------------------------ incremental movement state

#: The two kinds of row that may count as sold: which one does is known only from the whole table.
STATE_KINDS = ("typed", "negative")


def movement_state(mv: DataFrame) -> DataFrame:
    """What gold needs of movements, in a form that merges: per (product, calendar word) sums, counts and day bits.

    Both readings of "sold" are kept (sale-typed rows; rows with quantity < 0),
    since a later batch may bring the first sale-typed row of the table.
    """
    return _sums_and_days(mv, {"typed": is_sale(mv["txn_type"]),
                               "negative": F.coalesce(mv["quantity"] < 0, F.lit(False))})


def merge_states(first: DataFrame, *others: DataFrame) -> DataFrame:
    """The state of all movements from the states of disjoint batches (in any order and grouping)."""
    union = first
    for o in others:
        union = union.unionByName(o)
    aggs = [F.sum("net").alias("net")]
    for k in STATE_KINDS:
        aggs += [F.sum(f"{k}_rows").alias(f"{k}_rows"), F.sum(f"{k}_sum").alias(f"{k}_sum"),
                 F.bit_or(f"{k}_days").alias(f"{k}_days")]
    return union.groupBy("product_id", "day_word").agg(*aggs)


def summary_from_state(state: DataFrame) -> DataFrame:
    """The same columns as ``movement_summary``, from a (written) state instead of the movements."""
    typed = state.where(F.col("typed_rows") > 0).exists()
    rows, total, days = (F.when(typed, F.col(f"typed_{c}")).otherwise(F.col(f"negative_{c}")) for c in ("rows", "sum", "days"))
    chosen = state.select("product_id", "net", rows.alias("_r"), total.alias("_s"), days.alias("_d"))
    return _summed(chosen, F.col("_r"), F.col("_s"), F.col("_d"))


def sales_velocity(total_sales: Column, active_days: Column) -> Column:
    """total / active days; the total itself when there are no dated days."""
    return F.when(active_days > 0, total_sales / active_days).otherwise(total_sales)


def sales_features(summary: DataFrame) -> DataFrame:
    """Products with sales rows: ``product_id, total_sales, active_days, daily_sales_velocity``."""
    return summary.where(F.col("sold_rows") > 0).select(
        "product_id", "total_sales", "active_days", "daily_sales_velocity"
    )


# ------------------------------------------------------------ stock

def stock_balance(inv: DataFrame, summary: DataFrame) -> DataFrame:
    """Left join inventory ⟕ movements; ``stock = initial + coalesce(net, 0)``."""
    moved = summary.withColumnRenamed("product_id", "_moved")
    joined = inv.join(moved, same_key(inv, "product_id", moved, "_moved"), "left").drop("_moved")
    return joined.withColumn(
        "stock_balance", F.col("initial_stock") + F.coalesce(F.col("net_quantity"), F.lit(0.0))
    )


def stock_on_hand(stock: Column) -> Column:
    """Floor at zero. ``greatest`` skips NULL, so a NULL stock becomes 0.0."""
    return F.greatest(stock, F.lit(0.0))


# ------------------------------------------------------------ lead time

def actual_lead_time() -> Column:
    """Days from last order to receipt, as double; may be negative or NULL."""
    return F.datediff(F.col("received_day"), F.col("last_order_day")).cast(T.DoubleType())


@dataclass(frozen=True)
class LeadTimeMode:
    kind: str  # "per_product" | "global" | "default"


def supplier_lead_mode(roles: SupplierRoles) -> LeadTimeMode:
    if roles.product and roles.lead_time:
        return LeadTimeMode("per_product")
    if roles.lead_time:
        return LeadTimeMode("global")
    return LeadTimeMode("default")


def supplier_lead_per_product(sup: DataFrame, roles: SupplierRoles, key_type: T.DataType | None = None) -> DataFrame:
    """One supplier row per product: lowest supplier id, then known lead time first.

    Reducing before the join keeps the join 1:1 instead of fanning out.
    ``key_type`` is the type of the products to join; text keys take it before
    they are reduced. Columns: ``sup_product_id, avg_lead_time_days``.
    """
    cols = [sup[roles.product].alias("sup_product_id")]
    order = []
    if roles.supplier_id:
        cols.append(sup[roles.supplier_id].alias("_supplier"))
        order.append("_supplier")
    lead = to_double(sup[roles.lead_time])
    cols += [lead.isNull().alias("_lead_missing"), lead.alias("avg_lead_time_days")]
    order += ["_lead_missing", "avg_lead_time_days"]
    canonical = sup.select(*cols)
    if key_type is not None:
        canonical = with_key_as(canonical, "sup_product_id", key_type)
    reduced = dedup_by_key(canonical, "sup_product_id", order_by=order)
    return reduced.select("sup_product_id", "avg_lead_time_days")


def supplier_lead_global(sup: DataFrame, roles: SupplierRoles, accuracy: int = 10000) -> Column:
    """Approximate median lead time over all supplier rows (scalar subquery)."""
    return sup.select(F.percentile_approx(to_double(sup[roles.lead_time]), 0.5, accuracy)).scalar()


def with_supplier_lead_time(stock: DataFrame, sup: DataFrame, roles: SupplierRoles) -> DataFrame:
    """Add ``avg_lead_time_days`` (and ``sup_product_id`` when joined per product)."""
    mode = supplier_lead_mode(roles)
    if mode.kind == "per_product":
        per_product = supplier_lead_per_product(sup, roles, stock.schema["product_id"].dataType)
        return stock.join(per_product, same_key(stock, "product_id", per_product, "sup_product_id"), "left")
    if mode.kind == "global":
        return stock.withColumn("avg_lead_time_days", supplier_lead_global(sup, roles))
    return stock.withColumn("avg_lead_time_days", F.lit(DEFAULT_LEAD_TIME_DAYS))


def procurement_lead_time(actual: Column, avg: Column) -> Column:
    """``(coalesce(actual, avg) + coalesce(avg, 7)) / 2``."""
    return (F.coalesce(actual, avg) + F.coalesce(avg, F.lit(DEFAULT_LEAD_TIME_DAYS))) / 2.0


# ------------------------------------------------------------ targets

def order_buffer_index(stock: Column, velocity: Column) -> Column:
    """Days of cover; NULL when velocity is not positive."""
    return F.when(velocity > 0, stock / velocity).otherwise(_null_double())


def safety_stock(velocity: Column, lead: Column) -> Column:
    return velocity * lead


def stockout_risk(stock: Column, safety: Column) -> Column:
    """1 when stock ≤ safety stock (NULL safety counts as 0), else 0."""
    return F.when(stock <= F.coalesce(safety, F.lit(0.0)), F.lit(1)).otherwise(F.lit(0)).cast(T.IntegerType())


def reorder_point(velocity: Column, lead: Column, reorder_level: Column | None) -> Column:
    """Formula point, averaged with the historical level when one exists; floored at 0."""
    formula = velocity * lead * 2
    raw = (formula + F.coalesce(reorder_level, F.lit(0.0))) / 2.0 if reorder_level is not None else formula
    return F.greatest(raw, F.lit(0.0))


# ------------------------------------------------------------ composition

@dataclass(frozen=True)
class GoldInputs:
    movements: DataFrame
    inventory: DataFrame
    suppliers: DataFrame
    trx_roles: TransactionRoles
    inv_roles: InventoryRoles
    sup_roles: SupplierRoles


def prepare_inputs(trx: DataFrame, inv: DataFrame, sup: DataFrame,
                   trx_roles: TransactionRoles | None = None,
                   inv_roles: InventoryRoles | None = None,
                   sup_roles: SupplierRoles | None = None) -> GoldInputs:
    """Normalise names (run-wise) and resolve roles for the three inputs."""
    trx, inv, sup = (normalize_columns(d, collapse=True) for d in (trx, inv, sup))
    return GoldInputs(
        trx, inv, sup,
        trx_roles or resolve_transaction_roles(trx.columns),
        inv_roles or resolve_inventory_roles(inv.columns),
        sup_roles or resolve_supplier_roles(sup.columns),
    )


def gold_movements(g: GoldInputs) -> DataFrame:
    """Canonical movements whose product key has the type of the inventory's."""
    key_type = g.inventory.schema[g.inv_roles.product].dataType
    return with_key_as(canonical_movements(g.movements, g.trx_roles), "product_id", key_type)


def gold_wide(g: GoldInputs, summary: DataFrame | None = None) -> DataFrame:
    """Every intermediate column, one row per inventory product.

    ``summary`` (as of ``movement_summary``) stands in for the movements, which
    are then not read.
    """
    inv = one_row_per_product(canonical_inventory(g.inventory, g.inv_roles))
    if summary is None:
        summary = movement_summary(gold_movements(g))
    stock = stock_balance(inv, summary)
    stock = stock.withColumn("stock_on_hand", stock_on_hand(F.col("stock_balance")))
    stock = stock.withColumn("actual_lead_time", actual_lead_time())
    stock = with_supplier_lead_time(stock, g.suppliers, g.sup_roles)
    velocity = F.coalesce(F.col("daily_sales_velocity"), F.lit(0.0))
    lead = procurement_lead_time(F.col("actual_lead_time"), F.col("avg_lead_time_days"))
    level = F.col("reorder_level") if g.inv_roles.reorder_level else None
    wide = stock.select(
        "*",
        velocity.alias("_velocity"),
        lead.alias("procurement_lead_time"),
    )
    return wide.select(
        *[c for c in wide.columns if c not in ("daily_sales_velocity", "_velocity")],
        F.col("_velocity").alias("daily_sales_velocity"),
        order_buffer_index(F.col("stock_on_hand"), F.col("_velocity")).alias("order_buffer_index"),
        safety_stock(F.col("_velocity"), F.col("procurement_lead_time")).alias("safety_stock"),
        stockout_risk(F.col("stock_on_hand"), safety_stock(F.col("_velocity"), F.col("procurement_lead_time")))
        .alias("stockout_risk"),
        reorder_point(F.col("_velocity"), F.col("procurement_lead_time"), level).alias("reorder_point"),
    )


def gold_columns(g: GoldInputs) -> list[str]:
    """Output order; optional columns only when their inputs exist."""
    cols = list(GOLD_COLUMNS)
    if supplier_lead_mode(g.sup_roles).kind != "per_product":
        cols.remove("supplier_product_ref")
    if not g.inv_roles.reorder_level:
        cols.remove("historical_reorder_level")
    return cols


def gold_features(trx: DataFrame, inv: DataFrame, sup: DataFrame, summary: DataFrame | None = None, **roles) -> DataFrame:
    """The gold feature table: features plus the two targets, one row per product.

    With a ``summary`` only the columns of ``trx`` are looked at, not its rows.
    """
    g = prepare_inputs(trx, inv, sup, **roles)
    wide = gold_wide(g, summary)
    rename = {
        "supplier_product_ref": "sup_product_id",
        "initial_stock_quantity": "initial_stock",
        "historical_reorder_level": "reorder_level",
    }
    return wide.select(*[F.col(rename.get(c, c)).alias(c) for c in gold_columns(g)])
