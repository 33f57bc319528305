"""Independent SQL (DuckDB dialect) for every SQL-expressible query.

Written from the operator semantics, not generated from the Spark plans. The
driver registers the test tables as views; each statement below rebuilds the
fixture projections (FIXTURES.md) as CTEs and computes the same result.
"""

from __future__ import annotations

SALE_LIST = "('SALE', 'SALES', 'OUT', 'KELUAR')"

# ------------------------------------------------------------------ fixtures

STOCK_MOVE = """
SELECT l_orderkey AS order_ref, l_linenumber AS line_no, l_suppkey AS supplier_ref,
       l_partkey AS product_id,
       CASE l_returnflag WHEN 'A' THEN '{sale}' WHEN 'R' THEN 'adjustment'
                         WHEN 'N' THEN 'purchase' END AS transaction_type,
       CASE WHEN l_returnflag = 'A' THEN -l_quantity
            WHEN l_returnflag = 'N' THEN l_quantity
            WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN l_quantity
            WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN -l_quantity END AS quantity_change,
       l_shipdate AS transaction_date
FROM lineitem"""

INVENTORY = """
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
       CAST(p_size * 10 AS DOUBLE) AS stock_quantity,
       CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS reorder_level,
       CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_retailprice END AS unit_price,
       CAST(DATE '2001-01-01' + CAST(p_partkey % 365 AS INTEGER) AS DATE) AS last_order_date,
       CASE WHEN p_partkey % 11 = 0 THEN NULL
            ELSE CAST(DATE '2001-01-01' + CAST(p_partkey % 365 + p_partkey % 15 AS INTEGER) AS DATE)
       END AS date_received
FROM part"""

SUPPLIERS_A = """
SELECT CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE l_partkey END AS product_id, min(l_suppkey) AS supplier_id,
       CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE CAST(min(l_suppkey) % 14 + 1 AS DOUBLE) END
         AS avg_lead_time_days
FROM lineitem GROUP BY l_partkey"""

SUPPLIERS_FAN_OUT = """
SELECT product_id, supplier_id,
       CASE WHEN product_id % 17 = 0 THEN NULL ELSE CAST(supplier_id % 14 + 1 AS DOUBLE) END
         AS avg_lead_time_days
FROM (SELECT DISTINCT l_partkey AS product_id, l_suppkey AS supplier_id FROM lineitem)"""

SUPPLIERS_B = """
SELECT s_suppkey AS supplier_id, s_name AS supplier_name,
       CAST(s_suppkey % 14 + 1 AS DOUBLE) AS avg_lead_time_days
FROM supplier"""

SUPPLIERS_C = "SELECT s_suppkey AS supplier_id, s_name AS supplier_name FROM supplier"

# silver transactions: trimmed type, whole-row distinct
TRX_CLEAN = """
SELECT DISTINCT order_ref, line_no, supplier_ref, product_id, trim(transaction_type) AS transaction_type,
       quantity_change, transaction_date
FROM sm"""


TRX_KEYED = """
SELECT order_ref, line_no, supplier_ref, product_id, transaction_type, quantity_change, transaction_date
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY order_ref NULLS LAST, line_no NULLS LAST,
        supplier_ref NULLS LAST, product_id NULLS LAST, transaction_type NULLS LAST,
        quantity_change NULLS LAST, transaction_date NULLS LAST) AS rn
      FROM (SELECT order_ref * 8 + line_no AS id, order_ref, line_no, supplier_ref, product_id,
                   trim(transaction_type) AS transaction_type, quantity_change, transaction_date FROM sm))
WHERE rn = 1"""


def fixtures(sale: str = " sale ", suppliers: str = SUPPLIERS_A, keyed: bool = False) -> str:
    """The common CTE prefix: sm (raw movements), trx (silver), inv, sup."""
    return (
        f"WITH sm AS ({STOCK_MOVE.format(sale=sale)}),\n"
        f"trx AS ({TRX_KEYED if keyed else TRX_CLEAN}),\n"
        f"inv AS ({INVENTORY}),\n"
        f"sup AS ({suppliers})"
    )


# ------------------------------------------------------------------ gold

def gold_ctes(lead_mode: str = "per_product") -> str:
    """CTEs after ``fixtures()``; ends with ``gold`` holding every column."""
    flag = f"""
flag AS (SELECT coalesce(bool_or(coalesce(upper(transaction_type) IN {SALE_LIST}, false)), false) AS any_sale
         FROM trx)"""
    sales = f"""
sales AS (SELECT product_id, abs(sum(quantity_change)) AS total_sales,
                 count(DISTINCT CAST(transaction_date AS DATE)) AS active_days
          FROM trx, flag
          WHERE CASE WHEN any_sale THEN coalesce(upper(transaction_type) IN {SALE_LIST}, false)
                     ELSE quantity_change < 0 END
          GROUP BY product_id)"""
    sv = """
sv AS (SELECT product_id, total_sales, active_days,
              CASE WHEN active_days > 0 THEN total_sales / active_days ELSE total_sales END
                AS daily_sales_velocity
       FROM sales)"""
    net = "net AS (SELECT product_id, sum(quantity_change) AS net_quantity FROM trx GROUP BY product_id)"
    inv1 = """
inv1 AS (SELECT product_id, stock_quantity AS initial_stock, date_received, last_order_date, reorder_level
         FROM (SELECT *, row_number() OVER (PARTITION BY product_id
                 ORDER BY stock_quantity NULLS LAST, date_received NULLS LAST,
                          last_order_date NULLS LAST, reorder_level NULLS LAST) AS rn FROM inv)
         WHERE rn = 1)"""
    if lead_mode == "per_product":
        lead = """
sup1 AS (SELECT product_id AS sup_product_id, avg_lead_time_days
         FROM (SELECT *, row_number() OVER (PARTITION BY product_id
                 ORDER BY supplier_id NULLS LAST, avg_lead_time_days IS NULL,
                          avg_lead_time_days NULLS LAST) AS rn FROM sup)
         WHERE rn = 1)"""
        lead_join = "LEFT JOIN sup1 s ON i.product_id = s.sup_product_id"
        lead_cols = "s.sup_product_id, s.avg_lead_time_days"
    elif lead_mode == "global":
        lead = "sup1 AS (SELECT CAST(quantile_disc(avg_lead_time_days, 0.5) AS DOUBLE) AS avg_lead_time_days FROM sup)"
        lead_join = "CROSS JOIN sup1 s"
        lead_cols = "s.avg_lead_time_days"
    else:
        lead = "sup1 AS (SELECT CAST(7.0 AS DOUBLE) AS avg_lead_time_days)"
        lead_join = "CROSS JOIN sup1 s"
        lead_cols = "s.avg_lead_time_days"
    base = f"""
base AS (SELECT i.product_id, {lead_cols}, i.initial_stock, i.reorder_level,
                i.initial_stock + coalesce(n.net_quantity, CAST(0 AS DOUBLE)) AS stock_balance,
                greatest(i.initial_stock + coalesce(n.net_quantity, CAST(0 AS DOUBLE)), CAST(0 AS DOUBLE))
                  AS stock_on_hand,
                v.total_sales, v.active_days,
                coalesce(v.daily_sales_velocity, CAST(0 AS DOUBLE)) AS daily_sales_velocity,
                CAST(date_diff('day', i.last_order_date, i.date_received) AS DOUBLE) AS actual_lead_time
         FROM inv1 i LEFT JOIN net n ON i.product_id = n.product_id
                     LEFT JOIN sv v ON i.product_id = v.product_id
                     {lead_join})"""
    lt = """
lt AS (SELECT *, (coalesce(actual_lead_time, avg_lead_time_days)
                  + coalesce(avg_lead_time_days, CAST(7 AS DOUBLE))) / 2.0 AS procurement_lead_time
       FROM base)"""
    gold = """
gold AS (SELECT *,
           CASE WHEN daily_sales_velocity > 0 THEN stock_on_hand / daily_sales_velocity END AS order_buffer_index,
           daily_sales_velocity * procurement_lead_time AS safety_stock,
           CAST(CASE WHEN stock_on_hand <= coalesce(daily_sales_velocity * procurement_lead_time, CAST(0 AS DOUBLE))
                THEN 1 ELSE 0 END AS INTEGER) AS stockout_risk,
           greatest((daily_sales_velocity * procurement_lead_time * 2
                     + coalesce(reorder_level, CAST(0 AS DOUBLE))) / 2.0, CAST(0 AS DOUBLE)) AS reorder_point,
           greatest(daily_sales_velocity * procurement_lead_time * 2, CAST(0 AS DOUBLE)) AS reorder_point_formula
         FROM lt)"""
    return ",\n".join([flag, sales, sv, net, inv1, lead, base, lt, gold])


GOLD_SELECT_A = """
SELECT product_id, sup_product_id AS supplier_product_ref, initial_stock AS initial_stock_quantity,
       stock_on_hand, total_sales, active_days, daily_sales_velocity, actual_lead_time,
       avg_lead_time_days, procurement_lead_time, order_buffer_index, safety_stock,
       reorder_level AS historical_reorder_level, stockout_risk, reorder_point
FROM gold"""


def gold_sql(select: str = GOLD_SELECT_A, lead_mode: str = "per_product", sale: str = " sale ",
             suppliers: str = SUPPLIERS_A, extra_ctes: str = "", keyed: bool = False) -> str:
    ctes = fixtures(sale, suppliers, keyed) + ",\n" + gold_ctes(lead_mode)
    if extra_ctes:
        ctes += ",\n" + extra_ctes
    return ctes + "\n" + select


TRX_COLS = ["order_ref", "line_no", "supplier_ref", "product_id", "transaction_type",
            "quantity_change", "transaction_date"]


def md5_of(cols: list[str]) -> str:
    parts = ", ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in cols)
    return f"md5(concat_ws('|', {parts}))"


DIRTY = """
SELECT order_ref, line_no, product_id, transaction_type,
       CASE WHEN (order_ref * 8 + line_no) % 97 = 0 THEN 'bad'
            WHEN (order_ref * 8 + line_no) % 89 = 0 THEN NULL
            ELSE CAST(quantity_change AS VARCHAR) END AS quantity,
       CASE WHEN (order_ref * 8 + line_no) % 97 = 0 THEN 'bad'
            WHEN (order_ref * 8 + line_no) % 89 = 0 THEN ''
            ELSE strftime(transaction_date, '%Y-%m-%d %H:%M:%S') END AS transaction_date
FROM sm"""

SPLIT_BUCKET = "(('0x' || substr(md5('42:' || CAST(product_id AS VARCHAR)), 1, 8))::UBIGINT % 100)"

SILVER_INV = """
SELECT DISTINCT product_id, trim(product_name) AS product_name, trim(category) AS category, stock_quantity,
       reorder_level, coalesce(unit_price, (SELECT quantile_disc(unit_price, 0.5) FROM inv)) AS unit_price,
       last_order_date, date_received
FROM inv"""

SILVER_SUP_B = f"SELECT DISTINCT supplier_id, trim(supplier_name) AS supplier_name, avg_lead_time_days FROM ({SUPPLIERS_B})"


def _sm(sale: str = " sale ") -> str:
    return f"WITH sm AS ({STOCK_MOVE.format(sale=sale)})\n"


def recommendations_cte() -> str:
    ins = {
        "HIGH": ("Produk ini berisiko tinggi mengalami stockout. "
                 "Disarankan segera melakukan restock untuk menghindari kehilangan penjualan."),
        "MEDIUM": ("Produk menunjukkan potensi stockout dalam waktu dekat. "
                   "Monitoring dan restock dalam waktu dekat sangat disarankan."),
        "LOW": ("Stok produk masih dalam kondisi aman. "
                "Belum diperlukan tindakan restock dalam waktu dekat."),
    }
    return f"""
rec0 AS (SELECT product_id, stock_on_hand, stockout_risk AS predicted_stockout, reorder_point AS predicted_rop,
                CASE WHEN stockout_risk = 1 THEN CASE WHEN reorder_point > stock_on_hand THEN 'HIGH' ELSE 'MEDIUM' END
                     ELSE 'LOW' END AS priority,
                CASE WHEN reorder_point - stock_on_hand IS NOT NULL
                     THEN greatest(reorder_point - stock_on_hand, CAST(0 AS DOUBLE)) END AS recommended_order
         FROM gold),
rec AS (SELECT *, CASE priority WHEN 'HIGH' THEN '{ins["HIGH"]}' WHEN 'MEDIUM' THEN '{ins["MEDIUM"]}'
                                ELSE '{ins["LOW"]}' END AS insight FROM rec0)"""


def _gold(select: str, extra: str = "", **kw) -> str:
    return gold_sql(select=select, extra_ctes=extra, **kw)


FEATURES = ["initial_stock_quantity", "stock_on_hand", "total_sales", "active_days",
            "daily_sales_velocity", "actual_lead_time", "avg_lead_time_days", "procurement_lead_time"]
GOLD_NAMED = """
gnamed AS (SELECT product_id, sup_product_id AS supplier_product_ref, initial_stock AS initial_stock_quantity,
       stock_on_hand, total_sales, active_days, daily_sales_velocity, actual_lead_time,
       avg_lead_time_days, procurement_lead_time, order_buffer_index, safety_stock,
       reorder_level AS historical_reorder_level, stockout_risk, reorder_point FROM gold)"""

STAT_FEATURES = ["daily_sales_velocity", "stock_on_hand", "procurement_lead_time",
                 "order_buffer_index", "safety_stock", "reorder_point"]

SALES_ROWS = f"""
salesrows AS (SELECT trx.* FROM trx, flag
              WHERE CASE WHEN any_sale THEN coalesce(upper(transaction_type) IN {SALE_LIST}, false)
                         ELSE quantity_change < 0 END)"""

PAIRS = """
pairs AS (SELECT supplier_ref AS supplier_id, product_id,
                 sum(CASE WHEN quantity_change > 0 THEN quantity_change END) AS inbound
          FROM trx GROUP BY supplier_ref, product_id)"""


def sketch_sql(key: str | None, quantiles: list[tuple[str, float]]) -> str:
    """Quantiles of the price by buckets of ten mantissa bits: the middle of the values of the bucket with the wanted rank."""
    part = f"PARTITION BY {key}" if key else ""
    picked = ", ".join(
        f"max(CASE WHEN upto >= greatest(ceil(total * {p}), 1) AND upto - n < greatest(ceil(total * {p}), 1) "
        f"THEN low + (high - low) / 2 END) AS {name}" for name, p in quantiles)
    head = f"{key}, " if key else ""
    tail = f"GROUP BY {key}" if key else ""
    count = "" if key else ", CAST(sum(n) AS BIGINT) AS n_rows"
    return f"""
WITH prices AS (
  SELECT {head}unit_price AS v, floor(log2(unit_price)) AS e FROM ({INVENTORY}) WHERE unit_price IS NOT NULL
),
buckets AS (
  SELECT {head}e, floor((v / pow(2, e) - 1) * 1024) AS m, count(*) AS n, min(v) AS low, max(v) AS high
  FROM prices GROUP BY {head}e, m
),
ranked AS (
  SELECT *, sum(n) OVER ({part} ORDER BY e, m ROWS UNBOUNDED PRECEDING) AS upto, sum(n) OVER ({part}) AS total FROM buckets
)
SELECT {head}{picked}{count} FROM ranked {tail}"""


def statements() -> dict[str, str]:
    fx_a = fixtures()
    trx_sel = ", ".join(TRX_COLS)
    q: dict[str, str] = {}

    # ---------------------------------------------------------- sources / sinks
    q["scan_parquet"] = _sm() + "SELECT * FROM sm"
    q["scan_csv"] = f"SELECT * FROM ({INVENTORY})"
    q["scan_json_multiline"] = f"SELECT * FROM ({SUPPLIERS_A})"
    q["land_raw_files"] = f"SELECT * FROM ({SUPPLIERS_A})"
    q["sink_parquet_roundtrip"] = gold_sql()
    q["sink_parquet_single_file"] = gold_sql()
    q["bronze_landing"] = f"""
SELECT 'stock_transactions' AS dataset, CAST(count(*) AS BIGINT) AS n_rows FROM lineitem
UNION ALL SELECT 'grocery_inventory', CAST(count(*) AS BIGINT) FROM part
UNION ALL SELECT 'suppliers', CAST(count(*) AS BIGINT) FROM ({SUPPLIERS_A})"""
    q["bronze_movements"] = _sm() + "SELECT * FROM sm"
    q["bronze_inventory"] = f"SELECT * FROM ({INVENTORY})"
    q["bronze_suppliers"] = f"SELECT * FROM ({SUPPLIERS_A})"
    q["bronze_landing_incremental"] = _sm() + "SELECT * FROM sm"
    q["replace_survives_failure"] = f"""SELECT i.*, k.kept_by FROM ({INVENTORY}) i, (VALUES ('folder'), ('version')) k(kept_by)"""
    q["scan_csv_quoted_breaks"] = f"""SELECT * REPLACE (CASE WHEN product_id % 3 = 0
       THEN 'first "line",' || chr(10) || product_name || chr(13) || chr(10) || chr(10) || 'last' ELSE product_name END AS product_name)
FROM ({INVENTORY})"""
    q["scan_json_array"] = f"SELECT * FROM ({SUPPLIERS_A})"
    q["land_chunked_files"] = f"SELECT * FROM ({SUPPLIERS_A})"
    q["score_saved_models"] = "SELECT CAST(count(*) AS BIGINT) AS n_products, CAST(0 AS BIGINT) AS n_different FROM part"
    q["gold_incremental"] = gold_sql()
    q["silver_incremental"] = fx_a + f"\nSELECT *, {md5_of(TRX_COLS)} AS transaction_id FROM trx"
    q["quantile_sketch"] = sketch_sql("category", [("q1", 0.25), ("median", 0.5), ("q3", 0.75)])
    q["sketch_median"] = sketch_sql(None, [("median", 0.5)])
    q["gold_from_landed_files"] = gold_sql()

    # ---------------------------------------------------------- cleaning
    raw_inv = f"""SELECT product_id, product_name, unit_price AS {{price}}, date_received, stock_quantity
FROM ({INVENTORY})"""
    q["normalize_columns"] = raw_inv.format(price="unit___price")
    q["normalize_columns_collapsed"] = raw_inv.format(price="unit_price")
    q["trim_strings"] = _sm() + """SELECT order_ref, line_no, supplier_ref, product_id,
       trim(transaction_type) AS transaction_type, quantity_change, transaction_date FROM sm"""
    q["parse_datetimes"] = _sm() + f""", d AS ({DIRTY})
SELECT order_ref, line_no, product_id, transaction_type, quantity,
       TRY_CAST(transaction_date AS TIMESTAMP) AS transaction_date FROM d"""
    q["cast_quantity_default"] = _sm() + f""", d AS ({DIRTY})
SELECT order_ref, line_no, product_id, transaction_type,
       coalesce(TRY_CAST(quantity AS DOUBLE), CAST(0 AS DOUBLE)) AS quantity, transaction_date FROM d"""
    q["cast_price"] = f"SELECT product_id, unit_price FROM ({INVENTORY})"
    q["approx_median"] = f"SELECT quantile_disc(unit_price, 0.5) AS median FROM ({INVENTORY})"
    q["impute_median"] = f"""WITH inv AS ({INVENTORY})
SELECT product_id, coalesce(unit_price, (SELECT quantile_disc(unit_price, 0.5) FROM inv)) AS unit_price FROM inv"""
    q["generate_transaction_id"] = _sm() + f"SELECT *, {md5_of(TRX_COLS)} AS transaction_id FROM sm"
    order = ", ".join(f"{c} NULLS LAST" for c in TRX_COLS)
    q["dedup_by_key"] = _sm() + f"""SELECT id, {trx_sel} FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY {order}) AS rn
  FROM (SELECT order_ref * 8 + line_no AS id, * FROM sm)) WHERE rn = 1"""
    q["dedup_rows"] = _sm() + """SELECT DISTINCT * FROM (
  SELECT * FROM sm UNION ALL SELECT * FROM sm WHERE transaction_type = 'adjustment')"""
    q["rename_supplier_id"] = """SELECT s_suppkey AS supplier_id, '  ' || s_name || ' ' AS supplier_name,
       CAST(s_suppkey % 14 + 1 AS DOUBLE) AS avg_lead_time_days FROM supplier"""
    q["layer_counts"] = fx_a + f"""
SELECT 'transactions' AS dataset, CAST(count(*) AS BIGINT) AS n_rows FROM trx
UNION ALL SELECT 'inventory', CAST(count(*) AS BIGINT) FROM ({SILVER_INV})
UNION ALL SELECT 'suppliers', CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT * FROM sup)"""
    q["clean_transactions"] = fx_a + f"\nSELECT *, {md5_of(TRX_COLS)} AS transaction_id FROM trx"
    q["clean_inventory"] = f"WITH inv AS ({INVENTORY})\n{SILVER_INV}"
    q["clean_suppliers"] = """SELECT DISTINCT s_suppkey AS supplier_id, trim('  ' || s_name || ' ') AS supplier_name,
       CAST(s_suppkey % 14 + 1 AS DOUBLE) AS avg_lead_time_days FROM supplier"""
    q["resolve_roles"] = _sm() + """SELECT product_id, transaction_type AS txn_type, quantity_change AS quantity,
       CAST(transaction_date AS DATE) AS txn_day FROM sm"""

    # ---------------------------------------------------------- gold
    q["canonical_casts"] = f"""WITH inv AS ({INVENTORY})
SELECT product_id, stock_quantity AS initial_stock, date_received AS received_day,
       last_order_date AS last_order_day, reorder_level FROM ({SILVER_INV})"""
    canon = """SELECT product_id, transaction_type AS txn_type, quantity_change AS quantity,
       CAST(transaction_date AS DATE) AS txn_day FROM trx"""
    q["filter_sales"] = fx_a + f"\n{canon} WHERE upper(transaction_type) IN {SALE_LIST}"
    q["filter_sales_fallback"] = fixtures(sale=" movement ") + f"\n{canon} WHERE quantity_change < 0"
    q["total_sales"] = _gold("SELECT product_id, total_sales FROM sales")
    q["active_days"] = _gold("SELECT product_id, active_days FROM sales")
    q["sales_velocity"] = _gold("SELECT * FROM sv")
    q["sales_velocity_fallback"] = _gold("SELECT * FROM sv", sale=" movement ")
    q["net_movement"] = _gold("SELECT * FROM net")
    q["stock_balance"] = _gold("""SELECT b.product_id, b.initial_stock, n.net_quantity, b.stock_balance
FROM base b LEFT JOIN net n ON b.product_id = n.product_id""")
    q["stock_on_hand"] = _gold("SELECT product_id, stock_on_hand FROM gold")
    q["actual_lead_time"] = _gold("SELECT product_id, actual_lead_time FROM gold")
    q["supplier_lead_time"] = _gold(
        "SELECT product_id, sup_product_id AS supplier_product_ref, avg_lead_time_days FROM gold")
    q["supplier_lead_time_global"] = _gold("SELECT product_id, avg_lead_time_days FROM gold",
                                           lead_mode="global", suppliers=SILVER_SUP_B)
    q["supplier_lead_time_default"] = _gold("SELECT product_id, avg_lead_time_days FROM gold",
                                            lead_mode="default", suppliers=SUPPLIERS_C)
    q["procurement_lead_time"] = _gold(
        "SELECT product_id, actual_lead_time, avg_lead_time_days, procurement_lead_time FROM gold")
    q["join_sales_features"] = _gold(
        "SELECT product_id, total_sales, active_days, daily_sales_velocity FROM gold")
    q["order_buffer_index"] = _gold(
        "SELECT product_id, stock_on_hand, daily_sales_velocity, order_buffer_index FROM gold")
    q["safety_stock"] = _gold("SELECT product_id, safety_stock FROM gold")
    q["stockout_risk"] = _gold("SELECT product_id, stockout_risk FROM gold")
    q["reorder_point"] = _gold("SELECT product_id, reorder_point FROM gold")
    q["reorder_point_formula_only"] = _gold("SELECT product_id, reorder_point_formula AS reorder_point FROM gold")
    q["gold_features"] = gold_sql()
    q["gold_features_text_keys"] = gold_sql()
    q["gold_from_bronze"] = gold_sql()
    q["gold_features_fan_out"] = gold_sql(suppliers=SUPPLIERS_FAN_OUT)
    q["gold_features_keyed_dedup"] = gold_sql(keyed=True)
    q["gold_features_global_lead"] = _gold("""
SELECT product_id, initial_stock AS initial_stock_quantity, stock_on_hand, total_sales, active_days,
       daily_sales_velocity, actual_lead_time, avg_lead_time_days, procurement_lead_time, order_buffer_index,
       safety_stock, reorder_level AS historical_reorder_level, stockout_risk, reorder_point FROM gold""",
                                           lead_mode="global", suppliers=SILVER_SUP_B)
    q["gold_features_default_lead"] = _gold("""
SELECT product_id, initial_stock AS initial_stock_quantity, stock_on_hand, total_sales, active_days,
       daily_sales_velocity, actual_lead_time, avg_lead_time_days, procurement_lead_time, order_buffer_index,
       safety_stock, reorder_level AS historical_reorder_level, stockout_risk, reorder_point FROM gold""",
                                            lead_mode="default", suppliers=SUPPLIERS_C)
    q["gold_validation"] = _gold("""
SELECT total_products, at_risk, safe,
       round(100.0 * at_risk / greatest(total_products, 1), 1) AS pct_at_risk,
       round(100.0 * safe / greatest(total_products, 1), 1) AS pct_safe
FROM (SELECT CAST(count(*) AS BIGINT) AS total_products,
             CAST(count(CASE WHEN stockout_risk = 1 THEN 1 END) AS BIGINT) AS at_risk,
             CAST(count(CASE WHEN stockout_risk = 0 THEN 1 END) AS BIGINT) AS safe FROM gold)""")
    stats = "\nUNION ALL ".join(
        f"""SELECT '{f}' AS feature, CAST(count({f}) AS BIGINT) AS n, round(avg({f}), 6) AS mean,
       round(stddev_samp({f}), 6) AS stddev, min({f}) AS min, max({f}) AS max FROM gold"""
        for f in STAT_FEATURES)
    q["feature_stats"] = _gold(stats)
    q["gold_sample"] = _gold("SELECT * FROM gnamed ORDER BY product_id LIMIT 5", GOLD_NAMED)

    # ---------------------------------------------------------- models (SQL-checkable parts)
    q["select_features"] = _gold(f"SELECT product_id, {', '.join(FEATURES)} FROM gnamed", GOLD_NAMED)
    filled = ", ".join(f"coalesce({f}, 0) AS {f}" for f in FEATURES)
    q["fill_null_features"] = _gold(f"SELECT product_id, {filled}, stockout_risk, reorder_point FROM gnamed",
                                    GOLD_NAMED)
    q["assembled_values"] = _gold("\nUNION ALL ".join(
        f"SELECT product_id, {i} AS position, CAST(coalesce({f}, 0) AS DOUBLE) AS value FROM gnamed"
        for i, f in enumerate(FEATURES)), GOLD_NAMED)
    q["train_test_split"] = _gold(
        f"SELECT product_id, CASE WHEN {SPLIT_BUCKET} < 80 THEN 'train' ELSE 'test' END AS split FROM gold")
    test_rows = f"test AS (SELECT * FROM gold WHERE {SPLIT_BUCKET} >= 80)"
    q["rf_stockout_rows"] = _gold("SELECT product_id, stockout_risk, true AS p_in_range, true AS is_class FROM test", test_rows)
    q["rf_reorder_point_rows"] = _gold(
        "SELECT product_id, coalesce(reorder_point, 0) AS reorder_point, true AS in_label_range FROM test", test_rows)
    q["score_products_rows"] = _gold(
        "SELECT product_id, coalesce(stock_on_hand, 0) AS stock_on_hand, true AS is_class, true AS in_label_range FROM gold")
    q["feature_importance_rows"] = "\nUNION ALL ".join(
        f"SELECT {i} AS position, '{f}' AS feature, true AS in_range, true AS sums_to_one" for i, f in enumerate(FEATURES))
    q["auc_model_agreement"] = _gold("""
SELECT CAST(count(CASE WHEN stockout_risk = 1 THEN 1 END) AS BIGINT) AS n_pos,
       CAST(count(CASE WHEN stockout_risk = 0 THEN 1 END) AS BIGINT) AS n_neg, true AS metrics_agree FROM test""", test_rows)
    q["auc_exact"] = _gold("""
SELECT CASE WHEN sum(n_pos) > 0 AND sum(n_neg) > 0
            THEN sum(CAST(n_pos AS DOUBLE) * (before + CAST(n_neg AS DOUBLE) * 0.5))
                 / (CAST(sum(n_pos) AS DOUBLE) * CAST(sum(n_neg) AS DOUBLE)) END AS auc,
       CAST(coalesce(sum(n_pos), 0) AS BIGINT) AS n_pos, CAST(coalesce(sum(n_neg), 0) AS BIGINT) AS n_neg
FROM cum""", test_rows + """,
ps AS (SELECT CAST(0 AS DOUBLE) - stock_on_hand AS score,
              sum(CASE WHEN stockout_risk = 1 THEN 1 ELSE 0 END) AS n_pos,
              sum(CASE WHEN stockout_risk = 1 THEN 0 ELSE 1 END) AS n_neg
       FROM test WHERE stock_on_hand IS NOT NULL AND stockout_risk IS NOT NULL GROUP BY 1),
cum AS (SELECT *, coalesce(sum(n_neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                    AS before FROM ps)""")
    q["regression_metrics"] = _gold("""
SELECT CAST(count(*) AS BIGINT) AS n, round(avg(abs(safety_stock - reorder_point)), 6) AS mae,
       round(CASE WHEN sum((reorder_point - my) * (reorder_point - my)) > 0
                  THEN 1 - sum((safety_stock - reorder_point) * (safety_stock - reorder_point))
                           / sum((reorder_point - my) * (reorder_point - my)) END, 6) AS r2
FROM t2, m""", test_rows + """,
t2 AS (SELECT * FROM test WHERE reorder_point IS NOT NULL AND safety_stock IS NOT NULL),
m AS (SELECT avg(reorder_point) AS my FROM t2)""")

    # ---------------------------------------------------------- recommendations
    recs = recommendations_cte()
    q["priority"] = _gold("SELECT product_id, priority FROM rec", recs)
    q["recommended_order"] = _gold("SELECT product_id, recommended_order FROM rec", recs)
    q["insight_text"] = _gold("SELECT product_id, priority, insight FROM rec", recs)
    q["priority_summary"] = _gold("""
SELECT p.priority, CAST(count(r.product_id) AS BIGINT) AS n_products
FROM (VALUES ('HIGH'), ('MEDIUM'), ('LOW')) p(priority) LEFT JOIN rec r ON r.priority = p.priority
GROUP BY p.priority""", recs)
    q["recommendation_sample"] = _gold("""
SELECT product_id, stock_on_hand, predicted_rop, priority, recommended_order, insight FROM rec
ORDER BY CASE priority WHEN 'HIGH' THEN 0 WHEN 'MEDIUM' THEN 1 ELSE 2 END,
         recommended_order DESC NULLS LAST, product_id LIMIT 10""", recs)
    q["recommendations"] = _gold("SELECT * FROM rec", recs)
    q["sink_csv_roundtrip"] = q["recommendations"]

    # ---------------------------------------------------------- reports
    q["enriched_movements"] = fx_a + f""",
sinv AS ({SILVER_INV}),
p AS (SELECT pid, product_name, category FROM (
        SELECT product_id AS pid, product_name, category, row_number() OVER (PARTITION BY product_id
               ORDER BY product_name NULLS LAST, category NULLS LAST) AS rn FROM sinv) WHERE rn = 1),
s AS (SELECT sid, supplier_name FROM (
        SELECT supplier_id AS sid, supplier_name, row_number() OVER (PARTITION BY supplier_id
               ORDER BY supplier_name NULLS LAST) AS rn FROM ({SILVER_SUP_B})) WHERE rn = 1)
SELECT t.order_ref, t.line_no, t.product_id, t.supplier_ref, t.transaction_type, t.quantity_change,
       t.transaction_date, p.product_name, p.category, s.supplier_name
FROM trx t LEFT JOIN p ON t.product_id = p.pid LEFT JOIN s ON t.supplier_ref = s.sid"""
    q["inventory_performance_report"] = _gold("""
SELECT i.product_id, i.initial_stock AS initial_stock_quantity,
       coalesce(m.total_in, CAST(0 AS DOUBLE)) AS total_in, coalesce(m.total_out, CAST(0 AS DOUBLE)) AS total_out,
       i.initial_stock + coalesce(m.total_in, CAST(0 AS DOUBLE)) - coalesce(m.total_out, CAST(0 AS DOUBLE))
         AS final_balance
FROM inv1 i LEFT JOIN io m ON i.product_id = m.product_id""", """
io AS (SELECT product_id, sum(CASE WHEN quantity_change > 0 THEN quantity_change END) AS total_in,
              -sum(CASE WHEN quantity_change < 0 THEN quantity_change END) AS total_out
       FROM trx GROUP BY product_id)""")
    q["supplier_efficiency_metrics"] = _gold("""
SELECT supplier_id, CAST(count(CASE WHEN inbound > 0 THEN 1 END) AS BIGINT) AS n_products,
       coalesce(sum(inbound), CAST(0 AS DOUBLE)) AS inbound_quantity,
       CASE WHEN max(t) > 0 THEN coalesce(sum(inbound), CAST(0 AS DOUBLE)) / max(t) END AS inbound_share
FROM pairs, tot GROUP BY supplier_id""", PAIRS + """,
tot AS (SELECT sum(CASE WHEN quantity_change > 0 THEN quantity_change END) AS t FROM trx)""")
    status = """CASE WHEN stock_on_hand <= reorder_point THEN 'Low Stock'
            WHEN stock_on_hand > reorder_point * 3.0 THEN 'Overstock' ELSE 'Healthy' END"""
    q["inventory_status"] = _gold(
        f"SELECT product_id, stock_on_hand, reorder_point, {status} AS inventory_status FROM gold")
    q["restock_list"] = _gold(f"""
SELECT product_id, stock_on_hand, reorder_point, reorder_point - stock_on_hand AS shortfall FROM gold
WHERE {status} = 'Low Stock'""")
    q["supplier_review"] = _gold("""
SELECT supplier_id, n_products, inbound_quantity, n_stable, n_rated,
       CASE WHEN n_rated > 0 THEN n_stable / n_rated END AS stable_share,
       CAST(dense_rank() OVER (ORDER BY n_products DESC) AS INTEGER) AS activity_rank,
       CASE WHEN n_rated > 0 THEN CAST(dense_rank() OVER (PARTITION BY n_rated > 0
            ORDER BY n_stable / n_rated DESC) AS INTEGER) END AS stability_rank
FROM per""", PAIRS + """,
per AS (SELECT p.supplier_id, CAST(count(*) AS BIGINT) AS n_products, sum(p.inbound) AS inbound_quantity,
               CAST(count(CASE WHEN g.stockout_risk = 0 THEN 1 END) AS BIGINT) AS n_stable,
               CAST(count(g.stockout_risk) AS BIGINT) AS n_rated
        FROM pairs p LEFT JOIN gold g ON p.product_id = g.product_id
        WHERE p.inbound > 0 GROUP BY p.supplier_id)""")
    q["outflow_anomalies"] = _gold("""
SELECT r.product_id, r.order_ref, r.line_no, abs(r.quantity_change) AS outflow,
       round(st.mean_outflow, 6) AS mean_outflow, round(st.stddev_outflow, 6) AS stddev_outflow
FROM salesrows r JOIN st ON r.product_id = st.p
WHERE abs(r.quantity_change) > st.mean_outflow + 1.5 * st.stddev_outflow""", SALES_ROWS + """,
st AS (SELECT product_id AS p, avg(abs(quantity_change)) AS mean_outflow,
              stddev_samp(abs(quantity_change)) AS stddev_outflow FROM salesrows GROUP BY product_id)""")
    q["top_k_velocity"] = _gold("""
SELECT product_id, daily_sales_velocity, total_sales, active_days FROM gold
ORDER BY daily_sales_velocity DESC NULLS LAST, product_id LIMIT 20""")
    return q
