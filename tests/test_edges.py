"""Hand-made edge frames (FIXTURES.md §5)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from support import rows_of

from larder.operators import cleaning as C
from larder.operators import features as G
from larder.operators import recommend as R
from larder.operators import modeling as M

TRX_SCHEMA = "product_id long, transaction_type string, quantity_change double, transaction_date timestamp_ntz"
INV_SCHEMA = ("product_id long, stock_quantity double, reorder_level double, "
              "last_order_date date, date_received date")
D = dt.datetime(2024, 1, 1)


def _inv(spark, rows):
    return spark.createDataFrame(rows, INV_SCHEMA)


def test_lead_time_null_grid(spark):
    # actual / avg combinations of the NULL table, velocity 2, level 10
    trx = spark.createDataFrame(
        [(p, "SALE", -2.0, D) for p in (1, 2, 3, 4, 5)], TRX_SCHEMA)
    d0 = dt.date(2024, 1, 1)
    inv = _inv(spark, [
        (1, 100.0, 10.0, d0, dt.date(2024, 1, 5)),    # actual 4, avg 6
        (2, 100.0, 10.0, d0, None),                   # actual NULL, avg 6
        (3, 100.0, 10.0, d0, dt.date(2024, 1, 5)),    # actual 4, avg NULL
        (4, 0.0, 10.0, d0, None),                     # both NULL, stock 0
        (5, 100.0, 10.0, d0, dt.date(2023, 12, 1)),   # negative actual
    ])
    sup = spark.createDataFrame([(1, 6.0), (2, 6.0), (3, None), (4, None), (5, 2.0)],
                                "product_id long, lead_time_days double")
    g = {r.product_id: r for r in G.gold_features(trx, inv, sup).collect()}
    assert g[1].procurement_lead_time == 5.0 and g[1].safety_stock == 10.0
    assert g[1].reorder_point == (2 * 2 * 5.0 + 10.0) / 2
    assert g[2].procurement_lead_time == 6.0
    assert g[3].procurement_lead_time == (4 + 7.0) / 2
    assert g[4].procurement_lead_time is None and g[4].safety_stock is None
    assert g[4].stockout_risk == 1 and g[4].reorder_point == 0.0
    assert g[5].procurement_lead_time == (-31 + 2.0) / 2
    assert g[5].stockout_risk == 0 and g[5].reorder_point == 0.0


def test_fallback_to_negative_quantities(spark):
    trx = spark.createDataFrame(
        [(1, "move", -3.0, D), (1, "move", 5.0, D), (2, "move", -1.0, D + dt.timedelta(days=1))], TRX_SCHEMA)
    inv = _inv(spark, [(1, 10.0, None, None, None), (2, 10.0, None, None, None), (3, 1.0, None, None, None)])
    sup = spark.createDataFrame([(1, "x")], "supplier_id long, name string")
    g = {r.product_id: r for r in G.gold_features(trx, inv, sup).collect()}
    assert g[1].total_sales == 3.0 and g[1].active_days == 1
    assert g[1].stock_on_hand == 12.0
    assert g[3].total_sales is None and g[3].daily_sales_velocity == 0.0
    assert g[3].order_buffer_index is None
    assert g[3].avg_lead_time_days == 7.0


def test_sale_rows_present_disable_fallback(spark):
    trx = spark.createDataFrame([(1, " sale ", -3.0, D), (2, "out", -4.0, D), (2, "x", -9.0, D)], TRX_SCHEMA)
    trx = C.trim_strings(trx)
    s = {r.product_id: r for r in G.movement_summary(G.canonical_movements(trx)).collect()}
    assert s[1].total_sales == 3.0
    assert s[2].total_sales == 4.0 and s[2].net_quantity == -13.0


def test_null_type_and_date(spark):
    trx = spark.createDataFrame([(1, None, -3.0, D), (1, "SALE", -2.0, None)], TRX_SCHEMA)
    s = G.movement_summary(G.canonical_movements(trx)).collect()[0]
    assert s.total_sales == 2.0 and s.active_days == 0 and s.daily_sales_velocity == 2.0


def test_empty_movements(spark):
    trx = spark.createDataFrame([], TRX_SCHEMA)
    inv = _inv(spark, [(1, 5.0, 2.0, None, None)])
    sup = spark.createDataFrame([(1, 3.0)], "product_id long, leadtime double")
    r = G.gold_features(trx, inv, sup).collect()[0]
    assert r.stock_on_hand == 5.0 and r.daily_sales_velocity == 0.0 and r.order_buffer_index is None
    assert r.reorder_point == 1.0  # (0 + level 2) / 2


def test_null_initial_stock_floors_to_zero(spark):
    trx = spark.createDataFrame([(1, "SALE", -1.0, D)], TRX_SCHEMA)
    inv = _inv(spark, [(1, None, None, None, None)])
    sup = spark.createDataFrame([(9, "s")], "supplier_id long, name string")
    r = G.gold_features(trx, inv, sup).collect()[0]
    assert r.stock_on_hand == 0.0 and r.stockout_risk == 1


def test_fan_out_suppliers_reduced(spark):
    trx = spark.createDataFrame([(1, "SALE", -1.0, D)], TRX_SCHEMA)
    inv = _inv(spark, [(1, 5.0, None, None, None)])
    sup = spark.createDataFrame([(1, 7, 9.0), (1, 3, None), (1, 3, 4.0)],
                                "product_id long, supplier_id long, avg_lead_time_days double")
    rows = G.gold_features(trx, inv, sup).collect()
    assert len(rows) == 1 and rows[0].avg_lead_time_days == 4.0


def test_same_key_name_on_both_sides(spark):
    trx = spark.createDataFrame([(1, "SALE", -1.0, D)], TRX_SCHEMA)
    inv = _inv(spark, [(1, 5.0, None, None, None)])
    sup = spark.createDataFrame([(1, 2.0)], "product_id long, avg_lead_time_days double")
    assert G.gold_features(trx, inv, sup).count() == 1


def test_identical_rows_without_ids_are_deduplicated(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a")], "k long, v string")
    out = C.clean_transactions(df.withColumnRenamed("v", "transaction_type"))
    assert out.count() == 1
    ids = {r.transaction_id for r in out.collect()}
    assert ids == {r.transaction_id for r in C.clean_transactions(
        df.withColumnRenamed("v", "transaction_type")).collect()}


def test_name_clash_raises(spark):
    df = spark.createDataFrame([(1, 2)], "`A B` int, `a-b` int")
    with pytest.raises(ValueError, match="collide"):
        C.normalize_columns(df)


def test_all_null_price_stays_null(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "product_id long, price double")
    assert [r.price for r in C.clean_inventory(df).collect()] == [None, None]


def test_median_imputation(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0), (4, 10.0)], "id long, cost double")
    got = {r.id: r.cost for r in C.impute_median(df, "cost").collect()}
    assert got[2] == 3.0


def test_unparseable_values_become_null_or_default(spark):
    df = spark.createDataFrame([("x", "bad"), ("2024-01-02 10:00:00", "4.5"), ("", None)],
                               "created_at string, quantity string")
    out = C.cast_with_default(C.parse_datetimes(df)).collect()
    assert out[0].created_at is None and out[0].quantity == 0.0
    assert out[1].created_at == dt.datetime(2024, 1, 2, 10) and out[1].quantity == 4.5
    assert out[2].created_at is None and out[2].quantity == 0.0


def test_dedup_by_key_is_deterministic_and_idempotent(spark):
    rows = [(1, "b", 2.0), (1, "a", None), (1, "a", 1.0), (2, "z", 0.0)]
    df = spark.createDataFrame(rows, "id long, t string, q double")
    one = rows_of(C.dedup_by_key(df, "id"))
    two = rows_of(C.dedup_by_key(df.repartition(3), "id"))
    assert one == two
    assert rows_of(C.dedup_by_key(C.dedup_by_key(df, "id"), "id")) == one
    assert {r.id: (r.t, r.q) for r in C.dedup_by_key(df, "id").collect()}[1] == ("a", 1.0)


def test_nan_and_null_scores(spark):
    nan = float("nan")
    scored = spark.createDataFrame(
        [(1, 5.0, 1.0, 9.0), (2, 5.0, nan, 9.0), (3, nan, 1.0, 9.0), (4, 5.0, 1.0, None), (5, 5.0, 0.0, 1.0)],
        "product_id long, stock_on_hand double, predicted_stockout double, predicted_rop double")
    r = {x.product_id: x for x in R.recommendations(scored).collect()}
    assert r[1].priority == "HIGH" and r[1].recommended_order == 4.0
    assert r[2].priority == "LOW"
    assert r[3].priority == "MEDIUM" and r[3].recommended_order is None
    assert r[4].priority == "MEDIUM" and r[4].recommended_order is None
    assert r[5].priority == "LOW" and r[5].recommended_order == 0.0


def test_priority_summary_zero_filled(spark):
    scored = spark.createDataFrame([(1, 5.0, 0, 1.0)],
                                   "product_id long, stock_on_hand double, predicted_stockout int, predicted_rop double")
    got = {r.priority: r.n_products for r in R.priority_summary(R.recommendations(scored)).collect()}
    assert got == {"HIGH": 0, "MEDIUM": 0, "LOW": 1}


def test_single_class_auc_is_null(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.9)], "y int, s double")
    r = M.auc_by_aggregation(df, "y", "s").collect()[0]
    assert r.auc is None and r.n_pos == 2 and r.n_neg == 0


def test_gold_invariants(spark):
    from support import SF_SMALL
    from larder.plans.catalog import gold_features

    g = gold_features(spark, SF_SMALL)
    agg = g.agg(F.count("*").alias("n"), F.countDistinct("product_id").alias("k"),
                F.min("stock_on_hand").alias("soh"), F.min("reorder_point").alias("rop")).collect()[0]
    assert agg.n == agg.k == 200
    assert agg.soh >= 0 and agg.rop >= 0


def test_datetime_formats_list(spark):
    df = spark.createDataFrame([("02/01/2024 07:30",), ("2024-01-03 00:00:00",), ("junk",)], "order_date string")
    got = [r.order_date for r in C.parse_datetimes(df, ["dd/MM/yyyy HH:mm", "yyyy-MM-dd HH:mm:ss"]).collect()]
    assert got == [dt.datetime(2024, 1, 2, 7, 30), dt.datetime(2024, 1, 3), None]


def test_inventory_string_dates_and_missing_columns(spark):
    trx = spark.createDataFrame([(1, "SALE", -4.0, D), (1, "SALE", -2.0, D + dt.timedelta(days=1))], TRX_SCHEMA)
    inv = spark.createDataFrame([(1, " 50 ", "2024-01-01", " 2024-01-11 ")],
                                "product_id long, stock_quantity string, last_order_date string, date_received string")
    sup = spark.createDataFrame([(1, 4.0)], "product_id long, leadtime double")
    r = G.gold_features(trx, inv, sup).collect()[0]
    assert r.initial_stock_quantity == 50.0 and r.stock_on_hand == 44.0
    assert r.actual_lead_time == 10.0 and r.procurement_lead_time == 7.0
    assert r.daily_sales_velocity == 3.0 and r.safety_stock == 21.0 and r.stockout_risk == 0
    assert "historical_reorder_level" not in G.gold_features(trx, inv, sup).columns


def test_role_trap_and_explicit_override(spark):
    from larder.functions.roles import resolve_inventory_roles

    cols = ["product_name", "product_id", "stock_quantity"]
    assert resolve_inventory_roles(cols).product == "product_name"      # first match, as specified
    r = resolve_inventory_roles(cols, product="product_id")
    trx = spark.createDataFrame([(7, "SALE", -1.0, D)], TRX_SCHEMA)
    inv = spark.createDataFrame([("widget", 7, 5.0)], "product_name string, product_id long, stock_quantity double")
    sup = spark.createDataFrame([(1, "s")], "supplier_id long, name string")
    g = G.gold_features(trx, inv, sup, inv_roles=r).collect()[0]
    assert g.product_id == 7 and g.stock_on_hand == 4.0


def test_missing_mandatory_role_raises(spark):
    from larder.functions.roles import resolve_transaction_roles

    with pytest.raises(ValueError, match="transactions.quantity"):
        resolve_transaction_roles(["product_id", "kind", "ts_date"])


def test_keys_of_text_meet_keys_of_numbers(spark):
    from larder.operators import reports as D

    moves = [("A1", 1, "SALE", -5.0), ("7", 1, "SALE", -3.0), (" 07", 1, "SALE", -2.0), ("7.0", 1, "IN", 4.0), ("7.5", 1, "IN", 9.0),
             (None, 1, "IN", 1.0)]
    inv = [(7, 10.0, "n7"), (8, 5.0, "n8")]
    mv = spark.createDataFrame(moves, "product_id string, supplier_ref int, transaction_type string, quantity_change double").selectExpr(
        "*", "date'2024-01-01' AS transaction_date")
    iv = spark.createDataFrame(inv, "product_id long, stock_quantity double, product_name string").withColumn("category", F.lit("c"))
    sup = spark.createDataFrame([("1", "7", 3.0, "s1"), ("x", "B", 4.0, "s2")],
                                "supplier_id string, product_id string, lead_time_days double, supplier_name string")
    want = {7: (9.0, 5.0), 8: (5.0, None)}
    got = {int(r.product_id): (r.stock_on_hand, r.total_sales) for r in G.gold_features(mv, iv, sup).collect()}
    assert got == want
    # the other way round: text in the inventory, numbers in the movements
    flipped = mv.where("product_id in ('7', ' 07', '7.0')").withColumn("product_id", F.lit(7))
    text = iv.withColumn("product_id", F.col("product_id").cast("string")).union(spark.createDataFrame([("A1", 1.0, "a", "c")], iv.withColumn("product_id", F.lit("")).schema))
    got = {r.product_id: (r.stock_on_hand, r.total_sales) for r in G.gold_features(flipped, text, sup).collect()}
    assert got == {"7": (9.0, 5.0), "8": (5.0, None), "A1": (1.0, None)}
    named = sorted((r.product_id or "", r.product_name, r.supplier_name) for r in D.enriched_movements(mv, iv, sup).collect())
    assert named == [("", None, "s1"), (" 07", "n7", "s1"), ("7", "n7", "s1"), ("7.0", "n7", "s1"), ("7.5", None, "s1"), ("A1", None, "s1")]
    report = {r.product_id: r.final_balance for r in D.inventory_performance_report(mv, iv).collect()}
    assert report == {7: 9.0, 8: 5.0}
