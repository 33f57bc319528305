"""A hot key holding a third of all rows: results stay exact, work stays combined map-side."""

import datetime as dt
import random

import pandas as pd
from pyspark.sql import functions as F

from larder.operators import cleaning as C
from larder.operators import features as G
from larder.operators import reports as D


def _movements(spark, n=6000, seed=5):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        product = 1 if i % 3 == 0 else rnd.randint(2, 60)          # product 1: a third of all rows
        supplier = 7 if i % 3 == 1 else rnd.randint(1, 20)         # supplier 7: another third
        kind = rnd.choice(["SALE", "purchase", "adjustment"])
        q = float(rnd.randint(1, 40)) * (-1 if kind == "SALE" or rnd.random() < 0.2 else 1)
        day = dt.datetime(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 90))
        rows.append((i, supplier, product, kind, q, day))
    rows += [rows[0]] * (n // 3)                                     # a block of identical copies
    schema = ("order_ref long, supplier_ref long, product_id long, transaction_type string, "
              "quantity_change double, transaction_date timestamp_ntz")
    return spark.createDataFrame(rows, schema).repartition(6), pd.DataFrame(rows, columns=[
        "order_ref", "supplier_ref", "product_id", "transaction_type", "quantity_change", "transaction_date"])


def test_hot_product_summary_matches_brute_force(spark):
    sdf, pdf = _movements(spark)
    clean = C.dedup_rows(sdf)
    got = {r.product_id: r for r in G.movement_summary(G.canonical_movements(clean)).collect()}
    p = pdf.drop_duplicates()
    sales = p[p.transaction_type.str.upper() == "SALE"]
    for pid, grp in p.groupby("product_id"):
        s = sales[sales.product_id == pid]
        assert got[pid].net_quantity == grp.quantity_change.sum()
        if len(s):
            assert got[pid].total_sales == abs(s.quantity_change.sum())
            assert got[pid].active_days == s.transaction_date.dt.date.nunique()


def test_hot_supplier_metrics_match_brute_force(spark):
    sdf, pdf = _movements(spark)
    got = {r.supplier_id: r for r in D.supplier_efficiency_metrics(sdf).collect()}
    inbound = pdf[pdf.quantity_change > 0]
    total = inbound.quantity_change.sum()
    for sid, grp in inbound.groupby("supplier_ref"):
        assert got[sid].inbound_quantity == grp.quantity_change.sum()
        assert got[sid].n_products == grp.product_id.nunique()
        assert abs(got[sid].inbound_share - grp.quantity_change.sum() / total) < 1e-12


def test_hot_product_anomalies_match_brute_force(spark):
    sdf, pdf = _movements(spark)
    sales = G.filter_sales_with_fallback(sdf, "transaction_type", "quantity_change")
    got = sorted((r.product_id, r.order_ref) for r in
                 D.outflow_anomalies(sales, "product_id", "quantity_change", k=1.0).collect())
    s = pdf[pdf.transaction_type == "SALE"].copy()
    s["out"] = s.quantity_change.abs()
    st = s.groupby("product_id").out.agg(["mean", "std"])
    s = s.join(st, on="product_id")
    want = sorted((int(r.product_id), int(r.order_ref)) for r in s[s.out > s["mean"] + 1.0 * s["std"]].itertuples())
    assert got == want


def test_aggregations_combine_map_side(spark):
    sdf, _ = _movements(spark)
    plan = G.movement_summary(G.canonical_movements(sdf))._jdf.queryExecution().executedPlan().toString()
    # the summary shuffles once, and only partial aggregates (sums and day sets), never raw rows
    assert "partial_sum" in plan and "partial_bit_or" in plan
    assert plan.split("== Initial Plan ==")[-1].count("Exchange hashpartitioning") <= 2  # + repartition(6) of the input
    dedup = C.dedup_by_key(sdf, "product_id")._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in dedup and "Window" not in dedup


def test_enriched_movements_with_hot_and_null_keys_matches_brute_force(spark):
    sdf, pdf = _movements(spark, n=1500)
    extra = [(90001, None, 1, "SALE", -1.0, dt.datetime(2024, 2, 1)),
             (90002, 3, None, "SALE", -2.0, dt.datetime(2024, 2, 2)),
             (90003, None, None, "purchase", 5.0, None)]
    schema = sdf.schema
    trx = sdf.unionByName(spark.createDataFrame(extra, schema))
    inv = spark.createDataFrame([(p, f"name{p}", f"cat{p % 3}") for p in range(1, 50)],
                                "product_id long, product_name string, category string")
    sup = spark.createDataFrame([(s, f"sup{s}") for s in range(1, 15)], "supplier_id long, supplier_name string")
    got = sorted((r.order_ref, r.product_name, r.supplier_name) for r in
                 D.enriched_movements(trx, inv, sup).collect())
    p = pd.concat([pdf, pd.DataFrame(extra, columns=pdf.columns)]).astype({"product_id": "Int64", "supplier_ref": "Int64"})
    m = p.merge(inv.toPandas().astype({"product_id": "Int64"}), on="product_id", how="left")
    m = m.merge(sup.toPandas().astype({"supplier_id": "Int64"}), left_on="supplier_ref", right_on="supplier_id",
                how="left")
    norm = lambda v: None if (v is None or (isinstance(v, float) and v != v) or v is pd.NA) else v
    want = sorted((int(r.order_ref), norm(r.product_name), norm(r.supplier_name)) for r in m.itertuples())
    assert len(got) == len(want) == trx.count()
    assert got == want


def test_salts_follow_a_keys_rows(spark):
    from larder.functions.skew import hot_keys, replicate_for_salts, salt_rows

    # 13,000 rows: key 1 holds a third, key 2 one in 65, the rest 20 rows each
    n, share = 13_000, 100
    key = F.when(F.col("id") < n // 3, 1).when(F.col("id") < n // 3 + n // 65, 2).otherwise(3 + F.col("id") % 430)
    rows = spark.range(n).withColumn("k", key)
    counts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    hot = hot_keys(counts, "k", "n", rows_per_salt=share)
    assert {r._hk0: r._salts for r in hot.collect()} == {1: 44, 2: 2}
    salted = salt_rows(rows, rows["k"], hot).groupBy("k", "_salt").count()
    most = {r.k: r.m for r in salted.groupBy("k").agg(F.max("count").alias("m")).collect()}
    assert max(most.values()) < 1.5 * share
    assert salted.where("k > 2 and _salt > 0").count() == 0
    rep = {r.k: r["count"] for r in replicate_for_salts(counts, counts["k"], hot).groupBy("k").count().collect()}
    assert rep[1] == 44 and rep[2] == 2 and rep[3] == 1
    # the list of hot keys stays below its bound, whatever the share asked for
    assert hot_keys(counts, "k", "n", rows_per_salt=1, most_hot=50).count() < 50


def test_salted_anomalies_equal_unsalted(spark, monkeypatch):
    from larder.functions import skew

    sdf, _ = _movements(spark)
    sales = G.filter_sales_with_fallback(sdf, "transaction_type", "quantity_change")
    plain = sorted(map(tuple, D.outflow_anomalies(sales, "product_id", "quantity_change", k=1.0).collect()))
    monkeypatch.setattr(D, "hot_keys", lambda c, k, n: skew.hot_keys(c, k, n, rows_per_salt=50))
    salted = sorted(map(tuple, D.outflow_anomalies(sales, "product_id", "quantity_change", k=1.0).collect()))
    assert plain == salted and plain


def _planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_rows_are_shuffled_before_their_duplicates_go(spark):
    moves = spark.range(2000).selectExpr("id % 1500 AS product_id", "cast(id % 1500 as double) AS quantity_change",
                                         "if(id % 1500 < 9, 'sale', 'purchase') AS transaction_type",
                                         "date_add(date'2024-01-01', cast(id % 1500 as int)) AS transaction_date")
    clean = C.clean_transactions(moves)
    plan = _planned(clean)
    # one exchange, with no aggregate below it that would hold a split's distinct rows
    assert plan.count("Exchange ") == 1 and "Aggregate" in plan.split("Exchange ")[0]
    assert "Aggregate" not in plan.split("Exchange ")[1]
    assert clean.count() == 1500


def test_frequent_fact_rows_are_combined_before_the_shuffle(spark):
    rows = spark.range(6000).selectExpr(
        "if(id < 3000, 7, id) AS a", "if(id < 3000, null, cast('NaN' as double)) AS b",
        "if(id % 2 = 0, 0.0D, -0.0D) AS c", "if(id < 3000, null, 'x') AS `d.e`")
    rows = rows.unionByName(rows.where("a % 3 = 0"))
    plain, spread = C.dedup_rows(rows), C.dedup_fact_rows(rows, share=1.0, copies=100)
    plan = _planned(spread)
    assert "Union" in plan and plan.count("Exchange ") == 2
    frequent = plan.split("Exchange ")[2]
    assert "Aggregate" in frequent  # combined below its exchange
    assert _planned(C.dedup_fact_rows(rows, share=1.0, copies=10_000)).count("Exchange ") == 1
    for got in (spread, C.dedup_fact_rows(rows, share=1.0, copies=10_000)):
        assert got.columns == rows.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
