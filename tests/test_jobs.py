"""The layer jobs end to end, from landed text files."""

from support import SF_SMALL, rows_of

from larder.plans import catalog
from larder.plans import fixtures as fx
from larder.plans.jobs import run_all
from larder.session import scratch_path
from larder.sources import writers


def test_jobs_end_to_end(spark):
    raw, root = scratch_path(spark, "raw"), scratch_path(spark, "lake")
    writers.write_csv(fx.stock_move(spark, SF_SMALL), f"{raw}/stock_transactions")
    writers.write_csv(fx.inventory(spark, SF_SMALL), f"{raw}/grocery_inventory")
    writers.write_json_documents(fx.suppliers_per_product(spark, SF_SMALL), f"{raw}/suppliers")
    result = run_all(spark, raw, root)
    assert result["silver"]["grocery_inventory"] == 200
    assert result["gold"]["total_products"] == 200
    assert sum(result["priorities"].values()) == 200
    assert set(result["models"]["feature_importance"]) <= set(
        ["initial_stock_quantity", "stock_on_hand", "total_sales", "active_days", "daily_sales_velocity",
         "actual_lead_time", "avg_lead_time_days", "procurement_lead_time"])
    gold = spark.read.parquet(f"{root}/gold/gold_features")
    cast = gold.withColumn("product_id", gold["product_id"].cast("bigint")).withColumn(
        "supplier_product_ref", gold["supplier_product_ref"].cast("bigint"))
    assert rows_of(cast) == rows_of(catalog.gold_features(spark, SF_SMALL))
    assert result["gold"]["pct_at_risk"] + result["gold"]["pct_safe"] == 100.0
    assert set(result["reports"]) == {
        "inventory_performance_report", "supplier_efficiency_metrics", "inventory_status", "restock_list",
        "supplier_review", "outflow_anomalies", "top_k_velocity", "enriched_movements"}
    for path in result["reports"].values():
        assert spark.read.parquet(path).columns
    moves = spark.read.parquet(f"{root}/silver/stock_transactions").count()
    assert spark.read.parquet(result["reports"]["enriched_movements"]).count() == moves
    assert spark.read.parquet(f"{root}/gold/feature_stats").count() == 6


def test_bronze_to_recommendations_on_the_landed_folder_only(spark):
    from larder.plans.jobs import run_bronze

    src, raw, root = scratch_path(spark, "src"), scratch_path(spark, "landed"), scratch_path(spark, "lake")
    writers.write_csv(fx.inventory(spark, SF_SMALL), f"{src}/inventory")
    writers.write_json_documents(fx.suppliers_per_product(spark, SF_SMALL).withColumnRenamed("supplier_id", "id"),
                                 f"{src}/documents.json")
    from larder.sources import landing
    landing.land_bronze(spark, fx.stock_move(spark, SF_SMALL), f"{src}/inventory", f"{src}/documents.json", raw,
                        documents_glob="part-*")
    result = run_all(spark, raw, root, landed=True)
    assert result["silver"]["stock_transactions"] > 0 and result["gold"]["total_products"] == 200
    assert "supplier_id" in spark.read.parquet(f"{root}/silver/suppliers").columns
    gold = spark.read.parquet(f"{root}/gold/gold_features")
    for c in ("product_id", "supplier_product_ref"):
        gold = gold.withColumn(c, gold[c].cast("bigint"))
    assert rows_of(gold) == rows_of(catalog.gold_features(spark, SF_SMALL))
    counts = run_bronze(spark, fx.stock_move(spark, SF_SMALL), f"{src}/inventory", f"{src}/documents.json", f"{src}/again")
    assert {r.dataset: r.n_rows for r in counts.collect()}["grocery_inventory"] == 200


def test_documents_of_unknown_schema(spark, tmp_path):
    from larder.sources import readers

    (tmp_path / "a.json").write_text('[{"k": 1, "n": {"x": [1, 2]}},\n {"k": "b"}]')
    (tmp_path / "b.json").write_text('[]')
    (tmp_path / "c.json").write_text('[{"z": null, "k": 2.50}]')
    got = readers.json_document_records(readers.read_raw_files(spark, str(tmp_path)))
    assert got.columns == ["k", "n", "z"]
    assert sorted(map(tuple, got.collect())) == [("1", '{"x":[1,2]}', None), ("2.5", None, None), ("b", None, None)]


def test_numbers_of_landed_documents_keep_their_digits(spark, tmp_path):
    from larder.sources import readers

    (tmp_path / "a.json").write_text('[{"d": 12345678901234567.89, "i": 123456789012345678901234567890123456789012, "e": 1e3},\n'
                                     ' {"d": -0.10, "i": 7, "e": "0.10", "n": [1.5]}]')
    got = readers.json_document_records(readers.read_raw_files(spark, str(tmp_path), "a.json"))
    assert got.columns == ["d", "e", "i", "n"]
    assert sorted(map(tuple, got.collect()), key=repr) == [
        ("-0.1", "0.10", "7", "[1.5]"),
        ("12345678901234567.89", "1000.0", "123456789012345678901234567890123456789012", None)]


def test_silver_job_with_parquet_movements_and_sampled_inference(spark):
    from larder.plans.jobs import run_silver

    raw, silver = scratch_path(spark, "raw"), scratch_path(spark, "silver")
    writers.write_parquet(fx.stock_move(spark, SF_SMALL), f"{raw}/stock_transactions")
    writers.write_csv(fx.inventory(spark, SF_SMALL), f"{raw}/grocery_inventory")
    writers.write_json_documents(fx.suppliers_per_product(spark, SF_SMALL), f"{raw}/suppliers")
    counts = {r.dataset: r.n_rows for r in
              run_silver(spark, raw, silver, movements_format="parquet").collect()}
    assert counts["stock_transactions"] == fx.stock_move(spark, SF_SMALL).count()
    assert counts["grocery_inventory"] == 200
    moves = spark.read.parquet(f"{silver}/stock_transactions")
    assert dict(moves.dtypes)["transaction_date"] == "timestamp_ntz"


def test_jobs_cli_silver_and_gold(spark, capsys):
    import json

    from larder.plans.jobs import main

    raw, lake = scratch_path(spark, "raw"), scratch_path(spark, "lake")
    writers.write_csv(fx.stock_move(spark, SF_SMALL), f"{raw}/stock_transactions")
    writers.write_csv(fx.inventory(spark, SF_SMALL), f"{raw}/grocery_inventory")
    writers.write_json_documents(fx.suppliers_per_product(spark, SF_SMALL), f"{raw}/suppliers")
    main(["silver", "--raw", raw, "--silver", f"{lake}/silver"])
    main(["gold", "--silver", f"{lake}/silver", "--gold", f"{lake}/gold"])
    out = [json.loads(line) for line in capsys.readouterr().out.splitlines() if line.startswith(("[", "{"))]
    assert {d["dataset"] for d in out[0]} == {"stock_transactions", "grocery_inventory", "suppliers"}
    assert out[1]["total_products"] == 200 and out[1]["at_risk"] == 53
