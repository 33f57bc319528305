"""Replaces that fail, versioned tables, increments, saved models, counted writes."""

import os
import random

import pytest
from pyspark.sql import functions as F
from support import SF_SMALL, rows_of

from larder.functions import bloom
from larder.operators import features as G
from larder.operators import modeling as M
from larder.plans import catalog
from larder.plans import fixtures as fx
from larder.plans.incremental import STATE, fresh_state, incremental_gold, new_folders
from larder.plans.layers import gold_table, silver_tables
from larder.session import scratch_path
from larder.sources import files, readers, tables, writers
from larder.streaming.silver import append_new, clean_movements_incrementally


def failing(df, column="id", at=7):
    return df.withColumn(column, F.when(F.col(column) == at, F.raise_error(F.lit("broken off"))).otherwise(F.col(column)))


# ------------------------------------------------------------------ replaces

@pytest.mark.parametrize("write, read", [
    (writers.write_parquet, lambda s, p: s.read.parquet(p)),
    (writers.write_csv, lambda s, p: readers.read_csv(s, p)),
    (tables.replace_table, tables.read_table),
])
def test_failed_replace_leaves_the_old_rows(spark, write, read):
    root = scratch_path(spark, "replace")
    path = f"{root}/t"
    write(spark.range(10), path)
    with pytest.raises(Exception, match="broken off"):
        write(failing(spark.range(100, 200), at=150), path)
    assert sorted(int(r.id) for r in read(spark, path).collect()) == list(range(10))
    if read is not tables.read_table:
        assert files.names(spark, root) == ["t"]  # nothing left beside it
    write(spark.range(5), path)
    assert read(spark, path).count() == 5


def test_replace_may_read_what_it_replaces(spark):
    path = f"{scratch_path(spark, 'self')}/t"
    writers.write_parquet(spark.range(10), path)
    writers.write_parquet(spark.read.parquet(path).where("id > 5"), path)
    assert spark.read.parquet(path).count() == 4


def test_writes_count_without_a_count_job(spark):
    root = scratch_path(spark, "counted")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counted-write", "one write")
    try:
        assert writers.write_parquet(spark.range(0, 1000, numPartitions=3), f"{root}/p") == 1000
        assert len(tracker.getJobIdsForGroup("counted-write")) == 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert writers.write_parquet(spark.range(77), f"{root}/p", compact=True) == 77
    assert writers.write_csv(spark.range(5), f"{root}/c", num_files=2) == 5
    assert writers.write_parquet(spark.range(0), f"{root}/e") == 0


# ------------------------------------------------------------------ versions

def test_versions_readers_and_writers(spark):
    path = scratch_path(spark, "versions")
    tables.replace_table(spark.range(3), path)
    reader = tables.read_table(spark, path)
    tables.append_table(spark.range(3, 5), path, {"note": "x"})
    assert reader.count() == 3 and tables.read_table(spark, path).count() == 5 == tables.table_rows(spark, path)
    tables.replace_table(tables.read_table(spark, path).where("id >= 2"), path)
    version = tables.current(spark, path)
    assert version.number == 3 and len(version.folders) == 1 and reader.count() == 3
    # Of two writers from one version the second fails; its rows are in no version.
    with pytest.raises(Exception):
        tables.publish(spark, path, version)
    # A manifest that was never finished does not count, nor is its number used again.
    files.create_text(spark, f"{path}/{tables.MANIFESTS}/00000004.json", '{"number": 4, "fol')
    assert tables.read_table(spark, path).count() == 3
    assert tables.append_table(spark.range(1), path).number == 5
    gone = tables.vacuum(spark, path, keep=1)
    assert len(gone) == 2 and tables.read_table(spark, path).count() == 4


def test_plain_folders_are_read_as_they_are(spark):
    path = scratch_path(spark, "plain")
    writers.write_parquet(spark.range(4), path)
    assert tables.read_table(spark, path).count() == 4 and tables.table_rows(spark, path) is None


# ------------------------------------------------------------------ gold increments

def test_day_words_equal_day_sets(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(1, 6), rnd.choice(["SALE", "x", None]), float(rnd.randint(-5, 5)),
             rnd.choice([None, "1969-12-31", "1970-01-01", "1969-10-28", "2024-02-29", f"20{rnd.randint(10, 99)}-03-04"]))
            for _ in range(600)]
    df = spark.createDataFrame(rows, "product_id long, txn_type string, quantity double, d string")
    mv = df.select("product_id", "txn_type", "quantity", F.to_date("d").alias("txn_day"))
    want = {}
    for p, t, q, d in rows:
        n, total, days = want.setdefault(p, (0, 0.0, set()))
        if t == "SALE":
            want[p] = (n + 1, total + q, days | ({d} - {None}))
    for summary in (G.movement_summary(mv), G.summary_from_state(G.movement_state(mv))):
        got = {r.product_id: (r.sold_rows, r.total_sales, r.active_days) for r in summary.collect()}
        assert got == {p: (n, abs(s) if n else None, len(d) if n else None) for p, (n, s, d) in want.items()}


def test_gold_aggregates_by_hash_only(spark):
    plan = G.movement_summary(G.canonical_movements(fx.stock_move(spark, SF_SMALL)))._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan and "collect_set" not in plan
    assert plan.count("bit_or") >= 2


def test_states_merge_in_any_grouping_and_keep_the_fallback(spark):
    mv = G.canonical_movements(fx.stock_move(spark, SF_SMALL, " movement "))
    parts = [mv.where(F.pmod(F.hash("product_id", "txn_day", "quantity"), F.lit(3)) == i) for i in range(3)]
    states = [G.movement_state(p) for p in parts]
    merged = G.merge_states(G.merge_states(states[2], states[0]), states[1])
    assert rows_of(G.summary_from_state(merged)) == rows_of(G.movement_summary(mv))
    with_sale = mv.union(spark.createDataFrame([(1, "SALE", -2.0, None)], mv.schema))
    late = G.merge_states(merged, G.movement_state(with_sale.where("txn_type = 'SALE'")))
    assert rows_of(G.summary_from_state(late)) == rows_of(G.movement_summary(with_sale))


def test_incremental_gold_reads_only_new_folders(spark):
    trx, inv, sup = silver_tables(spark, SF_SMALL)
    silver, gold = scratch_path(spark, "inc-silver"), scratch_path(spark, "inc-gold")
    moves = f"{silver}/stock_transactions"
    tables.replace_table(inv, f"{silver}/grocery_inventory")
    tables.replace_table(sup, f"{silver}/suppliers")
    cut = F.col("transaction_date") < "1995-06-01"
    tables.append_table(trx.where(cut), moves)
    incremental_gold(spark, silver, gold)
    tables.append_table(trx.where(~cut), moves)
    folders, names, kept = new_folders(spark, moves, f"{gold}/{STATE}")
    assert len(folders) == 1 and len(names) == 2 and kept
    read = fresh_state(spark, moves, folders, inv).inputFiles()
    assert read and all(folders[0] in f for f in read)
    got = incremental_gold(spark, silver, gold)
    assert rows_of(got) == rows_of(catalog.gold_features(spark, SF_SMALL))
    assert "quantity_change" not in got._jdf.queryExecution().executedPlan().toString()
    assert new_folders(spark, moves, f"{gold}/{STATE}")[0] == []
    # Silver replaced: the state is built anew.
    tables.replace_table(trx.limit(50), moves)
    assert rows_of(incremental_gold(spark, silver, gold)) == rows_of(G.gold_features(tables.read_table(spark, moves), inv, sup))


# ------------------------------------------------------------------ silver increments

def test_bloom_filter_never_misses_and_seldom_errs(spark):
    inside, outside = spark.range(20_000), spark.range(10**6, 10**6 + 20_000)
    slots = bloom.slots_for(20_000)
    found = bloom.build(inside, F.col("id"), slots).select(
        F.lit("f").alias("_filter"), F.lit(slots).cast("long").alias("slots"), "slot", "bits")
    other = bloom.build(spark.range(10), F.col("id"), 16).select(
        F.lit("g").alias("_filter"), F.lit(16).cast("long").alias("slots"), "slot", "bits")
    both = found.union(other)
    hits = bloom.maybe_in(inside, F.col("id"), both, [slots, 16])
    assert hits.where("_filter = 'f'").select("id").distinct().count() == 20_000
    assert hits.where("_filter = 'g' and id < 10").count() == 10
    assert bloom.maybe_in(outside, F.col("id"), found, [slots]).count() < 400


def test_replayed_rows_are_not_appended(spark):
    path = scratch_path(spark, "silver-moves")
    moves = fx.stock_move(spark, SF_SMALL)
    early = F.col("transaction_date") < "1995-06-01"
    n = moves.count()
    assert append_new(moves.where(early), path, "s", 0) == moves.where(early).count()
    assert append_new(moves.where(early), path, "s", 0) == 0      # the batch again
    assert append_new(moves, path, "s", 1) == n - moves.where(early).count()
    assert append_new(moves, path) == 0                            # the file again, from elsewhere
    assert rows_of(tables.read_table(spark, path)) == rows_of(catalog.clean_transactions(spark, SF_SMALL))
    assert tables.table_rows(spark, path) == n
    with pytest.raises(ValueError, match="identified"):
        append_new(fx.stock_move_with_id(spark, SF_SMALL), path)


def test_ids_keep_their_first_delivery(spark):
    path = scratch_path(spark, "silver-ids")
    schema = "id long, quantity string, product string"
    append_new(spark.createDataFrame([(1, "5", "a"), (2, "6", "b"), (None, "1", "n")], schema), path)
    assert append_new(spark.createDataFrame([(2, "9", "z"), (3, "x", "c"), (None, "2", "n")], schema), path) == 1
    got = {r.id: (r.quantity, r["product"]) for r in tables.read_table(spark, path).collect()}
    assert got == {1: (5.0, "a"), 2: (6.0, "b"), 3: (0.0, "c"), None: (1.0, "n")}
    assert append_new(spark.createDataFrame([], schema), path) == 0


def test_streamed_files_delivered_twice(spark):
    src, silver, ckpt = (scratch_path(spark, n) for n in ("files", "moves", "ckpt"))
    moves = fx.stock_move(spark, SF_SMALL)
    writers.write_parquet(moves, src, num_files=3)
    first = clean_movements_incrementally(spark, src, moves.schema, silver, ckpt, max_files_per_trigger=1).count()
    writers.write_parquet(moves, src, num_files=2, mode="append")
    again = clean_movements_incrementally(spark, src, moves.schema, silver, ckpt)
    assert first == again.count() == moves.distinct().count()


# ------------------------------------------------------------------ models and jobs

def test_saved_models_score_alike(spark):
    gold = gold_table(spark, SF_SMALL)
    frame, feats = M.model_frame(gold)
    train = frame.where("split = 'train'")
    fitted = M.fit_classifier(train, num_trees=5), M.fit_regressor(train, num_trees=5)
    path = scratch_path(spark, "models")
    M.save_models(spark, *fitted, feats, path)
    M.save_models(spark, *fitted, feats, path)  # replaced
    loaded = M.load_models(spark, path, gold)
    assert rows_of(M.score_products(gold, *loaded)) == rows_of(M.score_products(gold, *fitted))
    with pytest.raises(ValueError, match="fitted on"):
        M.load_models(spark, path, gold.drop("total_sales"))


def test_jobs_with_versions_increments_breaks_and_csv_scores(spark, tmp_path):
    from larder.plans.jobs import run_gold, run_models, run_recommendations, run_score, run_silver

    raw, root = scratch_path(spark, "raw"), scratch_path(spark, "lake")
    silver, gold, out = f"{root}/silver", f"{root}/gold", f"{root}/models"
    moves = fx.stock_move(spark, SF_SMALL)
    inv = fx.inventory(spark, SF_SMALL).withColumn("product_name", F.concat("product_name", F.lit('\n"x"')))
    early = F.col("transaction_date") < "1995-06-01"
    writers.write_csv(inv, f"{raw}/grocery_inventory")
    writers.write_json_documents(fx.suppliers_per_product(spark, SF_SMALL), f"{raw}/suppliers")
    for part in (moves.where(early), moves):
        writers.write_csv(part, f"{raw}/stock_transactions")
        counts = {r.dataset: r.n_rows for r in
                  run_silver(spark, raw, silver, versioned=True, movements_increment=True).collect()}
        assert counts["grocery_inventory"] == 200
        report = run_gold(spark, silver, gold, incremental=True, versioned=True).collect()[0]
    assert counts["stock_transactions"] == moves.where(~early).count() and report.total_products == 200
    names = {r.product_name for r in tables.read_table(spark, f"{silver}/grocery_inventory").collect()}
    assert len(names) > 1 and all(n.endswith('\n"x"') for n in names)
    got = tables.read_table(spark, f"{gold}/gold_features")
    for c in ("product_id", "supplier_product_ref"):
        got = got.withColumn(c, got[c].cast("bigint"))
    assert rows_of(got) == rows_of(catalog.gold_features(spark, SF_SMALL))
    run_models(spark, gold, out)
    fitted = rows_of(spark.read.parquet(f"{out}/model_output"))
    assert [tuple(r) for r in run_score(spark, gold, out).collect()] == [("model_output", 200)]
    assert rows_of(spark.read.parquet(f"{out}/model_output")) == fitted
    by_parquet = {r.priority: r.n_products for r in run_recommendations(spark, f"{out}/model_output", f"{root}/recs").collect()}
    writers.write_csv(spark.read.parquet(f"{out}/model_output"), f"{root}/scores-csv", num_files=1)
    by_csv = {r.priority: r.n_products for r in
              run_recommendations(spark, f"{root}/scores-csv", f"{root}/recs-csv", scored_format="csv").collect()}
    assert by_csv == by_parquet and sum(by_csv.values()) == 200


def test_deliveries_grow_in_files_not_in_the_size_of_one(spark, tmp_path, monkeypatch):
    from larder.plans import table_catalog

    rows = spark.range(4000).selectExpr(
        "id AS l_orderkey", "id % 50 AS l_partkey", "id % 7 AS l_suppkey", "cast(id % 4 as int) AS l_linenumber",
        "cast(id % 9 as double) AS l_quantity", "'A' AS l_returnflag", "'F' AS l_linestatus",
        "cast(date_add(date'1993-01-01', cast(id % 2000 as int)) as timestamp_ntz) AS l_shipdate")
    rows.repartition(4).write.parquet(str(tmp_path / "lineitem.parquet"))
    seen, scratch = {}, table_catalog.scratch_path
    monkeypatch.setattr(table_catalog, "scratch_path", lambda s, name: seen.setdefault(name, scratch(s, name)))
    key = "spark.sql.files.openCostInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, str(128 << 20))  # each input file is a task of its own
    try:
        got = table_catalog.silver_incremental(spark, str(tmp_path))
        assert got.count() == 4000 and got.select("transaction_id").distinct().count() == 4000
    finally:
        spark.conf.set(key, old)
    files = [f for f in os.listdir(seen["inc-files"]) if f.endswith(".parquet")]
    assert len(files) == 16  # four deliveries of four files
    batches = [f for f in os.listdir(seen["inc-ckpt"] + "/commits") if f.isdigit()]
    assert len(batches) == 3  # as with one file a delivery
