"""Named queries over versioned tables, increments, sketches and saved models."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions import quantiles as Q
from larder.functions.lineage import stage
from larder.operators import cleaning as C
from larder.operators import modeling as M
from larder.plans import fixtures as fx
from larder.plans.incremental import incremental_gold
from larder.plans.layers import gold_table, silver_tables
from larder.session import scratch_path
from larder.sources import files, json_arrays, readers, tables, writers
from larder.sources.landing import land_chunked_documents
from larder.streaming.silver import clean_movements_incrementally

#: Dates that cut the movements into three deliveries.
DELIVERIES = ("1994-07-01", "1996-07-01")


def _deliveries(moves: DataFrame) -> list[DataFrame]:
    first, second = DELIVERIES
    day = F.to_date("transaction_date")
    return [moves.where(day < first), moves.where((day >= first) & (day < second)), moves.where((day >= second) | day.isNull())]


def replace_survives_failure(spark, sf):
    """Inventory written, then a replace that fails midway, as a plain folder and as a versioned table: both keep their rows."""
    inv = fx.inventory(spark, sf)
    plain, versioned = scratch_path(spark, "replace-plain"), scratch_path(spark, "replace-versioned")
    writers.write_parquet(inv, plain)
    tables.replace_table(inv, versioned)
    broken = inv.withColumn("product_name", F.when(F.col("product_id") < 50, F.col("product_name")).otherwise(
        F.raise_error(F.lit("delivery broke off"))))
    for write in (lambda: writers.write_parquet(broken, plain), lambda: tables.replace_table(broken, versioned)):
        try:
            write()
        except Exception as e:  # noqa: BLE001 - the planned failure, whatever wraps it
            if "delivery broke off" not in str(e):
                raise
        else:
            raise AssertionError("the broken delivery was written")
    both = spark.read.parquet(plain).withColumn("kept_by", F.lit("folder")).unionByName(
        tables.read_table(spark, versioned).withColumn("kept_by", F.lit("version")))
    return both


def gold_incremental(spark, sf):
    """Gold brought up after each of three deliveries of silver movements."""
    trx, inv, sup = silver_tables(spark, sf)
    silver, gold = scratch_path(spark, "inc-silver"), scratch_path(spark, "inc-gold")
    tables.replace_table(inv, f"{silver}/grocery_inventory")
    tables.replace_table(sup, f"{silver}/suppliers")
    for part in _deliveries(trx):
        tables.append_table(part, f"{silver}/stock_transactions")
        out = incremental_gold(spark, silver, gold)
    return out


def silver_incremental(spark, sf):
    """Movement files streamed into silver, two deliveries at a time, with a whole delivery repeated later.

    A delivery is written by the tasks that read it, so its files grow in number, not in size.
    """
    src, silver = scratch_path(spark, "inc-files"), scratch_path(spark, "inc-moves")
    moves = fx.stock_move(spark, sf)
    held = []
    for part in _deliveries(moves):
        writers.write_parquet(part, src, mode="append")
        held.append(sum(n.endswith(".parquet") for n in files.names(spark, src)))
    checkpoint = scratch_path(spark, "inc-ckpt")
    clean_movements_incrementally(spark, src, moves.schema, silver, checkpoint, max_files_per_trigger=held[1])
    writers.write_parquet(_deliveries(moves)[1], src, mode="append")
    return clean_movements_incrementally(spark, src, moves.schema, silver, checkpoint)


def quantile_sketch(spark, sf):
    """Price quartiles a category from sketches of the parts of the table, merged."""
    inv = C.cast_price(fx.inventory(spark, sf))
    parts = [Q.sketch(inv.where(cond), "unit_price", ["category"]) for cond in
             (F.col("stock_quantity") < 200, F.col("stock_quantity") >= 200)]
    return Q.quantiles(stage(Q.merge(*parts), "price-sketch"), [0.25, 0.5, 0.75], ["q1", "median", "q3"])


def sketch_median(spark, sf):
    """The median price by sketch (within one part in 2,048), and how many rows it stands for."""
    inv = fx.inventory(spark, sf)
    rows = stage(Q.sketch(inv, "unit_price"), "median-sketch")
    n = rows.select(F.sum("n")).scalar()
    return Q.quantiles(rows, [0.5], ["median"]).withColumn("n_rows", n)


def scan_csv_quoted_breaks(spark, sf):
    """Inventory whose names hold line breaks and quotes, through CSV files that many tasks read."""
    inv = fx.inventory(spark, sf)
    name = F.concat(F.lit('first "line",\n'), F.col("product_name"), F.lit("\r\n\nlast"))
    path = scratch_path(spark, "quoted-csv")
    writers.write_csv(inv.withColumn("product_name", F.when(F.col("product_id") % 3 == 0, name).otherwise(F.col("product_name"))), path)
    return readers.read_csv(spark, path, schema=inv.schema, multi_line=None)


def scan_json_array(spark, sf):
    """Supplier documents, few large arrays, read by byte ranges."""
    path = scratch_path(spark, "array-json")
    suppliers = fx.suppliers_per_product(spark, sf)
    writers.write_json_documents(suppliers, path, num_files=1)
    return json_arrays.read(spark, path, suppliers.schema)


def land_chunked_files(spark, sf):
    """Supplier documents landed in chunks of 64 KB, records read back out of the chunks."""
    docs = scratch_path(spark, "chunk-docs")
    suppliers = fx.suppliers_per_product(spark, sf)
    writers.write_json_documents(suppliers, docs, num_files=2)
    landed = land_chunked_documents(spark, docs, scratch_path(spark, "chunks"), chunk_bytes=64 << 10)
    return json_arrays.parse(json_arrays.pieces_of_chunks(landed), suppliers.schema)


def score_saved_models(spark, sf):
    """Products scored by the fitted forests and by their saved copies, and how many scores differ."""
    gold = gold_table(spark, sf)
    frame, feats = M.model_frame(gold)
    train = frame.where("split = 'train'")
    fitted = M.fit_classifier(train, num_trees=10), M.fit_regressor(train, num_trees=10)
    path = scratch_path(spark, "saved-models")
    M.save_models(spark, *fitted, feats, path)
    before = M.score_products(gold, *fitted).select("product_id", F.struct("predicted_stockout", "predicted_rop").alias("fitted"))
    after = M.score_products(gold, *M.load_models(spark, path, gold)).select(
        "product_id", F.struct("predicted_stockout", "predicted_rop").alias("loaded"))
    both = before.join(after, "product_id", "full_outer")
    return both.agg(F.count(F.lit(1)).alias("n_products"),
                    F.count(F.when(~F.col("fitted").eqNullSafe(F.col("loaded")), 1)).alias("n_different"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (replace_survives_failure, gold_incremental, silver_incremental, quantile_sketch, sketch_median,
           scan_csv_quoted_breaks, scan_json_array, land_chunked_files, score_saved_models)
    return {f.__name__: f for f in own}
