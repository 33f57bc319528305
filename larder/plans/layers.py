"""Materialised layers (bronze → silver → gold) in the shared checkpoint folder.

Each layer is a written Parquet table: later stages read it with column
pruning and predicate pushdown, and a lost executor re-reads files instead of
recomputing the lineage. Within one application a layer built from the same
inputs is written once and then reused.
"""

from __future__ import annotations

import re
import threading

from pyspark.sql import DataFrame, SparkSession

from larder.operators import cleaning as C
from larder.plans import fixtures as fx
from larder.session import scratch_path
from larder.sources.writers import write_parquet

_WRITTEN: dict[tuple, str] = {}
_LOCKS: dict[tuple, threading.Lock] = {}
_LOCKS_GUARD = threading.Lock()

SUPPLIER_VARIANTS = {
    "per_product": fx.suppliers_per_product,
    "fan_out": fx.suppliers_fan_out,
    "global": fx.suppliers_global,
    "none": fx.suppliers_no_lead,
}


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def materialize(spark: SparkSession, df: DataFrame, name: str, num_files: int | None = None) -> DataFrame:
    """Write ``df`` under the checkpoint folder and return the re-read table."""
    path = scratch_path(spark, name)
    write_parquet(df, path, num_files=num_files)
    return spark.read.parquet(path)


def input_state(spark: SparkSession, sf_dir: str) -> int:
    """Hash of the input tables' files: names, sizes and modification times."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files, found = fs.listFiles(path, True), []
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hash(tuple(sorted(found)))


def _memo(spark: SparkSession, key: tuple, build) -> DataFrame:
    """Write ``build()`` once per application, key and state of the input files; re-read afterwards."""
    full = (spark.sparkContext.applicationId, input_state(spark, key[1])) + key
    with _LOCKS_GUARD:
        lock = _LOCKS.setdefault(full, threading.Lock())
    with lock:  # one writer per layer, even when queries run from several threads
        path = _WRITTEN.get(full)
        if path is None or not _exists(spark, path):
            path = scratch_path(spark, re.sub(r"[^A-Za-z0-9.]+", "_", "-".join(str(k).strip() for k in key)))
            write_parquet(build(), path)
            _WRITTEN[full] = path
    return spark.read.parquet(path)


def silver_transactions(spark: SparkSession, sf_dir: str, sale_label: str = " sale ") -> DataFrame:
    return _memo(spark, ("silver_transactions", sf_dir, sale_label),
                 lambda: C.clean_transactions(fx.stock_move(spark, sf_dir, sale_label)))


def silver_transactions_with_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver movements from a source that carries a (non-unique) ``id``: one row per id."""
    return _memo(spark, ("silver_transactions_id", sf_dir),
                 lambda: C.clean_transactions(fx.stock_move_with_id(spark, sf_dir)))


def silver_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _memo(spark, ("silver_inventory", sf_dir), lambda: C.clean_inventory(fx.inventory(spark, sf_dir)))


def silver_suppliers(spark: SparkSession, sf_dir: str, variant: str = "per_product") -> DataFrame:
    return _memo(spark, ("silver_suppliers", sf_dir, variant),
                 lambda: C.clean_suppliers(SUPPLIER_VARIANTS[variant](spark, sf_dir)))


def silver_tables(spark: SparkSession, sf_dir: str, suppliers: str = "per_product",
                  sale_label: str = " sale ") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Silver transactions, inventory and suppliers for the fixture inputs.

    The three tables are independent, so they are written as concurrent Spark
    jobs: a small table's job does not leave executor slots idle while
    another finishes.
    """
    from concurrent.futures import ThreadPoolExecutor

    builds = (lambda: silver_transactions(spark, sf_dir, sale_label),
              lambda: silver_inventory(spark, sf_dir),
              lambda: silver_suppliers(spark, sf_dir, suppliers))
    with ThreadPoolExecutor(max_workers=len(builds)) as pool:
        return tuple(f.result() for f in [pool.submit(b) for b in builds])


def gold_table(spark: SparkSession, sf_dir: str, suppliers: str = "per_product") -> DataFrame:
    """The written gold table (what reports and models read)."""
    from larder.operators.features import gold_features

    return _memo(spark, ("gold", sf_dir, suppliers),
                 lambda: gold_features(*silver_tables(spark, sf_dir, suppliers)))
