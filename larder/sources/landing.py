"""Bronze landing: copy the three sources into the raw zone, as a Spark job.

Movements come from a relational table (or any DataFrame), inventory from CSV,
supplier documents as raw file bytes. Nothing is interpreted: the movement table
lands as Parquet with its types, CSV fields as text in CSV, documents byte-for-byte.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larder.sources import json_arrays
from larder.sources.readers import read_csv, read_raw_files
from larder.sources.writers import write_csv, write_parquet


def land_raw_documents(spark: SparkSession, src: str, dest: str, glob: str | None = None,
                       counts: dict[str, int] | None = None) -> DataFrame:
    """Land files unchanged as ``(path, length, content)`` Parquet rows (``counts["suppliers"]``: how many, if asked for)."""
    raw = read_raw_files(spark, src, glob).select("path", "length", "content")
    n = write_parquet(raw, dest)
    if counts is not None:
        counts["suppliers"] = n
    return spark.read.parquet(dest)


def land_chunked_documents(spark: SparkSession, src: str, dest: str, separator: str = json_arrays.SEPARATOR,
                           chunk_bytes: int = json_arrays.CHUNK_BYTES) -> DataFrame:
    """Land documents as ``(path, at, content)`` rows of about ``chunk_bytes``: no limit on a file, many tasks read one.

    For files too large for a row (2 GB) or a task; ``json_arrays.pieces_of_chunks``
    with ``json_arrays.parse`` reads array documents back without putting them together.
    """
    write_parquet(json_arrays.chunks(json_arrays.pieces(spark, src, separator), separator, chunk_bytes), dest)
    return spark.read.parquet(dest)


def land_bronze(spark: SparkSession, movements: DataFrame, inventory_csv: str, documents_dir: str, raw_root: str,
                inventory_schema=None, documents_glob: str | None = "*.json", multi_line: bool | None = None,
                counts: dict[str, int] | None = None) -> dict[str, DataFrame]:
    """Write the raw zone and return the landed datasets (re-read; ``inventory_schema`` only types what is returned).

    ``counts`` is filled with the rows written of each dataset.
    """
    root = raw_root.rstrip("/")
    counts = {} if counts is None else counts
    counts["stock_transactions"] = write_parquet(movements, f"{root}/stock_transactions")
    counts["grocery_inventory"] = write_csv(read_csv(spark, inventory_csv, multi_line=multi_line), f"{root}/grocery_inventory")
    docs = land_raw_documents(spark, documents_dir, f"{root}/suppliers", glob=documents_glob, counts=counts)
    return {
        "stock_transactions": spark.read.parquet(f"{root}/stock_transactions"),
        "grocery_inventory": read_csv(spark, f"{root}/grocery_inventory", schema=inventory_schema, multi_line=multi_line),
        "suppliers": docs,
    }
