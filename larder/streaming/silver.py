"""Incremental silver: each batch of raw movements is cleaned and only its new rows are appended.

The silver table is versioned (``sources.tables``): a batch adds one data folder
and, beside it, a Bloom filter of the folder's row identities. A batch's rows
are first looked up in the filters; only the folders that may hold some of them
are read (their identity column alone) to tell which are really known. A batch
without repeated rows thus reads a few bytes a known row instead of all ids.

Rows, filter and the stream's batch number appear in one manifest switch, so a
batch that is retried after a crash, or a file that is delivered twice, adds no
row. A row's identity is its ``id`` where the source has one, else its cleaned
content (by its hash); the first delivered row of an identity stays.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions import bloom
from larder.functions.columns import content_hash, normalized_names
from larder.functions.lineage import stage
from larder.operators import cleaning as C
from larder.sources import tables

#: Property of the table: per data folder its filter's folder and size.
FILTERS = "identity_filters"
#: Property of the table: per stream the last batch it holds.
BATCHES = "batches"


#: Property of the table: what identifies its rows (see ``identity_kind``).
IDENTITY = "identity"


def identity_kind(columns: list[str]) -> str:
    """``id`` for sources with one, ``transaction_id`` where that is the generated hash of the row, else ``content``."""
    names = normalized_names(columns)
    if C.DEDUP_KEY in names:
        return C.DEDUP_KEY
    return "content" if C.TRANSACTION_ID in names else C.TRANSACTION_ID


def identity(df: DataFrame, kind: str) -> Column:
    """What makes a cleaned row the same row."""
    if kind == "content":
        return content_hash([df[c] for c in sorted(df.columns)])
    return F.coalesce(F.col(kind).cast("string"), F.lit(""))


def _known(spark: SparkSession, path: str, version: tables.Version, keys: DataFrame, kind: str) -> DataFrame | None:
    """The identities among ``keys`` that the table holds already; None if no folder may hold any."""
    filters = version.properties.get(FILTERS, {})
    folders = [f for f in version.folders if f in filters]
    if not folders:
        return None
    parts = [spark.read.parquet(f"{path}/{filters[f]['folder']}").select(
        F.lit(f).alias("_filter"), F.lit(filters[f]["slots"]).cast("long").alias("slots"), "slot", "bits") for f in folders]
    maybe = stage(bloom.maybe_in(keys, F.col("_identity"), reduce(DataFrame.union, parts), [filters[f]["slots"] for f in folders]),
                  "silver-maybe")
    suspects = [r[0] for r in maybe.select("_filter").distinct().collect()]  # data folders, all named in the manifest
    if not suspects:
        return None
    held = tables.read_table(spark, path, folders=tuple(suspects))
    held = held.select(identity(held, kind).alias("_identity"))
    return held.join(maybe.select("_identity").distinct(), "_identity", "left_semi").distinct()


def append_new(batch: DataFrame, path: str, stream: str | None = None, batch_id: int | None = None) -> int:
    """Clean a batch of raw movements and append the rows the table does not hold; their number."""
    spark, path = batch.sparkSession, path.rstrip("/")
    version = tables.current(spark, path) or tables.Version()
    done = version.properties.get(BATCHES, {})
    if stream is not None and batch_id is not None and done.get(stream, -1) >= batch_id:
        return 0
    kind = identity_kind(batch.columns)
    if version.properties.get(IDENTITY, kind) != kind:
        raise ValueError(f"rows of {path} are identified by {version.properties[IDENTITY]}, those of the batch by {kind}")
    number = tables.next_number(spark, path)
    cleaned = C.clean_transactions(batch)
    cleaned = stage(cleaned.withColumn("_identity", identity(cleaned, kind)), "silver-batch")
    known = _known(spark, path, version, cleaned.select("_identity"), kind)
    new = cleaned if known is None else cleaned.join(known, "_identity", "left_anti")
    folder, n = tables.write_folder(new.drop("_identity").select(*[c for c in cleaned.columns if c != "_identity"]), path)
    properties = {**version.properties, IDENTITY: kind, BATCHES: {**done, **({stream: batch_id} if stream is not None else {})}}
    folders, rows = version.folders, version.rows
    if n or not folders:
        slots = bloom.slots_for(n)
        written = spark.read.parquet(f"{path}/{folder}")
        name = f"filter-{folder}"
        bloom.build(written, identity(written, kind), slots).write.parquet(f"{path}/{name}")
        properties[FILTERS] = {**version.properties.get(FILTERS, {}), folder: {"folder": name, "slots": slots}}
        folders, rows = folders + (folder,), {**rows, folder: n}
    tables.publish(spark, path, tables.Version(number, folders, rows, properties))
    return n


def clean_movements_incrementally(spark: SparkSession, src: str, schema: T.StructType | str, silver: str, checkpoint: str,
                                  fmt: str = "parquet", max_files_per_trigger: int = 1000, **options) -> DataFrame:
    """Append what the new files under ``src`` bring to the silver movements, and return them all.

    The backlog is taken in batches of ``max_files_per_trigger`` files
    (``availableNow``); the checkpoint records which files are done.
    """
    stream = (spark.readStream.format(fmt).schema(schema).options(**options)
              .option("maxFilesPerTrigger", max_files_per_trigger).load(src))
    query = (stream.writeStream.foreachBatch(lambda batch, i: append_new(batch, silver, checkpoint, i) and None)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return tables.read_table(spark, silver)
