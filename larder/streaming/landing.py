"""Incremental landing of movement files with Structured Streaming.

New files in the source folder are appended to the raw zone exactly once: the
stream's checkpoint (in the shared checkpoint folder) records what has been
processed, so a restarted or retried job neither skips nor duplicates files.
``availableNow`` processes the current backlog in bounded micro-batches and
stops, which suits scheduled bronze runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def land_movements_incrementally(spark: SparkSession, src_dir: str, schema: T.StructType | str,
                                 dest: str, checkpoint: str, fmt: str = "parquet",
                                 max_files_per_trigger: int = 1000) -> DataFrame:
    stream = (
        spark.readStream.format(fmt).schema(schema)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(src_dir)
    )
    query = (
        stream.writeStream.format("parquet")
        .option("path", dest)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(schema).parquet(dest)
