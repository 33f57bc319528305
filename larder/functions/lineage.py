"""Cut lineage for frames that are read several times.

A frame reused by several branches of a plan (a quantile subquery, a bucket
total and a per-bucket window, say) is otherwise recomputed from its sources
once per branch. ``stage`` writes it once as Parquet under the shared
checkpoint folder and returns the re-read table: the branches then scan a
small columnar table, and a lost executor re-reads files instead of
recomputing the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from larder.session import scratch_path


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
