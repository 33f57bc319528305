"""Sinks: Parquet and CSV datasets, replaced as a whole.

A replace fills a folder beside the old one and swaps the two when it is whole,
so a write that fails midway leaves the old rows as they were. The swap is two
renames (atomic each on a file system; for object stores use the versioned
tables of ``sources.tables``, which rename nothing). Writers return the number of
rows written, observed while they pass, so nothing is read again to count them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from larder.sources import files


def _shaped(df: DataFrame, num_files: int | None, compact: bool = False) -> DataFrame:
    if num_files:
        # repartition(n) rather than coalesce(n): the upstream stages keep their
        # parallelism and only the final write runs with n tasks.
        return df.repartition(num_files)
    if compact:
        # As few files as the data allows: AQE sizes the final partitions to
        # spark.sql.adaptive.advisoryPartitionSizeInBytes (one file for a small
        # table, many right-sized files written in parallel for a large one).
        return df.hint("rebalance")
    return df


def _save(df: DataFrame, path: str, fmt: str, mode: str, shape) -> int:
    """Write ``shape(df.write)`` to ``path``; the rows written."""
    spark, seen = df.sparkSession, Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("n"))

    def save(to: str, how: str) -> None:
        shape(counted.write.format(fmt).mode(how)).save(to)

    if mode == "overwrite" and files.exists(spark, path):
        replace_folder(spark, path, lambda aside: save(aside, "error"))
    else:
        save(path, mode)
    return int(seen.get["n"])


def replace_folder(spark: SparkSession, path: str, fill) -> None:
    """``fill(new)`` writes a new folder, which then takes the place of ``path``; if it fails, ``path`` is untouched."""
    path = path.rstrip("/")
    parent, name = path.rsplit("/", 1)
    tag = uuid.uuid4().hex
    aside, old = f"{parent}/_next-{name}-{tag}", f"{parent}/_old-{name}-{tag}"
    try:
        fill(aside)
    except Exception:
        files.delete(spark, aside)
        raise
    files.rename(spark, path, old)
    try:
        files.rename(spark, aside, path)
    except Exception:
        files.rename(spark, old, path)
        raise
    files.delete(spark, old)


def write_parquet(df: DataFrame, path: str, num_files: int | None = None,
                  partition_by: list[str] | None = None, mode: str = "overwrite",
                  compact: bool = False) -> int:
    def shape(w: DataFrameWriter) -> DataFrameWriter:
        return w.partitionBy(*partition_by) if partition_by else w

    return _save(_shaped(df, num_files, compact), path, "parquet", mode, shape)


def write_csv(df: DataFrame, path: str, num_files: int | None = None, header: bool = True,
              mode: str = "overwrite") -> int:
    """CSV that loses nothing: padding, microseconds, quotes (doubled), NULL (bare) and empty text (quoted)."""
    return _save(_shaped(df, num_files), path, "csv", mode, lambda w: w.options(
        header=header, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        timestampNTZFormat="yyyy-MM-dd HH:mm:ss.SSSSSS", timestampFormat="yyyy-MM-dd HH:mm:ss.SSSSSSXXX"))


def write_json_documents(df: DataFrame, path: str, num_files: int | None = None) -> None:
    """One multi-line JSON array document per output file (per partition).

    Each partition is rendered independently (``mapInPandas``), so no row
    leaves its task and the files are readable with ``multiLine``.
    """
    import pandas as pd
    from pyspark.sql import functions as F

    lines = _shaped(df, num_files).select(F.to_json(F.struct(*df.columns)).alias("value"))

    def render(batches):
        # Each element is followed by "," except the partition's last, which
        # is followed by "]"; the first is preceded by "[". One batch is held
        # back so the last element of the partition is known when it is sent.
        first, held = True, None
        for pdf in batches:
            if pdf.empty:
                continue
            if held is not None:
                out = held + ","
                if first:
                    out.iloc[0] = "[" + out.iloc[0]
                    first = False
                yield pd.DataFrame({"value": out})
            held = pdf["value"].reset_index(drop=True)
        if held is not None:
            out = held + ","
            if first:
                out.iloc[0] = "[" + out.iloc[0]
            out.iloc[-1] = out.iloc[-1][:-1] + "]"
            yield pd.DataFrame({"value": out})

    lines.mapInPandas(render, "value string").write.mode("overwrite").text(path)
