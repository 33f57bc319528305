r"""CSV with line breaks inside quoted fields, read by many tasks a file.

Whether a line break ends a record depends on the number of quotes before it in
the file, so a reader that starts in the middle cannot tell. Here the lines of
every file block are marked first as if the block began outside quotes: a line's
relative quote parity, and the last line that would begin a record under either
start. One small row a block (its parity, its last record starts) is combined
along each file, which settles every block's true start. Lines that are whole
records go on as they are, without a shuffle; only lines of records with breaks
are gathered, by the place their record begins. Parsing stays with ``from_csv``.

The text is scanned three times (block rows, whole records, broken records) and
nothing but broken records and block rows moves.

Quotes must be paired (doubled inside quoted fields); a file with an odd number
fails the job with its path. The first line of a file is its header; all files
must have the same. Line breaks inside fields stay as they are (``\n`` or ``\r\n``).
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_MARKED = "file string, block long, n long, odd long, rel long, start0 long, start1 long, line string"


def lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, block, line)``: the lines between ``\\n``, with the block of the file that they were read from."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))


def has_quoted_breaks(spark: SparkSession, path: str) -> bool:
    """Whether any line holds an odd number of quotes (the scan stops at the first one)."""
    quotes = F.length("line") - F.length(F.replace(F.col("line"), F.lit('"'), F.lit("")))
    return not lines(spark, path).where(quotes % 2 == 1).isEmpty()


def _marked(found: DataFrame) -> DataFrame:
    """Lines with their number in the block, parity, relative state and last record starts under both beginnings."""
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, n, state = None, 0, 0
        last = [-1, -1]  # the last line that began outside quotes, if the block began outside (0) or inside (1)
        for batch in batches:
            file, block, line = (batch.column(c) for c in ("file", "block", "line"))
            rows = batch.num_rows
            if not rows:
                continue
            odd = (pc.count_substring(line, '"').to_numpy(zero_copy_only=False) & 1).astype(np.int64)
            change = np.zeros(rows, bool)
            if rows > 1:
                change[1:] = (pc.not_equal(file.slice(1), file.slice(0, rows - 1)).to_numpy(zero_copy_only=False)
                              | pc.not_equal(block.slice(1), block.slice(0, rows - 1)).to_numpy(zero_copy_only=False))
            edges = [0, *np.flatnonzero(change).tolist(), rows]
            numbers, rel = np.empty(rows, np.int64), np.empty(rows, np.int64)
            starts = np.empty((2, rows), np.int64)
            for a, b in zip(edges, edges[1:]):
                key = (file[a].as_py(), block[a].as_py())
                if key != here:
                    here, n, state, last = key, 0, 0, [-1, -1]
                numbers[a:b] = np.arange(n, n + b - a)
                before = np.concatenate([[0], np.cumsum(odd[a:b])])
                rel[a:b] = (state + before[:-1]) & 1
                for outside in (0, 1):
                    begins = np.where(rel[a:b] == outside, numbers[a:b], -1)
                    starts[outside, a:b] = np.maximum(np.maximum.accumulate(begins), last[outside])
                    last[outside] = int(starts[outside, b - 1])
                n += b - a
                state = int((state + before[-1]) & 1)
            yield pa.RecordBatch.from_arrays(
                [file, block, *map(pa.array, (numbers, odd, rel, starts[0], starts[1])), line],
                names=[f.split()[0] for f in _MARKED.split(", ")])

    return found.mapInArrow(mark, _MARKED)


def _block_states(marked: DataFrame) -> DataFrame:
    """Per block: whether it begins inside quotes, and where the record that reaches into it began."""
    blocks = marked.groupBy("file", "block").agg(
        F.sum("odd").alias("quotes"), F.max("start0").alias("last0"), F.max("start1").alias("last1"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    # One row a block of a file: the window holds a file's blocks, not its lines.
    stated = blocks.withColumn("state", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    unpaired = F.raise_error(F.concat(F.lit("unpaired quote in "), F.col("file"))).cast("long")
    stated = stated.withColumn("state", F.when(F.sum("quotes").over(whole) % 2 == 1, unpaired).otherwise(F.col("state")))
    own = F.when(F.col("state") == 0, F.col("last0")).otherwise(F.col("last1"))
    place = F.when(own >= 0, F.struct(F.col("block").alias("block"), own.alias("n")))
    return stated.select(F.col("file").alias("of"), F.col("block").alias("at"), "state",
                         F.last(place, ignorenulls=True).over(before).alias("carried"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """``(file, block, n, record)``: every record with the place it begins at (block of the file, line of the block)."""
    marked = _marked(lines(spark, path))
    states = _block_states(marked)
    placed = marked.join(states, (F.col("file") == F.col("of")) & (F.col("block") == F.col("at")))
    outside = F.col("rel") == F.col("state")
    whole = outside & (F.col("odd") == 0)
    own = F.when(F.col("state") == 0, F.col("start0")).otherwise(F.col("start1"))
    begins = F.when(own >= 0, F.struct(F.col("block").alias("block"), own.alias("n"))).otherwise(F.col("carried"))
    single = placed.where(whole).select("file", "block", "n", F.col("line").alias("record"))
    broken = placed.where(~whole).select("file", begins.alias("begins"), F.struct("block", "n", "line").alias("part"))
    joined = broken.groupBy("file", "begins").agg(F.array_sort(F.collect_list("part")).alias("parts")).select(
        "file", "begins.block", "begins.n", F.array_join(F.transform("parts", lambda p: p["line"]), "\n").alias("record"))
    found = single.union(joined)
    trimmed = F.when(F.endswith("record", F.lit("\r")), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    return found.withColumn("record", trimmed)


def _is_header() -> Column:
    return (F.col("block") == 0) & (F.col("n") == 0)


def header(spark: SparkSession, found: DataFrame, path: str) -> list[str]:
    """The column names; the files' headers must agree (two rows at most reach the driver)."""
    heads = [r[0] for r in found.where(_is_header()).select("record").distinct().limit(2).collect()]
    if len(heads) > 1:
        raise ValueError(f"the files of {path} have different headers: {heads}")
    return next(csv.reader(heads), []) if heads else []


def read(spark: SparkSession, path: str, options: dict[str, str]) -> DataFrame:
    """The files' rows, every field as text; ``options`` are ``from_csv``'s."""
    found = records(spark, path)
    names = header(spark, found, path)
    rows = found.where(~_is_header() & (F.trim("record") != ""))
    if not names:
        return rows.select()
    ddl = ", ".join(f"_c{i} string" for i in range(len(names)))
    parsed = rows.select(F.from_csv("record", ddl, options).alias("r"))
    return parsed.select(*[F.col(f"r._c{i}").alias(name) for i, name in enumerate(names)])
