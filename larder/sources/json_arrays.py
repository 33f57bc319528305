r"""Documents that are one big JSON array of objects, read by many tasks.

A file is read in the pieces between closing braces (a text scan with ``}`` as
separator, so Spark splits it at any byte). Whether a piece lies inside a string,
and how deep, depends on all text before it, so pieces are first measured as if
their block began outside a string and as if inside: quotes outside escapes flip
the state, brackets outside strings change the depth. One row a block (its quote
parity, its depth change under either beginning) is combined along the file,
which gives every block its true state and depth.

A piece that begins and ends right below the array is a whole element and goes
on without a shuffle (every flat object is one); only pieces of nested objects
are gathered, by the place their element begins. Elements are parsed by
``from_json``. The pieces are scanned three times; nothing else moves.

An element that is no object, a document that is no array, and one that breaks
off fail the job with the path. A single string value of 2 GB is the limit, not
the file.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEPARATOR = "}"
#: Landed chunks hold about this many bytes (a longer piece is a chunk of its own).
CHUNK_BYTES = 8 << 20

CHUNK = "path string, at long, content binary"
_MARKED = "file string, block long, n long, rel long, parity long, in0 long, in1 long, out0 long, out1 long, piece binary"


def pieces(spark: SparkSession, path: str, separator: str = SEPARATOR) -> DataFrame:
    """``(file, block, piece)``: the bytes between separators, with the block of the file that they were read from."""
    return spark.read.option("lineSep", separator).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("piece"))


# ------------------------------------------------------------------ chunked landing

def chunks(found: DataFrame, separator: str = SEPARATOR, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Pieces as ``(path, at, content)``: separator-joined runs of a block, in the order of ``at`` within a file.

    Many tasks read a large file, each its own blocks; joined by the separator
    in the order of ``at``, the chunks of a file are its bytes (but for a
    separator at its very end, and a byte order mark).
    """
    mark = separator.encode()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, at, held, size = None, 0, [], 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([here[0]]), pa.array([here[1] + at], pa.int64()), pa.array([mark.join(held)], pa.binary())],
                names=["path", "at", "content"])

        for batch in batches:
            for file, block, piece in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "piece"))):
                if (file, block) != here or size + len(piece) > chunk_bytes:
                    if held:
                        yield row()
                        at += size
                    if (file, block) != here:
                        here, at = (file, block), 0
                    held, size = [], 0
                held.append(piece)
                size += len(piece) + len(mark)
        if held:
            yield row()

    return found.mapInArrow(pack, CHUNK)


def pieces_of_chunks(landed: DataFrame, separator: str = SEPARATOR) -> DataFrame:
    """The pieces of landed chunks again; every chunk stands as a block of its file."""
    mark = separator.encode()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, at, content in zip(*(batch.column(c).to_pylist() for c in ("path", "at", "content"))):
                found = content.split(mark)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(found)), pa.array([at] * len(found), pa.int64()), pa.array(found, pa.binary())],
                    names=["file", "block", "piece"])

    return landed.mapInArrow(cut, "file string, block long, piece binary")


# ------------------------------------------------------------------ elements

def measure(piece: bytes) -> tuple[int, int, int]:
    """Quote parity of a piece, and its depth change if it begins outside a string and if inside.

    The separator after the piece counts as its closing brace.
    """
    plain = piece.replace(b"\\\\", b"").replace(b'\\"', b"") if b"\\" in piece else piece
    parts = plain.split(b'"')
    parity = (len(parts) - 1) & 1
    deltas = []
    for begins_inside in (0, 1):
        outside = b"".join(parts[begins_inside::2])
        delta = outside.count(b"{") + outside.count(b"[") - outside.count(b"}") - outside.count(b"]")
        deltas.append(delta - (1 if parity == begins_inside else 0))  # ends outside: the separator is a brace
    return parity, deltas[0], deltas[1]


def _marked(found: DataFrame) -> DataFrame:
    """Pieces with, relative to their block: string state before, and depths before and after for either beginning."""
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, n, state, depth = None, 0, 0, [0, 0]
        for batch in batches:
            out: list[list[int]] = [[] for _ in range(7)]
            files, blocks_, texts = (batch.column(c) for c in ("file", "block", "piece"))
            for key, text in zip(zip(files.to_pylist(), blocks_.to_pylist()), texts.to_pylist()):
                if key != here:
                    here, n, state, depth = key, 0, 0, [0, 0]
                parity, outside, inside = measure(text)
                after = [depth[h] + (outside if state == h else inside) for h in (0, 1)]
                for column, value in zip(out, (n, state, parity, *depth, *after)):
                    column.append(value)
                n, state, depth = n + 1, state ^ parity, after
            yield pa.RecordBatch.from_arrays([files, blocks_, *(pa.array(np.array(c, np.int64)) for c in out), texts],
                                             names=[f.split()[0] for f in _MARKED.split(", ")])

    return found.mapInArrow(mark, _MARKED)


def _block_states(marked: DataFrame) -> DataFrame:
    """Per block the string state and depth at its beginning, checked to end as an array does."""
    last = F.max(F.struct("n", "out0", "out1"))
    blocks = marked.groupBy("file", "block").agg(F.sum("parity").alias("quotes"), last.alias("last"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("file")
    # One row a block of a file: the windows hold a file's blocks, not its pieces.
    stated = blocks.withColumn("state", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    change = F.when(F.col("state") == 0, F.col("last.out0")).otherwise(F.col("last.out1"))
    stated = stated.withColumn("change", change)
    stated = stated.withColumns({"depth": F.sum("change").over(upto) - F.col("change"),
                                 "total": F.sum("change").over(whole), "odd": F.sum("quotes").over(whole) % 2})
    # The last piece has no brace after it, so an array ends one below zero.
    bad = F.raise_error(F.concat(F.lit("not a whole JSON array document: "), F.col("file"))).cast("long")
    return stated.select(F.col("file").alias("of"), F.col("block").alias("at"),
                         F.when((F.col("total") == -1) & (F.col("odd") == 0), F.col("state")).otherwise(bad).alias("state"),
                         "depth")


def elements(found: DataFrame) -> DataFrame:
    """``(file, element)``: the text of every object right below a document's array."""
    marked = _marked(found)
    states = _block_states(marked)
    placed = marked.join(states, (F.col("file") == F.col("of")) & (F.col("block") == F.col("at")))
    chosen = F.col("state") == 0
    depth_in = F.col("depth") + F.when(chosen, F.col("in0")).otherwise(F.col("in1"))
    depth_out = F.col("depth") + F.when(chosen, F.col("out0")).otherwise(F.col("out1"))
    begins_outside = F.col("rel") == F.col("state")
    ends_outside = (F.col("rel") + F.col("parity")) % 2 == F.col("state")
    placed = placed.withColumns({
        "text": F.col("piece").cast("string"),
        "begins": begins_outside & (depth_in <= 1),           # at the array, or before its bracket
        "ends": ends_outside & (depth_out == 1)})
    whole = placed.where(F.col("begins") & F.col("ends")).select("file", "text")
    # Pieces after the last element hold only the closing bracket; the rest are parts of nested elements.
    parts = placed.where(~(F.col("begins") & F.col("ends")) & ~(begins_outside & ends_outside & (depth_out < 1)))
    own = Window.partitionBy("file", "block").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    started = parts.withColumn("start", F.last(F.when(F.col("begins"), F.col("n")), ignorenulls=True).over(own))
    lasts = parts.where("begins").groupBy("file", "block").agg(F.max("n").alias("n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    every = parts.select("file", "block").distinct().join(lasts, ["file", "block"], "left")
    carried = every.select(F.col("file").alias("f"), F.col("block").alias("b"), F.last(
        F.when(F.col("n").isNotNull(), F.struct(F.col("block").alias("block"), F.col("n").alias("n"))), ignorenulls=True)
        .over(earlier).alias("carried"))
    keyed = started.join(carried, (F.col("file") == F.col("f")) & (F.col("block") == F.col("b")))
    place = F.when(F.col("start").isNotNull(), F.struct(F.col("block").alias("block"), F.col("start").alias("n"))).otherwise(
        F.col("carried"))
    gathered = keyed.groupBy("file", place.alias("place")).agg(
        F.array_sort(F.collect_list(F.struct("block", "n", "text"))).alias("parts"))
    nested = gathered.select("file", F.array_join(F.transform("parts", lambda p: p["text"]), SEPARATOR).alias("text"))
    both = whole.union(nested)
    return both.select("file", F.concat(F.regexp_replace("text", r"^[\s,\[]+", ""), F.lit(SEPARATOR)).alias("element"))


def parse(found: DataFrame, element_schema: T.StructType) -> DataFrame:
    """One row an element of the pieces' documents; an element that does not parse fails the job."""
    return elements(found).select(F.from_json("element", element_schema, {"mode": "FAILFAST"}).alias("e")).select("e.*")


def read(spark: SparkSession, path: str, element_schema: T.StructType | str) -> DataFrame:
    """The objects of JSON array documents, each file read by as many tasks as it has splits."""
    if isinstance(element_schema, str):
        element_schema = T.StructType.fromDDL(element_schema)
    return parse(pieces(spark, path), element_schema)
