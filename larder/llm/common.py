"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator
from types import ModuleType

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.lineage import stage
from larder.functions.skew import hot_keys, replicate_for_salts, salt_rows

#: Prefix of working columns; an input column that starts with it is dropped.
TMP = "__llm_"

#: Edges of a node that one task joins, at most (or a 10,000th part of all).
HUB_EDGES = 1_000_000

#: Bytes of ASCII letters lower-cased (A-Z only).
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of one slice stay near ``most`` bytes.

    A batch of very long texts is then handled in several steps; no row is
    dropped and a single text is never cut. At the end the task's free memory
    goes back to the system, since the Python worker lives on for other tasks.
    """
    for batch in batches:
        if batch.num_rows <= 1 or batch.nbytes <= most:
            yield batch
            continue
        sizes = pc.binary_length(batch.column(column)).to_pylist()
        start, total = 0, 0
        for i, n in enumerate(sizes):
            n = n or 0
            if i > start and total + n > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        yield batch.slice(start)
        del batch
    release_memory()


def release_memory() -> None:
    """Give freed memory of Arrow's pool and, with glibc, of the heap back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def add_columns(df: DataFrame, column: str, added: T.StructType,
                fn: Callable[[], Callable[[list], dict[str, list]]],
                where: str | None = None, replace: bool = False) -> DataFrame:
    """Rows of ``df`` with columns computed from the texts of ``column``.

    ``fn()`` is called once per task and returns a function from a list of
    texts (None for null) to the added columns' lists. An input column with the
    name of an added one gives way to it. ``where`` names an added boolean
    column that decides which rows stay (it is dropped itself); with
    ``replace`` an added column named like an input one keeps its place.
    """
    taken = {f.name for f in added.fields}
    kept = [f for f in df.schema.fields if f.name not in taken or replace]
    kept = [f for f in kept if not f.name.startswith(TMP)]
    names = [f.name for f in kept]
    out = [f for f in kept if f.name not in taken] if not replace else kept
    fields = [added[f.name] if replace and f.name in taken else f for f in out]
    fields += [f for f in added.fields if f.name not in names and f.name != where]
    schema = T.StructType(fields)
    cast = F.col(f"`{column}`").cast("string")
    source = df.select(*[F.col(f"`{n}`") for n in names], cast.alias(TMP + "text"))
    arrow = {f.name: _arrow_type(f.dataType) for f in added.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = fn()
        for batch in slices(batches, TMP + "text"):
            got = compute(batch.column(TMP + "text").to_pylist())
            cols = {k: pa.array(v, type=arrow[k]) for k, v in got.items()}
            arrays = [cols[f.name] if f.name in cols else batch.column(f.name) for f in fields]
            result = pa.RecordBatch.from_arrays(arrays, names=[f.name for f in fields])
            yield result.filter(cols[where]) if where else result

    return source.mapInArrow(run, schema)


def _arrow_type(t: T.DataType) -> pa.DataType:
    simple = {"LongType": pa.int64(), "IntegerType": pa.int32(), "DoubleType": pa.float64(), "StringType": pa.string(),
              "BooleanType": pa.bool_(), "BinaryType": pa.binary()}
    if isinstance(t, T.ArrayType):
        return pa.list_(_arrow_type(t.elementType))
    return simple[type(t).__name__]


def once_a_worker(name: str, make: Callable):
    """``make()``, kept for the later tasks of this Python worker (functions pickled by value share no globals)."""
    kept = sys.modules.setdefault("_larder_llm_kept", ModuleType("_larder_llm_kept")).__dict__
    if name not in kept:
        kept[name] = make()
    return kept[name]


def number_rows(name: str = TMP + "row") -> Callable[[int], list[int]]:
    """Per-task source of row numbers, unique within one stage (stage the result to fix them)."""
    from pyspark import TaskContext

    state = [(TaskContext.get().partitionId() if TaskContext.get() else 0) << 40]

    def take(n: int) -> list[int]:
        first = state[0]
        state[0] += n
        return list(range(first, first + n))

    return take


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components: ``links`` (a, b: long) to rows (node, component).

    ``component`` is the smallest node reachable; nodes without a link to
    another node are absent. Alternating large-star and small-star steps: every
    step is an aggregate with map-side combine and a join, each round's links
    are a written table, and only a checksum reaches the driver. A chain or
    star of n nodes takes about log n rounds.
    """
    edges = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = stage(edges, "links")
    before = None
    for _ in range(max_rounds):
        edges = stage(_small_star(_large_star(edges)), "links")
        after = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if after == before or after[0] == 0:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
                edges.select("a", "a")).distinct()
        before = after
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest of it and its neighbours.

    A hub's edges are salted, so a component that holds most nodes is no single task's.
    """
    both = edges.union(edges.select(F.col("b"), F.col("a"))).toDF("u", "v")
    least = stage(both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.when(F.col("v") > F.col("u"), 1)).alias("n")), "least")
    hot = hot_keys(least, "u", "n", HUB_EDGES)
    larger = salt_rows(edges.toDF("u", "v"), F.col("u"), hot)  # a < b in every edge
    out = larger.join(replicate_for_salts(least, F.col("u"), hot), ["u", "_salt"]).select(F.least("m", "u").alias("a"), F.col("v").alias("b"))
    return out.where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    out = edges.join(least, "b").select(F.col("m"), F.explode(F.array("a", "b")).alias("n"))
    return out.where("m <> n").select(F.col("m").alias("a"), F.col("n").alias("b")).distinct()
