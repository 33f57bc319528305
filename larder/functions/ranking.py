"""Global order statistics without a single-partition window.

``Window.orderBy(x)`` with no ``partitionBy`` moves every row into one task.
Here a range shuffle (``repartitionByRange``) deals the rows into ranges, each
range is sorted by its own task, and one aggregate by range gives every range
the total of those before it. Equal keys always share a range, so callers pass
frames with one row a key (or aggregated to it) and ties are exact.

Spark samples the bounds of the ranges itself, a fixed number of keys a range,
so there is no limit on how finely the order can be cut: the number of ranges
grows with the input (about ``rows_per_bucket`` keys each). The dealt rows are
written with their range number, which fixes the ranges for every later reader,
also when tasks are retried.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.lineage import stage

MIN_BUCKETS = 8
MAX_BUCKETS = 100_000
ROWS_PER_BUCKET = 500_000

#: Row numbers within a task are the low bits of ``monotonically_increasing_id``.
_ROW_BITS = 33


def bucket_count(n_rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    return int(min(MAX_BUCKETS, max(MIN_BUCKETS, math.ceil(n_rows / rows_per_bucket))))


def _dealt(df: DataFrame, order: Sequence[Column], n_buckets: int | None, rows_per_bucket: int) -> DataFrame:
    """``df`` cut into ordered ranges: ``_range`` ascends with the order, ``_at`` numbers the rows of a range from 0.

    The input is staged (Spark reads it once to sample the bounds, once to deal)
    and so is the result.
    """
    df = stage(df, "rank-input")
    if n_buckets is None:
        n_buckets = bucket_count(df.count(), rows_per_bucket)
    return stage(_ranged(df, order, n_buckets), "rank-ranges")


def _ranged(df: DataFrame, order: Sequence[Column], n_buckets: int) -> DataFrame:
    at = F.monotonically_increasing_id()
    dealt = df.repartitionByRange(n_buckets, *order).sortWithinPartitions(*order)
    return dealt.withColumns({"_range": F.shiftright(at, _ROW_BITS), "_at": at.bitwiseAND(F.lit((1 << _ROW_BITS) - 1))})


def _offsets(dealt: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """Per range the sums of ``values`` over the ranges before it (one row a range, at most ``MAX_BUCKETS``)."""
    totals = dealt.groupBy("_range").agg(*[F.sum(v).alias(c) for c, v in values.items()])
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(F.col("_range").alias("_of"),
                         *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_off_{c}") for c in values])


def ordinals(df: DataFrame, order: Sequence[Column | str], name: str = "position", n_buckets: int | None = None,
             rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``df`` plus the 0-based place of each row in the global order (``order`` must tell all rows apart).

    One range shuffle; a row's place is its number in the range plus the rows
    of the ranges before.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    dealt = _dealt(df, order, n_buckets, rows_per_bucket)
    # One row a range, at most MAX_BUCKETS: a proven bound, safe to broadcast.
    joined = dealt.join(F.broadcast(_offsets(dealt, {"n": F.lit(1)})), F.col("_range") == F.col("_of"))
    return joined.select(*[dealt[c] for c in df.columns], (F.col("_off_n") + F.col("_at")).alias(name))


def exclusive_prefix_sums(df: DataFrame, key: str | Sequence[Column], value_cols: Sequence[str],
                          descending: bool = False, n_buckets: int | None = None,
                          prefix: str = "before_", rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """For a frame with *unique*, non-NULL ``key``: add, per value column, the
    sum over all rows that come strictly earlier in key order.

    ``key`` may also be a list of ordered columns that together tell all rows
    apart. Pass an already aggregated frame; it is staged once before it is dealt.
    """
    if isinstance(key, str):
        key = [F.col(key).desc() if descending else F.col(key).asc()]
    dealt = _dealt(df, key, n_buckets, rows_per_bucket)
    earlier = Window.partitionBy("_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    inner = dealt.select(*df.columns, "_range",
                         *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_in_{c}") for c in value_cols])
    # One row a range, at most MAX_BUCKETS: a proven bound, safe to broadcast.
    offsets = F.broadcast(_offsets(dealt, {c: F.col(c) for c in value_cols}))
    joined = inner.join(offsets, F.col("_range") == F.col("_of"))
    return joined.select(*df.columns, *[(F.col(f"_off_{c}") + F.col(f"_in_{c}")).alias(f"{prefix}{c}")
                                        for c in value_cols])


def dense_rank_tables(df: DataFrame, ranks: Mapping[str, str], descending: bool = True,
                      n_buckets: int | None = None, rows_per_bucket: int = ROWS_PER_BUCKET) -> dict[str, DataFrame]:
    """``{rank_col: (value double, rank)}`` for ``ranks`` = ``{rank_col: key}``: global ``dense_rank()`` of each key.

    All keys share one pass: their distinct non-NULL values are stacked as
    (which, value), aggregated map-side and numbered by one range shuffle. A
    key's ranks begin at its own first place.
    """
    stacked = F.explode(F.array(*[F.struct(F.lit(i).alias("which"), F.col(k).cast("double").alias("value"))
                                  for i, k in enumerate(ranks.values())]))
    distinct = df.select(stacked.alias("e")).select("e.*").where(F.col("value").isNotNull()).distinct()
    value = F.col("value").desc() if descending else F.col("value").asc()
    placed = ordinals(distinct, [F.col("which"), value], "_place", n_buckets, rows_per_bucket)
    # One row a key of the caller.
    firsts = placed.groupBy(F.col("which").alias("_w")).agg(F.min("_place").alias("_first"))
    ranked = placed.join(F.broadcast(firsts), F.col("which") == F.col("_w")).select(
        "which", "value", (F.col("_place") - F.col("_first") + 1).cast("int").alias("_rank"))
    ranked = stage(ranked, "ranks")
    return {name: ranked.where(F.col("which") == i).select("value", F.col("_rank").alias(name))
            for i, name in enumerate(ranks)}


def with_dense_ranks(df: DataFrame, ranks: Mapping[str, str], descending: bool = True,
                     n_buckets: int | None = None) -> DataFrame:
    """``df`` plus a global ``dense_rank()`` column for each of ``{rank_col: key}`` (NULL keys get NULL)."""
    out = df
    for name, table in dense_rank_tables(df, ranks, descending, n_buckets).items():
        keyed = table.withColumnRenamed("value", "_value")
        out = out.join(keyed, out[ranks[name]].cast("double") == keyed["_value"], "left").drop("_value")
    return out.select(*df.columns, *ranks)


def dense_rank(df: DataFrame, key: str, rank_col: str, descending: bool = True,
               n_buckets: int | None = None) -> DataFrame:
    """``df`` plus a global ``dense_rank()`` by ``key`` (NULL keys get NULL)."""
    return with_dense_ranks(df, {rank_col: key}, descending, n_buckets)
