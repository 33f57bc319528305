"""Salting for joins where one key may hold a large share of the rows.

A key is *hot* when it holds more rows than one task should take of it:
``rows_per_salt``, or the ``most_hot``-th part of all rows where that is more.
Fewer than ``most_hot`` keys can qualify, so the hot list has a proven size
bound and is broadcast. A hot key gets as many salts as it holds such shares,
so its salts grow with its rows. Its rows take a deterministic salt (a hash of
the row's content, stable across retries; copies of one row share it); the
other side's row for that key is replicated once per salt. Joining on
(key, salt) then spreads the key, with or without AQE's skew join. Keys may
span several columns and are compared NULL-safely.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_SALT = 1_000_000
MOST_HOT = 10_000


def _names(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def hot_keys(counts: DataFrame, keys: str | Sequence[str], n_col: str, rows_per_salt: int = ROWS_PER_SALT,
             most_hot: int = MOST_HOT) -> DataFrame:
    """Keys of more rows than one task's share (fewer than ``most_hot`` of them).

    Columns: ``_hk0, _hk1, ...`` (one per key column) and ``_salts``, the shares the key holds.
    """
    names = _names(keys)
    share = counts.select(F.greatest(F.lit(float(rows_per_salt)), F.sum(n_col) / F.lit(most_hot))).scalar()
    sized = counts.select(*[F.col(k).alias(f"_hk{i}") for i, k in enumerate(names)],
                          (F.col(n_col) / share).alias("_shares"))
    return sized.where(F.col("_shares") > 1).withColumn("_salts", F.ceil("_shares").cast("int")).drop("_shares")


def _mark_hot(df: DataFrame, key_cols: Sequence[Column], hot: DataFrame) -> DataFrame:
    cond = None
    for i, c in enumerate(key_cols):
        term = c.eqNullSafe(hot[f"_hk{i}"])
        cond = term if cond is None else cond & term
    joined = df.join(F.broadcast(hot), cond, "left")
    return joined.drop(*[f"_hk{i}" for i in range(len(key_cols))])


def salt_rows(rows: DataFrame, key_cols: Column | Sequence[Column], hot: DataFrame, by: Sequence[str] | None = None,
              name: str = "_salt") -> DataFrame:
    """Add ``name``: a hash of the columns ``by`` (all by default) below the key's salts for hot keys, 0 otherwise."""
    key_cols = [key_cols] if isinstance(key_cols, Column) else list(key_cols)
    salt = F.pmod(F.xxhash64(*[rows[f"`{c}`"] for c in by or rows.columns]), F.col("_salts")).cast("int")
    marked = _mark_hot(rows, key_cols, hot)
    return marked.withColumn(name, F.coalesce(salt, F.lit(0))).drop("_salts")


def replicate_for_salts(side: DataFrame, key_cols: Column | Sequence[Column], hot: DataFrame) -> DataFrame:
    """Add ``_salt``; hot keys' rows are replicated once per salt value."""
    key_cols = [key_cols] if isinstance(key_cols, Column) else list(key_cols)
    salts = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    marked = _mark_hot(side, key_cols, hot)
    return marked.select(*[marked[c] for c in side.columns], F.explode(salts).alias("_salt"))
