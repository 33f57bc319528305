"""Bloom filters as tables: ``(slot, bits)`` rows that build, merge and look up with joins and ``bit_or``.

A key sets four bits of one 64-bit word (a blocked filter), so a lookup is one
equi-join on the word's slot and one bit test. A filter of n keys has n / 4 words
or more, rounded up to a power of two: 16 to 32 bits a key, well under two wrong
"maybe" in a hundred, never a wrong "no". Nothing passes through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS_PER_WORD = 4
_BITS = 4


def slots_for(n_keys: int) -> int:
    """Words of a filter for ``n_keys`` keys."""
    return 1 << max(4, (max(1, n_keys) // KEYS_PER_WORD).bit_length())


def _parts(key: Column, slots: Column) -> tuple[Column, Column]:
    h = F.xxhash64(key)
    slot = F.shiftrightunsigned(h, 6 * _BITS).bitwiseAND(slots - 1)
    bits = F.lit(0).cast("long")
    for i in range(_BITS):
        at = F.shiftright(h, 6 * i).bitwiseAND(F.lit(63))
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at.cast("int")))
    return slot, bits


def build(df: DataFrame, key: Column, slots: int) -> DataFrame:
    """The filter ``(slot, bits)`` of the keys: one map-side combined aggregate."""
    slot, bits = _parts(key, F.lit(slots).cast("long"))
    return df.select(slot.alias("slot"), bits.alias("b")).groupBy("slot").agg(F.bit_or("b").alias("bits"))


def maybe_in(df: DataFrame, key: Column, filters: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """Rows of ``df`` with each filter that may hold their key, named in ``_filter``.

    ``filters``: ``(_filter, slots, slot, bits)``; ``sizes`` are the numbers of
    slots that occur. A key is looked up once a size (powers of two: a few dozen
    at most), whatever the number of filters of that size.
    """
    wanted = df.withColumn("_slots", F.explode(F.array(*[F.lit(s).cast("long") for s in sorted(set(sizes))])))
    slot, bits = _parts(key, F.col("_slots"))
    wanted = wanted.withColumns({"_slot": slot, "_bits": bits})
    found = wanted.join(filters, (wanted["_slots"] == filters["slots"]) & (wanted["_slot"] == filters["slot"]))
    return found.where(F.col("bits").bitwiseAND(F.col("_bits")) == F.col("_bits")).select(*df.columns, "_filter")
