"""Deterministic, mergeable quantile sketches: counts of logarithmic buckets as rows.

A bucket holds the numbers of one sign that share the binary exponent and the
first ``BITS`` bits of the mantissa, so its ends are within a factor of
1 + 2^-BITS of each other. A sketch is a table ``(keys…, bucket, n, low, high)``,
one row a bucket that occurs, built by one hash aggregate and merged by summing
``n`` (and the least ``low``, the greatest ``high``): the same rows whatever the
partitioning, the order or a retried task, unlike sketches that draw. Buckets
ascend with their numbers, so a quantile is a running sum over a few thousand
rows. It is exact where its bucket holds one distinct value, else the middle of
the bucket's own values, at most 2^-(BITS+1) of itself away (0.05 %).

The bucket of a number uses only exact arithmetic: ``log2`` proposes an exponent,
comparisons with powers of two settle it, and division by a power of two is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Mantissa bits of a bucket: values within a bucket differ by less than one part in 1,024.
BITS = 10
#: Added to exponents so that bucket numbers of positive values are positive (doubles reach 2^-1074).
_LOWEST = 1100


def bucket(value: Column) -> Column:
    """The bucket number of a double (0 for zero, negative for negatives; NULL for NULL and NaN; infinities at the ends)."""
    x = F.abs(value)
    guess = F.floor(F.log2(x))
    two = F.lit(2.0)
    exponent = (guess - F.when(F.pow(two, guess) > x, 1).otherwise(0) + F.when(F.pow(two, guess + 1) <= x, 1).otherwise(0))
    part = F.floor((x / F.pow(two, exponent) - 1) * (1 << BITS))
    number = (exponent + _LOWEST) * (1 << BITS) + part + 1
    sign = F.when(value < 0, -1).otherwise(1)
    return (F.when(value.isNull() | F.isnan(value), None).when(value == 0, 0)
            .when(x == float("inf"), sign * F.lit((_LOWEST + 1025) << BITS))
            .otherwise(sign * number)).cast("long")


def sketch(df: DataFrame, column: str, keys: Sequence[str] = ()) -> DataFrame:
    """``(keys…, bucket, n, low, high)`` of the column's values (NULL and NaN left out)."""
    value = F.col(column).cast("double")
    rows = df.select(*keys, value.alias("_value"), bucket(value).alias("bucket")).where(F.col("bucket").isNotNull())
    return rows.groupBy(*keys, "bucket").agg(F.count(F.lit(1)).alias("n"), F.min("_value").alias("low"),
                                             F.max("_value").alias("high"))


def merge(first: DataFrame, *others: DataFrame) -> DataFrame:
    """The sketch of all rows from sketches of disjoint parts."""
    union = first
    for o in others:
        union = union.unionByName(o)
    keys = [c for c in first.columns if c not in ("bucket", "n", "low", "high")]
    return union.groupBy(*keys, "bucket").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))


def quantiles(sketched: DataFrame, probs: Sequence[float], names: Sequence[str] | None = None,
              count: str | None = None) -> DataFrame:
    """``(keys…, q_0, …)``: the values at rank ceil(p · n) for each probability, from the sketch's rows alone.

    ``count`` names a further column with n, the values sketched.

    The running sum goes over one key's buckets: thousands of rows, whatever
    the number of values (without keys they are one window task).
    """
    keys = [c for c in sketched.columns if c not in ("bucket", "n", "low", "high")]
    names = list(names or [f"q_{i}" for i in range(len(probs))])
    upto = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = sketched.withColumnRenamed("bucket", "_bucket").withColumn("_upto", F.sum("n").over(upto))
    ranked = ranked.withColumn("_all", F.sum("n").over(upto.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    middle = F.col("low") + (F.col("high") - F.col("low")) / 2
    picked = []
    for p, name in zip(probs, names):
        wanted = F.greatest(F.ceil(F.col("_all") * F.lit(float(p))), F.lit(1))
        here = (F.col("_upto") >= wanted) & (F.col("_upto") - F.col("n") < wanted)
        picked.append(F.max(F.when(here, middle)).alias(name))
    if count:
        picked.append(F.max("_all").alias(count))
    return ranked.groupBy(*keys).agg(*picked)


def median(sketched: DataFrame) -> Column:
    """The median as a scalar-subquery column; NULL for an empty sketch."""
    return quantiles(sketched, [0.5], ["median"]).select("median").scalar()
