"""Logarithmic bucket sketches: error bound, determinism, merging."""

import math
import random

import pytest
from pyspark.sql import functions as F

from larder.functions import quantiles as Q


def values(n, seed=1):
    rnd = random.Random(seed)
    return [rnd.choice([-1, 1]) * math.exp(rnd.uniform(-30, 30)) for _ in range(n)] + [0.0] * 40


def exact(xs, p):
    xs = sorted(xs)
    return xs[max(1, math.ceil(p * len(xs))) - 1]


def test_quantiles_are_within_the_bound_at_any_partitioning(spark):
    xs = values(4_000)
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    results = []
    for n in (1, 3, 8):
        sketched = Q.sketch(df.repartition(n), "x")
        results.append((sorted(map(tuple, sketched.collect())), tuple(Q.quantiles(sketched, probs).first())))
    assert results[0] == results[1] == results[2]
    for p, got in zip(probs, results[0][1]):
        want = exact(xs, p)
        assert abs(got - want) <= abs(want) / 2 ** Q.BITS


def test_merged_parts_equal_the_whole(spark):
    rows = [(i % 3, x) for i, x in enumerate(values(900, 2))]
    df = spark.createDataFrame(rows, "k int, x double")
    parts = [Q.sketch(df.where(F.col("x") < -1), "x", ["k"]), Q.sketch(df.where(F.col("x").between(-1, 5)), "x", ["k"]),
             Q.sketch(df.where(F.col("x") > 5), "x", ["k"])]
    whole = Q.sketch(df, "x", ["k"])
    key = lambda d: sorted(map(tuple, d.select("k", "bucket", "n", "low", "high").collect()))
    assert key(Q.merge(*parts)) == key(Q.merge(Q.merge(parts[2], parts[0]), parts[1])) == key(whole)
    got = {r.k: r.q_0 for r in Q.quantiles(whole, [0.5]).collect()}
    for k in range(3):
        want = exact([x for j, x in rows if j == k], 0.5)
        assert abs(got[k] - want) <= abs(want) / 2 ** Q.BITS


def test_single_values_are_exact_and_empty_is_null(spark):
    df = spark.createDataFrame([(x,) for x in [1.0, 7.0, 7.0, 7.0, 14.0, None, float("nan")]], "x double")
    assert Q.quantiles(Q.sketch(df, "x"), [0.5], ["m"]).first().m == 7.0
    assert Q.sketch(df, "x").agg(F.sum("n")).first()[0] == 5
    none = df.where("x > 100 and not isnan(x)")
    assert Q.quantiles(Q.sketch(none, "x"), [0.5], ["m"]).first().m is None
    filled = none.union(df.limit(1)).withColumn("m", Q.median(Q.sketch(df, "x")))
    assert filled.first().m == 7.0


@pytest.mark.parametrize("x", [1.0, 2.0, 3.0, 0.1, 5e-324, 1.7976931348623157e308, 2.0**-1022, 8 - 2**-50, 2.0**52, float("inf")])
def test_buckets_ascend_and_mirror(spark, x):
    up = math.nextafter(x, math.inf)
    row = spark.createDataFrame([(x, up, -x)], "x double, up double, neg double").select(
        *[Q.bucket(F.col(c)).alias(c) for c in ("x", "up", "neg")]).first()
    assert 0 < row.x <= row.up and row.neg == -row.x
