"""Distributed prefix sums / dense rank / AUC against brute force."""

import random

from pyspark.sql import functions as F

from larder.functions.ranking import dense_rank, exclusive_prefix_sums
from larder.operators import modeling as M


def test_prefix_sums_match_brute_force(spark):
    rnd = random.Random(7)
    keys = rnd.sample(range(-5000, 5000), 900)
    rows = [(k, rnd.randint(0, 5)) for k in keys]
    df = spark.createDataFrame(rows, "k long, w long").repartition(5)
    for desc in (False, True):
        got = {r.k: r.before_w for r in exclusive_prefix_sums(df, "k", ["w"], descending=desc, n_buckets=16).collect()}
        ordered = sorted(rows, key=lambda x: -x[0] if desc else x[0])
        acc, want = 0, {}
        for k, w in ordered:
            want[k] = acc
            acc += w
        assert got == want


def test_dense_rank_matches_brute_force_with_ties_and_nulls(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice([None, 1.5, 2.0, 2.0, 3.25, 7.0, 7.0, 9.0]) ) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, v double")
    got = {r.id: r.rk for r in dense_rank(df, "v", "rk", descending=True, n_buckets=4).collect()}
    distinct = sorted({v for _, v in rows if v is not None}, reverse=True)
    want = {i: (None if v is None else distinct.index(v) + 1) for i, v in rows}
    assert got == want


def test_auc_matches_pairwise_count(spark):
    rnd = random.Random(11)
    rows = [(rnd.randint(0, 1), float(rnd.randint(0, 30))) for _ in range(500)]
    df = spark.createDataFrame(rows, "y int, s double")
    got = M.auc_by_aggregation(df, "y", "s", n_buckets=8).collect()[0].auc
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    assert abs(got - wins / (len(pos) * len(neg))) < 1e-12


def test_bucket_count_grows_with_input():
    from larder.functions.ranking import MAX_BUCKETS, MIN_BUCKETS, bucket_count

    assert bucket_count(10) == MIN_BUCKETS
    assert bucket_count(10**9) == 2000
    assert bucket_count(10**13) == MAX_BUCKETS


def test_prefix_sums_with_adaptive_buckets(spark):
    rows = [(k, 1) for k in range(3000)]
    df = spark.createDataFrame(rows, "k long, w long")
    got = {r.k: r.before_w for r in exclusive_prefix_sums(df, "k", ["w"], rows_per_bucket=100).collect()}
    assert got == {k: k for k in range(3000)}


def test_rank_helpers_on_empty_and_all_null_input(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id long, v double")
    assert {r.id: r.rk for r in dense_rank(df, "v", "rk").collect()} == {1: None, 2: None}
    empty = spark.createDataFrame([], "k long, w long")
    assert exclusive_prefix_sums(empty, "k", ["w"]).count() == 0
    single = spark.createDataFrame([(5, 2)], "k long, w long")
    assert [r.before_w for r in exclusive_prefix_sums(single, "k", ["w"]).collect()] == [0]


def test_ordinals_and_two_ranks_in_one_pass(spark):
    from larder.functions.ranking import dense_rank_tables, ordinals, with_dense_ranks

    rnd = random.Random(5)
    names = [f"n{rnd.randint(0, 10**9)}é" for _ in range(500)]
    df = spark.createDataFrame([(n,) for n in set(names)], "name string").repartition(7)
    got = {r.name: r.at for r in ordinals(df, ["name"], "at", n_buckets=9).collect()}
    assert got == {n: i for i, n in enumerate(sorted(set(names), key=lambda n: n.encode()))}
    rows = [(i, rnd.choice([None, 1, 2, 5]), rnd.choice([None, 0.5, 0.25])) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, a long, b double")
    got = {r.id: (r.ra, r.rb) for r in with_dense_ranks(df, {"ra": "a", "rb": "b"}).collect()}
    assert got == {i: ({5: 1, 2: 2, 1: 3}.get(a), {0.5: 1, 0.25: 2}.get(b)) for i, a, b in rows}
    assert set(dense_rank_tables(df, {"ra": "a", "rb": "b"})) == {"ra", "rb"}


def test_more_than_ten_thousand_ranges(spark):
    from larder.functions.ranking import _ranged

    df = spark.range(0, 24_000, numPartitions=8).select((F.col("id") * 3).alias("k"))
    ranged = _ranged(df, [F.col("k").desc()], 12_000)
    assert ranged.rdd.getNumPartitions() > 11_000  # bounds are chosen, the tiny tasks themselves are not run
    few = _ranged(df, [F.col("k").desc()], 40)
    edges = few.groupBy("_range").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).orderBy("_range").collect()
    assert len(edges) > 30 and all(a.lo > b.hi for a, b in zip(edges, edges[1:]))
