"""Property tests on generated inputs (hypothesis; few examples, each runs Spark jobs)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from support import rows_of

from larder.operators import cleaning as C
from larder.operators import features as G

TYPES = st.sampled_from(["SALE", "sale", "out", "purchase", "adjustment", None])
MOVE = st.tuples(
    st.integers(1, 6),                                        # product
    TYPES,
    st.one_of(st.none(), st.integers(-30, 30).map(float)),    # quantity
    st.one_of(st.none(), st.integers(0, 20).map(lambda d: dt.datetime(2024, 1, 1) + dt.timedelta(days=d))),
)
INV = st.tuples(st.integers(1, 8), st.one_of(st.none(), st.integers(0, 80).map(float)),
                st.one_of(st.none(), st.integers(0, 20).map(float)))
SUP = st.tuples(st.integers(1, 8), st.integers(1, 4), st.one_of(st.none(), st.integers(-3, 14).map(float)))

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
TRX_SCHEMA = "product_id long, transaction_type string, quantity_change double, transaction_date timestamp_ntz"


def _frames(spark, moves, inv, sup):
    trx = spark.createDataFrame(moves, TRX_SCHEMA)
    i = spark.createDataFrame(inv, "product_id long, stock_quantity double, reorder_level double")
    s = spark.createDataFrame(sup, "product_id long, supplier_id long, avg_lead_time_days double")
    return trx, i, s


@SETTINGS
@given(moves=st.lists(MOVE, max_size=40), inv=st.lists(INV, min_size=1, max_size=10),
       sup=st.lists(SUP, max_size=10))
def test_gold_invariants(spark, moves, inv, sup):
    trx, i, s = _frames(spark, moves, inv, sup)
    gold = G.gold_features(trx, i, s)
    rows = gold.collect()
    ids = [r.product_id for r in rows]
    assert len(ids) == len(set(ids)) == len({p for p, _, _ in inv})
    assert all(r.stock_on_hand >= 0 for r in rows)
    assert all(r.reorder_point is not None and r.reorder_point >= 0 for r in rows)
    assert all(r.stockout_risk in (0, 1) for r in rows)
    shuffled = G.gold_features(trx.repartition(3), i.repartition(2), s.repartition(3))
    assert rows_of(shuffled) == rows_of(gold)


@SETTINGS
@given(moves=st.lists(MOVE, max_size=40))
def test_dedup_idempotent_and_partition_independent(spark, moves):
    trx = spark.createDataFrame(moves + moves[: len(moves) // 2], TRX_SCHEMA)
    once = C.dedup_rows(trx)
    assert rows_of(C.dedup_rows(once)) == rows_of(once)
    keyed = C.dedup_by_key(trx, "product_id")
    assert rows_of(C.dedup_by_key(keyed, "product_id")) == rows_of(keyed)
    assert rows_of(C.dedup_by_key(trx.repartition(4), "product_id")) == rows_of(keyed)
    assert once.count() == len(set(moves))
