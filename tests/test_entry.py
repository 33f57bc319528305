"""The driver contract in __spark_entry__.py."""

import importlib.util
import os

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs_with_stable_schema(spark, entry_module):
    df = entry_module.entry(spark)
    assert df.columns[:4] == ["product_id", "supplier_product_ref", "initial_stock_quantity", "stock_on_hand"]
    assert df.count() == 200
    assert entry_module.entry(spark).schema == df.schema


def test_oracle_keys_are_query_keys(entry_module):
    q, o = entry_module.queries(), entry_module.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 80 and all(callable(f) for f in q.values())


def test_oracle_columns_match_query_columns(spark, duck, entry_module):
    from support import SF_SMALL

    q, o = entry_module.queries(), entry_module.oracle_sql()
    for name in ("gold_features", "supplier_review", "feature_stats", "recommendations"):
        cols = q[name](spark, SF_SMALL).columns
        ocols = [d[0] for d in duck.execute(o[name]).description]
        assert sorted(cols) == sorted(ocols), name
