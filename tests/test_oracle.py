"""Every SQL-checkable query against its DuckDB statement (sf0.001)."""

import pytest

from support import SF_SMALL, _norm

from larder.plans.catalog import queries
from larder.plans.oracle import statements

STATEMENTS = statements()


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query_matches_oracle(spark, duck, name):
    sdf = queries()[name](spark, SF_SMALL)
    cur = duck.execute(STATEMENTS[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(ocols)
    perm = [ocols.index(c) for c in sdf.columns]
    got = sorted((tuple(_norm(v) for v in r) for r in sdf.collect()), key=repr)
    want = sorted((tuple(_norm(r[i]) for i in perm) for r in orows), key=repr)
    assert len(got) == len(want)
    assert got == want


def test_every_query_has_oracle_or_is_model_output():
    rows_only = {"assemble_features", "rf_stockout", "auc_model", "rf_reorder_point",
                 "regression_metrics_model", "score_products", "feature_importance",
                 "recommendations_from_model_output"}
    missing = set(queries()) - set(STATEMENTS)
    assert missing == rows_only
