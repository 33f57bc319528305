"""Physical-plan properties of the flagship and the reports."""

import re

from support import SF_SMALL

from larder.plans import catalog


def _executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _final(plan: str) -> str:
    return plan.split("== Initial Plan ==")[0]


def _planned(df) -> str:
    """Physical plan before execution: each operator appears exactly once."""
    return df._jdf.queryExecution().executedPlan().toString()


def test_gold_scans_each_silver_table_once_and_never_cross_joins(spark):
    plan = _planned(catalog.gold_features(spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "transaction_type" in line]
    main = [s for s in scans if "quantity_change" in s]
    probes = [s for s in scans if re.search(r"FileScan parquet \[transaction_type#\d+\]", s)]
    # one scan of the movements, plus the limit-1 EXISTS probe of the type column
    assert len(main) == 1 and len(probes) <= 1 and len(scans) == len(main) + len(probes)


def test_movement_scan_reads_only_needed_columns(spark):
    df = catalog.gold_features(spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    movement_schemas = [r for r in read if "quantity_change" in r]
    assert movement_schemas and all("order_ref" not in r and "transaction_id" not in r for r in movement_schemas)


def test_no_query_plans_a_cross_join_or_unbounded_global_window(spark):
    from larder.plans.model_catalog import model_queries

    skip = set(model_queries()) - {"auc_exact"}  # model fits are MLlib jobs, not SQL plans
    unpartitioned: set[str] = set()
    for name, fn in catalog.queries().items():
        if name in skip:
            continue
        plan = _planned(fn(spark, SF_SMALL))
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name
        # a window without partition keys (its spec starts with the sort key) is
        # only allowed over the bucket-offset table, ordered by the bucket number
        for m in re.finditer(r"windowspecdefinition\(([^,()]+?) (ASC|DESC)", plan):
            assert m.group(1).startswith(("_bucket", "_range")), (name, m.group(0))
        unpartitioned.update(m.group(1) for m in re.finditer(r"windowspecdefinition\(([^,()]+?) (ASC|DESC)", plan))
    assert unpartitioned and all(u.startswith(("_bucket", "_range")) for u in unpartitioned)  # the check is not vacuous


def test_gold_at_scale_shape_four_shuffles_and_copartitioned_joins(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")   # the 100 TB case: no product-grain side fits a broadcast
    try:
        plan = _planned(catalog.gold_features(spark, SF_SMALL))
    finally:
        spark.conf.set(key, old)
    assert plan.count("SortMergeJoin") == 2
    # inventory, suppliers, movements by (product, 64-day word) and their words by product
    assert plan.count("Exchange hashpartitioning") == 4
    assert "partial_bit_or" in plan and "collect_set" not in plan and "BroadcastExchange" not in plan
