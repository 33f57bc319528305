"""Runnable layer jobs: bronze landing, silver, gold, models, scores, recommendations, reports.

Each job reads the previous layer from storage and writes its own, so they can
be scheduled separately (and retried) like the stages they replace::

    python -m larder.plans.jobs bronze  --jdbc-url U --table T --partition-column C --lower L --upper H \\
        --partitions N --inventory I --documents D --raw R
    python -m larder.plans.jobs silver  --raw R --silver S [--landed] [--movements-increment]
    python -m larder.plans.jobs gold    --silver S --gold G [--incremental]
    python -m larder.plans.jobs models  --gold G --out O
    python -m larder.plans.jobs score   --gold G --out O
    python -m larder.plans.jobs recommend --scored O/model_output --out O/business_recommendations [--scored-format csv]
    python -m larder.plans.jobs reports --silver S --gold G
    python -m larder.plans.jobs all --raw R --root T [--landed]

Raw inputs follow the landing layout: ``stock_transactions`` (CSV with header),
``grocery_inventory`` (CSV with header), ``suppliers`` (JSON documents), or, with
``--landed``, what the bronze job wrote. Layers are replaced as a whole and stay
readable if a write fails; with ``versioned`` they are versioned tables
(``sources.tables``, for object stores). Every job takes either kind as input.
Row counts come from the writes themselves; no written table is read again for
them. CSV with line breaks inside quoted fields is recognised and cut by quote
parity (``sources.quoted_csv``), however many tasks read a file.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators import cleaning as C
from larder.operators import features as G
from larder.operators import modeling as M
from larder.operators import recommend as R
from larder.operators import reports as D
from larder.operators import validation as V
from larder.functions.lineage import stage
from larder.functions.roles import resolve_transaction_roles
from larder.plans.incremental import incremental_gold
from larder.sources import landing, readers, tables, writers
from larder.streaming.silver import append_new

SILVER = ("stock_transactions", "grocery_inventory", "suppliers")


def _write(df: DataFrame, path: str, versioned: bool, compact: bool = False) -> int:
    if versioned:
        return sum(tables.replace_table(df, path).rows.values())
    return writers.write_parquet(df, path, compact=compact)


def _counts(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    return spark.createDataFrame(list(counts.items()), "dataset string, n_rows long")


def run_bronze(spark: SparkSession, movements: DataFrame, inventory_csv: str, documents: str, raw: str,
               multi_line: bool | None = None) -> DataFrame:
    """Land the three sources; returns (dataset, n_rows), for ``suppliers`` the number of documents."""
    counts: dict[str, int] = {}
    landing.land_bronze(spark, movements, inventory_csv, documents, raw, multi_line=multi_line, counts=counts)
    return _counts(spark, counts)


def run_silver(spark: SparkSession, raw: str, silver: str, infer_schema: bool = False,
               movements_format: str = "csv", landed: bool = False, multi_line: bool | None = None,
               versioned: bool = False, movements_increment: bool = False) -> DataFrame:
    """Clean the three raw datasets into Parquet; returns (dataset, n_rows).

    CSV fields are read as text, which the cleaning and the features cast
    leniently; ``infer_schema`` reads every file once more to type them.
    ``movements_format="parquet"`` reads movements landed as Parquet (e.g. from
    the partitioned relational read), keeping their types. ``landed`` reads what
    ``run_bronze`` wrote: Parquet movements and documents as landed bytes.
    ``multi_line`` says whether quoted fields may hold line breaks; unset, the
    files are looked at. With ``movements_increment`` the movements are one more
    delivery: only rows that the (versioned) silver table lacks are appended,
    and the count is that of the new rows.
    """
    raw, silver = raw.rstrip("/"), silver.rstrip("/")
    if landed:
        suppliers = readers.json_document_records(spark.read.parquet(f"{raw}/suppliers"))
    else:
        suppliers = readers.read_json_documents(spark, f"{raw}/suppliers")
    if landed or movements_format == "parquet":
        moves = spark.read.parquet(f"{raw}/stock_transactions")
    else:
        moves = readers.read_csv(spark, f"{raw}/stock_transactions", infer_schema=infer_schema, multi_line=multi_line)
    inventory = readers.read_csv(spark, f"{raw}/grocery_inventory", infer_schema=infer_schema, multi_line=multi_line)
    if movements_increment:
        counts = {SILVER[0]: append_new(moves, f"{silver}/{SILVER[0]}")}
    else:
        counts = {SILVER[0]: _write(C.clean_transactions(moves), f"{silver}/{SILVER[0]}", versioned)}
    counts[SILVER[1]] = _write(C.clean_inventory(inventory), f"{silver}/{SILVER[1]}", versioned)
    counts[SILVER[2]] = _write(C.clean_suppliers(suppliers), f"{silver}/{SILVER[2]}", versioned)
    return _counts(spark, counts)


def run_gold(spark: SparkSession, silver: str, gold: str, incremental: bool = False, versioned: bool = False) -> DataFrame:
    """Gold feature table (compact Parquet) with its statistics beside it; returns the validation row.

    ``incremental`` (silver movements are a versioned table) reads only the
    movement folders that are new since the last run.
    """
    silver, gold = silver.rstrip("/"), gold.rstrip("/")
    if incremental:
        features = incremental_gold(spark, silver, gold)
    else:
        features = G.gold_features(*(tables.read_table(spark, f"{silver}/{n}") for n in SILVER))
    _write(features, f"{gold}/gold_features", versioned, compact=True)
    table = tables.read_table(spark, f"{gold}/gold_features")
    writers.write_parquet(V.feature_stats(table), f"{gold}/feature_stats", compact=True)
    writers.write_parquet(V.gold_sample(table), f"{gold}/gold_sample", compact=True)
    return V.target_balance(table)


def run_models(spark: SparkSession, gold: str, out: str) -> dict:
    """Fit both forests on the train split, evaluate on test, save them, write scores for all products."""
    out = out.rstrip("/")
    table = tables.read_table(spark, f"{gold.rstrip('/')}/gold_features")
    frame, feats = M.model_frame(table)
    train, test = frame.where(F.col("split") == "train"), frame.where(F.col("split") == "test")
    clf, reg = M.fit_classifier(train), M.fit_regressor(train)
    M.save_models(spark, clf, reg, feats, f"{out}/models")
    # Written once: each metric reads the predictions, not the forests again.
    risk = stage(M.classifier_predictions(clf, test).select(M.CLASS_LABEL, "rawPrediction"), "class-predictions")
    points = stage(reg.transform(test).select(M.REGRESSION_LABEL, "prediction"), "reorder-predictions")
    metrics = {"auc": M.evaluator_auc(risk), **M.evaluator_regression(points)}
    imp = clf.stages[-1].featureImportances
    metrics["feature_importance"] = {f: round(float(imp[i]), 4) for i, f in enumerate(feats)}
    scored = M.score_products(table, clf, reg)  # the scores stand beside the features
    writers.write_parquet(scored, f"{out}/model_output", compact=True)
    return metrics


def run_score(spark: SparkSession, gold: str, out: str) -> DataFrame:
    """Score all products of the current gold table with the saved forests, without fitting; returns (dataset, n_rows)."""
    out = out.rstrip("/")
    table = tables.read_table(spark, f"{gold.rstrip('/')}/gold_features")
    clf, reg = M.load_models(spark, f"{out}/models", table)
    n = writers.write_parquet(M.score_products(table, clf, reg), f"{out}/model_output", compact=True)
    return _counts(spark, {"model_output": n})


def run_recommendations(spark: SparkSession, scored: str, out: str, scored_format: str = "parquet") -> DataFrame:
    """Recommendations as CSV; returns the zero-filled priority summary.

    ``scored_format="csv"`` takes scores as a CSV file with a header, as other
    tools write them: fields are text, the three scores are cast leniently.
    """
    if scored_format == "csv":
        scores = readers.read_csv(spark, scored)
        scores = scores.withColumns({c: F.trim(F.col(c)).try_cast("double") for c in R.SCORE_COLUMNS})
    else:
        scores = tables.read_table(spark, scored)
    recs = R.recommendations(scores)
    writers.write_csv(recs, out)
    return R.priority_summary(readers.read_csv(spark, out, schema=recs.schema))


def run_reports(spark: SparkSession, silver: str, gold: str) -> dict[str, str]:
    """Every report, written beside the feature table.

    Those by supplier are left out when the movements have no supplier column;
    movements are enriched with the names and categories that there are.
    """
    silver, gold = silver.rstrip("/"), gold.rstrip("/")
    trx, inv, sup = (tables.read_table(spark, f"{silver}/{n}") for n in SILVER)
    table = tables.read_table(spark, f"{gold}/gold_features")
    r = resolve_transaction_roles(trx.columns)
    outputs = {
        "inventory_performance_report": D.inventory_performance_report(trx, inv),
        "inventory_status": D.with_inventory_status(table),
        "restock_list": D.restock_list(table),
        "top_k_velocity": D.top_k_velocity(table),
        "outflow_anomalies": D.outflow_anomalies(
            G.filter_sales_with_fallback(trx, r.type, r.quantity), r.product, r.quantity),
    }
    if "supplier_ref" in trx.columns:
        outputs["supplier_efficiency_metrics"] = D.supplier_efficiency_metrics(trx)
        outputs["supplier_review"] = D.supplier_review(trx, table)
        if "supplier_id" in sup.columns:
            outputs["enriched_movements"] = D.enriched_movements(
                trx, inv, sup, product_attrs=tuple(c for c in ("product_name", "category") if c in inv.columns),
                supplier_attrs=tuple(c for c in ("supplier_name",) if c in sup.columns))
    for name, df in outputs.items():
        writers.write_parquet(df, f"{gold}/{name}", compact=True)
    return {n: f"{gold}/{n}" for n in outputs}


def run_all(spark: SparkSession, raw: str, root: str, movements_format: str = "csv", landed: bool = False) -> dict:
    root = root.rstrip("/")
    silver, gold, out = f"{root}/silver", f"{root}/gold", f"{root}/models"
    counts = {r.dataset: r.n_rows for r in
              run_silver(spark, raw, silver, movements_format=movements_format, landed=landed).collect()}
    validation = run_gold(spark, silver, gold).collect()[0].asDict()
    metrics = run_models(spark, gold, out)
    summary = {r.priority: r.n_products for r in
               run_recommendations(spark, f"{out}/model_output", f"{root}/business_recommendations").collect()}
    reports = run_reports(spark, silver, gold)
    return {"silver": counts, "gold": validation, "models": metrics, "priorities": summary, "reports": reports}


def main(argv: list[str] | None = None) -> None:
    from larder.session import get_session

    p = argparse.ArgumentParser(prog="larder.plans.jobs")
    p.add_argument("job", choices=["bronze", "silver", "gold", "models", "score", "recommend", "reports", "all"])
    p.add_argument("--jdbc-url")
    p.add_argument("--table")
    p.add_argument("--partition-column")
    p.add_argument("--lower", type=int)
    p.add_argument("--upper", type=int)
    p.add_argument("--partitions", type=int)
    p.add_argument("--inventory")
    p.add_argument("--documents")
    p.add_argument("--landed", action="store_true", help="the raw zone is what the bronze job wrote")
    p.add_argument("--raw")
    p.add_argument("--silver")
    p.add_argument("--gold")
    p.add_argument("--out")
    p.add_argument("--scored")
    p.add_argument("--root")
    p.add_argument("--object-store", action="store_true", help="apply S3A settings from the environment")
    p.add_argument("--movements-format", choices=["csv", "parquet"], default="csv")
    p.add_argument("--scored-format", choices=["parquet", "csv"], default="parquet")
    p.add_argument("--multi-line", choices=["auto", "yes", "no"], default="auto",
                   help="line breaks inside quoted CSV fields (auto: look at the files)")
    p.add_argument("--movements-increment", action="store_true", help="append the new movements to the versioned silver table")
    p.add_argument("--incremental", action="store_true", help="read only the movement folders that are new to gold")
    p.add_argument("--versioned", action="store_true", help="write layers as versioned tables")
    a = p.parse_args(argv)
    spark = get_session(object_store=a.object_store)
    multi_line = {"auto": None, "yes": True, "no": False}[a.multi_line]
    if a.job == "bronze":
        moves = readers.read_jdbc(spark, a.jdbc_url, a.table, a.partition_column, a.lower, a.upper, a.partitions)
        result = [r.asDict() for r in run_bronze(
            spark, moves, a.inventory, a.documents, a.raw, multi_line=multi_line).collect()]
    elif a.job == "silver":
        result = [r.asDict() for r in run_silver(
            spark, a.raw, a.silver, movements_format=a.movements_format, landed=a.landed, multi_line=multi_line,
            versioned=a.versioned, movements_increment=a.movements_increment).collect()]
    elif a.job == "gold":
        result = run_gold(spark, a.silver, a.gold, a.incremental, a.versioned).collect()[0].asDict()
    elif a.job == "models":
        result = run_models(spark, a.gold, a.out)
    elif a.job == "score":
        result = [r.asDict() for r in run_score(spark, a.gold, a.out).collect()]
    elif a.job == "recommend":
        result = [r.asDict() for r in run_recommendations(spark, a.scored, a.out, a.scored_format).collect()]
    elif a.job == "reports":
        result = run_reports(spark, a.silver, a.gold)
    else:
        result = run_all(spark, a.raw, a.root, a.movements_format, a.landed)
    print(json.dumps(result, default=str))


if __name__ == "__main__":
    main()
