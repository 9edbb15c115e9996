"""The five stages and the closing summary.

Stages hand tables over through ``root``: each reads its input back from
columnar files, so no plan grows over stage borders and a lost executor costs
at most the stage it was working on.
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from keepwell import contract as C
from keepwell.operators import explain, gates as G, kpis, models as ML, segments as SG, validate as V
from keepwell.operators import metrics as M
from keepwell.operators import priority as PR
from keepwell.operators.prepare import build_features, split_rejected
from keepwell.operators.score import Bundle
from keepwell.session import tune
from keepwell.sources import accounts as A
from keepwell.sources import tables as T

log = logging.getLogger("keepwell")


def features_stage(raw: DataFrame, root: str, expected_rows: int | None = None,
                   keep_rejects: bool = False) -> DataFrame:
    """Validate, build and store the feature table in one read of ``raw``: the
    checks of its rows and the blanks of the result are counted by the job that
    writes. The table takes its place only when all hold. With ``keep_rejects``
    rows that stay incomplete (tenure 0) go to their own table instead of failing."""
    V.enforce_rows(V.column_findings(raw))
    checks = V.row_counts(raw)
    seen = Observation("checks of the raw rows")
    rows = G.observable(raw).observe(seen, F.count(F.lit(1)).alias("rows"), *[
        count.alias(f"n{i}") for i, count in enumerate(checks.values())])
    features = build_features(A.typed(rows))
    if len(set(features.columns)) != len(features.columns):
        raise V.AccountTableError("duplicate column names in the feature table")
    written = G.write_observed(features, root, {
        c: F.count_if(F.col(c).isNull()) for c in features.columns}, raw.sparkSession)
    counted = seen.get
    copies = V.duplicate_count(written.table).first()["extra_copies"]
    found = [(*check, counted[f"n{i}"]) for i, check in enumerate(checks)] + [(4, "duplicate_id", C.ID, copies)]
    if expected_rows is not None:
        found.append((1, "row_count", "*", abs(counted["rows"] - expected_rows)))
    blanks = [c for c, n in written.counts.items() if n]
    try:
        V.enforce_rows(found)
        if blanks and not keep_rejects:
            raise V.AccountTableError(f"blanks left in {blanks}")
    except V.AccountTableError:
        T.remove(raw.sparkSession, written.path)
        raise
    if keep_rejects:
        good, bad = split_rejected(written.table)
        T.write_table(bad, root, "rejected_accounts")
        stored = T.write_table(good, root, "features")
        T.remove(raw.sparkSession, written.path)
    else:
        stored = G.publish(written, root, "features")
    log.info("features: %d rows read", counted["rows"])
    return stored


def churn_stage(spark: SparkSession, root: str,
                settings: ML.ForestSettings = ML.ForestSettings()) -> dict:
    features = T.read_table(spark, root, "features")
    train, test = ML.split_training_set(ML.churn_training_set(features), "label")
    models = ML.fit_churn_models(train, settings=settings)
    predictions = T.write_table(ML.held_out_predictions(models, test), root, "churn_test_predictions")
    comparison = T.write_table(ML.compare_models(predictions), root, "churn_model_comparison_full")
    winner = ML.best_model(comparison).first()["model"]
    T.write_table(T.rounded(comparison), root, "churn_model_comparison")
    T.write_table(M.confusion_matrix(predictions.where(F.col("model") == winner)),
                  root, "churn_confusion_matrix")
    T.write_table(explain.contribution_summary(models, test, T.table_path(root, "_forest_nodes")),
                  root, "churn_contributions")
    models[winner].save(T.table_path(root, "churn_model"))
    log.info("churn: %s deployed", winner)
    return {"better_model": winner}


def value_stage(spark: SparkSession, root: str,
                settings: ML.ForestSettings = ML.ForestSettings()) -> dict:
    features = T.read_table(spark, root, "features")
    training = ML.value_training_set(features)
    ML.require_finite(training, ["label"])
    train, test = ML.split_training_set(training, None)
    model = ML.fit_value_model(train, settings=settings)
    report = T.write_table(ML.value_model_report(model, test), root, "clv_metrics_full")
    ML.require_finite(report, report.columns)
    T.write_table(T.rounded(report), root, "clv_metrics")
    T.write_table(ML.feature_importance(model), root, "clv_feature_importance")
    model.save(T.table_path(root, "clv_model"))
    return report.first().asDict()


def segments_stage(spark: SparkSession, root: str, restarts: int = SG.RESTARTS) -> dict:
    features = T.read_table(spark, root, "features")
    ML.require_finite(features, C.SEGMENT_FEATURES)
    evaluation = T.write_table(SG.evaluate_k(features, restarts=restarts), root,
                               "segment_evaluation_full")
    T.write_table(T.rounded(evaluation), root, "segment_evaluation")
    model = SG.fit_segments(features, restarts=restarts)
    assigned = model.assign(features.select(C.ID, *C.SEGMENT_FEATURES))
    profiles = T.write_table(
        SG.segment_profiles(assigned, model, SG.population_terciles(features)),
        root, "segment_profiles")
    SG.require_distinct_names(profiles)
    assignments = T.write_table(SG.assign_segments(features, model, profiles), root,
                                "customer_segments")
    V.require_zero(V.assignment_contract(assignments, profiles), "segment assignments")
    model.fitted.save(T.table_path(root, "segmentation_model"))
    return {"k": C.SEGMENT_COUNT, "best_k": SG.best_k(evaluation).first()["k"]}


def priority_stage(spark: SparkSession, root: str, expected_rows: int | None = None) -> dict:
    features = T.read_table(spark, root, "features")
    segments = T.read_table(spark, root, "customer_segments")
    churn = ML.FittedModel.load(T.table_path(root, "churn_model"))
    value = ML.FittedModel.load(T.table_path(root, "clv_model"))
    scores = T.write_table(ML.score_base(features, churn, value), root, "account_scores")
    V.require_zero(V.score_range_check(scores), "scores")
    thresholds = PR.median_thresholds(scores)
    labelled = PR.label_accounts(scores, thresholds)
    V.require_one_to_one(labelled, segments)
    matrix = T.write_table(PR.ranked_list(PR.attach_segments(labelled, segments)), root,
                           "priority_matrix")
    rows = V.require_zero(V.label_contract(matrix), "priority labels")
    if expected_rows is not None and rows != expected_rows:
        raise V.AccountTableError(f"{rows} labelled accounts, expected {expected_rows}")
    names = {r["cluster"]: r["segment"] for r in
             T.read_table(spark, root, "segment_profiles").select("cluster", "segment").collect()}
    segment_model = SG.SegmentModel.of(
        ML.FittedModel.load(T.table_path(root, "segmentation_model")))
    Bundle(churn, value, segment_model, names, thresholds).save(root)
    return {"customers": rows, "thresholds": thresholds}


def run(raw: DataFrame, root: str, expected_rows: int | None = None,
        settings: ML.ForestSettings = ML.ForestSettings(),
        restarts: int = SG.RESTARTS, keep_rejects: bool = False) -> DataFrame:
    """All stages; returns the one-row business summary."""
    spark = tune(raw.sparkSession)
    features_stage(raw, root, expected_rows, keep_rejects)
    churn_stage(spark, root, settings)
    value_stage(spark, root, settings)
    segments_stage(spark, root, restarts)
    priority_stage(spark, root, None if keep_rejects else expected_rows)
    matrix = T.read_table(spark, root, "priority_matrix")
    return T.write_table(kpis.business_summary(matrix), root, "business_summary")


STAGES = {"churn": churn_stage, "value": value_stage, "segments": segments_stage,
          "priority": priority_stage}


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(description="customer-retention pipeline")
    parser.add_argument("--root", required=True, help="folder for the stage tables")
    parser.add_argument("--accounts", help="account table (csv or parquet)")
    parser.add_argument("--format", default="csv")
    parser.add_argument("--expected-rows", type=int)
    parser.add_argument("--keep-rejects", action="store_true")
    parser.add_argument("--stage", choices=["all", "features", *STAGES], default="all")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    spark = tune(SparkSession.builder.appName("keepwell").getOrCreate())
    if args.stage in STAGES:
        log.info("%s: %s", args.stage, STAGES[args.stage](spark, args.root))
        return
    raw = A.read_accounts(spark, args.accounts, args.format)
    if args.stage == "features":
        features_stage(raw, args.root, args.expected_rows, args.keep_rejects)
        return
    run(raw, args.root, args.expected_rows, keep_rejects=args.keep_rejects).show()


if __name__ == "__main__":
    main()
