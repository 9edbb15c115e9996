"""Benchmark: headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line. Every query is timed from building its plan (which runs
the small statistics jobs some plans need) to the last row written to a sink
that discards it. Model fits are lines of their own, named ``fit_*``.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))

from keepwell.plans import fitted  # noqa: E402
from keepwell.plans.queries import QUERIES  # noqa: E402
from keepwell.session import local_session  # noqa: E402

FITS = {
    "fit_feature_table": fitted.features,
    "fit_churn_models": fitted.churn,
    "fit_value_model": fitted.value,
    "fit_segments": fitted.segments,
    "fit_k_sweep": fitted.k_evaluation,
}
HEADLINE = [
    "q_scan_accounts", "q_validate_report", "q_duplicate_ids", "q_blank_profile",
    "q_vocab_violations", "q_rejected_records", "q_status_counts", "q_features",
    "q_derived_features", "q_churn_predictors", "q_median_thresholds", "q_terciles",
    "q_fixed_sample", "q_stratified_split", "q_plain_split", "q_standardize",
    "q_class_weights", "q_classification_metrics", "q_confusion_matrix", "q_roc_auc",
    "q_regression_metrics", "q_silhouette", "q_priority_labels", "q_attach_segments",
    "q_ranked_list", "q_kpis", "q_business_summary", "q_segment_overview",
    "q_segment_profiles_rule", "q_search_accounts", "q_priority_queue", "q_dossier",
    "q_rule_explained", "t_order_quantiles", "t_order_split", "t_order_ranking",
    "q_churn_lr_scores", "q_churn_rf_scores", "q_clv_scores", "q_model_comparison",
    "q_clv_metrics", "q_contrib_summary", "q_segment_assign", "q_model_priority_matrix",
    "q_score_new_accounts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}

    def timed(name, work):
        start = time.perf_counter()
        work()
        timings[name] = round(time.perf_counter() - start, 3)

    def drain(query):
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()

    QUERIES["q_status_counts"](spark, sf_dir).count()     # start-up, not timed
    plain = [n for n in HEADLINE if "fitted" not in QUERIES[n].__wrapped__.__code__.co_names]
    for name in plain:
        timed(name, lambda: drain(QUERIES[name]))
    for name, fit in FITS.items():
        timed(name, lambda: fit(spark, sf_dir))
    for name in HEADLINE:
        if name not in plain:
            timed(name, lambda: drain(QUERIES[name]))
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
