"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The loan table is derived and written first (entry ``loans_table``); every other entry
scans it. Results are evaluated in full through the no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from auditlens.plans import catalogue  # noqa: E402
from auditlens.session import local_session  # noqa: E402
from auditlens.sources.loans import complete_loans, loans  # noqa: E402

HEADLINE = """
profile_describe profile_table profile_correlations profile_feature_ranking profile_box_summary profile_density_curve
clean_drop_missing split_stratified encode_median_imputation encode_standardise
quality_rates quality_roc_auc quality_best_f1_threshold quality_threshold_sweep
stability_by_year stability_by_subgroup stability_by_quartile
explain_partial_dependence explain_curve_envelope explain_permutation_f1 explain_permutation_r2
explain_attribution_importance explain_sampled_attributions explain_local_linear
fairness_metrics fairness_equivalence_test fairness_candidate_variables fairness_group_roc
fairness_group_dependence fairness_dependence_disparity
model_linear_surrogate model_tree_surrogate model_forest_surrogate model_additive_surrogate model_black_box
compare_summary_record
""".split()


def timed(fn) -> float:
    start = time.perf_counter()
    fn()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    queries = catalogue.queries()
    seconds = {"loans_table": timed(lambda: loans(spark, sf_dir).count())}
    complete_loans(spark, sf_dir).count()
    for name in HEADLINE:
        run = lambda n=name: queries[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = sorted(timed(run) for _ in range(repeats))[repeats // 2]
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
