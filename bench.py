"""Time the headline queries: one JSON line. ``--all`` times every catalogued query."""
from __future__ import annotations

import json
import os
import sys
import time

# A spread over the operator families; each runs over its whole tables.
HEADLINE = [
    "labelled_source", "ascii_fold", "standardize", "one_hot_unseen", "geo_index", "null_share", "duplicate_keys",
    "flag_domain_check", "iqr_outlier_report", "iqr_multiplier_sweep", "impute_group_median", "impute_linear",
    "impute_knn", "stratified_split", "stratified_folds_shuffled", "information_gain_ranking", "combined_ranking",
    "wide_correlations", "max_min_selection", "relief_sampled", "pca_projection", "lasso_cross_validated",
    "knn_classify", "density_clusters", "forward_selection", "backward_selection", "profile_weighted_mean",
    "aggregation_rule_scores", "expert_diversity", "class_report",
]


def main() -> None:
    from tabulon.catalog import ENTRIES
    from tabulon.session import local_session
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = list(ENTRIES) if "--all" in sys.argv else HEADLINE
    spark = local_session(cpus, "bench")
    # Start the JVM code paths and the Python workers before the clock.
    spark.range(1000).repartition(8).mapInPandas(lambda it: it, "id bigint").count()
    times = {}
    for name in names:
        start = time.perf_counter()
        try:
            ENTRIES[name][0](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
        except Exception as e:
            times[name] = None
            print(f"{name}: {type(e).__name__}: {str(e)[:300]}", file=sys.stderr)
        if "--all" in sys.argv:
            print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(t for t in times.values() if t), 3),
                      "unit": "sec", "queries": times, "sf": os.path.basename(folder).removeprefix("sf")}))


if __name__ == "__main__":
    main()
