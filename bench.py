"""Warm wall time per headline query; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores, BENCH_RUNS the timed runs
per query (the median counts) and BENCH_ALL=1 times every registered query.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from adjudica import plans
from adjudica.session import local_session

HEADLINE = [
    "provider_fwa_features", "provider_worklist", "patient_stats", "chronic_weights", "abt_renewal",
    "member_history", "member_history_flattened", "claims_flatten", "cost_iqr", "visit_gap_std", "cost_trend_slope",
    "avg_provider_risk", "ytd_spend", "duplicate_claims", "claim_velocity_rolling", "unique_providers_rolling",
    "refill_frequency", "claims_last_hour", "member_session", "stp_label", "triage_decision", "feature_stage",
    "diag_proc_top5", "correlation_matrix", "stratified_split", "auc_claims", "bias_disparity", "drift_check",
    "flatten_claim_items", "real_claim_features", "churn_target_prob", "isolation_forest_score", "provider_tiers",
    "pricing_features", "stream_dedup",
]


def main() -> None:
    data = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores, "adjudica-bench")
    registered = plans.all_queries()
    names = list(registered) if os.environ.get("BENCH_ALL") == "1" else HEADLINE
    timings: dict[str, float] = {}
    for name in names:
        samples = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            registered[name](spark, data).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(samples[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total_warm_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(data.rstrip("/")).removeprefix("sf"),
                "cores": int(cores),
                "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
