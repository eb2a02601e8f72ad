"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from talweg import local_session, ship_package

HEADLINE = (
    "whitespace_cleaned", "rule_keys", "domain_classified", "domain_status_counts", "relation_enforced",
    "dates_parsed", "sequential_ids", "scan_order_ids", "unique_value_counts", "attribute_duplicates",
    "geometric_duplicates", "quality_summary", "polygon_metrics", "clipped_to_states", "regions_assigned",
    "region_pairs", "ogc_invalid_reasons", "geometries_repaired", "functional_dependencies", "domain_autofix",
    "control_triage", "treated_orders",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "talweg-bench")
    ship_package(spark)
    import workload

    registered = workload.queries()
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    times = {}
    spark.range(1000).selectExpr("sum(id)").collect()
    for name in HEADLINE:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
