"""Time the headline queries: one JSON line with the median seconds of three runs per query, and their total."""

from __future__ import annotations

import json
import os
import time
from statistics import median

from ferrytab.plans.catalogue import QUERIES
from ferrytab.session import local_session, scratch_scope

RUNS = 3

HEADLINE = (
    "extract_batches", "batch_checksum", "combined_checksum", "map_policies", "map_claims", "transform_stats",
    "tf_title_case", "validate_report", "validate_failures", "rule_transitions", "recon_report",
    "recon_mismatch_detail", "recon_composite", "lineage_build", "lineage_impact", "lineage_map",
    "question_context", "history_trim", "migration_report",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "ferrytab-bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/orders.parquet").count()  # start the executor before the clock
    seconds = {}
    for name in HEADLINE:
        took = []
        for _ in range(RUNS):
            start = time.perf_counter()
            with scratch_scope(spark):
                QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
                took.append(time.perf_counter() - start)
        seconds[name] = round(median(took), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
