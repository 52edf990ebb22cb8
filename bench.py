"""Wall time of the headline queries; prints one JSON line.

Every query is evaluated in full: its result goes to Spark's no-op sink, so nothing is
pruned and nothing is collected. A query is timed from building its plan on, the best of
``BENCH_RUNS`` runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from workload import REGISTRY, Data  # noqa: E402

HEADLINE = (
    "flagship_outcome_log",
    "scl_12_parse_timestamp",
    "scl_18_rule_interpreter",
    "prj_03_incremental_window",
    "prj_05_changed_keys",
    "prj_09_canonical_distinct",
    "jon_13_configured_join",
    "win_01_latest_per_key",
    "win_02_latest_canonical",
    "jon_04_parent_check",
    "jon_07_rule_chain_rejects",
    "jon_09_sweep",
    "jon_11_person_consolidation",
    "jon_12_organization_consolidation",
    "doc_02_view_hcp_name",
    "doc_05_secondary_records",
    "doc_06_primary_records",
    "doc_07_post_addresses",
    "doc_08_download_phones",
    "jon_18_drop_known",
    "sbc_01_validation",
    "sbc_06_conditional_fallback",
    "sbc_07_combined_answer",
    "snk_02_batch_replace",
    "snk_08_full_refresh",
    "prj_24_transition_state",
    "agg_13_duplicate_keys_by_batch",
    "agg_18_not_null_tests",
    "jon_15_key_overlap",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("goldrow-bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    data = Data(spark, folder)
    data["orders"].groupBy("o_orderstatus").count().write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in names:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            REGISTRY[name].run(data).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rstrip("/").rsplit("/", 1)[-1],
        "cpus": int(cpus),
        "spark": spark.version,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
