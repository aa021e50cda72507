"""Time the headline queries; print one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores,
``BENCH_QUERIES`` (comma-separated) an own choice of queries.
"""

from __future__ import annotations

import json
import os
import time

from fieldmill.catalog import Tables, load_all
from fieldmill.session import build_session

# Each query runs this often and its best time counts: the first run of a plan
# mostly measures how the JVM compiles it.
RUNS = 2

HEADLINE = (
    "a6_columnar_scan",
    "c1_key_overlap",
    "c2_original_features",
    "c5_table_lookup",
    "d3_distinct_counts",
    "d4_missing_counts",
    "d11_group_median",
    "d12_popularity",
    "d14_lifecycle",
    "d21_graph_features",
    "d27_five_numbers_by_bin",
    "d31_timed_counts",
    "e2_rolling_count",
    "e5_rolling_bundle",
    "e8_trailing_by_channel",
    "e11_sliding_periods",
    "e15_monthly_closed_both",
    "h14_text_measures",
    "h15_clean_pages",
    "h17_kept_tokens",
    "j2_rare_levels",
    "j5_null_policy",
    "j10_evidence_encoding",
    "l3_entity_split",
    "l5_time_split_discrete",
    "m1_forest_classifier",
    "m5_top_terms",
    "p1_roc_auc",
    "p5_threshold_table",
    "q2_trending_job",
    "q4_mail_table",
    "q6_loan_job",
)


def run(spark, folder: str, name: str) -> float:
    started = time.perf_counter()
    load_all()[name].build(Tables(spark, folder)).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": str(max(8, 2 * int(cpus) if cpus != "*" else 16)),
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start the JVM's compilers and the parquet reader before timing anything
    run(spark, folder, "a6_columnar_scan")
    run(spark, folder, "d7_value_counts")
    seconds = {name: min(run(spark, folder, name) for _ in range(RUNS)) for name in chosen}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rsplit("sf", 1)[-1],
                "runs": RUNS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
