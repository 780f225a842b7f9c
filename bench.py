"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import shutil
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from driver_queries.registry import QUERIES  # noqa: E402
from tallygate.session import build_session  # noqa: E402

HEADLINE = (
    "chk8_hourly_summary",
    "ag5_exact_quantiles",
    "wn1_exact_duplicates",
    "pf1_wait_percentiles",
    "pf4_negative_wait_by_segment",
    "pf6_prearranged_signature",
    "pf8_whole_minute_request_by_wait",
    "pf11_implied_speed",
    "pf17_column_profile",
    "vr8_rule_counts",
    "vr10_kpi_variants",
    "md4_dim_hour",
    "md6_fact_trip_event",
    "m1d_late_rate_borough_hour",
    "m3_dwell",
    "m4a_rain",
    "mx2_metric_table",
    "ce6_eligible_cells",
    "smp1_hash_sample",
    "smp3_rare_rule_sample",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    folder = tempfile.mkdtemp(prefix="spark-")
    spark = build_session(
        "bench",
        **{
            "spark.checkpoint.dir": folder,
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            # the bench files are small: let one file feed several tasks
            "spark.sql.files.maxPartitionBytes": str(2 << 20),
            "spark.sql.files.openCostInBytes": "0",
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start the workers and compile the common paths before the clock runs
    QUERIES["vr8_rule_counts"](spark, sf_dir).collect()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()
    shutil.rmtree(folder, ignore_errors=True)


if __name__ == "__main__":
    main()
