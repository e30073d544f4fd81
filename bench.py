"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS choose data and cores;
BENCH_QUERIES (comma separated, or "all") overrides the selection.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pledgeflow.queries import all_queries  # noqa: E402
from pledgeflow.session import get_session  # noqa: E402

HEADLINE = """
    max_per_key quarter_sum_std quarter_usd founder_distribution describe_wide column_stats box_stats
    hist2d_log upsert_replace upsert_if_newer count_mismatch first_match_merge semi_grouped anti_left_null
    event_number bucket_balanced log_fold interpolate_daily funding_curve unique_elements find_duplicates
    normalise_loan normalise_project sitemap_merge html_links classify_pages describe_report
""".split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    chosen = os.environ.get("BENCH_QUERIES", "")
    queries = all_queries()
    names = list(queries) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries["max_per_key"](spark, folder).write.format("noop").mode("overwrite").save()  # warm-up
    seconds = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
