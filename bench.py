"""Times the headline queries and prints one JSON line.

The small scale next to the measured one, where there is one, is run first, so that class loading and code
generation are not timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from parley.plans.catalog import QUERIES  # noqa: E402
from parley.session import build_session  # noqa: E402


HEADLINE = (
    "ingest_clean message_ids user_engagement user_engagement_tiers campaign_performance daily_activity report_summary "
    "daily_trend campaign_engagement_frequency analytics_report_rows detect_anomalies validate_embeddings "
    "table_fingerprint graph_nodes graph_edges user_similarity campaigns_for_users documents_projection upsert_documents "
    "latency_stats latency_anomalies run_summary embed_messages user_centroids knn_exact knn_ivf recommendations "
    "stream_daily_counts"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    for name in names if os.path.isdir(small) else []:
        QUERIES[name](spark, small).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
        print(f"{name:32s} {seconds[name]:8.3f}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
