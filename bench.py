"""Times the headline reports at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]`` and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from tidemark.plans import QUERIES
from tidemark.session import build_session

HEADLINE = [
    "hourly_summary_zero", "hourly_summary_skip", "hourly_stats", "percentile_by_value", "percentile_outliers", "top_by_source",
    "top_by_source_positional", "processed_share", "ingestion_health", "records_in_range", "unprocessed_of_source", "offset_page",
    "deep_offset_page", "keyset_page", "newest_tag_counts", "enriched_records", "request_errors", "batch_ingest_summary",
    "upsert_outcomes", "upserted_records", "records_marked_processed", "records_soft_deleted", "archive_additions", "archive_by_month",
    "parsed_events", "dead_letters", "first_events_by_key", "ledger_after_events", "retry_outcomes", "consumer_lag",
    "job_health", "job_duration_histogram", "request_rates", "server_error_ratio", "sustained_traffic",
    "token_bucket", "sliding_window", "accepted_within_ttl", "fixed_window", "order_summary", "revenue_by_nation", "orders_per_customer",
    "page_links", "bloom_probe", "distinct_texts", "search_documents", "nearest_points", "nearest_points_per_label",
    "streamed_events", "streamed_hourly_stats", "streamed_order_summary",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "tidemark-bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    # A real report warms up the session, so that the first timed one pays for nothing but itself.
    QUERIES["distinct_sources"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    chosen = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    seconds = {}
    for name in chosen:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_reports_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main()
