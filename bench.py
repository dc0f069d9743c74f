"""Times the headline queries on local cores and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cardsentry.plans.catalog import QUERIES
from cardsentry.session import local_session

HEADLINE = [
    "parse_valid", "parse_dlq", "dedupe_transactions", "card_facts", "risk_probability",
    "rule_velocity", "rule_amount_anomaly",
    "rule_geo_impossible", "rule_card_testing", "rule_model_score", "score_merged",
    "score_merged_split", "score_with_outside_hits", "alerts_flat", "alerts_page", "alerts_upsert",
    "hits_per_rule", "rule_config_problems", "rule_latest_valid", "rule_asof", "hit_rule_version",
    "daily_card_agg", "label_fpr", "rule_retune", "latency_percentiles", "quality_checks",
    "stream_scored",
]
# A stream cannot be repeated cheaply; everything else is timed after one unmeasured run.
ONCE = {"stream_scored"}


def _run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "cardsentry-bench")
    times = {}
    for name in HEADLINE:
        if name not in ONCE:
            _run(spark, name, sf_dir)
        times[name] = round(min(_run(spark, name, sf_dir) for _ in range(1 if name in ONCE else 2)), 3)
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "events": rows, "scored_rows_per_sec": round(rows / times["score_merged"])}))


if __name__ == "__main__":
    main()
