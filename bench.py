"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cinderlog.checks import loglines  # noqa: E402
from cinderlog.checks.queries import QUERIES  # noqa: E402
from cinderlog.session import build_session  # noqa: E402

HEADLINE = (
    "header_parse structured_lines skeleton_topk severity_report exceptions_report write_latency_report "
    "transfer_speed_report retry_report monthly_severity_report block_endpoints block_events block_sessions "
    "labelled_sessions split_sequential split_stratified sequence_slices level_counts_1m count_trend "
    "mean_per_interval points_counts json_roundtrip stream_level_counts stream_archive stream_batch_metrics "
    "term_frequency tfidf roc_auc anomaly_predictions"
).split()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        {"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}

    def timed(name, work):
        begun = time.time()
        work()
        seconds[name] = round(time.time() - begun, 3)

    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors
    timed("structure_store", lambda: loglines.store(spark, sf_dir).count())
    for name in HEADLINE:
        timed(name, lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale.group(1)) if scale else None,
    }))


if __name__ == "__main__":
    main()
