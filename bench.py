"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run once to warm up, then timed $BENCH_REPEAT times into a
noop sink (full computation, nothing collected); the median is reported.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "clean_text", "blank_filter", "drop_reasons", "label_review", "extract_suggestions",
    "preprocess_reviews", "training_extract", "class_proportions", "stratified_split_sizes",
    "top_bigrams", "top_trigrams", "word_frequency", "text_profile", "tfidf_weights", "confusion_matrix",
    "latest_reviews", "sentiment_by_day", "rolling_rates", "feed_dedupe", "join_back",
]
ONCE = ["train_predict"]  # iterative model fit: warmed up like the rest, then timed once


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    from revspark.session import build_session
    from revspark.plans.catalog import QUERIES
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    times, rows = {}, {}
    for name in HEADLINE:
        run(name)  # warm-up
        times[name] = round(statistics.median(run(name) for _ in range(repeat)), 3)
        rows[name] = QUERIES[name](spark, sf_dir).count()
    for name in ONCE:
        run(name)  # warm-up
        times[name] = round(run(name), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "rows": rows, "sf": sf,
                      "cpus": int(cpus), "repeat": repeat}))
    spark.stop()


if __name__ == "__main__":
    main()
