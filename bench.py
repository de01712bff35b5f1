"""Seconds per headline query; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma-separated names, default the headline list).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "clean_reviews", "dedupe_first", "extract_features", "lexicon_sentiment", "feature_means_by_label",
    "box_stats", "upsert_features", "stratified_split", "tfidf_vocab", "tfidf", "score_linear", "batch_scan",
    "explain_words", "roc_auc", "train_models", "stream_features",
]


def main() -> None:
    from veristar.plans.catalog import QUERIES
    from veristar.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(f"local[{cpus}]", "bench", shuffle_partitions=int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    # Start-up of the JVM and the code generator is not part of any query.
    QUERIES["punctuation_freq"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
