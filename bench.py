"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed to completion with the `noop` sink (full plan, no collect):
one warm-up run, then the median of $BENCH_REPEAT timed runs. Prints ONE JSON line:
{"metric": "...", "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "dense_keyword_issue",
    "keyword_frequency_log",
    "series_similarity",
    "top_alert",
    "issue_graph",
    "clean_text_full",
    "parse_dates",
    "post_comment_rows",
    "comment_threads",
    "page_posts",
    "mmr_keywords",
    "document_keywords",
    "sentiment_score",
    "stream_hour_issue",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from issuewatch.plans.catalog import QUERIES
    from issuewatch.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2, app="issuewatch-bench")
    times: dict[str, float] = {}
    for name in only or HEADLINE:
        fn = QUERIES[name]

        def run() -> float:
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        run()  # warm-up (JIT, file listing cache, Python workers)
        times[name] = round(statistics.median(run() for _ in range(repeat)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": int(cpus),
                "repeat": repeat,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
