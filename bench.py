"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print ONE JSON line.

Each query is executed to completion with a no-op sink (``write.format
("noop")``), so the timing covers the whole plan without collecting rows
to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from postlens.plans import catalog  # noqa: E402
from postlens.session import local_session  # noqa: E402

HEADLINE = [
    "community_top_keywords", "keywords_per_post", "clean_documents", "preprocess_documents",
    "behaviour_flags", "topics", "sentiment", "emotion", "entities", "post_summaries",
    "overview_sentiment", "community_metadata", "posts_by_hour", "search_all", "ingest_counters",
    "dashboard_stats", "overview", "community_summaries", "score_histogram",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in HEADLINE if n in catalog.QUERIES]
    spark = local_session(cpus=cpus, app="postlens-bench")
    times: dict[str, float] = {}
    # one run that is not timed, so that no query carries the start of the JVM
    catalog.QUERIES["posts_by_hour"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in names:
        t0 = time.time()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
