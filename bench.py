"""Benchmark of the headline queries.

Runs each query over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line.  Every query is executed
in full through the ``noop`` sink (all rows computed, nothing collected).
A warm-up pass runs the same queries once on the smallest data set
(sf0.001) so JVM start, class loading and code generation are not billed to
the measured run; every measured query then runs once, cold on its data.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from forumlens import session  # noqa: E402
from forumlens.plans.registry import all_queries  # noqa: E402

HEADLINE = [
    "report_deltas",         # E4: change since the previous report
    "top_comments",          # G2: top 12 comments per post
    "context_document",      # F3: per-community context text
    "upsert_posts",          # B1: replayable upsert of landed batches
    "upsert_comments",       # B3: upsert with re-parenting (lineitem-sized)
    "last_comment_scrape",   # F1: newest comment scrape per post (lineitem-sized)
    "stale_posts",           # E6
    "letter_entries",        # M1
    "ticker_mentions",       # M2
    "entry_links",           # M3
    "link_grounding",        # E10
    "weighted_themes",       # M5: tokens over whole post and comment texts
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = session.build_session(master=f"local[{cpus}]", shuffle_partitions=cpus * 2,
                                  extra={"spark.driver.memory": "16g"})
    qs = all_queries()
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in HEADLINE:  # warm-up on tiny data
            qs[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
