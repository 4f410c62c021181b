"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default sf0.1), ``BENCH_CPUS`` (default 8) and ``BENCH_RUNS``
(default 1: one timed run after one warm-up run per query) set the measurement.
Results go to Spark's no-op sink, so every row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from passagemill import plans
from passagemill.plans import fixtures
from passagemill.session import build_session

HEADLINE = (
    "token_counts",
    "content_type",
    "pages_elements",
    "char_window_chunks",
    "routed_chunks",
    "hierarchical_chunks",
    "hybrid_chunks",
    "chunk_table",
    "hash_embedding",
    "dense_topk",
    "bm25_topk",
    "bm25_indexed",
    "hash_dense_topk",
    "hybrid_topk",
    "two_route_rerank",
    "qa_unified",
    "qa_two_route",
    "flagship_contexts",
    "upsert",
    "change_feed",
    "index_rebuild",
    "incremental_sync",
    "ann_topk",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = sys.argv[1:] or HEADLINE
    spark = build_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        start = time.perf_counter()
        plans.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times: dict[str, float] = {}
    start = time.perf_counter()
    fixtures.passage_index(spark, sf_dir)
    times["passage_index_build"] = round(time.perf_counter() - start, 3)
    start = time.perf_counter()
    fixtures.cell_index(spark, sf_dir)
    times["cell_index_build"] = round(time.perf_counter() - start, 3)
    for name in chosen:
        seconds(name)
        times[name] = round(statistics.median(seconds(name) for _ in range(runs)), 3)
        print(name, times[name], file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rsplit("/", 1)[-1].removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
