"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pageloom.plans import catalog
from pageloom.session import build_session

HEADLINE = [
    "url_parts",
    "page_digest",
    "page_blocks_given",
    "main_region",
    "score_containers",
    "classify_blocks",
    "page_title",
    "page_meta",
    "extract_pages",
    "dedup_documents",
    "dedup_segments",
    "term_counts",
    "step_stats",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    known = catalog.all_queries()
    spark.range(1000).count()
    times: dict[str, float] = {}
    for name in HEADLINE:
        start = time.time()
        known[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    sys.stdout.flush()
    spark.stop()


if __name__ == "__main__":
    main()
