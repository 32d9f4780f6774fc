"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   tables to read   (default /root/testdata/sf0.1)
BENCH_CPUS     local threads    (default 8)
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import suite  # noqa: E402
from leafline.session import build_session  # noqa: E402

HEADLINE = [
    "recommend_titles",
    "recommend_batch",
    "similar_comments",
    "build_title_info",
    "build_comments",
    "title_dtm",
    "tfidf_l2",
    "top_terms",
    "bag_of_words",
    "daily_records",
    "keyed_upsert",
    "latest_per_key",
    "title_topics",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    suite.load_all()
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/part.parquet").count()  # start the executors before the clock
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        start = time.perf_counter()
        suite.CASES[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    found = re.search(r"sf([\d.]+)$", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(found.group(1)) if found else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
