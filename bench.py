"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR   data folder (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 8)
    BENCH_RUNS     timed runs per query, the fastest counts (default 2)
"""

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from folioscope.plans.registry import QUERIES  # noqa: E402
from folioscope.session import build_session  # noqa: E402

HEADLINE = [
    "json_line_extract",
    "json_line_parse",
    "delimited_scan",
    "html_taxonomy_extract",
    "table_write",
    "taxonomy_join_broadcast",
    "null_profile",
    "dedupe_by_id",
    "count_by_year_category",
    "author_stats_by_year_min",
    "category_series",
    "split_tests",
    "tokenise",
    "vocabulary",
    "idf_weight",
    "label_index",
    "classify_nb",
    "classify_lr",
    "metric_f1",
    "upsert",
]


def run(spark, key: str, folder: str) -> float:
    begin = time.perf_counter()
    QUERIES[key](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__folioscope__inputPartitions=cpus,
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "row_count", folder)
    timings = {}
    for key in sys.argv[1:] or HEADLINE:
        timings[key] = round(min(run(spark, key, folder) for _ in range(runs)), 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(scale[1]) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
