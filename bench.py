"""Time the headline queries and print one JSON line.

Each query runs once to warm up and then BENCH_RUNS times (default 3); the median
counts. Rows go to Spark's no-op sink, so every output column is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from registry.queries import QUERIES  # noqa: E402
from wordloom.session import session  # noqa: E402

HEADLINE = [
    "a3_tokens",
    "a5_corpus_status",
    "b4_float_range_filter",
    "b7_conjunction",
    "c1_all",
    "c3_phrase",
    "c4_boolean",
    "c5_extended",
    "d2_bm25",
    "d5_proximity",
    "e1_relevance",
    "g6_attrpair",
    "g7_multi_value",
    "g8_group_best",
    "g9_distinct",
    "i2_update_scalar",
    "j1_batch_search",
    "j1_default_search",
    "j2_match_result",
    "j4_word_stats",
    "l2_excerpts",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf).name.removeprefix("sf"),
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
