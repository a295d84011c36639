"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the number of cores.
Every query is computed whole: its result is aggregated to one row.
"""

import json
import os
import re
import time

from pyspark.sql import DataFrame, functions as F

from pathkin.session import local_session
from pathkin.workload.queries import QUERIES

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))
HEADLINE = os.environ.get("BENCH_QUERIES", "").split() or [
    "ngram_tokens",
    "triple_counts",
    "mutual_information_text",
    "mutual_information",
    "feature_pairs",
    "path_similarity",
    "discover_rules",
    "score_gold",
    "pr_curve",
    "error_samples",
]


def run(df: DataFrame) -> None:
    """Compute every row and column without bringing them to the driver."""
    df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*df.columns))).collect()


def main() -> None:
    spark = local_session(CPUS, "pathkin-bench")
    spark.sparkContext.setLogLevel("ERROR")
    run(spark.range(1000).groupBy("id").count())
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        run(QUERIES[name](spark, FOLDER))
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([0-9.]+)", FOLDER)
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else FOLDER,
            }
        )
    )


if __name__ == "__main__":
    main()
