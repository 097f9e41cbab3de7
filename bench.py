"""Time the headline queries and print one line of JSON."""

import json
import os
import statistics
import time

from ludolens import checks
from ludolens.session import local_session

HEADLINE = [
    "parse_price",
    "price_to_usd",
    "price_to_usd_udf",
    "release_year",
    "year_prefix_avg",
    "clean_games",
    "keep_last",
    "upsert_keep_last",
    "catalogue_upsert",
    "only_new_ids",
    "cache_split",
    "row_index",
    "assign_batches",
    "cap_by_bytes",
    "json_size",
    "flatten_details",
    "avg_price_by_genre_set",
    "avg_price_by_genre",
    "rank_genres",
    "rank_developers_global",
    "top_developers",
    "outlier_bounds",
    "outlier_bounds_nearest",
    "flag_outliers",
    "ols_price",
    "predict_prices",
    "plan_fetch",
    "ingest_details",
    "run_daily",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    all_queries = checks.queries()
    seconds = {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        runs = []
        for _ in range(repeats + 1):
            start = time.perf_counter()
            all_queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        # The first run warms up code generation and is not counted.
        seconds[name] = round(statistics.median(runs[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
