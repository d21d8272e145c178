"""Times the headline queries and prints one JSON line.

Environment: ``BENCH_SF_DIR`` (tables), ``BENCH_CPUS`` (local cores),
``BENCH_QUERIES`` (names, comma-separated, or ``all``), ``BENCH_REPEAT`` (runs
per query, the fastest counts). Every result is computed in full into a sink
that discards it; a query that writes and reads files is timed including both.
"""

from __future__ import annotations

import json
import os
import sys
import time

from citysignal.catalog.queries import QUERIES
from citysignal.session import build_session

HEADLINE = (
    "decide",
    "traffic_score",
    "sliding_traffic",
    "target_top5",
    "vehicle_first_last",
    "combine_signals",
    "weather_score",
    "weather_at_decision",
    "weather_air_join",
    "forecast_latest",
    "upsert_latest",
    "parse_vehicles",
    "parse_weather",
    "parse_tweets",
    "quarantine_rows",
    "lexicon_sentiment",
    "sentiment_ratio",
    "filter_keywords",
    "filter_geo_radius",
    "search_top",
    "latest_state",
    "decision_distribution",
    "daily_show_rate",
    "summary_by_decision",
    "describe_scores",
    "score_histogram",
    "score_boxplot",
    "score_correlation",
    "hourly_pattern",
    "top10_scores",
    "top5_days",
    "stream_ingest",
    "stream_traffic",
    "stream_sliding_traffic",
)


def run(spark, name: str, sf_dir: str) -> float:
    begin = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    spark = build_session("bench", cores=cpus, shuffle_partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    # One run beforehand, so that starting the engine is not charged to a query.
    run(spark, "sentiment_ratio", sf_dir)
    seconds = {}
    for name in names:
        seconds[name] = round(min(run(spark, name, sf_dir) for _ in range(repeat)), 3)
        print(f"{name:28s}{seconds[name]:9.3f}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
