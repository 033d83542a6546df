"""Benchmark of the headline queries.

Prints one JSON line.  Settings: BENCH_SF_DIR (default /root/testdata/sf0.1),
BENCH_CPUS (default: all), BENCH_REPEATS (default 2: the best run counts, so the
first one warms the JVM up).  The tables the queries read are built once, and
that time is reported under ``build_*``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from snapcat.registry import registered  # noqa: E402
from snapcat.session import build_session  # noqa: E402
from snapcat.warehouse import open_warehouse  # noqa: E402

TABLES = ("artists", "albums", "tracks", "dim_artist", "dim_album", "dim_track", "fact_artist_snapshot")
HEADLINE = (
    "silver_albums", "silver_tracks", "snapshot_base", "fact_artist_snapshot", "dim_track",
    "quality_gate", "dq_report", "dq_referential", "route_orphans_cascade", "incremental_merge",
    "mart_artist_activity", "mart_catalog_growth", "mart_release_seasonality", "mart_artist_momentum",
    "mart_artist_activity_latest", "mart_artist_momentum_latest",
    "q1_top_active", "q2_format_mix", "q3_growth_velocity", "q4_net_tracks_added", "q5_monthly_distribution",
    "q6_peak_month", "q7_momentum_leaderboard", "q8_momentum_delta",
    "explore_all_tracks", "duration_histogram", "explicit_ratio", "catalog_trends", "profile_snapshot",
    "presence_matrix", "metric_distribution", "warehouse_health",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = build_session(
        "snapcat-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=str(2 * cpus),
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    warehouse = open_warehouse(spark, sf_dir)
    seconds: dict[str, float] = {}

    def timed(name: str, run) -> None:
        start = time.perf_counter()
        run()
        took = round(time.perf_counter() - start, 3)
        seconds[name] = min(took, seconds.get(name, took))

    for table in TABLES:
        timed(f"build_{table}", lambda: warehouse.table(table))
    queries = registered()
    only = sys.argv[1:] or HEADLINE
    for name in only:
        for _ in range(repeats):
            timed(name, lambda: queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    print(
        json.dumps({
            "metric": "headline_queries_total",
            "value": round(sum(seconds.values()), 3),
            "unit": "sec",
            "queries": seconds,
            "sf": sf_dir.rstrip("/").rsplit("/sf", 1)[-1],
            "cpus": cpus,
            "repeats": repeats,
        })
    )
    spark.stop()


if __name__ == "__main__":
    main()
