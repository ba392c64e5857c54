"""Time the headline queries and print one JSON line.

Every query is run to the end into a sink that discards the rows.  The match table is
written once before, so operators and jobs are timed rather than their fixture.  One
untimed run of the first query starts the JVM's compilers and the Python workers.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from matchlake.workloads import fixtures  # noqa: E402
from matchlake.workloads.registry import queries  # noqa: E402

HEADLINE = [
    "league_standings",
    "winpct_standings",
    "winpct_standings_ties",
    "home_form_summary",
    "home_avg_summary",
    "home_away_splits",
    "home_away_splits_avg",
    "team_form",
    "team_form_avg",
    "head_to_head",
    "team_season_totals",
    "pair_home_away",
    "dedupe_latest",
    "normalize_names",
    "silver_games",
    "silver_matches",
    "silver_player_totals",
    "split_score",
    "quality_profile",
    "check_unique",
    "page_links",
    "html_table",
    "html_all_tables",
    "medallion_refresh",
    "medallion_soccer",
    "incremental_refresh",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("matchlake-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()

    def run(key: str) -> float:
        start = time.perf_counter()
        registered[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    fixtures.store_matches(spark, sf_dir)
    run(HEADLINE[0])
    times = {key: run(key) for key in HEADLINE}
    scale = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
