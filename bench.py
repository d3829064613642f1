"""Times the headline queries: prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from climate_lake.plans.queries import queries  # noqa: E402
from climate_lake.session import get_session  # noqa: E402

HEADLINE = [
    "flatten_daily",
    "flatten_daily_export",
    "clean_observations",
    "latest_only",
    "integrate_stations",
    "integrate_stations_large",
    "recent_events",
    "enabled_thresholds",
    "etl_to_trends",
    "monthly_trends",
    "extreme_summary",
    "annual_summary",
    "features",
    "temperature_stats",
    "model_metrics",
    "climatology",
    "forecasts",
    "latest",
    "trends_all",
    "avg_temp_by_city",
    "total_extreme_events",
    "describe_observations",
    "box_stats",
    "histogram",
    "raw_structure_summary",
    "quality_score",
    "sink_partitioned",
    "lag_features",
    "lake_end_to_end",
    "rf_rmse",
    "landed_documents",
    "sink_csv",
    "sink_json",
    "table_counts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINE
    spark = get_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    available = queries()
    # One untimed run brings up code generation and the file system.
    available["monthly_trends"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in wanted:
        begin = time.perf_counter()
        available[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
