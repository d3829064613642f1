"""Jobs for ``spark-submit``: ``__main__.py JOB LAKE [--as-of TIME] [--latest] [--all-stations] [--corrected]``."""

from __future__ import annotations

import argparse
from datetime import datetime

from climate_lake.plans import incremental, pipeline, report
from climate_lake.session import get_session, settings_for
from climate_lake.sinks import catalog
from climate_lake.sinks.tables import expire_versions
from climate_lake.sources.files import stored_bytes
from climate_lake.sources.tables import LakePaths

JOBS = ["etl", "analytics", "climatology", "all", "incremental", "expire", "catalog", "report"]


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="climate_lake", description="Run a job over a lake.")
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("lake", help="folder or URI with raw/, trusted/ and refined/")
    parser.add_argument("--as-of", type=datetime.fromisoformat, default=None, help="point in time, default now")
    parser.add_argument("--latest", action="store_true", help="newest row per city and day, newest snapshots")
    parser.add_argument("--all-stations", action="store_true", help="every snapshot of the stations")
    parser.add_argument("--input-bytes", type=int, default=None, help="bytes the job reads, default measured")
    parser.add_argument("--corrected", action="store_true", help="forecasts with real dates and year counts")
    parser.add_argument("--database", default="climate", help="catalog database")
    options = parser.parse_args(arguments)

    as_of = options.as_of or datetime.now()
    lake = LakePaths(options.lake)
    spark = get_session(f"climate_lake {options.job}")
    size = options.input_bytes
    if size is None:
        size = stored_bytes(spark, lake.raw, lake.zone("trusted"))
    for key, value in settings_for(size).items():
        spark.conf.set(key, value)
    if options.job == "etl":
        pipeline.run_etl(spark, lake, options.latest, options.all_stations)
    elif options.job == "analytics":
        pipeline.run_analytics(spark, lake)
    elif options.job == "climatology":
        pipeline.run_climatology(spark, lake, as_of, options.corrected)
    elif options.job == "all":
        steps = pipeline.run(
            spark, lake, as_of, options.latest, options.corrected, all_stations=options.all_stations
        )
        steps.show(truncate=False)
    elif options.job == "incremental":
        incremental.run(spark, lake, options.latest, options.all_stations).show(truncate=False)
    elif options.job == "expire":
        for name in incremental.stored_tables(spark, lake):
            expire_versions(spark, lake, name)
    elif options.job == "catalog":
        catalog.register_tables(spark, lake, options.database)
        catalog.repair_partitions(spark, lake, options.database)
    else:
        report.save_report(spark, lake, as_of.strftime("%Y%m%d_%H%M%S")).show(truncate=False)


if __name__ == "__main__":
    main()
