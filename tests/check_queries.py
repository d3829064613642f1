"""Compare every query with its SQL: ``python tests/check_queries.py [sf_dir] [query ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as contract  # noqa: E402
from climate_lake.session import get_session  # noqa: E402
from tests import compare  # noqa: E402


def main(sf_dir: str = "/root/testdata/sf0.01", *wanted: str) -> int:
    spark = get_session(
        "check", **{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                    "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracles, failures = compare.connect(sf_dir), contract.oracle_sql(), 0
    for name, query in contract.queries().items():
        if wanted and name not in wanted:
            continue
        begin = time.time()
        try:
            if name in oracles:
                problem = compare.difference(query(spark, sf_dir), connection, oracles[name])
            else:
                problem = None if query(spark, sf_dir).count() else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failures += problem is not None
        kind = "sql" if name in oracles else "rows"
        print(f"{'FAIL' if problem else 'ok':5}{kind:5}{time.time() - begin:6.1f}s  {name}  {problem or ''}", flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    sys.exit(min(main(*sys.argv[1:]), 1))
