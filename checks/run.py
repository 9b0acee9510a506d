"""Compare registered queries with their SQL: ``python -m checks.run <sf_dir> [name prefix ...]``."""

from __future__ import annotations

import sys
import time

import checks.primitives  # noqa: F401  (registers its queries)
from checks.catalog import ORACLE, QUERIES
from checks.compare import connect, differences
from postlens.sources import build_session


def main(sf_dir: str, prefixes: list[str]) -> int:
    spark = build_session("checks", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name, run in QUERIES.items():
        if prefixes and not name.startswith(tuple(prefixes)):
            continue
        start = time.perf_counter()
        rows, found = differences(run(spark, sf_dir), con, ORACLE[name])
        failed += bool(found)
        print(f"{name}: {rows} rows, {time.perf_counter() - start:.1f} s, {'same' if not found else found}", flush=True)
    print(f"{failed} differ")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
