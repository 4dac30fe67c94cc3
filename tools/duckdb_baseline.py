"""Single-node baseline: the oracle SQL of the bench's headline queries on
DuckDB (the engine the reference hands all its SQL to), same data, same
machine. Each query is materialised into a temporary table (as the
reference's CREATE TABLE ... AS does); median of 3 after one warm-up.
Usage: python tools/duckdb_baseline.py [sf_dir]  -> JSON line on stdout.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from bench import HEADLINE  # noqa: E402
from compare import duck  # noqa: E402
from oracle.duckdb_sql import queries  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    con = duck(sf_dir)
    sql = queries()

    def once(name: str) -> float:
        start = time.perf_counter()
        con.execute(f"CREATE OR REPLACE TEMP TABLE bench_out AS {sql[name]}")
        return time.perf_counter() - start

    for name in HEADLINE:
        once(name)
    timings = {n: round(statistics.median(once(n) for _ in range(3)), 3) for n in HEADLINE}
    print(json.dumps({"engine": "duckdb", "threads": os.cpu_count(), "sf_dir": sf_dir,
                      "total": round(sum(timings.values()), 3), "queries": timings}))


if __name__ == "__main__":
    main()
