"""Time the scheduled pipeline: first run, incremental run, no-new-data rerun.

Usage: python tools/pipeline_timing.py [sf_dir]  -> one JSON line.
Fetch 1 lands activities before 2000-01-01; fetch 2 re-fetches from
1999-10-01, so run 2 appends only what is newer than run 1's watermark.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from cairn.session import build_session

    scratch = tempfile.mkdtemp(prefix="cairn-pipe-")
    spark = build_session(extra={"spark.checkpoint.dir": scratch})
    from cairn.plans import pipeline
    from cairn.plans.lake import Lake
    from cairn.sources import landing

    paths = landing.write_landings(spark, sf_dir, f"{scratch}/landing")
    lake = Lake(spark, f"{scratch}/lake")
    out = {}
    for label, path, batch_id in (("first_run", paths[0], 1), ("incremental_run", paths[1], 2), ("no_new_data", paths[1], 3)):
        start = time.perf_counter()
        counts = pipeline.run(spark, lake, path, batch_id=batch_id)
        out[label] = {
            "sec": round(time.perf_counter() - start, 2),
            "new_bronze_rows": counts.get("bronze_activities", 0),
            "tables_written": len(counts),
        }
    print(json.dumps({"sf_dir": sf_dir, **out}))
    spark.stop()


if __name__ == "__main__":
    main()
