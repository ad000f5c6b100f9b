"""Time registered queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

``python bench.py [name ...]`` times only the named queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

from homeload.queries import QUERIES
from homeload.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def seconds(spark, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main(names: list[str]) -> None:
    spark = local_session("bench", CPUS)
    for table in ("orders", "events", "customer"):  # start executors and the Parquet reader before the clock
        spark.read.parquet(f"{SF_DIR}/{table}.parquet").write.format("noop").mode("overwrite").save()
    times = {name: round(seconds(spark, name), 3) for name in names or QUERIES}
    print(
        json.dumps(
            {
                "metric": "all registered queries", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv[1:])
