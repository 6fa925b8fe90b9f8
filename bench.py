"""Time the registered queries and print one JSON line.

Batch queries: one warm-up and the median of three runs. Queries that run a
stream or write lake tables: one warm-up and one timed run. Each run builds its
DataFrame anew and writes all of it to the ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from lakeweir.queries import ALL, files, joins, streams, topics
from lakeweir.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
SINGLE_RUN = {
    q.name for q in (*files.QUERIES, *streams.QUERIES, *topics.QUERIES) if q.name != "parquet_scan"
}


def timed(spark, name: str) -> float:
    started = time.perf_counter()
    ALL[name].run(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    conf = {
        "spark.sql.shuffle.partitions": CPUS,
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    }
    spark = build_session("bench", conf, master=f"local[{CPUS}]")
    spark.sparkContext.setLogLevel("OFF")
    names = sys.argv[1:] or list(ALL)
    timed(spark, joins.QUERIES[0].name)  # start-up cost belongs to no query
    seconds = {}
    for name in names:
        timed(spark, name)
        runs = 1 if name in SINGLE_RUN else 3
        seconds[name] = round(statistics.median(timed(spark, name) for _ in range(runs)), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")),
            }
        )
    )


if __name__ == "__main__":
    main()
