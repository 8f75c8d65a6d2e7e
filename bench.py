"""Time the registered queries; prints one JSON line.

Each query runs twice, writing to Spark's noop sink; the second time counts, so that
compilation and class loading do not. BENCH_SF_DIR, BENCH_CPUS and BENCH_QUERIES (names,
separated by commas) choose the tables, the cores and the queries.
"""

from __future__ import annotations

import json
import os
import time

from millrace.queries import QUERIES
from millrace.session import build_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))


def timed(spark, query) -> float:
    start = time.perf_counter()
    query(spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else list(QUERIES)
    spark = build_session("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    cold = {name: timed(spark, QUERIES[name]) for name in names}
    warm = {name: timed(spark, QUERIES[name]) for name in names}
    print(json.dumps({
        "metric": "seconds for all registered queries, second run",
        "value": round(sum(warm.values()), 3), "unit": "sec",
        "queries": {name: round(seconds, 3) for name, seconds in warm.items()},
        "cold": round(sum(cold.values()), 3),
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS), "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
