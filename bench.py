"""Benchmark: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

The given tables are files of one row group, which Spark reads in one task however
many cores there are. So they are landed first, untimed, as many files, the way a
feed lands them, and the queries (``queries``) are timed over those. The same
queries over the given files, once each, stand beside them (``given_files``).

Every query runs once to warm up (JIT, file metadata) before any is timed, then
each runs $BENCH_REPEAT times; the median wall time is reported. Results are fully
computed and discarded through the ``noop`` sink, so the timing covers the whole
plan (scan to last row), not a collect. Prints ONE JSON line on stdout.
"""

from __future__ import annotations

import glob
import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from tidewater.queries import QUERIES
    from tidewater.session import get_session

    spark = get_session(f"local[{cpus}]", app_name="tidewater-bench", shuffle_partitions=2 * cpus)
    spark.sparkContext.setLogLevel("ERROR")

    def timed(fn, folder: str) -> float:
        t0 = time.perf_counter()
        fn(spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    landed = tempfile.mkdtemp(prefix="run-bench-", dir="/tmp")
    for path in sorted(glob.glob(f"{sf_dir.rstrip('/')}/*.parquet")):
        files = 2 * cpus if os.path.getsize(path) > (1 << 20) else 1
        spark.read.parquet(path).repartition(files).write.parquet(f"{landed}/{os.path.basename(path)}")

    names = only or list(QUERIES)
    for name in names:  # warm-up pass over all queries
        timed(QUERIES[name], landed)
    timings: dict[str, float] = {}
    given: dict[str, float] = {}
    for name in names:
        timings[name] = round(statistics.median(timed(QUERIES[name], landed) for _ in range(repeat)), 4)
        given[name] = round(timed(QUERIES[name], sf_dir), 4)
        print(f"{name}: {timings[name]:.3f}s ({given[name]:.3f}s over the given files)", file=sys.stderr)

    match = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(match.group(1)) if match else None
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_seconds",
                "value": round(sum(timings.values()), 4),
                "unit": "sec",
                "queries": timings,
                "given_files": given,
                "sf": sf,
                "cpus": cpus,
                "repeat": repeat,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
