"""Kill an executor in the middle of queries and check their results.

Usage: python tests/executor_loss_check.py [sf_dir] [name ...]

Runs on a local cluster of separate executor processes. For each query, a
timer kills one executor process (found by asking the executors for their
own process ids) while the query runs; the result must still equal the
DuckDB oracle. Not part of the pytest run: it starts its own cluster.
"""

from __future__ import annotations

import os
import signal
import sys
import threading
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
for p in (ROOT, ROOT / "tests"):
    if str(p) not in sys.path:
        sys.path.insert(0, str(p))


def executor_pids(spark) -> list[int]:
    """Process ids of the executor JVMs (parents of their Python workers' daemon)."""

    def jvm_pid(_):
        daemon = os.getppid()
        with open(f"/proc/{daemon}/stat") as f:
            yield int(f.read().split()[3])

    return sorted(set(spark.sparkContext.parallelize(range(64), 16).mapPartitions(jvm_pid).collect()))


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    from oracle_compare import compare, duckdb_connection

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or ["word_count", "grid_hour_peak_records", "rank_grids_daily", "country_categories"]
    spark = (
        SparkSession.builder.master("local-cluster[3,2,2048]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "12")
        .config("spark.task.maxFailures", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con = duckdb_connection(sf_dir)
    failures = 0
    for name in names:
        victims = executor_pids(spark)
        killer = threading.Timer(1.5, lambda pid=victims[0]: os.kill(pid, signal.SIGKILL))
        killer.start()
        r = compare(spark, con, name, sf_dir)
        killer.cancel()
        ok = r["values_match"] and r["columns_match"] and r["rows"] == r["oracle_rows"]
        failures += not ok
        print(("OK  " if ok else "FAIL") + f" {name}: killed executor pid {victims[0]} of {victims}; rows {r['rows']}", flush=True)
    spark.stop()
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
