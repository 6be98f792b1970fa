"""Run every registered query against its SQL: ``python tests/check_all.py sf_dir [key...]``."""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                os.path.dirname(os.path.abspath(__file__))]

import oracle  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402


def main(sf_dir, keys):
    scratch = tempfile.mkdtemp(prefix="tidemark-check-")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle.connect(sf_dir)
    sqls, bad, times = entry.oracle_sql(), 0, []
    for key, build in entry.queries().items():
        if keys and key not in keys:
            continue
        start = time.time()
        try:
            if key in sqls:
                problem, rows = oracle.compare(con, build(spark, sf_dir), sqls[key])
            else:
                problem, rows = None, build(spark, sf_dir).count()
        except Exception as exc:  # noqa: BLE001
            problem, rows = f"{type(exc).__name__}: {str(exc)[:700]}", -1
        took = time.time() - start
        times.append((took, key))
        bad += problem is not None
        state = "FAIL" if problem else ("ok" if key in sqls else "rows")
        print(f"\n{state:5}{key:42}{rows:9}{took:7.2f}s  {problem or ''}", flush=True)
    print(f"{len(times)} queries, {bad} bad, {sum(t for t, _ in times):.1f}s")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], set(sys.argv[2:])) else 0)
