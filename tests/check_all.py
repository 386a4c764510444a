"""Run all (or the named) registered queries against their SQL and print a line each."""

from __future__ import annotations

import sys
import tempfile
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from compare import difference  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402


def main(sf_dir: str, names: list[str]) -> None:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, sql = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in names or sorted(sql):
        try:
            problem, took = difference(spark, sf_dir, name, queries[name], sql[name])
        except Exception:
            problem, took = traceback.format_exc()[-1500:], 0.0
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {took:.2f}s {problem}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
