"""Headline queries on local[$BENCH_CPUS] at $BENCH_SF_DIR; prints one JSON line.

Every operator query is run once to warm up and then timed; the two jobs are timed on their first run. What a job
starts from (the table snapshot, the dropped files) is written before the clock starts.
"""

from __future__ import annotations

import json
import os
import re
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from refsync.config import SyncSettings, TableSpec
from refsync.operators import clean
from refsync.plans import jobs
from refsync.plans import sample_tables as t
from refsync.plans.queries import QUERIES
from refsync.sources import snapshots, storage

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

OPERATORS = [
    "latest_wins",
    "gate_stale",
    "upsert",
    "field_changes",
    "duplicate_keys",
    "per_file_summary",
    "run_checks",
    "suppress_mirrors",
    "collapse_candidates",
    "vendor_list",
    "flag_duplicates",
    "highest_unit_price",
]


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(work: Callable[[], object]) -> float:
    started = time.perf_counter()
    work()
    return time.perf_counter() - started


def prepare_sync(spark: SparkSession) -> tuple[str, str]:
    """Table snapshot and dropped increment files (CSV), in eight files each."""
    spec = TableSpec()
    start = clean.enforce_schema(t.contract_rows(spark, SF_DIR), spec.types).repartition(8)
    root, folder = storage.new_path(spark, "bench-table"), storage.new_path(spark, "bench-drop")
    snapshots.write_snapshot(clean.exclude_values(start, spec.account, spec.excluded_accounts), root)
    rows = t.contract_increments(spark, SF_DIR).drop("source_file")
    rows.repartition(8).write.option("header", "true").csv(folder)
    return root, folder


def sync_job(spark: SparkSession, root: str, folder: str) -> jobs.SyncResult:
    settings = SyncSettings(increment_glob="*.csv", full_glob="full*", max_files=None)
    return jobs.sync(spark, folder, root, storage.new_path(spark, "bench-audit"), settings=settings)


def integrate_job(spark: SparkSession, table: DataFrame, daily: DataFrame) -> None:
    result = jobs.integrate(daily, table, t.manufacturer_map(spark, SF_DIR), t.vendor_map(spark, SF_DIR))
    jobs.classify(result).write.partitionBy("Bucket").parquet(storage.new_path(spark, "bench-export"))


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("refsync-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="refsync-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    only = os.environ.get("BENCH_ONLY", "").split()
    for name in OPERATORS:
        if only and name not in only:
            continue
        run(QUERIES[name](spark, SF_DIR))
        times[name] = timed(lambda: run(QUERIES[name](spark, SF_DIR)))

    lines = t.load(spark, SF_DIR, "lineitem").count()
    if not only or "sync_job" in only:
        started_from = prepare_sync(spark)
        done: list[jobs.SyncResult] = []
        times["sync_job"] = timed(lambda: done.append(sync_job(spark, *started_from)))
        accepted = sum(done[-1].counts.get(status, 0) for status in ("new", "updated", "unchanged"))
    if not only or "integrate_job" in only:
        spec = TableSpec()
        table = storage.stage(clean.enforce_schema(t.contract_rows(spark, SF_DIR), spec.types), "bench-contract")
        daily = storage.stage(t.daily_rows(spark, SF_DIR), "bench-daily")
        times["integrate_job"] = timed(lambda: integrate_job(spark, table, daily))

    scale = re.search(r"sf([0-9.]+)", SF_DIR)
    result = {
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {name: round(seconds, 3) for name, seconds in times.items()},
        "sf": float(scale.group(1)) if scale else None,
        "lineitem_rows": lines,
    }
    if "sync_job" in times:
        result["sync_rows_per_sec"] = round(lines / times["sync_job"])
        result["sync_accepted_rows_per_sec"] = round(accepted / times["sync_job"])
    print(json.dumps(result))


if __name__ == "__main__":
    main()
