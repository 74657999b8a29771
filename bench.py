"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores. Every query is computed in full
into a sink that discards rows: once to warm up, then BENCH_RUNS times, of which the fastest counts.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import SparkSession

from daybook.catalogue import catalogue

HEADLINE = (
    "fact_balance_loan",
    "fact_balance_sub",
    "fact_balance_subaccount",
    "fact_ordered",
    "last_txn_per_day",
    "forward_fill_balance",
    "running_max_balance",
    "ledger_last_known",
    "ledger_largest",
    "audit_fact",
    "constraint_audit",
    "reconcile_dims",
    "reconcile_fact",
    "dim_member",
    "dim_subaccount",
    "bridge_member_account",
    "upsert_by_key",
    "insert_if_absent",
    "latest_change",
    "check_primary_key",
    "check_foreign_key_composite",
    "ingest_select",
    "dictionary_attrs",
)


def seconds(query, spark: SparkSession, folder: str) -> float:
    started = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("daybook-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalogue()
    times = {}
    for name in HEADLINE:
        seconds(queries[name], spark, folder)
        times[name] = round(min(seconds(queries[name], spark, folder) for _ in range(runs)), 3)
    spark.stop()
    scale = re.search(r"sf([\d.]+)/?$", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
