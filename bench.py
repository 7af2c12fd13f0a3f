"""Benchmark: one JSON line.

BENCH_SF_DIR   input folder (default /root/testdata/sf0.1)
BENCH_CPUS     cores (default all)
BENCH_RUNS     warm runs per headline query, of which the median counts (default 3)
BENCH_COPIES   if set, also time the signals on that many copies of the transactions
BENCH_ALL      if set, also time every other query once

``full_pipeline`` goes from the raw table to all written outputs (profile, clean, flagged and star
tables, each as parquet and CSV). The other headline queries start from the raw events in every
run, too: the stages they share are forgotten in between.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F

from auditloom.plans import workspace as ws
from auditloom.plans.catalogue import QUERIES
from auditloom.plans.pipeline import flag_raw, pipeline_summary, run_full_pipeline
from auditloom.session import build_session
from auditloom.sources.events import load_transactions
from auditloom.storage import new_path, spread_small, staged

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

FRESH = ["suspicious_transactions", "pipeline_summary", "pipeline_summary_with_forest"]
STAGED = [
    "clean_transactions_view", "column_profile", "flag_duplicate", "flag_large_transaction",
    "flag_unusual_timing", "flag_vendor_spike", "flag_velocity", "flag_concentration", "dim_vendor",
    "daily_audit_trend", "category_risk_breakdown", "top_suspicious_vendors", "kpi_cards",
    "threshold_sweep", "stratified_sample"]


def consume(df):
    df.write.format("noop").mode("overwrite").save()


def timed(job):
    started = time.time()
    job()
    return time.time() - started


def median_of(job, warm_up=1):
    for _ in range(warm_up):
        job()
    return round(statistics.median(timed(job) for _ in range(RUNS)), 3)


def fresh(spark, name):
    ws.reset()
    consume(QUERIES[name](spark, FOLDER))


def copies(spark, n):
    """The transactions n times over, each copy with its own users and the same vendors."""
    txn = load_transactions(spark, FOLDER)
    copy = F.col("copy")
    return staged(
        txn.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
        .withColumn("row_id", F.col("row_id") + copy * F.lit(100_000_000_000))
        .withColumn("nameOrig", F.concat_ws("-", "nameOrig", copy)).drop("copy").repartition(CPUS * 4, "row_id"))


def main():
    spark = build_session(
        f"local[{CPUS}]", CPUS, **{"spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    raw = staged(spread_small(load_transactions(spark, FOLDER)), "raw")
    rows = raw.count()
    times = {"full_pipeline": median_of(lambda: run_full_pipeline(raw, new_path(spark, "out")), 2)}
    for name in FRESH:
        times[name] = median_of(lambda: fresh(spark, name))
    for name in STAGED:
        times[name] = median_of(lambda: consume(QUERIES[name](spark, FOLDER)))
    if os.environ.get("BENCH_ALL"):
        for name in sorted(set(QUERIES) - set(times)):
            times[name] = round(timed(lambda: consume(QUERIES[name](spark, FOLDER))), 3)
    result = {
        "metric": "full pipeline, raw table to all written outputs, median of warm runs",
        "value": times["full_pipeline"], "unit": "sec", "queries": times,
        "sf": os.path.basename(FOLDER.rstrip("/")), "rows": rows,
        "rows_per_sec": round(rows / times["full_pipeline"]), "cpus": CPUS, "spark": spark.version}
    if os.environ.get("BENCH_COPIES"):
        n = int(os.environ["BENCH_COPIES"])
        large = copies(spark, n)
        started = time.time()
        summary = pipeline_summary(staged(flag_raw(large), "flagged")).first().asDict()
        seconds = time.time() - started
        result["scaled"] = {
            "copies": n, "seconds": round(seconds, 1), "rows_per_sec": round(rows * n / seconds), **summary}
    print(json.dumps(result))


if __name__ == "__main__":
    main()
