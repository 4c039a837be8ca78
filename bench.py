"""Benchmark: the three jobs (daily, detail, summary ACTUAL and ESTIMATED) end to end.

Reads ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and
prints one JSON line. After one untimed warm-up run of every job, each job is built fresh and runs whole:
scalars, stages, the month's replacement in a target dataset and its statistics.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from costloom.session import build_session
    from costloom.plans import queries as Q

    spark = build_session(app="costloom-bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    from pyspark.sql import functions as F

    from costloom.plans.daily import DailyJob
    from costloom.plans.detail import DetailJob
    from costloom.plans.summary import SummaryJob
    from costloom.session import stage_root
    from costloom.sources import fixture_defs as FX
    from costloom.sources.catalog import DictCatalog

    fx = Q.fixture_catalog(spark, sf_dir)
    # Every line item is a transaction of the detail month (the estimated table, four weeks
    # earlier), so detail and ACTUAL work on all rows as ESTIMATED does. The inputs are written as
    # Parquet before any clock runs, as jobs find them; the bill by month.
    estimated = fx.usage_transaction_estimated
    inputs = {"usage_transaction": estimated.withColumn("usage_start_date", F.expr("usage_start_date - INTERVAL 28 DAYS")),
              "usage_transaction_estimated": estimated, "cost_usage_report": fx.cost_usage_report,
              "resource_user": fx.resource_user, "resource_user_estimated": fx.resource_user_estimated, "resource_tag": fx.resource_tag}
    root = f"{stage_root(spark)}/bench-{os.getpid()}"
    for name, df in inputs.items():
        out = df.repartition(int(cpus)).write
        (out.partitionBy("invoice_month") if name == "cost_usage_report" else out).parquet(f"{root}/in/{name}")

    def catalog():
        return DictCatalog(spark, {n: spark.read.parquet(f"{root}/in/{n}") for n in inputs}, fallback=fx)

    jobs = {
        "run1_daily": lambda: DailyJob(catalog(), FX.DAILY_MONTH),
        "run2_detail": lambda: DetailJob(catalog(), FX.DETAIL_MONTH),
        "run3_actual": lambda: SummaryJob(catalog(), "ACTUAL", FX.DETAIL_MONTH),
        "run3_estimated": lambda: SummaryJob(catalog(), "ESTIMATED"),
    }
    target = f"{root}/out"
    # warm-up: one untimed run of every job (JVM JIT, parquet footers, codegen caches)
    for name, build in jobs.items():
        build().run(f"{target}-{name}")

    times, rows = {}, {}
    for name, build in jobs.items():
        t0 = time.perf_counter()
        rows[name] = build().run(f"{target}-{name}")["row_count"]
        times[name] = round(time.perf_counter() - t0, 3)
    read = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in ("events", "lineitem")}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "job_seconds_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "rows_written": rows, "rows_of_inputs": read, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
