"""The incremental trigger reruns the daily job for the months a batch of dropped files touched."""

from __future__ import annotations

import os

from conftest import SF001
from costloom.plans.sink import read_target
from costloom.plans.daily import DailyJob
from costloom.sources import fixture_defs as FX
from costloom.sources.catalog import DictCatalog, FixtureCatalog
from costloom.streaming.drops import watch_bill_drops


def test_drops_trigger_month_rerun(spark, scratch):
    fx = FixtureCatalog(spark, SF001)
    drops = os.path.join(scratch, "drops")
    fx.cost_usage_report.write.partitionBy("invoice_month").parquet(drops)
    bill = spark.read.parquet(drops)
    cat = DictCatalog(spark, {"cost_usage_report": bill}, fallback=fx)
    target = os.path.join(scratch, "daily")
    q = watch_bill_drops(spark, drops, bill.schema, lambda m: cat, target, os.path.join(scratch, "ckpt"))
    q.awaitTermination(600)
    written = read_target(spark, target)
    assert {r.invoice_month for r in written.select("invoice_month").distinct().collect()} == {FX.DAILY_MONTH}
    assert written.count() == DailyJob(cat, FX.DAILY_MONTH).output().count()
    # a second trigger with no new files does nothing and leaves the month as it was
    n = written.count()
    q2 = watch_bill_drops(spark, drops, bill.schema, lambda m: cat, target, os.path.join(scratch, "ckpt"))
    q2.awaitTermination(600)
    assert read_target(spark, target).count() == n
