"""What a run reads, reports and refuses: one pass, no driver actions while planning, gates."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from conftest import SF001
from costloom.checks.gates import BrokenInvariant
from costloom.plans.daily import DailyJob
from costloom.plans.detail import DetailJob
from costloom.plans.sink import read_target
from costloom.plans.summary import SummaryJob
from costloom.sources import fixture_defs as FX
from costloom.sources.catalog import DictCatalog, FixtureCatalog

JOBS = {
    "daily": lambda c: DailyJob(c, FX.DAILY_MONTH),
    "detail": lambda c: DetailJob(c, FX.DETAIL_MONTH),
    "actual": lambda c: SummaryJob(c, "ACTUAL", FX.DETAIL_MONTH),
    "estimated": lambda c: SummaryJob(c, "ESTIMATED"),
}
SOURCES = {"daily": "cost_usage_report", "detail": "usage_transaction", "actual": "usage_transaction", "estimated": "usage_transaction_estimated"}


@pytest.mark.parametrize("name", JOBS)
def test_planning_runs_no_action_but_stages(spark, monkeypatch, name):
    def refuse(self, *a, **k):
        raise AssertionError("an action while the plan is built")

    job = JOBS[name](FixtureCatalog(spark, SF001))
    for action in ("collect", "first", "head", "take", "count", "isEmpty", "toPandas", "toLocalIterator"):
        monkeypatch.setattr(DataFrame, action, refuse)
    out = job.output()
    assert not out.isStreaming and job.stages
    monkeypatch.undo()
    job._release()


@pytest.mark.parametrize("name", JOBS)
def test_a_run_reads_its_flow_once(spark, scratch, monkeypatch, name):
    """Of all a run executes, one plan reads the source's cost columns; the scalars read a few others."""
    fx = FixtureCatalog(spark, SF001)
    path = os.path.join(scratch, "source")
    getattr(fx, SOURCES[name]).write.parquet(path)
    cat = DictCatalog(spark, {SOURCES[name]: spark.read.parquet(path)}, fallback=fx)
    plans = []

    def watched(cls, method, frame):
        real = getattr(cls, method)

        def call(self, *a, **k):
            plans.append(frame(self)._jdf.queryExecution().optimizedPlan().toString())
            return real(self, *a, **k)
        monkeypatch.setattr(cls, method, call)

    for method in ("collect", "first", "count", "isEmpty"):
        watched(DataFrame, method, lambda df: df)
    for method in ("parquet", "save"):
        watched(DataFrameWriter, method, lambda w: w._df)
    status = JOBS[name](cat).run(os.path.join(scratch, "out"))
    monkeypatch.undo()
    column = "line_item_usage_amount" if name == "daily" else "usage_quantity"
    source = [p for p in plans if any("Relation" in x and column in x for x in p.splitlines())]
    flow = [p for p in source if any(column in x and "Relation" not in x for x in p.splitlines())]      # it is read, not only there
    assert status["row_count"] > 0 and len(flow) == 1 and len(source) == 2
    assert sum("Relation" in x and column in x for x in flow[0].splitlines()) == 1


@pytest.mark.parametrize("name", JOBS)
def test_reports_carry_rows_sizes_and_companies_by_account(spark, scratch, name):
    target = os.path.join(scratch, "out")
    job = JOBS[name](FixtureCatalog(spark, SF001))
    sizes = sorted(r[0] for r in (job.unmapped_spot().collect() if name != "detail" else []))
    status = JOBS[name](FixtureCatalog(spark, SF001)).run(target)
    assert status["error"] == "" and status["row_count"] == read_target(spark, target).count() > 0
    assert status["created_date"] is not None
    assert status["adhoc_companies"] == {FX.HOSTING: "Client A,Client B,Client C", FX.PROD: "Client D"}
    assert status["unmapped_spot_sizes"] and (name == "detail" or status["unmapped_spot_sizes"] == sizes)
    dry = JOBS[name](FixtureCatalog(spark, SF001)).run()
    assert dry["row_count"] == status["row_count"] and dry["unmapped_spot_sizes"] == status["unmapped_spot_sizes"]


@pytest.mark.parametrize("name", JOBS)
def test_an_empty_month_then_data_on_one_object(spark, scratch, name):
    fx = FixtureCatalog(spark, SF001)
    whole = getattr(fx, SOURCES[name])
    cat = DictCatalog(spark, {SOURCES[name]: whole.where("1 = 0")}, fallback=fx)
    job, target = JOBS[name](cat), os.path.join(scratch, "out")
    status = job.run(target)
    assert status["row_count"] == 0 and status["error"] and not os.path.exists(target)
    cat.tables[SOURCES[name]] = whole
    assert job.run(target)["row_count"] > 0 and job.stages == []


def test_runs_without_a_month_over_empty_tables(spark, scratch):
    fx = FixtureCatalog(spark, SF001)
    cat = DictCatalog(spark, {"usage_transaction": fx.usage_transaction.where("1 = 0")}, fallback=fx)
    for job in (DetailJob(cat, None), SummaryJob(cat, "ACTUAL")):
        status = job.run(os.path.join(scratch, "out"))
        assert status["row_count"] == 0 and status["invoice_month"] is None and "No transactions" in status["error"]


@pytest.mark.parametrize("name", JOBS)
def test_a_corrupted_weight_leaves_the_month(spark, scratch, monkeypatch, name):
    target = os.path.join(scratch, "out")
    cat = FixtureCatalog(spark, SF001)
    before = JOBS[name](cat).run(target)
    job = JOBS[name](cat)
    real, column = type(job).infra_weights, "retail_weight" if name == "daily" else "weight"
    monkeypatch.setattr(type(job), "infra_weights", lambda self: real(self).withColumn(column, (F.col(column) * F.lit(1.01)).cast("decimal(38,16)")))
    with pytest.raises(BrokenInvariant, match="infra weights"):
        job.run(target)
    assert job.stages == [] and read_target(spark, target).count() == before["row_count"]


def test_uneven_weighted_cost_and_off_hours_weights_are_refused(spark, scratch, monkeypatch):
    from costloom.operators import adhoc, rollup
    cat, target = FixtureCatalog(spark, SF001), os.path.join(scratch, "out")
    real = rollup.weight_actual_cost
    monkeypatch.setattr(rollup, "weight_actual_cost", lambda *a: real(*a).withColumn("weighted_actual_cost", (F.col("weighted_actual_cost") + 1).cast("decimal(38,8)")))
    with pytest.raises(BrokenInvariant, match="weighted actual cost"):
        SummaryJob(cat, "ACTUAL", FX.DETAIL_MONTH).run(target)
    monkeypatch.undo()
    weights = adhoc.adhoc_weights
    monkeypatch.setattr(adhoc, "adhoc_weights", lambda *a: weights(*a).withColumn("weight", (F.col("weight") / 2).cast("decimal(18,16)")))
    with pytest.raises(BrokenInvariant, match="off-hours"):
        DailyJob(cat, FX.DAILY_MONTH, adhoc_scope="account").run(target)
    assert not os.path.exists(os.path.join(target, "_months"))


def test_estimated_transactions_of_two_months_raise(spark, scratch):
    fx = FixtureCatalog(spark, SF001)
    two = fx.usage_transaction_estimated
    two = two.unionByName(two.limit(3).withColumn("usage_start_date", F.expr("usage_start_date + INTERVAL 40 DAYS")))
    with pytest.raises(Exception, match="more than one invoice month"):
        SummaryJob(DictCatalog(spark, {"usage_transaction_estimated": two}, fallback=fx), "ESTIMATED").run(os.path.join(scratch, "out"))
