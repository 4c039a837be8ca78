"""Job-level behaviour: month replacement, stats, production catalog plans, oracle parity."""

from __future__ import annotations

import os

import pytest

from conftest import SF001
from costloom.plans.daily import DailyJob, daily_stats_only
from costloom.plans.detail import DetailJob
from costloom.plans.sink import read_target, replace_month
from costloom.plans.stats import month_stats
from costloom.plans.summary import SummaryJob
from costloom.sources import fixture_defs as FX
from costloom.sources.catalog import DictCatalog, FixtureCatalog, ParquetCatalog


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["invoice_month", "bill_billing_entity", "line_item_usage_account_id"]
    assert len(df.columns) == 28


def test_daily_run_replaces_month_and_reports_stats(spark, scratch):
    target = os.path.join(scratch, "daily")
    job = DailyJob(FixtureCatalog(spark, SF001), FX.DAILY_MONTH)
    first = job.run(target)
    n = job.output().count()
    assert first["row_count"] == n and first["is_invoiced"] == 0 and first["trx_source"] == "ESTIMATED"
    again = DailyJob(FixtureCatalog(spark, SF001), FX.DAILY_MONTH).run(target)
    assert again["row_count"] == n                                   # rerun replaces, never appends
    assert daily_stats_only(spark, target, FX.DAILY_MONTH)["row_count"] == n
    assert read_target(spark, target).where("invoice_month = 202401").count() == n


def test_empty_rerun_empties_the_month(spark, scratch):
    target = os.path.join(scratch, "t")
    import datetime as dt
    now = dt.datetime(2024, 3, 1)
    df = spark.createDataFrame([(202401, "INV1", 1, now)],
                               "invoice_month INT, bill_invoice_id STRING, x INT, t_created_date TIMESTAMP_NTZ")
    replace_month(df, target, 202401)
    replace_month(spark.createDataFrame([(202402, "", 2, now)], df.schema), target, 202402)
    assert month_stats(spark, target, 202401, "bill_invoice_id")["row_count"] == 1
    replace_month(df.limit(0), target, 202401)
    assert month_stats(spark, target, 202401, "bill_invoice_id")["row_count"] == 0
    assert month_stats(spark, target, 202402, "bill_invoice_id")["row_count"] == 1


def test_empty_month_aborts_before_the_target(spark, scratch):
    cat = FixtureCatalog(spark, SF001)
    status = DailyJob(cat, 203001).run(os.path.join(scratch, "never"))
    assert status["row_count"] == 0 and status["error"]
    assert not os.path.exists(os.path.join(scratch, "never"))


def test_detail_and_summary_runs_write_their_month(spark, scratch):
    cat = FixtureCatalog(spark, SF001)
    d = DetailJob(cat, FX.DETAIL_MONTH).run(os.path.join(scratch, "detail"))
    s = SummaryJob(cat, "ACTUAL", FX.DETAIL_MONTH).run(os.path.join(scratch, "summary"))
    e = SummaryJob(cat, "ESTIMATED").run(os.path.join(scratch, "summary"))
    assert d["row_count"] > 0 and s["row_count"] > 0 and e["row_count"] > 0
    months = {r.invoice_month for r in read_target(spark, os.path.join(scratch, "summary")).select("invoice_month").distinct().collect()}
    assert months == {FX.DETAIL_MONTH, FX.ESTIMATED_MONTH}


def test_production_catalog_prunes_and_pushes_down(spark, scratch):
    """On Parquet inputs the month reaches the scan: a partition filter on the bill, a
    pushed range filter on the transactions, and only the needed columns are read."""
    fx = FixtureCatalog(spark, SF001)
    root = os.path.join(scratch, "warehouse")
    fx.cost_usage_report.write.partitionBy("invoice_month").parquet(f"{root}/cost_usage_report")
    fx.usage_transaction.write.parquet(f"{root}/usage_transaction")
    given = {n: fx.table(n) for n in (*FX.CONFIG_TABLES, "resource_user", "resource_tag")}
    cfg = DictCatalog(spark, given, fallback=ParquetCatalog(spark, root))
    hourly = DailyJob(cfg, FX.DAILY_MONTH, checkpoint=False).hourly
    plan = hourly._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(invoice_month" in plan and "(invoice_month#" in plan
    assert "PushedFilters: [IsNotNull(line_item_usage_account_id)" in plan or "PushedFilters" in plan
    from costloom.operators.normalize import transactions_for_month
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    scan = transactions_for_month(cfg.usage_transaction, FX.DETAIL_MONTH).select("usage_start_date", "unblended_cost")
    det_plan = scan._jdf.queryExecution().executedPlan().toString().replace(" ", "")
    assert "GreaterThanOrEqual(usage_start_date,1998-01-01T00:00)" in det_plan
    assert "LessThan(usage_start_date,1998-02-01T00:00)" in det_plan
    assert "ReadSchema:struct<usage_start_date:timestamp_ntz,unblended_cost:decimal(28,12)>" in det_plan


def _oracle_names():
    from costloom.plans.queries import registry
    return sorted(n for n, spec in registry().items() if spec.oracle is not None)


@pytest.mark.parametrize("name", _oracle_names())
def test_oracle_parity_sf0001(spark, duck, name):
    import __spark_entry__ as E
    from tools.check_oracle import digest
    sdf = E.queries()[name](spark, SF001)
    s_rows = [r.asDict() for r in sdf.collect()]
    cols = sorted(sdf.columns)
    rel = duck.execute(E.oracle_sql()[name])
    d_cols = [d[0] for d in rel.description]
    d_rows = [dict(zip(d_cols, r)) for r in rel.fetchall()]
    assert cols == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(s_rows, cols)[0] == digest(d_rows, cols)[0]


def test_results_do_not_depend_on_session_time_zone(spark, duck):
    """Month bounds, cut times and UTC+7 slots are wall-clock (timestamp_ntz) values."""
    import __spark_entry__ as E
    from tools.check_oracle import digest
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        for name in ("cut1_future_fee", "nrm2_normalize", "run3_estimated"):
            sdf = E.queries()[name](spark, SF001)
            rows, cols = [r.asDict() for r in sdf.collect()], sorted(sdf.columns)
            rel = duck.execute(E.oracle_sql()[name])
            d_cols = [d[0] for d in rel.description]
            d_rows = [dict(zip(d_cols, r)) for r in rel.fetchall()]
            assert digest(rows, cols)[0] == digest(d_rows, cols)[0], name
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_runs_remove_their_staged_tables(spark, scratch):
    """Staged Parquet under the checkpoint folder is deleted once the month is written."""
    from costloom.session import stage_root
    root = stage_root(spark).replace("file:", "")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    cat = FixtureCatalog(spark, SF001)
    jobs = [DailyJob(cat, FX.DAILY_MONTH), DetailJob(cat, FX.DETAIL_MONTH), SummaryJob(cat, "ACTUAL")]
    for i, job in enumerate(jobs):
        status = job.run(os.path.join(scratch, f"t{i}"))
        assert status["row_count"] > 0 and job.stages == []
    after = set(os.listdir(root)) if os.path.isdir(root) else set()
    assert after <= before


def test_second_run_on_one_job_sees_new_rows(spark, scratch):
    """A job object that runs again computes everything from the inputs as they are then."""
    from pyspark.sql import functions as F
    fx = FixtureCatalog(spark, SF001)
    cases = [("cost_usage_report", "line_item_usage_start_date", lambda c: DailyJob(c, FX.DAILY_MONTH)),
             ("usage_transaction", "usage_start_date", lambda c: DetailJob(c, FX.DETAIL_MONTH)),
             ("usage_transaction", "usage_start_date", lambda c: SummaryJob(c, "ACTUAL", FX.DETAIL_MONTH))]
    for i, (table, ts, make) in enumerate(cases):
        whole = getattr(fx, table)
        cat = DictCatalog(spark, {table: whole.where(F.dayofmonth(ts) <= 9)}, fallback=fx)
        job, target = make(cat), os.path.join(scratch, f"t{i}")
        job.run(target)
        few = read_target(spark, target).count()
        cat.tables[table] = whole
        job.run(target)
        many = read_target(spark, target).count()
        fresh = os.path.join(scratch, f"f{i}")
        make(cat).run(fresh)
        again, once = (read_target(spark, x).drop("t_created_date") for x in (target, fresh))
        assert many > few and again.exceptAll(once).isEmpty() and once.exceptAll(again).isEmpty()


def test_stats_of_an_unreadable_month_raise(spark, scratch):
    from costloom.plans.sink import current, data_path
    target = os.path.join(scratch, "u")
    assert month_stats(spark, target, 202401)["row_count"] == 0
    replace_month(spark.range(2).selectExpr("id", "202401 AS invoice_month", "'' AS bill_invoice_id", "timestamp_ntz'2024-01-01' AS t_created_date"), target, 202401)
    place = data_path(target, 202401, current(spark, target, 202401).name)
    for name in os.listdir(place):
        if name.endswith(".parquet"):
            with open(f"{place}/{name}", "w") as f:
                f.write("not parquet")
    with pytest.raises(Exception):
        month_stats(spark, target, 202401)
