"""Registered queries: one per operator of the inventory, each over the driver testdata.

Every query runs a job (or part of one) on the fixture catalog and ends with the same
``comparable`` projection as its oracle SQL: numeric columns rounded, then DOUBLE, so
the two engines' decimal typing does not decide the comparison.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costloom.sources import fixture_defs as FX
from costloom.sources.catalog import FixtureCatalog

M4 = ("line_item_unblended_cost", "pricing_public_on_demand_cost", "line_item_usage_amount")


@dataclass
class QuerySpec:
    name: str
    spark: Callable[[SparkSession, str], DataFrame]
    oracle: Callable[[], str] | None
    numeric: dict[str, int] = field(default_factory=dict)
    columns: list[str] | None = None


def comparable(df: DataFrame, numeric: dict[str, int], columns: list[str] | None = None) -> DataFrame:
    if columns:
        df = df.select(*columns)
    return df.select(*[F.round(F.col(c), numeric[c]).cast("double").alias(c) if c in numeric else F.col(c)
                       for c in df.columns])


def fixture_catalog(spark: SparkSession, sf_dir: str) -> FixtureCatalog:
    return FixtureCatalog(spark, sf_dir)


def daily_job(spark: SparkSession, sf_dir: str, scope: str = "instance"):
    from costloom.plans.daily import DailyJob
    return DailyJob(fixture_catalog(spark, sf_dir), FX.DAILY_MONTH, adhoc_scope=scope)


def detail_job(spark: SparkSession, sf_dir: str, month: int | None = FX.DETAIL_MONTH):
    from costloom.plans.detail import DetailJob
    return DetailJob(fixture_catalog(spark, sf_dir), month)


def summary_job(spark: SparkSession, sf_dir: str, source: str):
    from costloom.plans.summary import SummaryJob
    month = FX.DETAIL_MONTH if source == "ACTUAL" else None
    return SummaryJob(fixture_catalog(spark, sf_dir), source, month)


def _specs() -> list[QuerySpec]:
    """One row a query: name, Spark frame, the oracle's step, rounded columns."""
    from oracle import daily as OD
    from oracle import monthly as OM
    from oracle.sqltext import comparable as compared

    m3, rq = {c: 4 for c in M4}, {"retail_cost": 4, "quantity": 4}
    rates = {**m3, "line_item_unblended_rate": 10, "pricing_public_on_demand_rate": 10}
    shares = {"pricing_public_on_demand_cost": 4, "retail_weight": 10}
    daily = [
        ("nrm1_normalize", lambda j: j.hourly, "hours", m3),
        ("sta1_state", lambda j: j.billing_state(), "invoiced", {}),
        ("cut1_future_fee", lambda j: j.after_cut(), "running", m3),
        ("spt1_daily", lambda j: j.after_spot(), "priced", m3),
        ("spt2_unmapped", lambda j: j.unmapped_spot(), "unpriced", {}),
        ("zer1_drop", lambda j: j.after_zero(), "costing", m3),
        ("amo1_rifee", lambda j: j.after_amortize(), "sliced", m3),
        ("adh2_realloc_instance", lambda j: j.after_adhoc(), "paid", m3),
        ("adh2_realloc_account", lambda j: j.after_adhoc(), "paid", m3),
        ("dly1_rollup", lambda j: j.rolled(), "days", m3),
        ("bkf1_zero", lambda j: j.backfilled, "filled", m3),
        ("kub2_daily", lambda j: j.after_kube(), "clustered", m3),
        ("upf1_rows", lambda j: j.after_upfront(), "with_fees", m3),
        ("inf1_weights", lambda j: j.infra_weights(), "cloud_shares", shares),
        ("inf2_daily", lambda j: j.after_infra(), "spread", m3),
        ("run1_daily", lambda j: j.output(), "daily_rows", rates),
    ]
    detail = [
        ("mon2_latest", lambda j: j.latest_month(), "(SELECT max(year(usage_start_date) * 100 + month(usage_start_date)) AS invoice_month "
                                                   "FROM usage_transaction)", {}),
        ("nrm2_normalize", lambda j: j.normalized(), "lines", rq),
        ("spt1_detail", lambda j: j.after_spot(), "priced", rq),
        ("zer1_detail", lambda j: j.after_zero(), "costing", rq),
        ("adh2_detail", lambda j: j.after_adhoc(), "paid", rq),
        ("det1_rollup", lambda j: j.rolled, "grouped", rq),
        ("inf1_weights_detail", lambda j: j.infra_weights(), "company_shares", {"retail_cost": 4, "weight": 10}),
        ("inf2_detail", lambda j: j.after_infra(), "spread", rq),
        ("run2_detail", lambda j: j.output(), "detail_rows", {"retail_cost": 4, "quantity": 8}),
    ]
    trx = {x: 4 for x in ("unblended_cost", "ondemand_cost", "quantity", "ri_normalizationfactor", "normalizationfactor")}
    agg = {"actual_cost": 4, "retail_cost": 4}
    fin = {**agg, "weighted_actual_cost": 4, "retail_cost_percent": 8}
    out = {**fin, "weighted_upfront_rifee_actual_cost": 4}
    summary = [
        ("nrm3_{}", lambda j: j.normalized, "lines", trx),
        ("spt1_summary_{}", lambda j: j.after_spot(), "priced", trx),
        ("spt2_unmapped_{}", lambda j: j.unmapped_spot(), "unpriced", {}),
        ("adh2_summary_{}", lambda j: j.after_adhoc(), "paid", trx),
        ("sum1_rollup_{}", lambda j: j.rolled(), "products", agg),
        ("kub2_summary_{}", lambda j: j.after_kube(), "clustered", agg),
        ("wgt1_weighted_{}", lambda j: j.weighted, "weighted", fin),
        ("inf2_summary_{}", lambda j: j.after_infra(), "spread", fin),
        ("upf2_column_{}", lambda j: j.with_upfront(), "with_fees", out),
        ("run3_{}", lambda j: j.output(), "summary_rows", out),
    ]

    def spec(name, job, frame, steps, rel, numeric) -> QuerySpec:
        return QuerySpec(name, lambda s, d: frame(job(s, d)), lambda: steps().final(compared(rel, numeric)), numeric)

    specs = []
    for name, frame, rel, numeric in daily:
        scope = "account" if name.endswith("_account") else "instance"
        specs.append(spec(name, lambda s, d, scope=scope: daily_job(s, d, scope), frame, lambda scope=scope: OD.steps(FX.DAILY_MONTH, scope), rel, numeric))
    specs += [spec(n, detail_job, f, OM.detail_steps, r, k) for n, f, r, k in detail]
    for source in ("ACTUAL", "ESTIMATED"):
        for name, frame, rel, numeric in summary + ([("amo1_{}", lambda j: j.after_amortize(), "sliced", trx)] if source == "ESTIMATED" else []):
            specs.append(spec(name.format(source.lower()), lambda s, d, source=source: summary_job(s, d, source), frame,
                              lambda source=source: OM.summary_steps(source), rel, numeric))
    return specs + _check_specs()


def _check_specs() -> list[QuerySpec]:
    """Reconciliation checks over job stages and written months (data-derived ones only; the
    config-only weight totals CHK2/CHK6 are covered by tests)."""
    from costloom import constants as K
    from costloom.checks import reconcile as CHK
    from costloom.plans.sink import read_target
    from costloom.plans.stats import month_stats_frame
    from oracle import checks as OC

    def chk1(s, d):
        job = daily_job(s, d)
        return CHK.adhoc_balance(job.after_amortize(), job.after_adhoc(), job.adhoc_alloc(),
                                 account_col="line_item_usage_account_id", name_col="resource_tags_user_name",
                                 ts_col="line_item_usage_start_date", type_col="line_item_line_item_type",
                                 measure="line_item_unblended_cost", skip_types=K.FEE_TYPES, note=K.NOTE_ADHOC_DAILY)

    def chk4(s, d):
        job = daily_job(s, d)
        return CHK.infra_totals_daily(job.after_upfront(), job.after_infra())

    def written(s, job) -> DataFrame:
        """The month as the job's sink leaves it."""
        from costloom.session import own, stage_root
        target = own(s, f"{stage_root(s)}/target-{uuid.uuid4().hex}")
        job.run(target)
        return read_target(s, target)

    def stt1(s, d):
        return month_stats_frame(written(s, daily_job(s, d)), FX.DAILY_MONTH).drop("created_date")

    def chk10(s, d):
        return CHK.rows_per_month(written(s, summary_job(s, d, "ACTUAL")).unionByName(written(s, summary_job(s, d, "ESTIMATED"))))

    def joi4(s, d):
        return detail_job(s, d).normalized().groupBy("user_name", "user_company", "usage_date").agg(F.count(F.lit(1)).alias("n"))

    spot_n = {x: 4 for x in ("quantity", "unblended_cost", "ondemand_cost", "unblended_rate_calc",
                             "ondemand_rate_calc", "savings_percent")}
    chk5_n = {"actual_cost": 4, "weighted_actual_cost": 4, "retail_cost": 4, "savings": 4, "actual_diff": 4,
              "total_weight": 8}
    return [
        QuerySpec("chk1_adhoc_balance", chk1, OC.chk1, {"difference": 4}),
        QuerySpec("chk3_infra_weight_total", lambda s, d: CHK.weight_total(daily_job(s, d).infra_weights(), "retail_weight"),
                  OC.chk3, {"total_weight": 8}),
        QuerySpec("chk4_infra_totals", chk4, OC.chk4, {m: 4 for m in M4}),
        QuerySpec("chk5_weighted_actual", lambda s, d: CHK.weighted_actual_totals(summary_job(s, d, "ACTUAL").weighted),
                  OC.chk5, chk5_n),
        QuerySpec("chk7_spot_savings", lambda s, d: CHK.spot_savings(daily_job(s, d).after_spot()), OC.chk7, spot_n),
        QuerySpec("chk8_zero_retail", lambda s, d: CHK.zero_retail_rows(detail_job(s, d).rolled), OC.chk8,
                  {"quantity": 4}),
        QuerySpec("chk9_amortized_per_day", lambda s, d: CHK.amortized_fee_per_day(daily_job(s, d).after_amortize()),
                  OC.chk9, {"amort_unblended_cost": 4}),
        QuerySpec("chk10_rows", chk10, OC.chk10),
        QuerySpec("stt1_stats", stt1, OC.stt1),
        QuerySpec("joi4_interval", joi4, OC.joi4),
    ]


def registry() -> dict[str, QuerySpec]:
    return {s.name: s for s in _specs()}


def spark_query(spec: QuerySpec) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(spec.spark(spark, sf_dir), spec.numeric, spec.columns)
    run.__name__ = spec.name
    return run
