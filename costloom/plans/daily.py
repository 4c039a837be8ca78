"""RUN1: the daily job. Hourly bill -> normalised, repriced, amortised, reallocated daily
cost rows by company, written one invoice month at a time.

Stages are DataFrames. Written as Parquet under the shared checkpoint folder are the scalars that the
flow needs first (one aggregate over a column-pruned scan of the filtered bill), the daily roll-up, which
several steps read (kube guard, infra weights, infra split), and the small weight tables, whose file
sizes then decide how they join. The much larger hourly stage flows through once without being written.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costloom import constants as K
from costloom.checks import reconcile as CHK
from costloom.checks.gates import Gate
from costloom.functions.columns import c
from costloom.operators import adhoc as ADH
from costloom.operators import amortize as AMO
from costloom.operators import fees as FEES
from costloom.operators import infra as INF
from costloom.operators import kube as KUB
from costloom.operators import rollup as R
from costloom.operators import spot as SPT
from costloom.operators.calendar import month_calendar
from costloom.operators.normalize import bill_rows, normalize_bill
from costloom.plans.job import MonthJob, Shares
from costloom.plans.stats import month_stats


def resolve_month(invoice_month: int | None, now: dt.datetime | None = None) -> int:
    """NULL/0 -> current month, -1 -> previous month, else as given."""
    now = now or dt.datetime.now()
    if not invoice_month:
        return now.year * 100 + now.month
    if invoice_month == -1:
        y, m = (now.year, now.month - 1) if now.month > 1 else (now.year - 1, 12)
        return y * 100 + m
    return int(invoice_month)


class DailyJob(MonthJob):
    label = "daily"
    invoice_col = "bill_invoice_id"

    @cached_property
    def month(self) -> int:
        return resolve_month(self.invoice_month)

    # -- (1) scan, normalise, hourly aggregate ------------------------------------------
    @cached_property
    def hourly(self) -> DataFrame:
        return normalize_bill(self.cat.cost_usage_report, self.cat.account_config, self.month, self.cfg)

    def _scalar_rows(self) -> DataFrame:
        """Row count, billing state and last transaction time (the hour roll-up changes none of
        them, so the hourly stage itself is read once and never written)."""
        rows = bill_rows(self.cat.cost_usage_report, self.cat.account_config, self.month, self.cfg)
        return FEES.stage_scalars(rows, "line_item_usage_start_date", "line_item_line_item_type", "bill_invoice_id")

    def billing_state(self) -> DataFrame:
        """STA1 as a one-row frame, from a column-pruned scan (the hour roll-up keeps the invoice id)."""
        return FEES.billing_state(bill_rows(self.cat.cost_usage_report, self.cat.account_config, self.month, self.cfg), "bill_invoice_id")

    # -- (1.a-c) future fee cut, spot pricing, zero-cost drop ----------------------------
    def after_cut(self) -> DataFrame:
        return FEES.drop_future_recurring_fees(self.hourly, self.last_trx, "line_item_usage_start_date",
                                               "line_item_line_item_type")

    def after_spot(self) -> DataFrame:
        return SPT.fill_spot_daily(self.after_cut(), self.cat.price_list, self._watch)

    def unmapped_spot(self) -> DataFrame:
        return SPT.unmapped_spot_sizes(SPT.fill_spot_daily(self.after_cut(), self.cat.price_list), self.cat.price_list)

    def after_zero(self) -> DataFrame:
        return FEES.drop_zero_cost_rows(self.after_spot())

    # -- (2) RI fee amortisation -----------------------------------------------------------
    def after_amortize(self) -> DataFrame:
        return AMO.amortize_rifee_daily(self.after_zero(), self.last_trx)

    # -- (3) ad hoc / off-hours reallocation -------------------------------------------------
    def adhoc_schedule(self) -> DataFrame:
        return ADH.adhoc_schedule(self.cat.adhoc_billing, self.cat.adhoc_billing_instance,
                                  self.cat.adhoc_billing_schedule_hours, month_calendar(self.spark, self.month),
                                  self.month)

    @cached_property
    def _alloc(self) -> DataFrame:
        return self._keep(ADH.adhoc_weights(self.adhoc_schedule(), self.adhoc_scope), "adhoc")

    def adhoc_alloc(self) -> DataFrame:
        return self._alloc

    def after_adhoc(self) -> DataFrame:
        measures = {m: K.MONEY for m in ("line_item_unblended_cost", "pricing_public_on_demand_cost",
                                         "line_item_usage_amount")}
        return ADH.reallocate_adhoc(self.after_amortize(), self.adhoc_alloc(),
                                    account_col="line_item_usage_account_id", name_col="resource_tags_user_name",
                                    ts_col="line_item_usage_start_date", type_col="line_item_line_item_type",
                                    company_col="resource_tags_user_company", measures=measures,
                                    skip_types=K.FEE_TYPES, note=K.NOTE_ADHOC_DAILY, cfg=self.cfg)

    # -- (4) daily grain, on-demand backfill ---------------------------------------------------
    def rolled(self) -> DataFrame:
        return R.daily_rollup(self.after_adhoc())

    @cached_property
    def backfilled(self) -> DataFrame:
        return self._keep(FEES.backfill_zero_ondemand(self.rolled()), "daily")

    # -- (5) kube ------------------------------------------------------------------------------
    def kube_weights(self) -> DataFrame:
        return KUB.kube_weights(self.cat.kube_monthly_namespace_usage, self.cat.kube_namespace_product_mapping,
                                self.month, daily_notes=True, cfg=self.cfg)

    @cached_property
    def kube_alloc(self) -> DataFrame:
        """The month's weights, none unless a Regional row carries a literal kube product (the
        reference's first guard, part of the plan; it matters, as replacement targets any weighted
        product. Its second guard, usage rows of the month, holds by itself: no rows, no weights)."""
        guarded = KUB.kube_guard_rows("line_item_usage_account_id", "resource_tags_user_company", "resource_tags_user_product", self.cfg)
        has_rows = self.backfilled.where(guarded).agg((F.count(F.lit(1)) > 0).alias("has_rows")).scalar()
        return self._keep(self.kube_weights().where(has_rows), "kube")

    def after_kube(self) -> DataFrame:
        return KUB.reallocate_kube_daily(self.backfilled, self.kube_alloc, cfg=self.cfg)

    # -- (6) upfront fee rows ------------------------------------------------------------------
    def upfront_rows(self) -> DataFrame:
        return R.upfront_fee_rows(self.cat.upfront_purchases_amortization_schedule, self.cat.account_config,
                                  self.month, self.last_trx, self.cfg)

    def after_upfront(self) -> DataFrame:
        return self.after_kube().unionByName(self.upfront_rows(), allowMissingColumns=True)

    # -- (7) infra -----------------------------------------------------------------------------
    def infra_weights(self) -> DataFrame:
        return INF.infra_weights_daily(self.after_upfront(), self.cat.azure_cost_summary, self.month, self.cfg)

    @cached_property
    def infra_alloc(self) -> DataFrame:
        return self._keep(self.infra_weights(), "infra")

    def after_infra(self) -> DataFrame:
        return INF.redistribute_infra_daily(self.after_upfront(), self.infra_alloc, self.cfg)

    # -- (999) output ----------------------------------------------------------------------------
    def output(self) -> DataFrame:
        return R.daily_output(self.after_infra())

    def gates(self, written: DataFrame) -> list[Gate]:
        """Infra weights add up to one (CHK3), and the split leaves the cost as it was (CHK4)."""
        total = self.infra_alloc.agg(F.sum("retail_weight").alias("w"), F.count(F.lit(1)).alias("n")).first()
        out = [*self.adhoc_gates(), Shares(total["w"], total["w"] or Decimal(0), total["n"]).gate()]
        sides = {r["src"]: r for r in CHK.infra_totals_daily(self.after_upfront(), written, self.cfg).collect()}
        # each written row is rounded once at the scale of the measure
        for m in ("line_item_unblended_cost", "pricing_public_on_demand_cost", "line_item_usage_amount") if total["n"] else ():
            before, after = (sides[k][m] if k in sides else None for k in ("ORIGINAL", "ALLOCATED"))
            out.append(Gate(f"infra {m}", after, before, max(Decimal("0.001"), abs(before or 0) * Decimal("1e-9"))))
        return out

    def _empty(self) -> dict | None:
        if self.scalars["rows"]:
            return None
        return {"invoice_month": self.month, "error": f"No bill rows exist for invoice month {self.month}", "row_count": 0}

    def _status(self) -> dict:
        return {"invoice_month": self.month, "trx_source": self.scalars["trx_source"], "error": ""}

    def run(self, target: str | None = None, mode: str = "PROCESS_DATA") -> dict:
        """``PROCESS_DATA`` (any case): compute and, if ``target``, replace the month in the target
        dataset. ``STATS_ONLY``: the month's stats from the target, nothing recomputed."""
        if mode.upper() == "STATS_ONLY":
            return daily_stats_only(self.spark, target, self.month)
        if mode.upper() != "PROCESS_DATA":
            raise ValueError(f"mode must be PROCESS_DATA or STATS_ONLY, not {mode!r}")
        return super().run(target)


def daily_stats_only(spark, target: str, invoice_month: int | None) -> dict:
    """``STATS_ONLY`` mode: the month's stats from the target, nothing recomputed."""
    m = resolve_month(invoice_month)
    return {"invoice_month": m, **month_stats(spark, target, m, invoice_col="bill_invoice_id")}
