"""RUN3: the monthly summary job, ``ACTUAL`` (one invoiced month) or ``ESTIMATED`` (the
running month held by the estimated transactions).

One large stage is written: the retail-weighted final stage (infra weights and infra split both read it).
Scalars (rows, month, first and last transaction time) are a one-row stage from a column-pruned scan of the
filtered transactions, so the transaction-grain stage flows through once without being written."""

from __future__ import annotations

from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costloom import constants as K
from costloom.checks.gates import Gate
from costloom.functions.columns import c, month_of
from costloom.operators import adhoc as ADH
from costloom.operators import amortize as AMO
from costloom.operators import fees as FEES
from costloom.operators import infra as INF
from costloom.operators import kube as KUB
from costloom.operators import rollup as R
from costloom.operators import spot as SPT
from costloom.operators.calendar import month_calendar
from costloom.operators.normalize import normalize_summary, transaction_rows
from costloom.plans.detail import resolve_latest
from costloom.plans.job import MonthJob
from costloom.settings import DEFAULTS, Settings
from costloom.sources.catalog import Catalog


class SummaryJob(MonthJob):
    def __init__(self, catalog: Catalog, source: str, invoice_month: int | None = None,
                 adhoc_scope: str = "instance", checkpoint: bool = True, settings: Settings = DEFAULTS):
        if source not in ("ACTUAL", "ESTIMATED"):
            raise ValueError(f"source must be ACTUAL or ESTIMATED, not {source!r}")
        super().__init__(catalog, invoice_month, adhoc_scope, checkpoint, settings)
        self.source = source
        self.estimated = source == "ESTIMATED"
        self.label = f"summary-{source.lower()}"

    @cached_property
    def requested_month(self) -> int | None:
        """ACTUAL: a month that is not given is looked up, which is an action."""
        return None if self.estimated else resolve_latest(self.cat, self.invoice_month)

    @cached_property
    def normalized(self) -> DataFrame:
        c_ = self.cat
        if self.estimated:
            df = normalize_summary(c_.usage_transaction_estimated, c_.account_config, c_.rifee_estimated,
                                   c_.resource_user_estimated, c_.resource_tag, "ESTIMATED", None, self.cfg,
                                   span=(self.scalar("first_trx"), self.scalar("newest_trx")), keep=self._keep)
        else:
            df = normalize_summary(c_.usage_transaction, c_.account_config, c_.rifee, c_.resource_user,
                                   c_.resource_tag, "ACTUAL", self.requested_month, self.cfg, keep=self._keep)
        return df

    def _scalar_rows(self) -> DataFrame:
        """Rows, month, first and last transaction time (ESTIMATED ignores the recurring savings-plan
        fee for the last, ACTUAL takes every row). Estimated transactions of more than one month raise."""
        trx = self.cat.usage_transaction_estimated if self.estimated else self.cat.usage_transaction
        rows = transaction_rows(trx, self.cat.account_config, None if self.estimated else self.requested_month)
        ts, t = c("usage_start_date"), c("lineitem_type")
        last = F.max(F.when(t != K.SP_RECURRING_FEE, ts)) if self.estimated else F.max(ts)
        month = (F.year(ts) * 100 + F.month(ts)).cast("int")
        many = F.raise_error(F.lit("estimated transactions hold more than one invoice month")).cast("int")
        one = F.when(F.min(month) < F.max(month), many).otherwise(F.max(month)) if self.estimated else F.lit(self.requested_month).cast("int")
        return rows.agg(F.count(F.lit(1)).alias("rows"), last.alias("last_trx"), F.min(ts).alias("first_trx"), F.max(ts).alias("newest_trx"), one.alias("month"))

    @property
    def month(self) -> Column | int | None:
        """A number, or for the estimated table a scalar of the plan."""
        return self.scalar("month") if self.estimated else self.requested_month

    def _month_number(self) -> int | None:
        return self.scalars["month"] if self.estimated else self.requested_month

    def after_cut(self) -> DataFrame:
        if not self.estimated:
            return self.normalized
        return FEES.drop_future_recurring_fees(self.normalized, self.last_trx, "usage_date_hour", "lineitem_type")

    def unmapped_spot(self) -> DataFrame:
        return SPT.unmapped_spot_sizes(self.after_cut(), self.cat.price_list, "instance_size", "lineitem_type",
                                       "usage_type")

    def after_spot(self) -> DataFrame:
        return SPT.reprice_spot_summary(self.after_cut(), self.cat.price_list, self._watch)

    def after_amortize(self) -> DataFrame:
        if not self.estimated:
            return self.after_spot()
        return AMO.amortize_rifee_estimated(self.after_spot(), self.last_trx)

    @cached_property
    def _alloc(self) -> DataFrame:
        sched = ADH.adhoc_schedule(self.cat.adhoc_billing, self.cat.adhoc_billing_instance,
                                   self.cat.adhoc_billing_schedule_hours, month_calendar(self.spark, self.month),
                                   self.month)
        return self._keep(ADH.adhoc_weights(sched, self.adhoc_scope), "adhoc")

    def adhoc_alloc(self) -> DataFrame:
        return self._alloc

    def after_adhoc(self) -> DataFrame:
        return ADH.reallocate_adhoc(self.after_amortize(), self.adhoc_alloc(), account_col="account_id",
                                    name_col="user_name", ts_col="usage_date_hour", type_col="lineitem_type",
                                    company_col="user_company",
                                    measures={"unblended_cost": K.MONEY, "ondemand_cost": K.MONEY, "quantity": K.MONEY},
                                    skip_types=K.FEE_TYPES, note=K.NOTE_ADHOC_SUMMARY, cfg=self.cfg)

    def rolled(self) -> DataFrame:
        return R.summary_rollup(self.after_adhoc())

    def kube_weights(self) -> DataFrame:
        return KUB.kube_weights(self.cat.kube_monthly_namespace_usage, self.cat.kube_namespace_product_mapping,
                                self.month, daily_notes=False, cfg=self.cfg)

    @cached_property
    def kube_alloc(self) -> DataFrame:
        return self._keep(self.kube_weights(), "kube")

    def after_kube(self) -> DataFrame:
        """The reference's second guard matters here: with no kube usage for the month the
        kube rows stay; with usage, unweighted kube products lose their cost (Q14)."""
        usage = self.cat.kube_monthly_namespace_usage.where(c("month_id") == month_of(self.month))
        has_usage = usage.agg((F.count(F.lit(1)) > 0).alias("has_usage")).scalar()
        return KUB.reallocate_kube_summary(self.rolled(), self.kube_alloc, has_usage, cfg=self.cfg)

    @cached_property
    def weighted(self) -> DataFrame:
        weighed = R.weight_actual_cost(self.after_kube(), self.cat.account_config, self._keep)
        return self._keep(self._watch(weighed, "weighted", F.sum("actual_cost").alias("actual"), F.sum("weighted_actual_cost").alias("spread"),
                                      F.count(F.lit(1)).alias("rows")), "final")

    def infra_weights(self) -> DataFrame:
        return INF.infra_weights_monthly(self.weighted, self.cat.azure_cost_summary, self.month, self.cfg)

    @cached_property
    def infra_alloc(self) -> DataFrame:
        return self._keep(self.infra_weights(), "infra")

    def after_infra(self) -> DataFrame:
        return INF.redistribute_infra_summary(self.weighted, self.infra_alloc, self.cfg)

    def with_upfront(self) -> DataFrame:
        return R.upfront_fee_column(self.after_infra(), self.cat.rifee_amortization_schedule, self.month,
                                    self.last_trx, self.cfg)

    def output(self) -> DataFrame:
        return R.summary_output(self.with_upfront(), self.last_trx)

    def gates(self, written: DataFrame) -> list[Gate]:
        """Weighted actual cost adds up to actual cost (CHK5); infra weights to one (CHK3); what the split
        left and dropped is what the final stage had (CHK4). Rows are written at four places."""
        spread = self._fact("weighted")
        even = Gate("weighted actual cost", spread["spread"], spread["actual"], Decimal("1e-6") * max(spread["rows"], 1))
        before, shares = self.infra_split(self.weighted, ("actual_cost", "weighted_actual_cost"))
        after = written.agg(F.count(F.lit(1)).alias("n"), *[F.sum(m).alias(m) for m in before]).first()
        size = Decimal("0.00005") * max(after["n"], 1) + Decimal("1e-6") * max(spread["rows"], 1)
        whole = [Gate(f"written {m}", after[m], rest + target * shares.kept, size) for m, (rest, target) in before.items()]
        return [*self.adhoc_gates(), even, shares.gate(), *whole]

    def _empty(self) -> dict | None:
        if self.estimated or self.requested_month is not None:
            if self.scalars["rows"]:
                return None
        month = self.scalars["month"] if self.estimated else self.requested_month
        return {"invoice_month": month, "trx_source": self.source, "row_count": 0, "error": f"No transactions for invoice month {month} ({self.source})"}

    def _status(self) -> dict:
        return {"invoice_month": self._month_number(), "trx_source": self.source, "error": ""}
